"""Queries on protection, contents against bodies, words read as several, and nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify, nesting
from ..operators import fold, more, preambles, protection, runs, vote
from ..sources import sinks
from .catalog import TOKENS, doc_tokens, query, said, table

# protection: rich customers protect their open orders, those their returned lines, and these part and supplier

REFERENCES = """r AS (
  SELECT 'customer' AS kind, o_custkey AS id, 'order' AS to_kind, o_orderkey AS to_id FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'order', l_orderkey, 'line', l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'line', l_orderkey * 10 + l_linenumber, 'part', l_partkey FROM lineitem
  UNION ALL SELECT 'line', l_orderkey * 10 + l_linenumber, 'supplier', l_suppkey FROM lineitem
), m(kind, id, hops) AS (
  SELECT 'customer', c_custkey, 0 FROM customer WHERE c_acctbal > 9000
  UNION SELECT r.to_kind, r.to_id, m.hops + 1 FROM m JOIN r ON r.kind = m.kind AND r.id = m.id
)"""


def references(spark, d) -> DataFrame:
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    lines = table(spark, d, "lineitem")
    edge = lambda t, kind, key, to, to_key: t.select(F.lit(kind).alias("kind"), key.alias("id"), F.lit(to).alias("to_kind"), to_key.alias("to_id"))
    parts = [
        edge(table(spark, d, "orders").where("o_orderstatus = 'O'"), "customer", F.col("o_custkey"), "order", F.col("o_orderkey")),
        edge(lines.where("l_returnflag = 'R'"), "order", F.col("l_orderkey"), "line", line),
        edge(lines, "line", line, "part", F.col("l_partkey")),
        edge(lines, "line", line, "supplier", F.col("l_suppkey")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def marks(spark, d) -> DataFrame:
    seeds = table(spark, d, "customer").where("c_acctbal > 9000").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"))
    return protection.protected(seeds, references(spark, d))


@query(f"WITH RECURSIVE {REFERENCES} SELECT kind, id, min(hops) AS hops FROM m GROUP BY kind, id")
def protected_records(spark, d):
    return marks(spark, d)


@query(
    f"""WITH RECURSIVE {REFERENCES}, k AS (SELECT DISTINCT kind, id FROM m)
SELECT 'order' AS kind, o_orderkey AS id FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderkey IN (SELECT id FROM k WHERE kind = 'order')
UNION ALL SELECT 'part', p_partkey FROM part WHERE p_size >= 25 OR p_partkey IN (SELECT id FROM k WHERE kind = 'part')
UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE s_suppkey IN (SELECT id FROM k WHERE kind = 'supplier')"""
)
def kept_records(spark, d):
    found = marks(spark, d)
    stays = [
        ("order", "o_orderkey", protection.unprotected_rows({"order": (table(spark, d, "orders"), "o_orderkey")}, found, "o_orderpriority = '5-LOW'")),
        ("part", "p_partkey", protection.unprotected_rows({"part": (table(spark, d, "part"), "p_partkey")}, found, "p_size < 25")),
        ("supplier", "s_suppkey", protection.unprotected_rows({"supplier": (table(spark, d, "supplier"), "s_suppkey")}, found)),
    ]
    rows = [t[kind].select(F.lit(kind).alias("kind"), F.col(key).alias("id")) for kind, key, t in stays]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# contents: a supplier's accepted and returned lines by date; body: returned ones, those at 10 % off last, and others

SIDES = """s AS (
  SELECT l_suppkey AS doc_id, l_returnflag AS flag, l_discount >= 0.1 AS late, l_orderkey * 10 + l_linenumber AS name, min(l_shipdate) AS day FROM lineitem GROUP BY ALL
), u AS (
  SELECT * FROM s QUALIFY count(*) OVER (PARTITION BY doc_id, name) = 1
)"""


def sides(spark, d) -> DataFrame:
    name = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("doc_id"), F.col("l_returnflag").alias("flag"), (F.col("l_discount") >= 0.1).alias("late"), name.alias("name")).agg(F.min("l_shipdate").alias("day"))
    n = F.count("*").over(Window.partitionBy("doc_id", "name"))
    return lines.withColumn("n", n).where("n = 1").withColumn("header", F.concat(F.lit("line "), F.col("name").cast("string")))


@query(
    f"""WITH {SIDES}, o AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY day, name) AS p FROM u WHERE flag = 'R'
), c AS (
  SELECT doc_id, p, count(*) FILTER (WHERE NOT late) OVER (PARTITION BY doc_id ORDER BY p) + count(*) FILTER (WHERE late) OVER (PARTITION BY doc_id) - count(*) FILTER (WHERE late) OVER (PARTITION BY doc_id ORDER BY p) AS kept,
    count(*) FILTER (WHERE late) OVER (PARTITION BY doc_id) AS n_late, count(*) OVER (PARTITION BY doc_id) AS n FROM o
), k AS (SELECT doc_id, greatest(max(kept), max(n_late)) AS kept, max(n) AS n FROM c GROUP BY doc_id),
t AS (SELECT doc_id, count(*) FILTER (WHERE flag = 'A') AS dropped, count(*) FILTER (WHERE flag = 'N') AS inserted FROM u GROUP BY doc_id)
SELECT t.doc_id, 2 * coalesce(k.kept, 0) AS kept, 2 * (coalesce(k.n, 0) - coalesce(k.kept, 0)) AS moved, t.dropped, t.inserted FROM t LEFT JOIN k ON k.doc_id = t.doc_id"""
)
def contents_against_body(spark, d):
    s = sides(spark, d)
    number = lambda *order: F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)).alias("item")
    contents = s.where("flag <> 'N'").select("doc_id", number("day", "name"), "header")
    body = s.where("flag <> 'A'").select("doc_id", number(F.col("late") & (F.col("flag") == "R"), "day", "name"), "header")
    states = fold.fold_contents(contents, body)
    count = lambda state: F.count(F.when(F.col("state") == state, 1)).alias(state)
    return states.groupBy("doc_id").agg(*(count(x) for x in ("kept", "moved", "dropped", "inserted")))


@query(
    """WITH i AS (
  SELECT l_suppkey AS doc_id, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS INT) AS item, substr(regexp_replace(CAST(l_partkey AS VARCHAR), '[^A-Za-z0-9]', '', 'g'), 1, 41) AS key FROM lineitem
), p AS (
  SELECT doc_id, item, lead(item) OVER (PARTITION BY doc_id, key ORDER BY item) AS partner, item // 40 AS page FROM i
), c AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, page) AS n FROM p WHERE partner IS NOT NULL
)
SELECT doc_id, min(item) AS first, arg_min(partner, item) AS rest FROM c WHERE n >= 5 GROUP BY doc_id"""
)
def contents_bounds(spark, d):
    w = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    items = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc_id"), F.row_number().over(w).alias("item"), F.col("l_partkey").cast("string").alias("header"))
    return fold.contents_bounds(items.withColumn("page", F.floor(F.col("item") / 40).cast("int")))


# engines: one reads words of ten letters and more in two pieces, and two short words as one

WORDS_OF_LINES = """w AS (SELECT doc_id, [x FOR x IN string_split_regex(text, '\\s+') IF x <> ''] AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS text, CAST(generate_subscripts(w, 1) - 1 AS INT) AS sn FROM w),
a AS (
  SELECT doc_id, sn, CAST(sn // 8 AS INT) AS line, sn % 8 AS col, text, length(text) AS n, lead(text) OVER (PARTITION BY doc_id, sn // 8 ORDER BY sn) AS after FROM t
), k AS (
  SELECT *, n >= 10 AS split, col % 2 = 0 AND n <= 3 AND length(after) <= 3 AS joined FROM a
)"""


def lines_of_words(spark, d) -> DataFrame:
    """Words with the one after them on their line (after), and whether they are split, joined with it, or joined with the one before (second); no window, as a text's words lie together."""
    words = table(spark, d, "documents").select("doc_id", F.filter(F.split("text", r"\s+"), lambda x: x != "").alias("w")).where(F.size("w") > 0)
    before, after = F.concat(F.array(F.lit(None).cast("string")), F.slice("w", 1, F.size("w") - 1)), F.slice("w", 2, F.size("w"))
    t = words.select("doc_id", F.posexplode(F.arrays_zip(F.col("w").alias("text"), before.alias("before"), after.alias("after"))).alias("sn", "z")).select("doc_id", "sn", "z.*")
    t = t.withColumns({"line": F.floor(F.col("sn") / 8).cast("int"), "col": F.col("sn") % 8, "n": F.length("text")})
    short = lambda c: F.length(c) <= 3
    second = (F.col("col") % 2 == 1) & short("before") & short("text")
    return t.withColumns({"split": F.col("n") >= 10, "joined": (F.col("col") % 2 == 0) & short("text") & short("after"), "second": second, "x1": F.col("col") * 1000, "page": F.lit(1)})


@query(
    f"""WITH {WORDS_OF_LINES}, r AS (
  SELECT doc_id, 1 AS page, line, sn AS first_a, CASE WHEN split THEN sn ELSE sn + 1 END AS last_a, 2 * sn AS first_b, CASE WHEN split THEN 2 * sn + 1 ELSE 2 * sn END AS last_b,
    CASE WHEN split THEN text ELSE text || ' ' || after END AS text_a, CASE WHEN split THEN substr(text, 1, n // 2) || '- ' || substr(text, n // 2 + 1) ELSE text || after END AS text_b,
    CASE WHEN split THEN regexp_full_match(text, '[A-Za-z]+') ELSE regexp_full_match(text || after, '[A-Za-z]+') END AS plain, split,
    CASE WHEN split THEN CAST(60 + (sn * 7) % 40 AS DOUBLE) ELSE (60 + (sn * 7) % 40 + 60 + ((sn + 1) * 7) % 40) / 2.0 END AS conf_a, CAST(60 + (sn * 5) % 40 AS DOUBLE) AS conf_b
  FROM k WHERE split OR joined
), v AS (SELECT *, CASE WHEN split AND plain OR conf_a >= conf_b THEN 'a' ELSE 'b' END AS chosen FROM r)
SELECT doc_id, page, line, first_a, last_a, first_b, last_b, text_a, text_b, chosen, CASE WHEN chosen = 'a' THEN text_a ELSE text_b END AS chosen_text FROM v"""
)
def words_read_as_several(spark, d):
    t = lines_of_words(spark, d).where("split or joined or second")
    letters = lambda c: c.rlike("^[A-Za-z]+$")
    conf = lambda k: (60 + (F.col("sn") * k) % 40).cast("int")
    cols = ["doc_id", "page", "line"]
    a = t.select(*cols, "sn", "text", "x1", (F.col("x1") + 800).alias("x2"), conf(7).alias("conf"), letters(F.col("text")).alias("known"))
    half = F.floor(F.col("n") / 2).cast("int")
    first = F.when(F.col("split"), F.concat(F.substr("text", F.lit(1), half), F.lit("-"))).otherwise(F.concat("text", "after"))
    second = F.when(F.col("split"), F.substr("text", half + 1))
    piece = lambda s, nth, lo, hi: F.struct(s.alias("text"), (2 * F.col("sn") + nth).cast("int").alias("nth"), (F.col("x1") + lo).alias("x1"), (F.col("x1") + hi).alias("x2"))
    whole = F.when(F.col("split"), F.array(piece(first, 0, 0, 390), piece(second, 1, 410, 800))).otherwise(F.array(piece(first, 0, 0, 1800)))
    b = t.where("split or joined").select(*cols, conf(5).alias("conf"), F.explode(whole).alias("p"))
    b = b.select(*cols, F.col("p.nth").alias("sn"), "p.text", "p.x1", "p.x2", "conf", letters(F.col("p.text")).alias("known"))
    return runs.matched_runs(a, b)


# nesting: four letters of the documents stand for brackets, quotation marks are as they are


@query(
    r"""WITH b AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(translate(text, 'ensi', '{}[]'), '\\.', '', 'g'), '"[^"]*("|$)', '', 'g'), '[^{}\[\]()]', '', 'g') AS b FROM documents
), c AS (
  SELECT doc_id, unnest(string_split(b, '')) AS c, generate_subscripts(string_split(b, ''), 1) AS i FROM b
), s AS (
  SELECT doc_id, i, sum(CASE WHEN c IN ('{', '[', '(') THEN 1 WHEN c <> '' THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM c
), e AS (SELECT doc_id, CAST(arg_max(depth, i) AS INT) AS balance, CAST(least(0, min(depth)) AS INT) AS least FROM s GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(e.balance, 0) END AS balance, CASE WHEN d.text IS NOT NULL THEN coalesce(e.least, 0) END AS least FROM documents d LEFT JOIN e ON e.doc_id = d.doc_id"""
)
def nested_texts(spark, d):
    brackets = F.translate("text", "ensi", "{}[]")
    return table(spark, d, "documents").select("doc_id", nesting.nesting(brackets).alias("n")).select("doc_id", "n.balance", "n.least")


# where documents come from: orders lie in the folder of their customer, that in a nation's, that belongs to a region


def folder_tree(spark, d) -> tuple[DataFrame, DataFrame]:
    """Folders (id, parent_id, org_id) and assignments (folder_id, org_id, country)."""
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    name = lambda letter, key: F.concat(F.lit(letter), F.col(key).cast("string"))
    none = F.lit(None).cast("string")
    folders = c.select(name("c", "c_custkey").alias("id"), name("n", "c_nationkey").alias("parent_id"), none.alias("org_id"))
    folders = folders.unionByName(n.select(name("n", "n_nationkey").alias("id"), none.alias("parent_id"), name("r", "n_regionkey").alias("org_id")))
    assigned = c.where("c_acctbal < 0").select(name("c", "c_custkey").alias("folder_id"), none.alias("org_id"), F.col("c_mktsegment").alias("country"))
    assigned = assigned.unionByName(n.where("n_nationkey < 10").select(name("n", "n_nationkey").alias("folder_id"), none.alias("org_id"), F.col("n_name").alias("country")))
    assigned = assigned.unionByName(r.where("r_regionkey > 1").select(none.alias("folder_id"), name("r", "r_regionkey").alias("org_id"), F.col("r_name").alias("country")))
    return folders, assigned


@query(
    """SELECT o.o_orderkey AS doc_id, coalesce(CASE WHEN c.c_acctbal < 0 THEN c.c_mktsegment END, CASE WHEN n.n_nationkey < 10 THEN n.n_name END, CASE WHEN r.r_regionkey > 1 THEN r.r_name END, 'USA') AS country
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""
)
def document_countries(spark, d):
    folders, assigned = folder_tree(spark, d)
    docs = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("folder_id"))
    return preambles.document_values(docs, folders, assigned)


@query(TOKENS + " SELECT doc_id, page, length(string_agg(text, ' ' ORDER BY sn)) AS n_chars, count(*) AS n_words, count(*) AS n_spans, min(sn) AS first_span, max(sn) AS last_span FROM tok WHERE NOT contains(text, '<') AND NOT contains(text, '>') GROUP BY doc_id, page")
def label_spans(spark, d):
    t = doc_tokens(spark, d).where("not contains(text, '<') and not contains(text, '>')")
    return preambles.label_spans(sinks.display_html(t), ["doc_id", "page"]).select("doc_id", "page", F.length("text").alias("n_chars"), "n_words", "n_spans", "first_span", "last_span")


# recitals: lines are marks of customers' documents, named by their number; parts are features


@query(
    """SELECT CAST(l_linenumber AS BIGINT) AS entity, CASE l_linenumber WHEN 1 THEN 'Preamble' WHEN 2 THEN 'Recitals' WHEN 3 THEN 'Sigblock' ELSE 'Table_Of_Contents' END AS name, l_returnflag AS value, o.o_orderkey AS doc_id, CAST(l_quantity AS INT) AS para_no,
  o.o_orderpriority AS document, c.c_mktsegment AS folder, n.n_name AS parent, p.p_type AS feature
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size < 25
WHERE l_linenumber <= 4 AND o.o_orderpriority NOT LIKE '%Abstract%'"""
)
def marked_paragraphs(spark, d):
    o, c, n, p = (table(spark, d, t) for t in ("orders", "customer", "nation", "part"))
    texts = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_linenumber").cast("long").alias("entity_id"), F.col("l_orderkey").alias("doc_id"), F.col("l_quantity").cast("int").alias("para_no"), F.col("l_returnflag").alias("value"))
    names = ["Preamble", "Recitals", "Sigblock", "Table_Of_Contents", "Other", "Other", "Other"]
    entities = spark.createDataFrame(list(enumerate(names, 1)), "id long, name string")
    features = p.where("p_size < 25").select(F.col("p_partkey").alias("instance_id"), F.col("p_type").alias("feature"))
    documents = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("folder_id"))
    folders = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_mktsegment").alias("name"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_id"))
    folders = folders.unionByName(n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("parent_id")))
    return preambles.marked_paragraphs(texts, entities, features, documents, folders)


@query()
def decided_preambles(spark, d):
    """Marks are lines of the customers' outlines that are no items, items their headings in chains."""
    from ..operators import numbering
    from ..sources.durable import durable
    from .outlines import outline

    rows = durable(outline(spark, d))
    names = F.element_at(F.array(*map(F.lit, ["Preamble", "Recitals", "Preamble", "Table_Of_Contents", "Sigblock"])), (F.col("para_no") % 5 + 1).cast("int"))
    marks = rows.where("text = 'Other goods are neither'").select("doc_id", "para_no", names.alias("name"))
    n = F.count("*").over(Window.partitionBy("doc_id", "seq"))
    items = numbering.chains(numbering.numbered_items(rows)).withColumn("n", n).select("doc_id", "para_no", "enum", "nth", "n")
    return preambles.decide_preambles(marks, items, rows.select("doc_id", "para_no", F.length("text").alias("length")))


# votes: words of ten letters are marked as split, those with a digit replaced; words behind a comma come in anew, lower by their length


@query(
    TOKENS
    + """, v AS (
  SELECT doc_id, sn, CASE WHEN length(text) >= 10 THEN 1 WHEN regexp_matches(text, '[0-9]') THEN 2 ELSE 0 END AS split, text || '!' AS voted FROM tok WHERE length(text) >= 10 OR regexp_matches(text, '[0-9]') OR ends_with(text, '.')
), x AS (
  SELECT doc_id, sn AS after, text || 'x' AS voted, y1 + 30 * length(text) AS y1, y2 + 30 * length(text) AS y2 FROM tok WHERE ends_with(text, ',') AND sn > 0
), k AS (
  SELECT *, lead(y1) OVER w AS n1, lead(y2) OVER w AS n2 FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY sn)
), u AS (
  SELECT t.doc_id, t.sn AS at_, 0 AS nth, t.sn, coalesce(v.voted, t.text) AS text, CASE WHEN v.split = 1 THEN 1 ELSE 0 END AS split_token, false AS inserted FROM tok t LEFT JOIN v ON v.doc_id = t.doc_id AND v.sn = t.sn
  UNION ALL SELECT x.doc_id, x.after, 1, NULL, x.voted, 0, true FROM x JOIN k ON k.doc_id = x.doc_id AND k.sn = x.after
    WHERE abs(k.y1 - x.y1) < 200 AND abs(k.y2 - x.y2) < 200 AND coalesce(abs(k.n1 - x.y1) < 200 AND abs(k.n2 - x.y2) < 200, true)
)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY at_, nth, text) - 1 AS place, sn, text, split_token, inserted FROM u"""
)
def votes_of_all_kinds(spark, d):
    t = doc_tokens(spark, d)
    size = F.length("text")
    digit = F.col("text").rlike("[0-9]")
    none = lambda kind: F.lit(None).cast(kind)
    replaced = t.where((size >= 10) | digit | F.col("text").endswith(".")).select("doc_id", "sn", F.concat("text", F.lit("!")).alias("voted"), F.when(size >= 10, 1).when(digit, 2).otherwise(0).alias("split"), none("int").alias("after"), none("int").alias("nth"), "y1", "y2")
    new = t.where(F.col("text").endswith(",") & (F.col("sn") > 0)).select("doc_id", none("int").alias("sn"), F.concat("text", F.lit("x")).alias("voted"), F.lit(0).alias("split"), F.col("sn").alias("after"), F.lit(1).alias("nth"), (F.col("y1") + 30 * size).alias("y1"), (F.col("y2") + 30 * size).alias("y2"))
    return vote.applied_votes(t, replaced.unionByName(new))


# marks of tokens and exhibit lines


@query(TOKENS + " SELECT doc_id, sn, regexp_matches(text, '^[0-9]{1,3}\\.?$') AS digits, length(text) <= 8 AND (x1 + x2) / 2 BETWEEN 4000 AND 6000 AND (contains(lower(text), 'page') OR regexp_matches(lower(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')), '^([a-z0-9]{1,2}|[ivxl]{1,5})$')) AS page_number FROM tok")
def number_marks(spark, d):
    c = F.col("text")
    return doc_tokens(spark, d).select("doc_id", "sn", classify.is_digits(c).alias("digits"), classify.is_page_number(c, F.col("x1"), F.col("x2")).alias("page_number"))


@query(
    """WITH l AS (
  SELECT o_custkey AS doc_id, CAST(floor((row_number() OVER w - 1) / 5) AS INT) AS page, CAST((row_number() OVER w - 1) % 5 AS INT) AS line_in_page, CASE o_orderpriority WHEN '1-URGENT' THEN 'EXHIBIT A' WHEN '2-HIGH' THEN 'Schedule 2' ELSE 'Plain words' END AS text
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
), e AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page) AS n FROM l WHERE text <> 'Plain words')
SELECT doc_id, page, line_in_page, text FROM e WHERE n = 1 AND line_in_page <= 2"""
)
def lone_exhibits(spark, d):
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1
    body = F.when(F.col("o_orderpriority") == "1-URGENT", "EXHIBIT A").when(F.col("o_orderpriority") == "2-HIGH", "Schedule 2").otherwise("Plain words")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.floor(nth / 5).cast("int").alias("page"), (nth % 5).cast("int").alias("line_in_page"), body.alias("text"))
    return more.one_exhibit_a_page(rows)


said("number_marks")
