"""The registered queries of the layout engine, and SQL that gives the same rows.

Each query applies operators to a whole table. Tables hold plain texts, so word boxes come from the
fixed layout of sources.layout; numbering queries take order lines as enumerations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify, text
from ..operators import clusters, lines, more, pages, pairwise, parts, toc, tokens, vote
from ..sources import layout, readers, sinks
from ..sources.durable import dictionary_join, durable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "page_statistics"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


#: Words of the invented languages and the words of contracts that stand for them, so that rules of contracts have something to find.
SAID = [
    (" of ", " LEASE AGREEMENT AMENDMENT "),
    (" the ", " 12 "),
    (" and ", " 3. "),
    (" to ", " witness "),
    (" in ", " By "),
    (" la ", " INDEX "),
    (" le ", " DATE "),
    (" der ", " lease data "),
    (" die ", " in Section 4 hereof "),
    (" und ", " WHEREAS "),
    (" de ", " regula- regulation "),
    (" que ", " landlord "),
    (" zu ", " EXHIBIT "),
    (" et ", " made and entered into by and between "),
    ("In ", "Section "),
]


class Said(str):
    """A folder of tables whose documents and conversations are read with the words of SAID."""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    # sides of a union whose partitions are joined to larger ones each for itself pass for dealt by one key, and a window then sees parts of its groups
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    df = spark.read.parquet(f"{d}/{name}.parquet")
    if isinstance(d, Said) and name in ("documents", "conversations"):
        text_ = F.col("text")
        for word, other in SAID:
            text_ = F.replace(text_, F.lit(word), F.lit(other))
        df = df.withColumn("text", text_)
    return df


def said(*names: str) -> None:
    """Let registered queries and their SQL read documents and conversations with the words of SAID."""
    changed = "text"
    for word, other in SAID:
        changed = f"replace({changed}, '{word}', '{other}')"
    for name in names:
        QUERIES[name] = lambda spark, d, f=QUERIES[name]: f(spark, Said(d))
        if name in ORACLE_SQL:
            sql = ORACLE_SQL[name]
            tables = [t for t in ("documents", "conversations") if f"FROM {t}" in sql]
            for t in tables:
                sql = sql.replace(f"FROM {t}", f"FROM said_{t}")
            ctes = ", ".join(f"said_{t} AS (SELECT * REPLACE ({changed} AS text) FROM {t})" for t in tables)
            opening = "WITH RECURSIVE " if sql.lstrip().startswith("WITH RECURSIVE ") else "WITH " if sql.lstrip().startswith("WITH ") else ""
            ORACLE_SQL[name] = f"{opening or 'WITH '}{ctes}{', ' if opening else ' '}{sql.lstrip()[len(opening) :]}"


def doc_tokens(spark: SparkSession, d: str) -> DataFrame:
    return layout.tokens_from_text(table(spark, d, "documents").select("doc_id", "text"))


def gathered_tokens(spark: SparkSession, d: str, finer: int = 0) -> DataFrame:
    """doc_tokens of documents that are dealt by doc_id first, for queries that group, join or number tokens by document.

    The texts are moved, which are a fraction of their tokens, and nothing that is keyed by document is moved again:
    joins by document and page or block take both sides as they lie, which Spark does only where it is allowed to.
    finer: so many times the session's partitions, where what is made of a token is large.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    docs = table(spark, d, "documents").select("doc_id", "text")
    n = [finer * int(spark.conf.get("spark.sql.shuffle.partitions"))] if finer else []
    return layout.tokens_from_text(docs.repartition(*n, "doc_id"))


WORDS = """w AS (SELECT doc_id, [x FOR x IN string_split_regex(text, '\\s+') IF x <> ''] AS w FROM documents),
t0 AS (SELECT doc_id, unnest(w) AS text, CAST(generate_subscripts(w, 1) - 1 AS INT) AS sn FROM w)"""
TOKENS = (
    "WITH RECURSIVE "
    + WORDS
    + """, tok AS (
  SELECT doc_id, sn, CAST(sn // 400 + 1 AS INT) AS page, CAST(sn // 5 AS INT) AS block, CAST(sn // 10 AS INT) AS line, text,
    CAST(1040 + 800 * (sn % 10) AS INT) AS x1, CAST(1040 + 800 * (sn % 10) + least(80 * length(text), 780) AS INT) AS x2,
    CAST(500 + 200 * ((sn // 10) % 40) + 90 * (((sn // 10) % 40) // 7) AS INT) AS y1,
    CAST(650 + 200 * ((sn // 10) % 40) + 90 * (((sn // 10) % 40) // 7) AS INT) AS y2, CAST(60 + (sn * 7) % 40 AS INT) AS conf
  FROM t0)"""
)
BLOCKS = (
    TOKENS
    + """, blk AS (
  SELECT doc_id, page, line, block, CAST(min(sn) AS INT) AS first_sn, CAST(max(sn) AS INT) AS last_sn, string_agg(text, ' ' ORDER BY sn) AS text,
    min(x1) AS x1, max(x2) AS x2, min(y1) AS y1, max(y2) AS y2
  FROM tok GROUP BY doc_id, page, line, block)"""
)
ENGINES = (
    TOKENS
    + """, tokb AS (
  SELECT doc_id, page, sn, block, line, CASE WHEN sn % 7 = 0 THEN translate(text, 'lO', '10') ELSE text END AS text,
    x1 + 5 * (sn % 3) AS x1, x2 + 5 * (sn % 3) AS x2, y1, y2, CAST(60 + (sn * 5) % 40 AS INT) AS conf
  FROM tok WHERE sn % 11 <> 0)
, prs AS (
  SELECT a.doc_id, a.page, a.sn AS sn_a, b.sn AS sn_b, a.text AS text_a, b.text AS text_b, a.conf AS conf_a, b.conf AS conf_b,
    (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS overlap
  FROM tok a JOIN tokb b ON a.doc_id = b.doc_id AND a.page = b.page AND a.line = b.line
    AND least(a.x2, b.x2) > greatest(a.x1, b.x1) AND least(a.y2, b.y2) > greatest(a.y1, b.y1))
, best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, sn_a ORDER BY overlap DESC, sn_b) AS ra,
    row_number() OVER (PARTITION BY doc_id, page, sn_b ORDER BY overlap DESC, sn_a) AS rb FROM prs) WHERE ra = 1 AND rb = 1)"""
)


# layout and reading order


@query(TOKENS + " SELECT * FROM tok")
def tokens_layout(spark, d):
    return doc_tokens(spark, d)


@query(TOKENS + " SELECT doc_id, sn, round(x1 * 0.0612::DOUBLE, 4) AS px1, round(x2 * 0.0612::DOUBLE, 4) AS px2, round(y1 * 0.0792::DOUBLE, 4) AS py1, round(y2 * 0.0792::DOUBLE, 4) AS py2 FROM tok")
def coords_pixels(spark, d):
    px = lambda c, size: F.round(F.col(c) * F.lit(size / 10000), 4)
    return doc_tokens(spark, d).select("doc_id", "sn", px("x1", 612).alias("px1"), px("x2", 612).alias("px2"), px("y1", 792).alias("py1"), px("y2", 792).alias("py2"))


@query("SELECT vec_id, list_sum([CAST(trunc(CAST(x AS DOUBLE) * 10000) AS INT) FOR x IN embedding])::BIGINT AS scaled FROM embeddings")
def coords_scaled(spark, d):
    total = F.aggregate(F.transform("embedding", lambda x: readers.scaled(x.cast("double"))), F.lit(0).cast("long"), lambda n, x: n + x)
    return table(spark, d, "embeddings").select("vec_id", total.alias("scaled"))


@query(BLOCKS + " SELECT * FROM blk")
def blocks_of_words(spark, d):
    return layout.blocks(doc_tokens(spark, d))


@query(
    BLOCKS
    + """, s AS (SELECT *, lag(page) OVER w AS pp, lag(y1 + y2) OVER w AS py, lag(x2) OVER w AS px FROM blk WINDOW w AS (PARTITION BY doc_id ORDER BY block)),
n AS (SELECT *, CAST(sum(CASE WHEN pp IS NULL OR pp <> page OR abs(y1 + y2 - py) > 100 OR x1 < px THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block) - 1 AS INT) AS line_in_doc FROM s)
SELECT doc_id, block, page, line_in_doc, line_in_doc - min(line_in_doc) OVER (PARTITION BY doc_id, page) AS line_in_page FROM n"""
)
def line_numbering(spark, d):
    return lines.number_lines(layout.blocks(doc_tokens(spark, d))).select("doc_id", "block", "page", "line_in_doc", "line_in_page")


@query(
    TOKENS
    + """ SELECT doc_id, sn, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY sn) - 1 AS INT) AS sn_in_page,
  CAST(row_number() OVER (PARTITION BY doc_id, line ORDER BY sn) - 1 AS INT) AS sn_in_line, CAST(row_number() OVER (PARTITION BY doc_id, block ORDER BY sn) - 1 AS INT) AS sn_in_block FROM tok"""
)
def sn_in_line(spark, d):
    return lines.serial_numbers(doc_tokens(spark, d)).select("doc_id", "sn", "sn_in_page", "sn_in_line", "sn_in_block")


GAPS = (
    BLOCKS
    + """, gap AS (
  SELECT doc_id, page, line, CAST(row_number() OVER w - 1 AS INT) AS nth, lag(x2, 1, 0) OVER w AS "left", x1 AS "right" FROM blk WINDOW w AS (PARTITION BY doc_id, page, line ORDER BY x1, block)
  UNION ALL SELECT doc_id, page, line, CAST(count(*) AS INT), max(x2), 10000 FROM blk GROUP BY doc_id, page, line)"""
)


@query(GAPS + " SELECT * FROM gap")
def token_gaps(spark, d):
    return lines.block_gaps(layout.blocks(doc_tokens(spark, d)))


LINE_STATS = (
    TOKENS
    + """, ln AS (
  SELECT doc_id, page, line, count(*) AS n_words, sum(CASE WHEN regexp_matches(text, '^[^A-Za-z]*[A-Z]') THEN 1 ELSE 0 END)::BIGINT AS n_first_cap,
    sum(CASE WHEN NOT regexp_matches(text, '[a-z]') AND regexp_matches(text, '[A-Z]') THEN 1 ELSE 0 END)::BIGINT AS n_all_cap,
    min(CASE WHEN length(text) > 1 THEN x1 END) AS left_x, max(CASE WHEN length(text) > 1 THEN x2 END) AS right_x,
    CAST(arg_max(regexp_matches(text, '^[0-9]{1,3}$'), sn) AS INT) AS right_is_number
  FROM tok GROUP BY doc_id, page, line),
lns AS (SELECT *, CAST(floor((left_x + right_x) / 2) AS INT) AS center FROM ln)"""
)


@query(LINE_STATS + " SELECT * FROM lns")
def line_statistics(spark, d):
    return pages.line_stats(doc_tokens(spark, d))


@query(
    LINE_STATS
    + """ SELECT doc_id, page, line, len([x FOR x IN list(left_x) OVER w IF abs(x - left_x) < 20]) - 1 AS n_similar, lead(line) OVER (PARTITION BY doc_id, page ORDER BY line) - line AS to_next
FROM lns WHERE left_x IS NOT NULL WINDOW w AS (PARTITION BY doc_id, page ORDER BY line ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)"""
)
def indent_neighbors(spark, d):
    rows = pages.line_stats(doc_tokens(spark, d)).where("left_x is not null").withColumnRenamed("left_x", "x1")
    return lines.similar_indents(rows).select("doc_id", "page", "line", "n_similar", "to_next")


SECTION = "|".join(classify.SECTION_WORDS)
PARAS = (
    BLOCKS
    + f""", pb AS (SELECT *, y1 - lag(y2) OVER w AS gap, lag(page) OVER w AS pp, lag(text) OVER w AS pt FROM blk WINDOW w AS (PARTITION BY doc_id ORDER BY block)),
par AS (SELECT *, CAST(sum(CASE WHEN pp IS NULL OR pp <> page OR gap > 120 OR ((gap > 0 OR gap < -400)
  AND (regexp_matches(text, '^([0-9]{{1,2}}\\.|[ivx]{{1,5}}\\.|[A-Z]\\.|[a-z]\\)|\\([ivx]{{1,5}}\\)|\\([0-9]{{1,2}}\\)|\\([a-z]\\))(\\s|$)')
    OR regexp_matches(text, '(?i)^({SECTION})\\s+([0-9]+|[ivxl]+|[a-z])\\b')
    OR (NOT regexp_matches(text, '[a-z]') AND regexp_matches(text, '[A-Z]') AND x2 - x1 < 2000 AND abs((x1 + x2) / 2 - 5000) < 400 AND len(string_split_regex(trim(text), '\\s+')) <= 4))
  AND NOT regexp_matches(lower(pt), '(^|\\s)({"|".join(classify.CONNECTORS)})\\s*$')) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY block) - 1 AS INT) AS para_no FROM pb)"""
)


@query(PARAS + " SELECT doc_id, block, page, para_no FROM par")
def paragraph_segments(spark, d):
    return lines.paragraphs(layout.blocks(doc_tokens(spark, d))).select("doc_id", "block", "page", "para_no")


def para_tokens(spark, d):
    t = gathered_tokens(spark, d)
    # a block for each few tokens: nothing to broadcast
    return t.hint("merge").join(lines.paragraphs(layout.blocks(t)).select("doc_id", "block", "para_no"), ["doc_id", "block"])


PARA_STATS = (
    PARAS
    + """, ps AS (SELECT t.doc_id, p.para_no, min(t.sn) AS first_sn, count(*) AS n_tokens, min(t.page) AS page, min(t.line) AS line,
  min(CASE WHEN regexp_matches(t.text, '[a-z]') THEN 0 ELSE 1 END) AS all_upper, sum(CASE WHEN regexp_matches(t.text, '^[^A-Za-z]*[A-Z]') THEN 1 ELSE 0 END)::BIGINT AS n_first_cap,
  sum(CASE WHEN regexp_matches(t.text, '^[A-Za-z]{2,}[.,;:]?$') THEN 1 ELSE 0 END)::BIGINT AS n_real
FROM tok t JOIN par p ON p.doc_id = t.doc_id AND p.block = t.block GROUP BY t.doc_id, p.para_no)"""
)


@query(PARA_STATS + " SELECT * FROM ps")
def paragraph_statistics(spark, d):
    return lines.paragraph_stats(para_tokens(spark, d))


@query(PARA_STATS + " SELECT doc_id, page, min(para_no) AS first_para FROM ps GROUP BY doc_id, page")
def page_first_para(spark, d):
    return lines.first_paragraphs(lines.paragraph_stats(para_tokens(spark, d)))


@query(BLOCKS + ", s AS (SELECT doc_id, page, block, y1 - lag(y2) OVER (PARTITION BY doc_id, page ORDER BY block) AS space FROM blk) SELECT * FROM s WHERE space > 120")
def vertical_spaces(spark, d):
    return lines.vertical_spaces(layout.blocks(doc_tokens(spark, d)))


@query(TOKENS + " SELECT doc_id, sn, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS loc FROM tok")
def char_offsets(spark, d):
    return sinks.char_offsets(doc_tokens(spark, d)).select("doc_id", "sn", "loc")


LINES_OF_PAGE = "(SELECT doc_id, page, count(DISTINCT line) AS lines_in_page FROM tok GROUP BY doc_id, page)"
COLUMNS = (
    GAPS
    + f""", mid AS (SELECT DISTINCT doc_id, page, line FROM gap WHERE "left" < 5000 AND "right" > 5000 AND "left" > 0 AND "right" < 10000),
isl AS (SELECT *, line - row_number() OVER (PARTITION BY doc_id, page ORDER BY line) AS g FROM mid),
col AS (SELECT i.doc_id, i.page, min(line) AS first_line, max(line) AS last_line, count(*) AS n_lines, count(*) / any_value(lines_in_page) AS line_ratio
  FROM isl i JOIN {LINES_OF_PAGE} l ON l.doc_id = i.doc_id AND l.page = i.page GROUP BY i.doc_id, i.page, g HAVING count(*) >= 2)"""
)


def column_groups_of(t: DataFrame) -> DataFrame:
    per_page = t.groupBy("doc_id", "page").agg(F.countDistinct("line").alias("lines_in_page"))
    return lines.column_groups(lines.block_gaps(layout.blocks(t)), per_page)


@query(COLUMNS + " SELECT doc_id, page, first_line, last_line, n_lines, round(line_ratio, 4) AS line_ratio FROM col")
def dc_groups(spark, d):
    return column_groups_of(doc_tokens(spark, d)).withColumn("line_ratio", F.round("line_ratio", 4))


@query(
    COLUMNS
    + """ SELECT b.doc_id, b.block, CAST(row_number() OVER (PARTITION BY b.doc_id ORDER BY b.page, coalesce(c.first_line, b.line), CASE WHEN c.first_line IS NOT NULL AND b.x1 >= 5000 THEN 1 ELSE 0 END, b.line, b.block) - 1 AS INT) AS place
FROM blk b LEFT JOIN col c ON c.doc_id = b.doc_id AND c.page = b.page AND b.line BETWEEN c.first_line AND c.last_line AND c.line_ratio >= 0.7"""
)
def reading_order(spark, d):
    t = doc_tokens(spark, d)
    return lines.reading_order(layout.blocks(t), column_groups_of(t)).select("doc_id", "block", "place")


@query(
    GAPS
    + """, g AS (SELECT * FROM gap WHERE "right" > "left")
SELECT a.doc_id, a.page, a.line AS line_a, a.nth AS nth_a, b.line AS line_b, b.nth AS nth_b, least(a."right", b."right") - greatest(a."left", b."left") AS overlap
FROM g a JOIN (SELECT *, line - 1 AS above FROM g UNION ALL SELECT *, line - 2 FROM g) b ON a.doc_id = b.doc_id AND a.page = b.page AND a.line = b.above WHERE least(a."right", b."right") > greatest(a."left", b."left")"""
)
def gap_overlap(spark, d):
    return clusters.overlapping_gaps(lines.block_gaps(layout.blocks(doc_tokens(spark, d))))


@query()
def gap_clusters(spark, d):
    return clusters.gap_clusters(clusters.overlapping_gaps(lines.block_gaps(layout.blocks(doc_tokens(spark, d)))))


# tokens, names and numbers


def _case(chain, test, other):
    return "CASE " + " ".join(f"WHEN {test(p)} THEN '{n}'" for n, p in chain) + f" ELSE '{other}' END"


CATEGORY = _case(classify.CATEGORIES, lambda p: "regexp_matches(text, '^(" + p.replace("'", "''") + ")$')", "NONE")


@query(TOKENS + f" SELECT category, count(*) AS n FROM (SELECT {CATEGORY} AS category FROM tok) GROUP BY category")
def token_category(spark, d):
    return doc_tokens(spark, d).groupBy(classify.token_category(F.col("text")).alias("category")).agg(F.count("*").alias("n"))


@query(
    TOKENS
    + """ SELECT doc_id, sn, CASE WHEN regexp_matches(text, '^[A-Za-z0-9]+$') THEN 0 WHEN regexp_matches(text, '^[A-Za-z0-9]+[^A-Za-z0-9]$') THEN 1
WHEN regexp_matches(text, '^[^A-Za-z0-9][A-Za-z0-9]+$') THEN 2 WHEN regexp_matches(text, '^[^A-Za-z0-9]+$') THEN 3 ELSE 4 END AS shape FROM tok"""
)
def word_shape(spark, d):
    return doc_tokens(spark, d).select("doc_id", "sn", classify.word_shape(F.col("text")).alias("shape"))


@query(TOKENS + " SELECT doc_id, sn, text FROM tok WHERE regexp_matches(text, '^(" + "|".join(classify.UNSPLITTABLE).replace("'", "''") + ")$')")
def unsplittable_tokens(spark, d):
    return doc_tokens(spark, d).where(classify.is_unsplittable(F.col("text"))).select("doc_id", "sn", "text")


@query()
def token_pieces(spark, d):
    return lines.space_before(tokens.token_pieces(doc_tokens(spark, d))).select("doc_id", "sn", "piece", "text", "x1", "x2", "has_space_before")


@query("SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_', '') AS slug FROM part")
def slug(spark, d):
    return table(spark, d, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query(
    "SELECT p_partkey, regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(lower(p_name || ' Square Feet'), '[^a-z0-9]+', '_', 'g'), 'square', 'sq'), 'feet', 'ft'), 'foot', 'ft'), '^_+', ''), '_+$', '') AS name FROM part"
)
def std_name(spark, d):
    return table(spark, d, "part").select("p_partkey", text.standard_name(F.concat("p_name", F.lit(" Square Feet"))).alias("name"))


@query("SELECT c_custkey, list_reduce([s FOR s IN list_concat([''], [CASE WHEN i = 1 THEN p[i] ELSE upper(p[i][1]) || p[i][2:] END FOR i IN range(1, len(p) + 1)])], lambda a, b: a || b) AS camel FROM (SELECT c_custkey, string_split(lower(c_mktsegment || '_' || 'of_' || c_name), '_') AS p FROM customer)")
def camel_name(spark, d):
    name = F.lower(F.concat("c_mktsegment", F.lit("_of_"), "c_name"))
    return table(spark, d, "customer").select("c_custkey", text.camel_case(name).alias("camel"))


@query("SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded FROM customer")
def pad8(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.pad8(F.col("c_custkey")).alias("padded"))


@query("SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g') AS plain FROM documents")
def norm_para(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normal_paragraph(F.col("text")).alias("plain"))


@query("SELECT doc_id, lower(regexp_replace(substring(text, 1, 41), '[^A-Za-z0-9]', '', 'g')) AS header FROM documents")
def norm_header(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normal_header(F.col("text")).alias("header"))


@query()
def norm_token_split(spark, d):
    return doc_tokens(spark, d).select("doc_id", "sn", F.posexplode(text.normal_token(F.col("text"))).alias("part", "text"))


@query("SELECT p_partkey, CASE WHEN p_size % 50 BETWEEN 1 AND 39 THEN p_size % 50 END AS value, CASE WHEN p_size % 50 BETWEEN 1 AND 39 THEN p_size % 50 END AS small FROM part")
def roman_value(spark, d):
    """Sizes below 40 written in roman numerals; 40 and more are written in digits and are none."""
    n = (F.col("p_size") % 50).cast("int")
    ones = F.element_at(F.array(*map(F.lit, ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"])), n % 10 + 1)
    written = F.when((n > 0) & (n < 40), F.concat(F.expr("repeat('X', cast(p_size % 50 div 10 as int))"), ones)).otherwise(n.cast("string"))
    rows = table(spark, d, "part").withColumn("written", written)
    return rows.select("p_partkey", text.roman_value(F.col("written")).alias("value"), text.roman_value(F.lower("written")).alias("small"))


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 20 AND 99 THEN p_size END AS value, CASE WHEN p_size <= 20 THEN p_size END AS ordinal FROM part")
def number_words(spark, d):
    """Sizes from 20 on written in words, and those up to 20 as ordinals; what is no number word has no value."""
    size = F.col("p_size")
    at = lambda words, n: F.try_element_at(F.array(*map(F.lit, words)), n)
    ones = at(text.UNITS[:9], (size % 10).cast("int"))
    ten = at(text.TENS, (F.floor(size / 10) - 1).cast("int"))
    word = F.when(size >= 20, F.when(size % 10 == 0, ten).otherwise(F.concat_ws("-", ten, ones))).otherwise(F.lit("DOZENS"))
    ordinal = F.when(size <= 20, at(text.ORDINALS, size)).otherwise(F.lit("LATER"))
    return table(spark, d, "part").select("p_partkey", text.word_number(word).alias("value"), text.word_number(ordinal).alias("ordinal"))


@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS VARCHAR) AS enum_field, CAST(l_orderkey % 97 + 1 AS VARCHAR) AS parent_field, 'decimal_pair' AS style, l_linenumber AS value FROM lineitem"
)
def section_fields(spark, d):
    s = F.concat((F.col("l_orderkey") % 97 + 1).cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    fields = text.section_fields(s)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.element_at(fields, -1).alias("enum_field"), F.element_at(fields, -2).alias("parent_field"), text.numeral_style(s).alias("style"), text.section_value(s).alias("value"))


STYLE = _case(text.NUMERAL_STYLES, lambda p: f"regexp_matches(text, '^({p})$')", "none")


@query(TOKENS + f" SELECT style, count(*) AS n FROM (SELECT {STYLE} AS style FROM tok) GROUP BY style")
def numbering_group(spark, d):
    return doc_tokens(spark, d).groupBy(text.numeral_style(F.col("text")).alias("style")).agg(F.count("*").alias("n"))


@query("SELECT item_id, rtrim(substring(CASE WHEN regexp_extract(text, '^([^\\n]{3}[^.:\\-]*)', 1) = '' THEN text ELSE rtrim(regexp_extract(text, '^([^\\n]{3}[^.:\\-]*)', 1)) END, 1, 80)) AS header FROM benchmark")
def header_chop(spark, d):
    return table(spark, d, "benchmark").select("item_id", F.rtrim(text.sentence_header(F.col("text"))).alias("header"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals, len(regexp_extract_all(text, '[A-Z]{2,}')) AS n_capital_words, len([x FOR x IN string_split_regex(text, '\\s+') IF x <> '']) AS n_words FROM documents")
def caps_counts(spark, d):
    c = F.col("text")
    n = F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    return table(spark, d, "documents").select("doc_id", F.regexp_count(c, F.lit("[A-Z]")).alias("n_capitals"), F.regexp_count(c, F.lit("[A-Z]{2,}")).alias("n_capital_words"), n.alias("n_words"))


FREQ = TOKENS + """, wf AS (SELECT word, count(*) AS freq FROM (SELECT lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS word FROM tok) WHERE length(word) > 1 GROUP BY word)"""


@query(FREQ + " SELECT word, freq, round(freq / (SELECT sum(freq) FROM wf), 9) AS share FROM wf")
def dict_freq(spark, d):
    return tokens.word_frequencies(doc_tokens(spark, d)).withColumn("share", F.round("share", 9))


@query(
    TOKENS
    + """, ty AS (SELECT doc_id, sn, CASE WHEN regexp_matches(text, '^\\(.*\\)$') THEN '__PAREN__' WHEN regexp_matches(text, '^[0-9]+(\\.[0-9]+)+\\.?$') THEN '__SECTION__'
  WHEN regexp_matches(text, '^[$]?[0-9][0-9,.]*$') THEN '__NUMBER__' ELSE lower(regexp_replace(text, '[.,;:]+$', '')) END AS w1 FROM tok),
p AS (SELECT w1, lead(w1) OVER (PARTITION BY doc_id ORDER BY sn) AS w2 FROM ty) SELECT w1, w2, count(*) AS freq FROM p WHERE w2 IS NOT NULL GROUP BY w1, w2"""
)
def bigrams(spark, d):
    return tokens.typed_bigrams(doc_tokens(spark, d))


# two engines


def engines(spark, d):
    a = gathered_tokens(spark, d)
    return a, layout.second_engine(a)


@query(ENGINES + " SELECT doc_id, page, sn_a, sn_b, overlap FROM prs")
def engine_overlap(spark, d):
    return vote.overlapping_pairs(*engines(spark, d)).select("doc_id", "page", "sn_a", "sn_b", "overlap")


@query(ENGINES + " SELECT doc_id, page, sn_a, sn_b, overlap FROM best")
def engine_best_match(spark, d):
    return vote.mutual_best(vote.overlapping_pairs(*engines(spark, d))).select("doc_id", "page", "sn_a", "sn_b", "overlap")


@query(ENGINES + " SELECT doc_id, page, sn_a, sn_b, overlap FROM best")
def engine_greedy_match(spark, d):
    return vote.greedy_matches(vote.overlapping_pairs(*engines(spark, d)))


@query(ENGINES + " SELECT t.doc_id, t.page, t.sn FROM tok t WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.doc_id = t.doc_id AND b.sn_a = t.sn)")
def engine_unmatched(spark, d):
    a, b = engines(spark, d)
    return vote.unmatched(a, vote.mutual_best(vote.overlapping_pairs(a, b)), "a").select("doc_id", "page", "sn")


@query(
    ENGINES
    + """ SELECT kind, count(*) AS n FROM (SELECT CASE WHEN text_a = text_b THEN 'SAME' WHEN lower(text_a) = lower(text_b) THEN 'CAPITAL'
  WHEN regexp_replace(text_a, '[^A-Za-z0-9]', '', 'g') = regexp_replace(text_b, '[^A-Za-z0-9]', '', 'g') THEN 'NONALNUM'
  WHEN levenshtein(text_a, text_b) <= 0.5 * greatest(length(text_a), length(text_b)) AND greatest(length(text_a), length(text_b)) <= 150 THEN 'SIMILAR' ELSE 'DIFFERENT' END AS kind FROM best) GROUP BY kind"""
)
def discrepancy(spark, d):
    best = vote.mutual_best(vote.overlapping_pairs(*engines(spark, d)))
    return best.groupBy(vote.discrepancy(F.col("text_a"), F.col("text_b")).alias("kind")).agg(F.count("*").alias("n"))


CAT_A, CAT_B = CATEGORY.replace("(text,", "(text_a,"), CATEGORY.replace("(text,", "(text_b,")


@query(
    ENGINES
    + f""", d AS (SELECT word FROM (SELECT lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS word FROM tok) WHERE length(word) > 1 GROUP BY word HAVING count(*) >= 3),
v AS (SELECT b.*, {CAT_A} <> 'NONE' AS ta, {CAT_B} <> 'NONE' AS tb, regexp_matches(text_a, '[^\\x00-\\x7F]') AS oa, regexp_matches(text_b, '[^\\x00-\\x7F]') AS ob,
  x.word IS NOT NULL AS ka, y.word IS NOT NULL AS kb FROM best b LEFT JOIN d x ON x.word = lower(regexp_replace(text_a, '[^A-Za-z]', '', 'g')) LEFT JOIN d y ON y.word = lower(regexp_replace(text_b, '[^A-Za-z]', '', 'g')))
SELECT doc_id, page, sn_a, CASE WHEN ta AND NOT tb THEN 'a' WHEN tb AND NOT ta THEN 'b' WHEN ob AND NOT oa THEN 'a' WHEN oa AND NOT ob THEN 'b' WHEN ka AND NOT kb THEN 'a' WHEN kb AND NOT ka THEN 'b'
  WHEN conf_b > conf_a THEN 'b' ELSE 'a' END AS voted FROM v"""
)
def engine_vote(spark, d):
    a, b = engines(spark, d)
    best = vote.mutual_best(vote.overlapping_pairs(a, b))
    word = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z]", ""))
    known = durable(tokens.frequent_words(doc_tokens(spark, d)))
    for s in "ab":
        side = known.select(F.col("word").alias(f"word_{s}"), F.lit(True).alias(f"known_{s}"))
        best = dictionary_join(best.withColumn(f"word_{s}", word(f"text_{s}")), side, f"word_{s}")
    k = lambda s: F.coalesce(f"known_{s}", F.lit(False))
    voted = vote.decide(F.col("text_a"), F.col("text_b"), k("a"), k("b"), F.col("conf_a"), F.col("conf_b"))
    return best.select("doc_id", "page", "sn_a", voted.alias("voted"))


@query(
    TOKENS
    + """, k AS (SELECT doc_id, page, sn, CASE WHEN sn % 5 <> 0 THEN sn END AS sn_a FROM tok),
p AS (SELECT doc_id, page, sn, sn_a, last_value(sn_a IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor FROM k)
SELECT doc_id, page, sn, anchor, CAST(row_number() OVER (PARTITION BY doc_id, page, anchor ORDER BY sn) AS INT) AS nth FROM p WHERE sn_a IS NULL"""
)
def insert_anchor(spark, d):
    a = doc_tokens(spark, d)
    matched = a.where("sn % 5 <> 0").select("doc_id", "page", F.col("sn").alias("sn_a"), F.col("sn").alias("sn_b"))
    return vote.insert_anchors(matched, a.where("sn % 5 = 0"))


@query(
    ENGINES
    + """, c AS (SELECT doc_id, page, sum(a)::BIGINT AS n_a, sum(b)::BIGINT AS n_b FROM (SELECT doc_id, page, 1 AS a, 0 AS b FROM tok UNION ALL SELECT doc_id, page, 0, 1 FROM tokb) GROUP BY doc_id, page)
SELECT doc_id, page, n_a, n_b, round(abs(n_b - n_a) / (n_a + n_b), 6) AS ratio FROM c WHERE abs(n_b - n_a) / (n_a + n_b) >= 0.05"""
)
def missing_pages(spark, d):
    return vote.page_counts(*engines(spark, d), least=0.05).withColumn("ratio", F.round("ratio", 6))


@query(TOKENS + " SELECT doc_id, line, text, count(*) AS n, min(sn) AS sn FROM tok GROUP BY doc_id, line, text HAVING count(*) > 1")
def dup_tokens(spark, d):
    return doc_tokens(spark, d).groupBy("doc_id", "line", "text").agg(F.count("*").alias("n"), F.min("sn").alias("sn")).where("n > 1")


# clusters of blocks


@query()
def footer_pairs(spark, d):
    return clusters.repeated_blocks(layout.blocks(gathered_tokens(spark, d)))


@query()
def footer_designations(spark, d):
    b = layout.blocks(gathered_tokens(spark, d))
    pairs = clusters.repeated_blocks(b).select("doc_id", F.col("block_a").alias("a"), F.col("block_b").alias("b"))
    return clusters.designate(b, clusters.document_clusters(pairs), "footer").where("designation is not null").select("doc_id", "block", "designation")


@query(
    """WITH blk AS (
  SELECT l_orderkey AS doc_id, 1 AS page, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_extendedprice) AS INT) AS block,
    CAST(round(1000 + l_discount * 3000) AS INT) AS x1, CAST(round(1000 + l_discount * 3000 + l_tax * 1000) AS INT) AS x2, CASE l_returnflag WHEN 'R' THEN CAST(l_linenumber AS VARCHAR) || '.' WHEN 'A' THEN CAST(l_linenumber AS VARCHAR) ELSE 'line' END AS text FROM lineitem
), f AS (SELECT * FROM blk WHERE x1 < 2000 AND regexp_matches(text, '^[0-9]{1,3}\\.?$'))
SELECT p.doc_id, p.page, p.block AS a, q.block AS b FROM f p JOIN f q ON p.doc_id = q.doc_id AND p.page = q.page AND p.block < q.block AND abs(p.x1 - q.x1) + abs(p.x2 - q.x2) < 200"""
)
def enum_pairs(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice")
    number = F.col("l_linenumber").cast("string")
    body = F.when(F.col("l_returnflag") == "R", F.concat(number, F.lit("."))).when(F.col("l_returnflag") == "A", number).otherwise(F.lit("line"))
    at = lambda c: F.round(c).cast("int")
    left = 1000 + F.col("l_discount") * 3000
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page"), F.row_number().over(w).alias("block"), at(left).alias("x1"), at(left + F.col("l_tax") * 1000).alias("x2"), body.alias("text"))
    return clusters.aligned_numbers(rows.withColumn("line", F.col("block")))


@query(BLOCKS + " SELECT p.doc_id, p.page, count(*) AS n FROM blk p JOIN blk q ON p.doc_id = q.doc_id AND p.page = q.page AND p.block < q.block AND abs(p.x1 - q.x1) < 25 GROUP BY p.doc_id, p.page")
def block_similar_x(spark, d):
    return clusters.same_indent(layout.blocks(doc_tokens(spark, d))).groupBy("doc_id", "page").agg(F.count("*").alias("n"))


# pages

PAGE_DICT = TOKENS + """, d AS (SELECT word FROM (SELECT lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS word FROM tok) WHERE length(word) > 1 GROUP BY word HAVING count(*) >= 3),
pg AS (SELECT t.doc_id, t.page, count(*) AS n_words, sum(CASE WHEN regexp_matches(text, '^[^A-Za-z]*[A-Z]') THEN 1 ELSE 0 END)::BIGINT AS n_cap_words,
  sum(CASE WHEN length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) < 2 THEN 1 ELSE 0 END)::BIGINT AS n_junk, sum(CASE WHEN d.word IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS n_dict,
  count(DISTINCT line) AS n_lines, sum(length(text))::BIGINT AS n_chars FROM tok t LEFT JOIN d ON d.word = lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) GROUP BY t.doc_id, t.page)"""


@query(PAGE_DICT + " SELECT * FROM pg")
def page_statistics(spark, d):
    t = doc_tokens(spark, d)
    return pages.page_stats(t)


@query(
    LINE_STATS
    + """ SELECT doc_id, page, max(f) AS right_cluster FROM (SELECT doc_id, page, count(*) OVER (PARTITION BY doc_id, page ORDER BY right_x RANGE BETWEEN 3999 PRECEDING AND 3999 FOLLOWING) - 1 AS f
FROM lns WHERE right_x IS NOT NULL) GROUP BY doc_id, page"""
)
def right_cluster(spark, d):
    return pages.right_cluster(pages.line_stats(doc_tokens(spark, d)))


@query()
def center_cluster(spark, d):
    return pages.center_cluster(pages.line_stats(doc_tokens(spark, d)))


@query(
    LINE_STATS
    + """, b AS (SELECT doc_id, page, CAST(floor(left_x / 1000) AS INT) AS bin, count(*) AS n FROM lns WHERE left_x IS NOT NULL GROUP BY ALL)
SELECT doc_id, page, bin, n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY n DESC, bin) AS r FROM b) WHERE r = 1 AND n >= 3"""
)
def indent_mode(spark, d):
    return pages.indent_mode(pages.line_stats(doc_tokens(spark, d)))


SCORES = (
    LINE_STATS
    + """, sc AS (SELECT doc_id, page, sum(CASE WHEN n_words <= 4 AND center BETWEEN 4000 AND 6000 THEN 2 ELSE 0 END + CASE WHEN n_all_cap * 2 >= n_words THEN 3 ELSE 0 END)::BIGINT * 10 // count(*) AS title_score,
  sum(CASE WHEN right_is_number = 1 THEN 10 ELSE 0 END + CASE WHEN n_first_cap * 2 >= n_words THEN 1 ELSE 0 END)::BIGINT * 10 // count(*) AS toc_score,
  sum(CASE WHEN n_words <= 4 AND center BETWEEN 4000 AND 6000 AND NOT n_all_cap * 2 >= n_words THEN 1 ELSE 0 END)::BIGINT AS sig_score FROM lns GROUP BY doc_id, page)"""
)


@query(SCORES + " SELECT * FROM sc")
def page_scores(spark, d):
    return pages.page_scores(pages.line_stats(doc_tokens(spark, d)))


@query(
    SCORES
    + """, i AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM sc WHERE toc_score > 0)
SELECT doc_id, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages, max(toc_score) AS best FROM i GROUP BY doc_id, g"""
)
def toc_page_runs(spark, d):
    return pages.toc_runs(pages.page_scores(pages.line_stats(doc_tokens(spark, d))))


@query(
    TOKENS
    + """, c AS (SELECT *, sum(CASE WHEN NOT regexp_matches(text, '[a-z]') AND regexp_matches(text, '[A-Z]') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, line ORDER BY sn) AS low FROM tok)
SELECT doc_id, line, string_agg(text, ' ' ORDER BY sn) AS label, count(*) AS n FROM c WHERE low = 0 GROUP BY doc_id, line"""
)
def caps_points(spark, d):
    return pages.caps_points(doc_tokens(spark, d))


@query(TOKENS + ", p AS (SELECT doc_id, page, string_agg(text, ' ' ORDER BY sn) AS text FROM tok GROUP BY doc_id, page) SELECT doc_id, page, regexp_matches(lower(text), '" + "|".join(classify.SUMMARY_PHRASES) + "') AS is_summary FROM p")
def summary_pages(spark, d):
    return pages.page_texts(doc_tokens(spark, d)).select("doc_id", "page", classify.is_summary(F.col("text")).alias("is_summary"))


def _score_sql(label):
    holds = lambda p, with_case: f"contains({'q' if with_case else 'lower(q)'}, '{p}')"
    one = lambda ways: " OR ".join(" AND ".join(holds(p, with_case) for p in phrases) for phrases, with_case in ways)
    return " + ".join(f"CASE WHEN {one(ps)} THEN {w} ELSE 0 END" for k, w, ps in classify.PHRASE_WEIGHTS if k == label)


@query("SELECT conv_id, turn, " + ", ".join(f"{_score_sql(k)} AS {k}" for k in ("preamble", "signature", "recitals", "toc")) + " FROM (SELECT *, regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+$', '') || ' ', '[^A-Za-z0-9]+', ' ', 'g') AS q FROM conversations)")
def phrase_scores(spark, d):
    c = F.col("text")
    return table(spark, d, "conversations").select("conv_id", "turn", *(classify.phrase_score(c, k).alias(k) for k in ("preamble", "signature", "recitals", "toc")))


@query(
    f"SELECT conv_id, turn, score FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM (SELECT conv_id, turn, {_score_sql('preamble')} AS score FROM (SELECT *, regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+$', '') || ' ', '[^A-Za-z0-9]+', ' ', 'g') AS q FROM conversations)) WHERE score > 2) WHERE r <= 25"
)
def phrase_caps(spark, d):
    return pages.capped_labels(table(spark, d, "conversations"), "preamble", order="turn", key="conv_id").select("conv_id", "turn", "score")


@query(
    TOKENS
    + " SELECT doc_id, page, "
    + ", ".join(
        f"sum(CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in d.items()) + f" ELSE 0 END)::BIGINT AS {n}" for c, d, n in (("lower(text)", classify.TITLE_WORDS, "title_words"), ("text", classify.SIGNATURE_WORDS, "sig_words"))
    )
    + " FROM tok GROUP BY doc_id, page"
)
def page_word_weights(spark, d):
    return pages.page_word_weights(doc_tokens(spark, d))


_ROLES = ", ".join(f"'{r}'" for r in classify.PARTY_ROLES)


@query(f"SELECT conv_id, turn, len([x FOR x IN string_split_regex(lower(text), '[^a-z]+') IF x IN ({_ROLES})]) AS n_roles FROM conversations")
def party_roles(spark, d):
    roles = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w.isin(*classify.PARTY_ROLES))
    return table(spark, d, "conversations").select("conv_id", "turn", F.size(roles).alias("n_roles"))


# numbering: order lines as enumerations

ITEMS = "it AS (SELECT l_orderkey, l_linenumber, CAST(l_linenumber + (min(l_partkey) % 3 = 0)::INT AS INT) AS enum FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def order_items(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    return items.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") + F.when(F.col("p") % 3 == 0, 1).otherwise(0)).alias("enum"))


@query(
    f"""WITH {ITEMS}, r AS (SELECT l_orderkey, enum, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS INT) AS at FROM it)
SELECT a.l_orderkey, b.at AS i, a.at AS j, b.enum - a.enum AS gap, b.at - a.at - 1 AS dist FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.at < b.at AND b.enum - a.enum BETWEEN 1 AND 4"""
)
def enum_chain_pairs(spark, d):
    return toc.chain_pairs(order_items(spark, d), ["l_orderkey"], "l_linenumber", "enum")


BADNESS = f"""{ITEMS}, g AS (SELECT l_orderkey, enum - lag(enum) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS gap FROM it),
bad AS (SELECT l_orderkey, count(*) AS n, coalesce(sum(gap), 0)::BIGINT AS total_gap, coalesce(max(gap), 0) AS max_gap, coalesce(sum(gap * gap), 0)::BIGINT AS total_diff2 FROM g GROUP BY l_orderkey)"""


@query(f"WITH {BADNESS} SELECT * FROM bad")
def seq_badness(spark, d):
    return toc.sequence_badness(order_items(spark, d), ["l_orderkey"], "l_linenumber", "enum")


SPANS = """sp AS (SELECT o.o_custkey, l.l_orderkey AS seq, min(l.l_shipdate) AS first, max(l.l_shipdate) AS last FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY ALL),
rel AS (SELECT a.o_custkey, a.seq AS a, b.seq AS b, CASE WHEN a.first = b.first AND a.last = b.last THEN 'same' WHEN a.last < b.first THEN 'before' WHEN a.first > b.last THEN 'after'
  WHEN a.first <= b.first AND a.last >= b.last THEN 'includes' WHEN a.first >= b.first AND a.last <= b.last THEN 'included' ELSE 'overlaps' END AS relation
  FROM sp a JOIN sp b ON a.o_custkey = b.o_custkey AND a.seq <> b.seq)"""


def order_spans(spark, d):
    both = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.groupBy("o_custkey", F.col("l_orderkey").alias("seq")).agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


@query(f"WITH {SPANS} SELECT * FROM rel")
def seq_span_relations(spark, d):
    return toc.span_relations(order_spans(spark, d), ["o_custkey"])


RANKS = f"""{SPANS}, {BADNESS}, c AS (SELECT o_custkey, a AS seq, sum((relation = 'includes')::INT) AS inc, sum((relation = 'overlaps')::INT) AS ovr FROM rel GROUP BY ALL),
rk AS (SELECT o.o_custkey, b.l_orderkey AS seq, coalesce(inc, 0) - 3 * coalesce(ovr, 0) - 5 * (total_gap + total_diff2) / n AS rank
  FROM bad b JOIN orders o ON o.o_orderkey = b.l_orderkey LEFT JOIN c ON c.o_custkey = o.o_custkey AND c.seq = b.l_orderkey)"""


def order_ranks(spark, d):
    owner = table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), "o_custkey")
    bad = toc.sequence_badness(order_items(spark, d), ["l_orderkey"], "l_linenumber", "enum").withColumnRenamed("l_orderkey", "seq").join(owner, "seq")
    return toc.sequence_ranks(toc.span_relations(order_spans(spark, d), ["o_custkey"]), bad, ["o_custkey"])


@query(f"WITH {RANKS} SELECT o_custkey, seq, round(rank, 4) AS rank FROM rk")
def seq_rank(spark, d):
    return order_ranks(spark, d).withColumn("rank", F.round(F.col("rank").cast("double"), 4))


@query(f"WITH {RANKS} SELECT o_custkey, seq FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY rank DESC, seq) AS r FROM rk) WHERE r = 1")
def main_sequence(spark, d):
    return toc.main_sequence(order_ranks(spark, d), ["o_custkey"])


LEVELS = "lv AS (SELECT l_orderkey, l_linenumber AS item, CAST(2 + min(l_suppkey) % 3 AS INT) AS level, CAST(10 * l_linenumber AS INT) AS para_no FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def leveled(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("l_suppkey"))
    return items.select("l_orderkey", F.col("l_linenumber").alias("item"), (2 + F.col("l_suppkey") % 3).cast("int").alias("level"), (10 * F.col("l_linenumber")).alias("para_no"))


@query(f"WITH {LEVELS} SELECT a.l_orderkey, a.item, a.level, (SELECT max(b.item) FROM lv b WHERE b.l_orderkey = a.l_orderkey AND b.item < a.item AND b.level = a.level - 1) AS parent FROM lv a")
def toc_parent(spark, d):
    return toc.parents(leveled(spark, d), "l_orderkey").select("l_orderkey", "item", "level", "parent")


@query(f"WITH {LEVELS} SELECT a.l_orderkey, a.item, a.level, (SELECT min(b.para_no) FROM lv b WHERE b.l_orderkey = a.l_orderkey AND b.item > a.item AND b.level <= a.level) - 1 AS end_para FROM lv a")
def toc_end(spark, d):
    return toc.ends(leveled(spark, d), "l_orderkey").select("l_orderkey", "item", "level", "end_para")


@query(
    "WITH i AS (SELECT l_orderkey, l_linenumber, min(l_returnflag || l_linestatus) AS f FROM lineitem GROUP BY ALL), n AS (SELECT *, lag(f) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS p FROM i) SELECT l_orderkey, l_linenumber FROM n WHERE p IS NULL OR p <> f"
)
def index_dedup(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.concat("l_returnflag", "l_linestatus")).alias("flags"))
    return readers.drop_repeats(items, ["l_orderkey"], ["l_linenumber"], ["flags"]).select("l_orderkey", "l_linenumber")


@query()
def toc_items_full(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    head = F.concat(F.col("l_linenumber").cast("string"), F.lit(". "), F.initcap(F.concat_ws(" ", "l_returnflag", "l_linestatus", F.lit("Terms"))))
    items = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"), F.min("l_linestatus").alias("l_linestatus"))
    rows = items.select(F.col("l_orderkey").alias("doc_id"), F.row_number().over(w).alias("para_no"), F.lit(1).alias("page"), head.alias("text"))
    return toc.build(rows)


# parts, facts, lookups, retrieval


@query(
    """SELECT s.s_suppkey, coalesce(CASE WHEN s.s_suppkey % 3 = 0 THEN n.n_name END, CASE WHEN s.s_suppkey % 5 <> 0 THEN r.r_name END, 'USA') AS country
FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""
)
def country_fallback(spark, d):
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    rows = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    country = F.coalesce(F.when(F.col("s_suppkey") % 3 == 0, F.col("n_name")), F.when(F.col("s_suppkey") % 5 != 0, F.col("r_name")), F.lit("USA"))
    return rows.select("s_suppkey", country.alias("country"))


@query(
    "SELECT event_id, last_value(CASE WHEN event_type = 'login' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS enclosing FROM events"
)
def asof_enclosing(spark, d):
    e = table(spark, d, "events")
    return lines.last_known(e, ["user_id"], F.struct("ts", "event_id"), F.when(F.col("event_type") == "login", F.col("event_id")), "enclosing").select("event_id", "enclosing")


@query("SELECT page_id, length(regexp_replace(html, '<[^>]*>', '', 'g')) AS n FROM pages")
def tag_strip(spark, d):
    return table(spark, d, "pages").select("page_id", F.length(text.remove_tags(F.col("html"))).alias("n"))


@query()
def kept_tags(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("html"))


@query("SELECT page_id, CAST(generate_subscripts(p, 1) - 1 AS INT) AS nth, trim(regexp_replace(unnest(p), '<[^>]*>', '', 'g')) AS text FROM (SELECT page_id, regexp_extract_all(html, '(?s)<p[^>]*>(.*?)</p>', 1) AS p FROM pages)")
def html_paragraphs(spark, d):
    return readers.html_paragraphs(table(spark, d, "pages"))


@query()
def html_sections(spark, d):
    return readers.split_sections(table(spark, d, "pages"))


@query(
    """WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (
  SELECT q.vec_id AS query, v.vec_id, list_cosine_similarity(q.e, v.embedding::DOUBLE[]) AS score FROM q JOIN embeddings v ON v.vec_id <> q.vec_id)
SELECT query, vec_id, round(score, 6) AS score, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 3"""
)
def topk_similar(spark, d):
    e = table(spark, d, "embeddings")
    return parts.top_similar(e.where("vec_id % 50 = 0"), e).withColumn("score", F.round("score", 6))


@query(
    """SELECT o_orderkey, 'status' AS attribute, 'text' AS type, CAST(NULL AS BIGINT) AS int_v, CAST(NULL AS DOUBLE) AS float_v, o_orderstatus AS text_v, CAST(NULL AS VARCHAR) AS date_v FROM orders
UNION ALL SELECT o_orderkey, 'customer', 'integer', o_custkey, NULL, NULL, NULL FROM orders UNION ALL SELECT o_orderkey, 'total', 'float', NULL, o_totalprice, NULL, NULL FROM orders
UNION ALL SELECT o_orderkey, 'day', 'date', NULL, NULL, NULL, strftime(o_orderdate, '%Y-%m-%d') FROM orders"""
)
def eav_facts(spark, d):
    values = {"status": F.col("o_orderstatus"), "customer": F.col("o_custkey"), "total": F.col("o_totalprice"), "day": F.col("o_orderdate")}
    return parts.facts(table(spark, d, "orders"), "o_orderkey", values).withColumn("date_v", F.col("date_v").cast("string"))


@query("SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS display FROM orders")
def display_number(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.display_number(F.floor("o_totalprice")).alias("display"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS display FROM orders")
def display_date(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.display_date(F.col("o_orderdate")).alias("display"))


@query("SELECT p_partkey FROM part WHERE NOT regexp_matches(lower(p_name), 'abstract|ccr|recon')")
def abstract_filter(spark, d):
    return table(spark, d, "part").where(~classify.is_abstract_name(F.col("p_name"))).select("p_partkey")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def label_lookup(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


# further operators

AT = "WITH i AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY ALL)"


def order_lines(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))


@query(LINE_STATS + ", r AS (SELECT doc_id, page, right_x - lag(right_x) OVER (PARTITION BY doc_id, page ORDER BY line) AS d FROM lns WHERE right_is_number = 1) SELECT doc_id, page, count(*) AS n_refs, round(sqrt(coalesce(sum(d::DOUBLE * d), 0)) / count(*), 4) AS spread FROM r GROUP BY doc_id, page")
def aligned_references(spark, d):
    rows = pages.line_stats(doc_tokens(spark, d))
    return pages.aligned_references(rows.withColumn("right_x", F.col("right_x").cast("double"))).withColumn("spread", F.round("spread", 4))


@query(TOKENS + ", s AS (SELECT doc_id, sn, text, lead(text) OVER (PARTITION BY doc_id ORDER BY sn) AS nx FROM tok) SELECT doc_id, sn FROM s WHERE ends_with(text, '-') AND starts_with(nx, regexp_replace(text, '-+$', '')) AND length(nx) > length(regexp_replace(text, '-+$', ''))")
def split_word_candidates(spark, d):
    w = Window.partitionBy("doc_id").orderBy("sn")
    return doc_tokens(spark, d).withColumn("nx", F.lead("text").over(w)).where(classify.is_split_word(F.col("text"), F.col("nx"))).select("doc_id", "sn")


@query()
def joined_split_words(spark, d):
    return tokens.join_split_words(gathered_tokens(spark, d), tokens.word_frequencies(doc_tokens(spark, d)))


@query(
    ENGINES
    + f""", un AS (SELECT * FROM tok t WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.doc_id = t.doc_id AND b.sn_a = t.sn)),
d AS (SELECT word FROM (SELECT lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS word FROM tok) WHERE length(word) > 1 GROUP BY word HAVING count(*) >= 3)
SELECT doc_id, sn FROM un LEFT JOIN d ON d.word = lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) WHERE {CATEGORY} <> 'NONE' OR word IS NOT NULL OR conf > 80"""
)
def pairless_kept(spark, d):
    a, b = engines(spark, d)
    only = vote.unmatched(a, vote.mutual_best(vote.overlapping_pairs(a, b)), "a")
    return vote.keep_pairless(only, tokens.frequent_words(a)).select("doc_id", "sn")


@query(ENGINES + ", v AS (SELECT doc_id, sn_a AS sn, text_b AS voted FROM best WHERE text_a <> text_b AND conf_b > conf_a) SELECT t.doc_id, t.sn, coalesce(v.voted, t.text) AS text FROM tok t LEFT JOIN v ON v.doc_id = t.doc_id AND v.sn = t.sn")
def applied_votes(spark, d):
    a, b = engines(spark, d)
    best = vote.mutual_best(vote.overlapping_pairs(a, b)).where("text_a <> text_b and conf_b > conf_a")
    return vote.apply_votes(a, best.select("doc_id", F.col("sn_a").alias("sn"), F.col("text_b").alias("voted"))).select("doc_id", "sn", "text")


@query(
    "WITH i AS (SELECT l_orderkey, l_linenumber, min(l_quantity)::BIGINT AS v FROM lineitem GROUP BY ALL), s AS (SELECT *, v - lag(v) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS step FROM i) SELECT l_orderkey AS cluster, count(*) AS n, round(avg(CASE WHEN step = 1 THEN 1.0 ELSE 0.0 END), 6) AS seq_ratio, round(avg(CASE WHEN v % 2 = 0 THEN 1.0 ELSE 0.0 END), 6) AS period_ratio FROM s GROUP BY l_orderkey"
)
def line_number_scores(spark, d):
    v = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").cast("long").alias("v"))
    rows = v.select(F.lit(1).alias("doc_id"), F.col("l_orderkey").alias("cluster"), F.col("l_linenumber").alias("block"), F.concat(F.col("v").cast("string"), F.when(F.col("v") % 2 == 0, ".").otherwise("")).alias("text"))
    return clusters.line_number_scores(rows).select("cluster", "n", F.round("seq_ratio", 6).alias("seq_ratio"), F.round("period_ratio", 6).alias("period_ratio"))


@query(
    BLOCKS
    + """, s AS (SELECT doc_id, line, x1 < 5000 AS is_label, list(block ORDER BY block) AS blocks FROM blk GROUP BY doc_id, page, line, x1 < 5000)
SELECT v.doc_id, v.line, unnest(l.blocks) AS label_block, v.value_block FROM (SELECT doc_id, line, unnest(blocks) AS value_block FROM s WHERE NOT is_label) v JOIN s l ON l.doc_id = v.doc_id AND l.line = v.line AND l.is_label"""
)
def label_values(spark, d):
    b = layout.blocks(doc_tokens(spark, d))
    return clusters.label_values(b.where("x1 < 5000"), b.where("x1 >= 5000")).select("doc_id", "line", "label_block", "value_block")


@query(AT + " SELECT l_orderkey, s % 3 AS style, count(*) AS n, round(avg(p), 4) AS mean_left, round(stddev_samp(p), 4) AS sd_left FROM i GROUP BY l_orderkey, s % 3")
def sequence_positions(spark, d):
    rows = order_lines(spark, d).select("l_orderkey", (F.col("s") % 3).alias("style"), F.col("p").alias("left"), F.col("s").alias("center"))
    out = more.sequence_position(rows, ["l_orderkey", "style"])
    return out.select("l_orderkey", "style", "n", F.round("mean_left", 4).alias("mean_left"), F.round("sd_left", 4).alias("sd_left"))


@query(AT + ", c AS (SELECT l_orderkey AS doc_id, s % 3 AS style, p % 4 AS level, count(*) AS n FROM i GROUP BY ALL) SELECT doc_id, style, level FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, style ORDER BY n DESC, level) AS r FROM c) WHERE r = 1")
def modal_levels(spark, d):
    rows = order_lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), (F.col("s") % 3).alias("style"), (F.col("p") % 4).alias("level"))
    return more.modal_level(rows)


@query(AT + ", w AS (SELECT *, last_value(CASE WHEN s % 2 = 0 THEN p % 4 END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM i) SELECT l_orderkey AS doc_id, l_linenumber AS item, CASE WHEN s % 2 = 1 AND p % 4 <= b THEN b + 1 ELSE p % 4 END AS level FROM w")
def deeper_parentheses(spark, d):
    rows = order_lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("item"), F.when(F.col("s") % 2 == 1, "digit_paren").otherwise("digit").alias("style"), (F.col("p") % 4).alias("level"))
    return more.deeper_parentheses(rows).select("doc_id", "item", "level")


@query(f"WITH {LEVELS}, e AS (SELECT a.l_orderkey AS doc_id, a.para_no, (SELECT min(b.para_no) FROM lv b WHERE b.l_orderkey = a.l_orderkey AND b.item > a.item AND b.level <= a.level) - 1 AS end_para FROM lv a) SELECT p.doc_id, p.para_no, count(*) AS covers FROM e p JOIN e t ON t.doc_id = p.doc_id AND t.para_no <= p.para_no AND (t.end_para IS NULL OR t.end_para >= p.para_no) GROUP BY p.doc_id, p.para_no")
def cover_counts(spark, d):
    t = toc.ends(leveled(spark, d), "l_orderkey").withColumnRenamed("l_orderkey", "doc_id")
    return more.cover_counts(t.select("doc_id", "para_no"), t)


@query()
def section_html(spark, d):
    t = toc.ends(leveled(spark, d), "l_orderkey").withColumnRenamed("l_orderkey", "doc_id").withColumn("section", F.col("item").cast("string")).withColumn("header", F.lit("Terms"))
    return more.section_html(t, t.select("doc_id", "para_no", F.lit("text").alias("text")))


@query()
def aligned_headers(spark, d):
    header = text.sentence_header(F.col("text"))
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("key"), header.alias("a"), F.lower(header).alias("b"))
    return pairwise.align_pairs(b)


@query()
def indent_groups(spark, d):
    rows = order_lines(spark, d).select(F.col("l_orderkey").alias("doc_id"), F.lit("digit").alias("style"), F.col("l_linenumber").alias("item"), F.col("p").alias("left"), F.col("s").alias("center"))
    return more.group_indents(rows)


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def unprotected_rows(spark, d):
    kept = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return more.unprotected(table(spark, d, "part").select("p_partkey"), kept, "p_partkey")


@query("WITH n AS (SELECT DISTINCT regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '_', 'g') AS name FROM customer), k AS (SELECT name, CAST(100 AS BIGINT) AS id FROM n WHERE name = 'building') SELECT name, id FROM k UNION ALL SELECT name, coalesce((SELECT max(id) FROM k), 0) + row_number() OVER (ORDER BY name) FROM n WHERE name NOT IN (SELECT name FROM k)")
def label_ids(spark, d):
    names = table(spark, d, "customer").select(F.col("c_mktsegment").alias("name"))
    known = names.select(text.standard_name(F.col("name")).alias("name")).distinct().where("name = 'building'").select("name", F.lit(100).cast("long").alias("id"))
    return more.ids_for_names(names, known)


@query(LINE_STATS + " SELECT doc_id, page, line FROM lns WHERE center BETWEEN 4500 AND 5500 AND left_x > 1000 AND n_words < 12 AND n_all_cap * 3 >= n_words * 2")
def centred_headings(spark, d):
    return more.centred_headings(pages.line_stats(doc_tokens(spark, d)), band=500, left=1000).select("doc_id", "page", "line")


@query(PAGE_DICT + " SELECT doc_id, page FROM pg WHERE n_words >= 2.0 * greatest(n_dict, 1)")
def drawing_pages(spark, d):
    return more.drawing_pages(page_statistics(spark, d), 2.0)


@query("SELECT doc_id, format('htmlfile_{:08d}', doc_id) AS html_name FROM documents")
def html_names(spark, d):
    return more.name_register(table(spark, d, "documents").select("doc_id", F.lit("media/a/b.pdf").alias("path")), "path").select("doc_id", "html_name")


@query("WITH p AS (SELECT conv_id AS doc_id, turn AS para_no, CASE WHEN regexp_matches(text, '^[A-M]') THEN 'start' ELSE 'end' END AS mark FROM conversations), b AS (SELECT *, last_value(CASE WHEN mark = 'start' THEN para_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY para_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS begin_para FROM p) SELECT doc_id, begin_para, para_no AS end_para FROM b WHERE mark = 'end' AND para_no - begin_para <= 20")
def recital_intervals(spark, d):
    marks = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("para_no"), F.when(F.col("text").rlike("^[A-M]"), "start").otherwise("end").alias("mark"))
    return parts.recitals(marks)


_LABELS = " UNION ALL ".join(f"SELECT conv_id AS doc_id, turn AS para_no, '{k}' AS label, {_score_sql(k)} AS score, {bar} AS bar, {classify.LABEL_CAPS[k]} AS cap FROM q0" for k, bar in classify.LABEL_BAR.items())


@query(
    f"""WITH q0 AS (SELECT *, regexp_replace(regexp_replace(text, '[^A-Za-z0-9]+$', '') || ' ', '[^A-Za-z0-9]+', ' ', 'g') AS q FROM conversations), s AS ({_LABELS}),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, label ORDER BY para_no) AS r FROM s WHERE score > bar) WHERE r <= cap),
n AS (SELECT *, CASE WHEN para_no - lag(para_no) OVER w <= 5 THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY doc_id, label ORDER BY para_no)), r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, label ORDER BY para_no) AS run FROM n)
SELECT doc_id, label, min(para_no) AS begin_para, max(para_no) AS end_para, count(*) AS n FROM r GROUP BY doc_id, label, run"""
)
def part_intervals(spark, d):
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("para_no"), "text")
    return parts.intervals(parts.label_paragraphs(rows))
