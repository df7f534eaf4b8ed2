"""More registered queries: page scores, titles, lookups, votes put into the text, header matches, text functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import classify, text
from ..operators import lines, lookups, pages, parts, scores, toc, vote
from ..sources import layout, readers, sinks
from . import catalog
from .catalog import (
    BLOCKS, CATEGORY, COLUMNS, ENGINES, ITEMS, LEVELS, LINE_STATS, PARAS, PARA_STATS, RANKS, STYLE, TOKENS,
    column_groups_of, doc_tokens, engines, gathered_tokens, leveled, order_items, order_ranks, order_spans, para_tokens, query, table,
)

_quoted = lambda words: ", ".join(f"'{w}'" for w in words)
_count = lambda c: f"sum(CASE WHEN {c} THEN 1 ELSE 0 END)::BIGINT"
_int = lambda c: f"coalesce(try_cast(regexp_extract({c}, '^\\s*([+-]?[0-9]+)', 1) AS INT), 0)"
_MIDDLE = f"center > {scores.CENTER[0]} AND center < {scores.CENTER[1]}"
_CENTRED = f"coalesce({_MIDDLE} AND left_x > {scores.LEFT}, false)"
_WIDE = f"coalesce(center > {scores.WIDE_CENTER[0]} AND center < {scores.WIDE_CENTER[1]} AND left_x > {scores.WIDE_LEFT[0]} AND left_x < {scores.WIDE_LEFT[1]}, false)"
_FIRST = "n_words * 2 < n_first_cap * 3"
_CAPS = f"(n_words * 2 < n_all_cap * 3 OR {_FIRST})"

MARKED = (
    LINE_STATS
    + f""", mk AS (SELECT doc_id, page, line, sum(length(text))::BIGINT AS n_chars, {_count(f"text IN ({_quoted(classify.SIGNATURE_WORDS)})")} AS n_sig,
  {_count("low = 'by'")} AS n_by, {_count(f"low IN ({_quoted(classify.PARTY_ROLES)})")} AS n_party, {_count("low = 'witness'")} AS n_witness,
  {_count("low IN ('name', 'title', 'date')")} AS n_names, {_count(f"text IN ({_quoted(scores.CONTENTS_WORDS)})")} AS n_contents,
  CAST(regexp_matches(arg_min(text, sn), '{scores.ITEM_START}') AS INT) AS toc_item, CAST(regexp_matches(arg_max(text, sn), '{scores.REFERENCE_END}') AS INT) AS page_ref,
  {_int("arg_min(text, sn)")} AS item_value, CASE WHEN regexp_matches(arg_max(text, sn), '{scores.REFERENCE_END}') THEN {_int("arg_max(text, sn)")} ELSE 0 END AS ref_value
  FROM (SELECT *, lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS low FROM tok) GROUP BY doc_id, page, line),
mln AS (SELECT * FROM lns JOIN mk USING (doc_id, page, line))"""
)
DOC_SCORES = (
    MARKED
    + f""", sm AS (SELECT doc_id, page, count(*) AS n, sum(n_words)::BIGINT AS words, {_count("n_chars > 2")} AS rl, {_count(f"n_chars > 2 AND ({_CENTRED} OR {_WIDE})")} AS mid,
  {_count("n_chars > 2 AND n_words > 9")} AS long, {_count(f"n_chars > 2 AND {_CAPS}")} AS caps, {_count(_CENTRED)} AS amid, {_count("n_words > 9")} AS along, {_count(_FIRST)} AS acaps,
  sum(n_sig)::BIGINT AS n_sig, sum(n_by)::BIGINT AS n_by, sum(n_party)::BIGINT AS n_party, sum(n_witness)::BIGINT AS n_witness, sum(n_names)::BIGINT AS n_names,
  sum(toc_item)::BIGINT AS items, sum(page_ref)::BIGINT AS refs, max((n_contents > 0)::INT) AS headed FROM mln GROUP BY doc_id, page),
dsc AS (SELECT doc_id, page, 10 + greatest(0, 11 - rl) * 5 + ((5 * (mid - rl)) // (rl + 2)) - ((10 * long) // (rl + 2)) - ((10 * n_sig) // (words + 2)) + ((5 * (caps - rl)) // (rl + 2)) AS title_score,
  ((100 * acaps) // (n + 2)) - ((100 * amid) // (n + 2)) - ((100 * along) // (n + 2)) + ((200 * items) // (n + 2)) + ((100 * refs) // (n + 2)) + 150 * headed - 100 AS toc_score,
  10 * n_by + 10 * (CASE WHEN n_party <= 4 THEN n_party ELSE 8 - n_party END) + 150 * n_witness + 5 * (CASE WHEN n_names < 10 THEN n_names ELSE 10 - n_names END) AS sig_score FROM sm)"""
)


@query(MARKED + " SELECT * FROM mln")
def line_marks(spark, d):
    return scores.marked_lines(doc_tokens(spark, d))


@query(DOC_SCORES + " SELECT * FROM dsc")
def document_scores(spark, d):
    return scores.document_scores(scores.marked_lines(doc_tokens(spark, d)))


@query(MARKED + " SELECT doc_id, page, sum(toc_item)::BIGINT AS n_items, count(*) AS n_lines, sum(toc_item) > 0.5 * count(*) AS is_contents FROM mln GROUP BY doc_id, page")
def contents_report(spark, d):
    return scores.contents_report(scores.marked_lines(doc_tokens(spark, d)))


_starts = lambda words: "^(" + "|".join(w[:n] if n else f"{w}$" for w, n in words) + ")"
_TITLE = f"""((starts_with(text, 'LEAS') AND NOT regexp_matches(nx, '{_starts(scores.NOT_AFTER_CAPITALS)}') OR text = 'Lease' AND nx NOT IN ({_quoted(scores.NOT_AFTER_CASED)})) AND lower(pv) <> 'of'
  OR (text = 'RULES' AND starts_with(nx2, 'REGU')) OR regexp_matches(text, '{_starts(scores.TITLE_CAPITALS)}') OR regexp_matches(text, '{_starts(scores.TITLE_CASED)}'))"""


@query(
    LINE_STATS
    + f""", nb AS (SELECT *, lag(text, 1, '') OVER w AS pv, lead(text, 1, '') OVER w AS nx, lead(text, 2, '') OVER w AS nx2 FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY sn)),
tl AS (SELECT doc_id, page, line, {_count(_TITLE)} AS n_title FROM nb GROUP BY doc_id, page, line),
sc AS (SELECT doc_id, page, line, n_title, 10 * n_title + CASE WHEN {_MIDDLE} THEN 10 ELSE 0 END - CASE WHEN center < {scores.FAR_LEFT} THEN 10 ELSE 0 END
  + CASE WHEN left_x > {scores.LEFT} THEN 10 ELSE 0 END + CASE WHEN {_CAPS} THEN 10 ELSE 0 END AS score FROM tl JOIN lns USING (doc_id, page, line) WHERE line % 40 < 5 AND n_title > 0 AND n_words <= 7)
SELECT * FROM sc WHERE score >= 22"""
)
def lease_titles(spark, d):
    return scores.lease_titles(doc_tokens(spark, d), layout.LINES_PER_PAGE)


PARA_SCORES = (
    PARAS
    + f""", pt0 AS (SELECT t.doc_id, p.para_no, t.page, t.sn, t.text FROM tok t JOIN par p ON p.doc_id = t.doc_id AND p.block = t.block),
pm AS (SELECT doc_id, para_no, min(page) AS page, sum(length(text)) + count(*) - 1 AS n_chars, CAST(regexp_matches(arg_min(text, sn), '{scores.ITEM_START}') AS INT) AS toc_item,
  CAST(regexp_matches(arg_max(text, sn), '{scores.REFERENCE_END}') AS INT) AS page_ref, {_int("arg_min(text, sn)")} AS item_value,
  CASE WHEN regexp_matches(arg_max(text, sn), '{scores.REFERENCE_END}') THEN {_int("arg_max(text, sn)")} ELSE 0 END AS ref_value, max((text IN ({_quoted(scores.CONTENTS_WORDS)}))::INT) AS headed FROM pt0 GROUP BY doc_id, para_no),
pl AS (SELECT *, ref_value - lag(ref_value, 1, 0) OVER w AS dr, item_value - lag(item_value, 1, 0) OVER w AS di FROM pm WINDOW w AS (PARTITION BY doc_id ORDER BY para_no)),
psc AS (SELECT doc_id, para_no, page, 5 * toc_item + 5 * page_ref + 300 * headed + CASE WHEN ref_value <> 0 AND dr IN (0, 1) THEN 10 ELSE 0 END + CASE WHEN item_value <> 0 AND di IN (0, 1) THEN 10 ELSE 0 END
  - CASE WHEN n_chars > 30 THEN 5 ELSE 0 END - CASE WHEN n_chars > 100 THEN 10 ELSE 0 END - CASE WHEN n_chars > 200 THEN 15 ELSE 0 END AS score FROM pl)"""
)


def scored_paragraphs(spark, d):
    return scores.paragraph_scores(scores.marked_paragraphs(para_tokens(spark, d)))


@query(PARA_SCORES + " SELECT * FROM psc")
def paragraph_scores(spark, d):
    return scored_paragraphs(spark, d)


@query(
    DOC_SCORES
    + """, i AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM dsc WHERE toc_score > -100),
rn AS (SELECT doc_id, min(page) AS a, max(page) AS b FROM i GROUP BY doc_id, g), np AS (SELECT doc_id, count(*) AS n_pages FROM dsc GROUP BY doc_id),
it AS (SELECT doc_id, line AS para_no, page, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS nth FROM mln WHERE toc_item = 1 OR page_ref = 1)
SELECT it.doc_id, it.para_no, it.page, EXISTS (SELECT 1 FROM rn WHERE rn.doc_id = it.doc_id AND it.page BETWEEN rn.a AND rn.b) AND n_pages > 4 AND nth > 1 AND (it.page < 12 OR n_pages > 90) AS in_contents FROM it JOIN np USING (doc_id)"""
)
def contents_flags(spark, d):
    marked = scores.marked_lines(doc_tokens(spark, d))
    s = scores.document_scores(marked)
    runs = pages.toc_runs(s.withColumn("toc_score", F.col("toc_score") + 100))
    items = marked.where("toc_item = 1 or page_ref = 1").select("doc_id", F.col("line").alias("para_no"), "page")
    return scores.contents_flags(items, runs, s.groupBy("doc_id").agg(F.count("*").alias("n_pages")))


@query(
    f"""WITH {ITEMS}, sq AS (SELECT o_custkey, l_orderkey AS seq, count(*) AS n, sum(enum)::BIGINT AS words, count(DISTINCT enum) AS caps, min(l_linenumber) AS a, max(l_linenumber) AS b FROM it JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT o_custkey AS doc_id, seq, round(10 * ln(n + 1) - CASE WHEN n <= 3 THEN 20 ELSE 0 END + 10 * (ln(caps + 1) - ln(n + 1)) + ln(1) - ln(1) + ln(caps + 1) + ln(n + 1) - 2 * ln(words + 1) + 5 * ln(b - a + 1) + 2 * (ln(1) - ln(n + 1)) - CASE WHEN seq % 2 = 0 THEN 0 ELSE 15 END, 6) AS score FROM sq WHERE n > 2"""
)
def main_scores(spark, d):
    owner = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("doc_id"))
    seqs = order_items(spark, d).join(owner, "l_orderkey").groupBy("doc_id", F.col("l_orderkey").alias("seq")).agg(
        F.count("*").alias("n_items"), F.sum("enum").alias("n_words"), F.countDistinct("enum").alias("header_words"), F.min("l_linenumber").alias("first_page"), F.max("l_linenumber").alias("last_page")
    )
    none = F.lit(0)
    full = seqs.withColumns({"includes": none, "included": none, "n_first_cap": F.col("header_words"), "n_all_cap": F.col("n_items"), "n_titled": none, "plain": F.col("seq") % 2 == 0})
    return scores.main_scores(full).withColumn("score", F.round("score", 6))


# places


@query(
    TOKENS
    + """, lc AS (SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY sn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS loc FROM tok),
o AS (SELECT doc_id, unnest(range(0, length(text) + 1, 100)) AS "offset" FROM documents WHERE text IS NOT NULL)
SELECT o.doc_id, o."offset", sn, page, line, x1, y1 FROM o ASOF JOIN lc ON lc.doc_id = o.doc_id AND lc.loc <= o."offset\""""
)
def offset_tokens(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    asked = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.length("text").cast("long"), F.lit(100).cast("long"))).alias("offset"))
    return lookups.at_offsets(sinks.char_offsets(doc_tokens(spark, d)), asked)


@query(LINE_STATS + " SELECT t.doc_id, t.page, t.line, t.sn, n_words, left_x, center FROM tok t JOIN lns l ON l.doc_id = t.doc_id AND l.page = t.page AND l.line = t.line")
def token_lines(spark, d):
    t = doc_tokens(spark, d)
    return lookups.with_line(t.select("doc_id", "page", "line", "sn").hint("merge"), pages.line_stats(t), ["n_words", "left_x", "center"])


@query(PARA_STATS + f", c AS (SELECT doc_id, sn FROM tok WHERE {CATEGORY} <> 'NONE') SELECT c.doc_id, c.sn, ps.para_no FROM c ASOF JOIN ps ON ps.doc_id = c.doc_id AND ps.first_sn <= c.sn")
def category_paragraphs(spark, d):
    t = doc_tokens(spark, d)
    found = t.where(classify.token_category(F.col("text")) != "NONE")
    return lookups.paragraph_of(found, lines.paragraph_stats(para_tokens(spark, d)))


@query(BLOCKS + " SELECT doc_id, page, line, count(*) AS n_blocks, string_agg(CAST(block AS VARCHAR), ',' ORDER BY x1, block) AS blocks FROM blk GROUP BY doc_id, page, line")
def line_blocks(spark, d):
    return lookups.line_blocks(layout.blocks(doc_tokens(spark, d)))


@query(
    BLOCKS
    + """, p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, line ORDER BY x1, block) AS place FROM blk)
SELECT doc_id, page, block, place, count(*) OVER (PARTITION BY doc_id, page, place ORDER BY x1 RANGE BETWEEN 44 PRECEDING AND 44 FOLLOWING) - 1 AS n_near FROM p WHERE place <= 2"""
)
def near_starts(spark, d):
    return lookups.near_starts(layout.blocks(doc_tokens(spark, d)))


ORDERED = (
    COLUMNS
    + """, ord AS (SELECT b.doc_id, b.block, NOT regexp_matches(b.text, '[A-Za-z0-9]') AS gone, row_number() OVER (PARTITION BY b.doc_id ORDER BY b.page, coalesce(c.first_line, b.line), CASE WHEN c.first_line IS NOT NULL AND b.x1 >= 5000 THEN 1 ELSE 0 END, b.line, b.block) AS place
FROM blk b LEFT JOIN col c ON c.doc_id = b.doc_id AND c.page = b.page AND b.line BETWEEN c.first_line AND c.last_line AND c.line_ratio >= 0.7)"""
)


@query(ORDERED + " SELECT t.doc_id, t.sn, CASE WHEN gone THEN -3 ELSE row_number() OVER (PARTITION BY t.doc_id ORDER BY gone, place, t.sn) - 1 END AS place FROM tok t JOIN ord o ON o.doc_id = t.doc_id AND o.block = t.block")
def word_places(spark, d):
    t = doc_tokens(spark, d)
    b = layout.blocks(t)
    return lookups.word_places(t, lines.reading_order(b, column_groups_of(t)), b.where(~F.col("text").rlike("[A-Za-z0-9]")))


@query(
    COLUMNS
    + """ SELECT b.doc_id, b.page, count(DISTINCT CASE WHEN x1 < 5000 THEN line END) AS n_left_lines, count(DISTINCT CASE WHEN x1 >= 5000 THEN line END) AS n_right_lines, sum(last_sn - first_sn + 1)::BIGINT AS n_words
FROM blk b JOIN col c ON c.doc_id = b.doc_id AND c.page = b.page AND b.line BETWEEN c.first_line AND c.last_line GROUP BY b.doc_id, b.page"""
)
def column_report(spark, d):
    t = doc_tokens(spark, d)
    return lookups.column_report(layout.blocks(t), column_groups_of(t))


# votes and inserted tokens


@query(
    ENGINES
    + """, bt AS (SELECT doc_id, sn, text, y1, false AS ins FROM tokb UNION ALL SELECT doc_id, sn, text, y1, true FROM tok WHERE sn % 11 = 0),
n AS (SELECT *, abs(y1 - lag(y1) OVER w) AS dp, abs(y1 - lead(y1) OVER w) AS dn FROM bt WINDOW w AS (PARTITION BY doc_id ORDER BY sn, ins))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sn, ins) - 1 AS place, sn, text, ins AS inserted FROM n WHERE NOT ins OR (coalesce(dp < 200, true) AND coalesce(dn < 200, true))"""
)
def inserted_tokens(spark, d):
    a, b = engines(spark, d)
    # the second engine's words, with those that it left out
    only = vote.unmatched(a, vote.mutual_best(vote.overlapping_pairs(a, b)), "a")
    return lookups.inserted_tokens(b, only)


@query(ENGINES + " SELECT doc_id, page, sn_a AS sn, text_b AS text, sn_a - lag(sn_a) OVER (PARTITION BY doc_id ORDER BY page, sn_a) AS gap FROM best WHERE text_a <> text_b AND conf_b > conf_a")
def voted_scan(spark, d):
    a, b = engines(spark, d)
    best = vote.mutual_best(vote.overlapping_pairs(a, b)).where("text_a <> text_b and conf_b > conf_a")
    return lookups.voted_scan(best.select("doc_id", "page", F.col("sn_a").alias("sn"), F.col("text_b").alias("voted")))


_ED = lambda a, b: f"(CASE WHEN length({a}) > 150 OR length({b}) > 150 THEN length({a}) + length({b}) ELSE levenshtein({a}, {b}) END)"


@query(
    ENGINES
    + f""", e AS (SELECT doc_id, sn_a, {_ED("text_a", "text_b")} AS whole, {_ED("lower(text_a)", "lower(text_b)")} AS low,
  {_ED("regexp_replace(lower(text_a), '[^a-z0-9]', '', 'g')", "regexp_replace(lower(text_b), '[^a-z0-9]', '', 'g')")} AS core FROM best WHERE text_a <> text_b)
SELECT doc_id, sn_a AS sn, whole AS distance, whole - low AS capital, low - least(core, low) AS non_alnum, least(core, low) AS alnum FROM e"""
)
def split_distances(spark, d):
    a, b = engines(spark, d)
    best = vote.mutual_best(vote.overlapping_pairs(a, b)).where("text_a <> text_b")
    return best.select("doc_id", F.col("sn_a").alias("sn"), text.split_distance(F.col("text_a"), F.col("text_b")).alias("s")).select("doc_id", "sn", "s.*")


@query(
    TOKENS
    + f""", m AS (SELECT doc_id, sn, 'RF' || row_number() OVER (PARTITION BY doc_id ORDER BY sn) AS text, 0 AS side FROM tok WHERE {CATEGORY} <> 'NONE'),
u AS (SELECT doc_id, sn, text, 1 AS side FROM tok UNION ALL SELECT * FROM m) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sn, side) - 1 AS place, text FROM u"""
)
def label_tokens(spark, d):
    t = doc_tokens(spark, d)
    return lookups.label_tokens(t, t.where(classify.token_category(F.col("text")) != "NONE"))


@query(ENGINES + ", e AS (SELECT doc_id, page, 'a' AS engine FROM tok UNION ALL SELECT doc_id, page, 'b' FROM tokb) SELECT doc_id, engine, max(page) AS last_page, count(*) AS n FROM e GROUP BY doc_id, engine")
def engine_pages(spark, d):
    a, b = engines(spark, d)
    both = a.select("doc_id", "page", F.lit("a").alias("engine")).unionByName(b.select("doc_id", "page", F.lit("b").alias("engine")))
    return both.groupBy("doc_id", "engine").agg(F.max("page").alias("last_page"), F.count("*").alias("n"))


# headers, sequences, paths


@query(
    """WITH n AS (SELECT source, doc_id, lower(c) AS low, c FROM (SELECT source, doc_id, regexp_replace(substring(text, 1, 41), '[^A-Za-z0-9]', '', 'g') AS c FROM documents) WHERE length(c) > 2),
p AS (SELECT a.source, a.doc_id AS i, b.doc_id AS j, levenshtein(a.low, b.low) AS distance, levenshtein(a.c, b.c) AS case_distance FROM n a JOIN n b ON a.source = b.source AND a.doc_id < b.doc_id AND abs(length(a.low) - length(b.low)) <= 2 WHERE levenshtein(a.low, b.low) <= 2)
SELECT source, i, j, distance, case_distance FROM (SELECT *, row_number() OVER (PARTITION BY source, i ORDER BY distance + case_distance, j) AS r FROM p) WHERE r = 1"""
)
def near_headers(spark, d):
    docs = table(spark, d, "documents")
    return lookups.near_headers(docs.select("source", F.col("doc_id").alias("item"), F.col("text").alias("header")), "source")


@query(
    "WITH i AS (SELECT l_orderkey, l_linenumber AS item, min(l_suppkey) AS page, min(l_returnflag) = 'R' AS removed FROM lineitem GROUP BY ALL), k AS (SELECT * FROM i WHERE NOT removed) "
    "SELECT o.l_orderkey, min(k.item) AS first_item, max(k.item) AS last_item, arg_min(k.page, k.item) AS first_page, arg_max(k.page, k.item) AS last_page FROM (SELECT DISTINCT l_orderkey FROM i) o LEFT JOIN k ON k.l_orderkey = o.l_orderkey GROUP BY o.l_orderkey"
)
def sequence_ends(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("item")).agg(F.min("l_suppkey").alias("page"), (F.min("l_returnflag") == "R").alias("removed"))
    return lookups.sequence_ends(rows, ["l_orderkey"])


@query(f"WITH {ITEMS} SELECT l_orderkey, l_linenumber, coalesce(abs(enum - lag(enum) OVER w - 1), 0) + coalesce(abs(lead(enum) OVER w - enum - 1), 0) AS badness FROM it WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)")
def item_badness(spark, d):
    return lookups.item_badness(order_items(spark, d), ["l_orderkey"], "l_linenumber", "enum").select("l_orderkey", "l_linenumber", "badness")


@query(
    "SELECT s.s_suppkey, coalesce(CASE WHEN n.n_nationkey % 2 = 0 THEN upper(n.n_name) END, CASE WHEN r.r_regionkey <> 0 THEN upper(r.r_name) END, 'USA') AS country FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"
)
def path_country(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    own = n.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, F.upper("n_name")).alias("v"))
    up = r.select(F.col("r_regionkey").alias("n_regionkey"), F.when(F.col("r_regionkey") != 0, F.upper("r_name")).alias("v"))
    return parts.coalesced_path(table(spark, d, "supplier"), [(own, "s_nationkey", "v"), (up, "n_regionkey", "v")], "country", "USA").select("s_suppkey", "country")


@query(f"WITH {LEVELS} SELECT l_orderkey, item, CASE WHEN level * 5 - 9 > 12 OR level * 5 - 9 < 1 THEN 10 ELSE level * 5 - 9 END AS level FROM (SELECT l_orderkey, item, level + item % 3 AS level FROM lv)")
def bad_levels(spark, d):
    return toc.bad_levels(leveled(spark, d).select("l_orderkey", "item", ((F.col("level") + F.col("item") % 3) * 5 - 9).alias("level")))


@query(
    f"""WITH {LEVELS}, x AS (SELECT l_orderkey AS doc_id, item, para_no, level, 'Item' AS header FROM lv WHERE NOT (para_no BETWEEN 15 AND 35) UNION ALL SELECT DISTINCT l_orderkey, 0, 20, 2, 'Recitals' FROM lv)
SELECT doc_id, item, para_no, level, header, row_number() OVER (PARTITION BY doc_id ORDER BY para_no, level, header) AS place FROM x"""
)
def edited_contents(spark, d):
    t = leveled(spark, d).withColumnRenamed("l_orderkey", "doc_id").withColumn("header", F.lit("Item"))
    ids = t.select("doc_id").distinct()
    removed = ids.select("doc_id", F.lit(15).alias("begin_para"), F.lit(35).alias("end_para"))
    added = ids.select("doc_id", F.lit(0).alias("item"), F.lit(20).alias("para_no"), F.lit(2).alias("level"), F.lit("Recitals").alias("header"))
    return parts.edit_toc(t, removed, added)


# predicates and text functions


@query(
    TOKENS
    + f""", l AS (SELECT doc_id, line, arg_max(text, sn) AS ref FROM tok GROUP BY doc_id, line), k AS (SELECT *, CASE WHEN regexp_matches(ref, '^I?[0-9]+$') OR ref = 'I' THEN 2 WHEN regexp_matches(ref, '^I?[ivx]+$') THEN 1 ELSE 4 END AS kind FROM l)
SELECT kind, count(*) AS n, sum(CASE WHEN kind = 2 THEN greatest(1, coalesce(try_cast(regexp_replace(ref, '^I', '1') AS INT), 0)) END)::BIGINT AS total FROM k GROUP BY kind"""
)
def page_types(spark, d):
    refs = doc_tokens(spark, d).groupBy("doc_id", "line").agg(F.max_by("text", "sn").alias("ref")).withColumn("kind", text.page_type(F.col("ref")))
    return refs.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.when(F.col("kind") == text.PAGE_TYPES["arabic"], text.page_value(F.col("ref")))).alias("total"))


@query("SELECT doc_id, text FROM documents")
def unescaped_texts(spark, d):
    docs = table(spark, d, "documents")
    # as a JSON writer puts it: quotes, controls and letters with accents escaped
    json = F.expr(r"substring(to_json(named_struct('t', text)), 7, length(to_json(named_struct('t', text))) - 8)")
    for letter in "éèêàùçôîûÉÈ£€¥°":
        json = F.replace(json, F.lit(letter), F.lit(f"\\u{ord(letter):04x}"))
    return docs.select("doc_id", F.when(F.col("text").isNotNull(), text.unescape(json)).alias("text"))


_SEC = "|".join(w[:7] for w in classify.SECTION_WORDS)


@query(
    f"""SELECT conv_id, turn, upper(regexp_replace(substring(text, 1, 60), '[^ -~]', '', 'g')) AS capitals, lower(substring(text, 1, 100)) AS small, CASE WHEN contains(text, '. ') THEN '. ' || list_last(string_split(text, '. ')) ELSE '' END AS tail,
  coalesce(nullif(regexp_extract(text, '"([^"]*)"', 1), ''), '-') AS quoted, regexp_matches(lower(text), '^({_SEC})') AS opens, regexp_matches(text, '^[ivxl]{{1,5}}$|^[IVXL]{{1,5}}$') AS roman,
  regexp_matches(text, '(?i)\\b(in|of|under|to|with)\\s+(section|article|paragraph)\\s+[0-9]+|(section|article|paragraph)\\s+[0-9]+\\s+(hereof|above|below)') AS refers,
  substring(ltrim(regexp_replace(regexp_replace(text, '&[a-z]+;', '', 'g'), '["''<>\\n]', '', 'g'), ' '), 1, 80) AS plain FROM conversations"""
)
def header_forms(spark, d):
    c = F.col("text")
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.upper(F.regexp_replace(F.substring(c, 1, 60), "[^ -~]", "")).alias("capitals"), text.lower_and_cut(c).alias("small"), text.after_last(c, ". ").alias("tail"),
        text.or_placeholder(F.regexp_extract(c, '"([^"]*)"', 1)).alias("quoted"), classify.opens_section(c).alias("opens"), classify.is_roman(c).alias("roman"),
        classify.refers_to_section(c).alias("refers"), text.clean_quotes(c).alias("plain"),
    )


@query("SELECT o_orderkey, CASE WHEN starts_with(lower(o_orderpriority), '1-') OR starts_with(lower(o_orderpriority), '2-') THEN 'first' WHEN starts_with(lower(o_orderpriority), '4-not') THEN 'none' ELSE 'later' END AS model FROM orders")
def prefix_classes(spark, d):
    names = {"1-": "first", "2-": "first", "4-NOT": "none"}
    return table(spark, d, "orders").select("o_orderkey", text.prefix_class(F.col("o_orderpriority"), names, "later").alias("model"))


@query("SELECT page_id, len(regexp_extract_all(html, '(?i)<p\\b')) AS n_paragraphs, len(regexp_extract_all(html, '(?i)<a\\b')) AS n_links, len(regexp_extract_all(html, '(?i)<span\\b')) AS n_spans FROM pages")
def tag_counts(spark, d):
    return table(spark, d, "pages").select("page_id", *(text.count_tags(F.col("html"), tag).alias(n) for tag, n in (("p", "n_paragraphs"), ("a", "n_links"), ("span", "n_spans"))))


@query(
    TOKENS
    + """, l AS (SELECT doc_id, line, count(*) AS n, try_cast(CASE WHEN regexp_matches(arg_max(text, sn), '^[0-9]{1,3}$') THEN arg_max(text, sn) END AS INT) AS last FROM tok GROUP BY doc_id, line),
c AS (SELECT * FROM l WHERE n <= 10 AND last < 200), r AS (SELECT *, max(last) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM c)
SELECT doc_id, line, last, coalesce(last >= top, true) AS rises FROM r"""
)
def rising_references(spark, d):
    rows = doc_tokens(spark, d).groupBy("doc_id", "line").agg(F.count("*").alias("n"), F.max_by("text", "sn").alias("ref"))
    found = rows.where(F.col("ref").rlike(r"^\d{1,3}$") & (F.col("n") <= 10)).withColumn("last", F.col("ref").cast("int")).where("last < 200")
    top = F.max("last").over(Window.partitionBy("doc_id").orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    return found.select("doc_id", "line", "last", F.coalesce(F.col("last") >= top, F.lit(True)).alias("rises"))


@query(
    LINE_STATS
    + """, c AS (SELECT doc_id, page, left_x // 1000 AS bin, count(*) AS n, avg(left_x) AS mean_left, avg(right_x) AS mean_right, stddev_samp(left_x) AS sd_left, stddev_samp(right_x) AS sd_right, avg(right_is_number) AS number_ratio, avg(n_words) AS mean_words
  FROM lns WHERE left_x IS NOT NULL GROUP BY ALL) SELECT doc_id, page, bin, n, round(mean_left, 4) AS mean_left, round(mean_right, 4) AS mean_right, round(sd_left, 4) AS sd_left, round(sd_right, 4) AS sd_right, round(number_ratio, 4) AS number_ratio, round(mean_words, 4) AS mean_words FROM c"""
)
def indent_cluster_stats(spark, d):
    return pages.indent_clusters(pages.line_stats(doc_tokens(spark, d)))


@query(
    LINE_STATS
    + """, c AS (SELECT doc_id, page, left_x // 1000 AS bin, count(*) AS n FROM lns WHERE left_x IS NOT NULL GROUP BY ALL)
SELECT doc_id, count(*) AS n_clusters, round(avg(n), 4) AS mean_size, round(stddev_pop(n), 4) AS sd_size FROM c GROUP BY doc_id"""
)
def cluster_sizes(spark, d):
    c = pages.indent_clusters(pages.line_stats(doc_tokens(spark, d)))
    return c.groupBy("doc_id").agg(F.count("*").alias("n_clusters"), F.round(F.avg("n"), 4).alias("mean_size"), F.round(F.stddev_pop("n"), 4).alias("sd_size"))


@query(
    f"""WITH {LEVELS}, p AS (SELECT *, lag(level) OVER (PARTITION BY l_orderkey ORDER BY item) AS pl, item - lag(item) OVER (PARTITION BY l_orderkey ORDER BY item) - 1 AS gap FROM lv)
SELECT l_orderkey, count(*) AS n_items, {_count("level = 2")} AS n_top, {_count("level > pl")} AS n_nested, coalesce(sum(gap), 0)::BIGINT AS total_gap FROM p GROUP BY l_orderkey"""
)
def contents_summary(spark, d):
    return toc.summary(leveled(spark, d), "l_orderkey")


@query("""WITH b AS (SELECT o_custkey, 'status' AS attribute, arg_max(o_orderstatus, o_orderkey) AS v FROM orders GROUP BY o_custkey) SELECT o_custkey, attribute, v AS text_v FROM b""")
def upserted_facts(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.lit("status").alias("attribute"), F.col("o_orderstatus").alias("text_v"), F.col("o_orderkey").alias("version"))
    half = F.col("version") % 2 == 0
    return sinks.upserted(o.where(half), o.where(~half), ["o_custkey", "attribute"], "version").drop("version")


@query(
    f"""WITH {RANKS}, rt AS (SELECT o_custkey, seq AS root FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY rank DESC, seq) AS r FROM rk) WHERE r = 1),
be AS (SELECT rel.o_custkey, b AS seq, root FROM rel JOIN rt ON rt.o_custkey = rel.o_custkey AND a = root WHERE relation = 'includes'),
pr AS (SELECT rel.o_custkey, rel.a AS o, rel.b AS seq FROM rel JOIN be x ON x.o_custkey = rel.o_custkey AND x.seq = rel.a JOIN be y ON y.o_custkey = rel.o_custkey AND y.seq = rel.b WHERE relation = 'includes'),
dp AS (SELECT o_custkey, seq, count(*) AS n FROM pr GROUP BY ALL),
pa AS (SELECT pr.o_custkey, pr.seq, pr.o, row_number() OVER (PARTITION BY pr.o_custkey, pr.seq ORDER BY coalesce(dp.n, 0) DESC, pr.o) AS r FROM pr LEFT JOIN dp ON dp.o_custkey = pr.o_custkey AND dp.seq = pr.o)
SELECT be.o_custkey, be.seq, coalesce(pa.o, root) AS parent, CAST(least(coalesce(n, 0) + 3, 12) AS INT) AS level FROM be LEFT JOIN dp ON dp.o_custkey = be.o_custkey AND dp.seq = be.seq LEFT JOIN pa ON pa.o_custkey = be.o_custkey AND pa.seq = be.seq AND r = 1
UNION ALL SELECT o_custkey, root, NULL, 2 FROM rt"""
)
def sequence_tree(spark, d):
    roots = toc.main_sequence(order_ranks(spark, d), ["o_custkey"])
    return toc.sequence_tree(toc.span_relations(order_spans(spark, d), ["o_custkey"]), roots, ["o_custkey"])


@query(TOKENS + f" SELECT doc_id, style, count(*) AS n, bool_or(regexp_matches(text, '[.)]')) AS marked FROM (SELECT doc_id, text, {STYLE} AS style FROM tok) WHERE style <> 'none' GROUP BY doc_id, style")
def marked_styles(spark, d):
    items = doc_tokens(spark, d).withColumn("style", text.numeral_style(F.col("text"))).where("style <> 'none'").withColumnRenamed("text", "section")
    return toc.marked_styles(items, ["doc_id", "style"])


# files: what is written and read again


def page_json(spark, d):
    return sinks.ocr_json(gathered_tokens(spark, d, finer=4))


@query(TOKENS + f" SELECT doc_id, 'w' || sn AS id, page, text, CAST(conf AS DOUBLE) AS conf, x1, x2, y1, y2, {CATEGORY} AS category FROM tok")
def ocr_word_scan(spark, d):
    w = readers.ocr_words(page_json(spark, d))
    return w.select("doc_id", "id", "page", "text", F.col("conf").cast("double").alias("conf"), "x1", "x2", "y1", "y2", classify.token_category(F.col("text")).alias("category"))


@query(TOKENS + " SELECT doc_id, 'l' || line AS id, page, string_agg(text, ' ' ORDER BY sn) AS text, count(*) AS n_words, min(x1) AS x1, max(x2) AS x2, min(y1) AS y1, max(y2) AS y2 FROM tok GROUP BY doc_id, page, line")
def ocr_line_scan(spark, d):
    return readers.ocr_lines(page_json(spark, d)).select("doc_id", "id", "page", "text", F.size("tokens").cast("long").alias("n_words"), "x1", "x2", "y1", "y2")


@query(TOKENS + " SELECT doc_id, 'l' || line AS line_id, 'w' || sn AS word_id, CAST(sn % 10 AS INT) AS nth, text FROM tok")
def ocr_membership(spark, d):
    return readers.words_of_lines(page_json(spark, d)).select("doc_id", "line_id", "word_id", "nth", "text")


PARA_TEXTS = PARAS + ", ptx AS (SELECT t.doc_id, p.para_no, min(t.page) AS page, string_agg(t.text, ' ' ORDER BY t.sn) AS text FROM tok t JOIN par p ON p.doc_id = t.doc_id AND p.block = t.block GROUP BY t.doc_id, p.para_no)"


def para_texts(spark, d):
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sn", "text"))), lambda s: s["text"]), " ")
    return para_tokens(spark, d).groupBy("doc_id", "para_no").agg(F.min("page").alias("page"), body.alias("text"))


@query(PARA_TEXTS + """ SELECT doc_id, page, '<HR pn=' || page || '>' || chr(10) || string_agg('<p id="' || para_no || '">' || text || '</p>', chr(10) ORDER BY para_no) AS html FROM ptx GROUP BY doc_id, page""")
def paragraph_pages(spark, d):
    return sinks.paragraph_html(para_texts(spark, d))


@query(PARA_TEXTS + " SELECT doc_id, page, para_no, text FROM ptx")
def paged_paragraphs(spark, d):
    return readers.paged_paragraphs(sinks.paragraph_html(para_texts(spark, d)))


@query(TOKENS + """ SELECT doc_id, page, string_agg('<span id="sp_' || sn || '">' || text || '</span>', ' ' ORDER BY sn) AS html FROM tok GROUP BY doc_id, page""")
def display_pages(spark, d):
    return sinks.display_html(doc_tokens(spark, d))


_HEAD = "rtrim(substring(regexp_extract(text, '^((?:(?:[A-Z0-9(][^\\s]*|" + "|".join(text.SMALL_WORDS) + ")(?:\\s+|$))*)', 1), 1, 80), ' ')"


@query(PARA_TEXTS + f""", h AS (SELECT *, {_HEAD} AS header FROM ptx) SELECT doc_id, para_no, CASE WHEN header <> '' THEN '<MARK class="toc_header">' || header || '</MARK>' || substring(text, length(header) + 1) ELSE text END AS html FROM h""")
def marked_headers(spark, d):
    return sinks.marked_headers(para_texts(spark, d).withColumn("header", text.capital_head(F.col("text"))))


@query(PARA_TEXTS + f""" SELECT doc_id, count(*) AS n, {_count("regexp_matches(text, '[A-Z]') AND NOT regexp_matches(text, '[a-z]')")} AS n_caps, {_count("ends_with(text, '.')")} AS n_period, {_count("length(text) > 80")} * 2 > count(*) AS too_long FROM ptx GROUP BY doc_id""")
def paragraph_tallies(spark, d):
    return toc.sequence_tallies(para_texts(spark, d), ["doc_id"], "text")


_N = lambda mark: f"(length(html) - length(replace(html, '{mark}', '')))"


@query(f"SELECT page_id, {_N('{')} = {_N('}')} AND {_N('[')} = {_N(']')} AS balanced FROM pages")
def balanced_pages(spark, d):
    return table(spark, d, "pages").select("page_id", text.balanced(F.col("html")).alias("balanced"))


@query(
    LINE_STATS
    + """, x AS (SELECT doc_id, page, line, string_agg(text, ' ' ORDER BY sn) AS text FROM tok GROUP BY doc_id, page, line),
n AS (SELECT x.*, center AS c, n_words AS w, n_first_cap AS f, lead(x.text, 1) OVER o AS t1, lead(center, 1) OVER o AS c1, lead(n_words, 1) OVER o AS w1, lead(x.text, 2) OVER o AS t2, lead(center, 2) OVER o AS c2, lead(n_words, 2) OVER o AS w2, lead(n_first_cap, 2) OVER o AS f2
  FROM x JOIN lns USING (doc_id, page, line) WINDOW o AS (PARTITION BY doc_id, page ORDER BY line))
SELECT doc_id, page, line, concat_ws(' ', text, CASE WHEN abs(c1 - c) < 133 AND w < 10 AND w1 < 10 THEN t1 END, CASE WHEN abs(c2 - c) < 133 AND w < 10 AND w2 < 10 AND f * 2 >= w AND f2 * 2 >= w2 THEN t2 END) AS heading
FROM n WHERE regexp_matches(lower(text), '^(exhibit|schedule|appendix)') AND w >= 6"""
)
def exhibit_headings(spark, d):
    t = doc_tokens(spark, d)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sn", "text"))), lambda s: s["text"]), " ")
    rows = pages.line_stats(t, body.alias("text"))
    # labels of fewer than six words may take in four lines; the SQL tells of the others
    found = scores.exhibit_headings(rows).join(rows.select("doc_id", "page", "line", "n_words"), ["doc_id", "page", "line"])
    return found.where("n_words >= 6").drop("n_words")


# the invented texts hold none of the words that these look for
catalog.said(
    "line_marks",
    "document_scores",
    "contents_report",
    "contents_flags",
    "summary_pages",
    "party_roles",
    "rising_references",
    "aligned_references",
    "split_word_candidates",
    "lease_titles",
    "exhibit_headings",
    "header_forms",
    "phrase_caps",
)
