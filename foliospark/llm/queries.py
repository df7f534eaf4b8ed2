"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, decontaminate, embeddings, licenses, minhash, mixing, ranking, secrets, sharding, suffixes, toxicity, wordpieces
from .runtime import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WINDOW = 10


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_embeddings(read_table(spark, sf_dir, "embeddings"), 0.95)


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r(id, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id
), k AS (SELECT id, min(c) AS component_id FROM r GROUP BY id), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, k.component_id, e.vec_id = k.component_id AS kept
FROM embeddings e LEFT JOIN k ON k.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.bpe_digests(bpe.bpe_encode(docs, str(TOKENIZER)).select("doc_id", "ids"), str(TOKENIZER))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_wordpiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpieces.count_tokens(read_table(spark, sf_dir, "documents"), str(TOKENIZER))


def held_out(doc_id):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_names(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.span_names(F.col("spans")).alias("spans"),
        "n_live",
        "n_example",
    )


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.find_repeats(read_table(spark, sf_dir, "documents"), 200).drop("spans")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), n_words=3, percent=85)


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
  FROM w
), n AS (SELECT doc_id, len(s) AS n_shingles FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.k >= 85 * (x.n_shingles + y.n_shingles - p.k)
), both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN both_ways l ON l.a = r.id),
k AS (SELECT id, min(c) AS component_id FROM r GROUP BY id)
SELECT n.doc_id, CAST(n.n_shingles AS BIGINT) AS n_shingles, k.component_id, n.doc_id = k.component_id AS kept
FROM n JOIN k ON k.id = n.doc_id
"""


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), WINDOW)
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_rates(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST(CAST('0x' || substr(sha256('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS draw
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source
), w AS (
  SELECT *, CASE nth % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s
), k AS (
  SELECT *, row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, nth) AS place, sum(source_size) OVER () AS all_sizes, sum(weight) OVER () AS all_weights,
    coalesce(sum(source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sizes_before,
    coalesce(sum(weight) OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights_before
  FROM w
), l AS (
  SELECT arg_min(level, place) FILTER (WHERE weight * level <= 2 * source_size) AS level
  FROM (SELECT *, CAST(3 * all_sizes - 4 * sizes_before AS DOUBLE) / CAST(2 * (all_weights - weights_before) AS DOUBLE) AS level FROM k)
), t AS (
  SELECT source, source_size, least(weight * coalesce(level, 0.0), CAST(2 * source_size AS DOUBLE)) AS target,
    CAST(CAST('0x' || substr(sha256('11:' || coalesce('source ' || source, 'no source')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS start
  FROM w, l
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t
), n AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rate, r.start, r.rate - floor(r.rate) AS fraction,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.draw) - 1 AS nth
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, CAST(floor(rate) + floor(start + (nth + 1) * fraction) - floor(start + nth * fraction) AS BIGINT) * size AS taken
FROM n
"""


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf) AS n FROM f GROUP BY doc_id),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c GROUP BY term, n_docs),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), g AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
s AS (
  SELECT g.item_id, f.doc_id, CAST(sum(g.times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + CAST((25 * d.n * c.n_docs) // c.n_terms AS BIGINT))))) AS BIGINT) AS score
  FROM g JOIN f ON f.term = g.term JOIN w ON w.term = g.term JOIN d ON d.doc_id = f.doc_id, c GROUP BY g.item_id, f.doc_id
), r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(read_table(spark, sf_dir, "documents"), str(TOKENIZER), str(PIECES))[0]


def queries() -> dict:
    return {f.__name__: f for f in (op1_embeddings, op2_bpe, op3_sharding, op4_wordpiece, op5_toxicity, op6_secrets, op7_suffixes, op8_licenses, op9_minhash, op10_decontaminate, op11_mixing, op12_ranking, op13_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op1_embeddings": OP1_SQL, "op9_minhash": OP9_SQL, "op11_mixing": OP11_SQL, "op12_ranking": OP12_SQL}
