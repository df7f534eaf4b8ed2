"""The corpus pipeline: documents to the tokens of clean, distinct, uncontaminated texts without secrets.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again
before the next. All but the last keep the columns of documents. A document leaves only by a stage's
decision: toxic, a near copy of one with a smaller id, or holding a benchmark passage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bpe, decontaminate, minhash, secrets, toxicity
from foliospark.llm.queries import TOKENIZER, WINDOW, held_out
from foliospark.llm.runtime import durable, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model fitted on the labelled documents that aren't held out.

    Null, empty and very long texts are scored like others, repeated rows and null ids too; without
    labels nothing goes but what the prior rejects, which is nothing. Any further columns stay.
    """
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    own = [f"__c{k}" for k in range(len(docs.columns))]  # so that no column is named like a result
    scored = toxicity.score_toxicity(docs.toDF(*own), model, text_col=own[docs.columns.index("text")], keep=tuple(own))
    return scored.where("score < 0.5").select(*own).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows (five-word shingles, 0.8 or more) the one of smallest doc_id, null ids last.

    Rows are linked by numbers of their own, fixed in the checkpoint folder: repeated and null ids are rows like others.
    Null, empty and wordless texts are similar to nothing and stay; of equal ones with one id the first stored stays.
    """
    rows = durable(docs.withColumn("__row", F.monotonically_increasing_id()))
    groups = minhash.near_duplicates(rows, n_words=5, percent=80, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))["__row"].alias("__row")
    kept = rows.select("__row", "doc_id").join(groups, "__row").groupBy("component_id").agg(first).select("__row")
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark. Null and empty texts stay; an empty benchmark drops nothing."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), WINDOW)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; n_chars, where there is one, follows. A null text stays null."""
    clean = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, lossless): token ids, and whether they decode to the text. A null text counts as empty and has none."""
    coded = bpe.bpe_encode(docs.select("doc_id", "text"), str(TOKENIZER), decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact),
    ("tokens", tokenize),
]
#: Models, hashing and tokenizing are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each on what the one before kept, its rows fixed in the checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs)
    return docs
