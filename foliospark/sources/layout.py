"""Word boxes: a fixed layout derived from plain texts, and the second engine's view of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_PER_LINE, LINES_PER_PAGE, WORDS_PER_BLOCK = 10, 40, 5


def tokens_from_text(docs: DataFrame) -> DataFrame:
    """One row for each word of each document: its place in the reading order and its box in ten-thousandths of the page.

    Ten words make a line, forty lines a page, five words a block; every seventh line leaves a wider
    gap. No shuffle: a document's words stay in its partition. A null text has no words.
    """
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    t = docs.select("doc_id", F.posexplode(words).alias("sn", "text"))
    line = F.col("sn").cast("long") / F.lit(WORDS_PER_LINE)
    t = t.withColumn("line", F.floor(line).cast("int"))
    on_page = F.col("line") % LINES_PER_PAGE
    x1 = 1040 + 800 * (F.col("sn") % WORDS_PER_LINE)
    y1 = 500 + 200 * on_page + 90 * F.floor(on_page / 7).cast("int")
    return t.select(
        "doc_id",
        "sn",
        (F.floor(F.col("line") / LINES_PER_PAGE) + 1).cast("int").alias("page"),
        F.floor(F.col("sn") / WORDS_PER_BLOCK).cast("int").alias("block"),
        "line",
        "text",
        x1.alias("x1"),
        (x1 + F.least(80 * F.length("text"), F.lit(780))).alias("x2"),
        y1.alias("y1"),
        (y1 + 150).alias("y2"),
        (60 + (F.col("sn") * 7) % 40).alias("conf"),
    )


def second_engine(tokens: DataFrame) -> DataFrame:
    """What another engine would read: some words missing, shifted a little, some letters misread."""
    shift = 5 * (F.col("sn") % 3)
    misread = F.when(F.col("sn") % 7 == 0, F.translate("text", "lO", "10")).otherwise(F.col("text"))
    return tokens.where("sn % 11 <> 0").withColumns({"x1": F.col("x1") + shift, "x2": F.col("x2") + shift, "text": misread, "conf": 60 + (F.col("sn") * 5) % 40})


def blocks(tokens: DataFrame) -> DataFrame:
    """Blocks of words that follow one another on a line."""
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sn", "text"))), lambda s: s["text"]), " ")
    return tokens.groupBy("doc_id", "page", "line", "block").agg(
        F.min("sn").alias("first_sn"), F.max("sn").alias("last_sn"), ordered.alias("text"), F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.min("y1").alias("y1"), F.max("y2").alias("y2")
    )
