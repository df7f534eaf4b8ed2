"""Balanced contiguous shards from global byte-size prefix sums; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import durable


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long")


def shard_by_bytes(docs: DataFrame, n_shards: int, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (keep..., size, text_crc32, shard, slot): shards 0..n_shards-1 of nearly equal bytes.

    Rows stay in stored order: partition by partition, and in each as read. Each partition's total
    gives every row its place in the bytes of the whole corpus (a prefix sum over as many values as
    there are partitions, then one within each partition), and the shard is the equal share of all
    bytes in which the middle of the row falls. So shards are contiguous, and no shard is off its
    share by more than the two rows at its ends. slot counts a shard's rows from 0 without gaps.

    No value is a grouping key, so repeated rows, equal texts, hot sources and null ids cannot skew
    it. A null or empty text counts 8 bytes. An empty table gives no rows. A kept column named like one
    of the results gives way to it. The text itself is never
    shuffled; the narrow rows are fixed in the checkpoint folder first, for partition numbers must
    not change when a lost task runs again.
    """
    keep = tuple(c for c in keep if c.lower() not in ("size", "text_crc32", "shard", "slot"))
    held = [f"__k{i}" for i in range(len(keep))]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*(F.col(c).alias(h) for c, h in zip(keep, held, strict=True)), text_size(F.col(text_col)).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    at = F.monotonically_increasing_id()
    rows = durable(rows.withColumns({"part": F.shiftright(at, 33), "nth": at}))
    totals = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("count"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    within = Window.partitionBy("part").orderBy("nth")
    placed = rows.withColumns({"upto": F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)), "row": F.row_number().over(within) - 1}).join(starts, "part")
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")
    placed = placed.select(*held, "size", "text_crc32", (F.col("rows_before") + F.col("row")).alias("row"), F.expr("0").alias("shard"), middle.alias("middle"), "all_bytes")
    placed = placed.withColumn("shard", F.expr(f"cast((middle * {int(n_shards)}) div (2 * all_bytes) as int)"))
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(*(F.col(h).alias(c) for c, h in zip(keep, held, strict=True)), "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))
