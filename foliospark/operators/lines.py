"""Reading order: lines, gaps, columns, paragraphs. Everything is windowed by document, so one shuffle by doc_id serves all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify

#: Vertical gap, in ten-thousandths of the page, from which a paragraph begins.
VERT_THRESH = 120


def number_lines(blocks: DataFrame, tolerance: int = 50) -> DataFrame:
    """Blocks with line_in_doc and line_in_page, from 0: a line begins with a page, with a vertical step or left of the block before."""
    w = Window.partitionBy("doc_id").orderBy("block")
    before = lambda c: F.lag(c).over(w)
    step = F.abs(F.col("y1") + F.col("y2") - before("y1") - before("y2")) > 2 * tolerance
    new = F.when(before("page").isNull() | (before("page") != F.col("page")) | step | (F.col("x1") < before("x2")), 1).otherwise(0)
    out = blocks.withColumn("__new", new).withColumn("line_in_doc", (F.sum("__new").over(w) - 1).cast("int")).drop("__new")
    return out.withColumn("line_in_page", F.col("line_in_doc") - F.min("line_in_doc").over(Window.partitionBy("doc_id", "page")))


def serial_numbers(tokens: DataFrame) -> DataFrame:
    """Tokens with their places in the page, the line and the block, from 0."""
    place = lambda *by: (F.row_number().over(Window.partitionBy("doc_id", *by).orderBy("sn")) - 1).cast("int")
    return tokens.withColumns({"sn_in_page": place("page"), "sn_in_line": place("line"), "sn_in_block": place("block")})


def space_before(pieces: DataFrame) -> DataFrame:
    """Pieces of split tokens with has_space_before: the first piece of a token has a space."""
    w = Window.partitionBy("doc_id").orderBy("sn", "piece")
    return pieces.withColumn("has_space_before", F.when(F.lag("sn").over(w) == F.col("sn"), 0).otherwise(1))


def block_gaps(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, line, nth, left, right): horizontal gaps of each line, its margins included."""
    w = Window.partitionBy("doc_id", "page", "line").orderBy("x1", "block")
    inner = blocks.select("doc_id", "page", "line", (F.row_number().over(w) - 1).cast("int").alias("nth"), F.lag("x2", 1, 0).over(w).alias("left"), F.col("x1").alias("right"))
    last = blocks.groupBy("doc_id", "page", "line").agg(F.count("*").cast("int").alias("nth"), F.max("x2").alias("left")).withColumn("right", F.lit(10000))
    return inner.unionByName(last)


def similar_indents(lines: DataFrame, rows: int = 6, near: int = 20) -> DataFrame:
    """Lines with how many of the `rows` lines before and the rows - 1 after start within `near` of them."""
    w = Window.partitionBy("doc_id", "page").orderBy("line")
    around = F.collect_list("x1").over(w.rowsBetween(-rows, rows - 1))
    return lines.withColumn("n_similar", F.size(F.filter(around, lambda x: F.abs(x - F.col("x1")) < near)) - 1).withColumn("to_next", F.lead("line").over(w) - F.col("line"))


def paragraphs(blocks: DataFrame, vert: int = VERT_THRESH) -> DataFrame:
    """Blocks with para_no from 0: a paragraph begins with a page, after a wide gap, or with a heading that no sentence runs into."""
    w = Window.partitionBy("doc_id").orderBy("block")
    gap = F.col("y1") - F.lag("y2").over(w)
    moved = (gap > 0) | (gap < -400)
    heading = moved & classify.starts_toc_section(F.col("text"), F.col("x1"), F.col("x2")) & ~classify.dangles(F.lag("text").over(w))
    new = F.when(F.lag("page").over(w).isNull() | (F.lag("page").over(w) != F.col("page")) | (gap > vert) | heading, 1).otherwise(0)
    return blocks.withColumn("__new", new).withColumn("para_no", (F.sum("__new").over(w) - 1).cast("int")).drop("__new")


def vertical_spaces(blocks: DataFrame, vert: int = VERT_THRESH) -> DataFrame:
    w = Window.partitionBy("doc_id", "page").orderBy("block")
    return blocks.withColumn("space", F.col("y1") - F.lag("y2").over(w)).where(F.col("space") > vert).select("doc_id", "page", "block", "space")


def paragraph_stats(tokens: DataFrame) -> DataFrame:
    """One row for each (doc_id, para_no) of tokens."""
    text = F.col("text")
    return tokens.groupBy("doc_id", "para_no").agg(
        F.min("sn").alias("first_sn"),
        F.count("*").alias("n_tokens"),
        F.min("page").alias("page"),
        F.min("line").alias("line"),
        F.min(F.when(text.rlike("[a-z]"), 0).otherwise(1)).alias("all_upper"),
        F.sum(F.when(classify.is_first_cap(text), 1).otherwise(0)).alias("n_first_cap"),
        F.sum(F.when(classify.is_real_word(text), 1).otherwise(0)).alias("n_real"),
    )


def first_paragraphs(stats: DataFrame) -> DataFrame:
    return stats.groupBy("doc_id", "page").agg(F.min("para_no").alias("first_para"))


def islands(rows: DataFrame, by: list[str], order: str, name: str = "island") -> DataFrame:
    """Rows numbered by runs of consecutive `order` values."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn(name, F.col(order) - F.row_number().over(w))


def column_groups(gaps: DataFrame, lines_of_page: DataFrame, least: int = 2) -> DataFrame:
    """Runs of lines with a gap across the middle: (doc_id, page, first_line, last_line, n_lines, line_ratio)."""
    middle = gaps.where("left < 5000 and right > 5000 and left > 0 and right < 10000").select("doc_id", "page", "line").distinct()
    runs = islands(middle, ["doc_id", "page"], "line").groupBy("doc_id", "page", "island")
    runs = runs.agg(F.min("line").alias("first_line"), F.max("line").alias("last_line"), F.count("*").alias("n_lines")).where(F.col("n_lines") >= least)
    joined = runs.join(lines_of_page, ["doc_id", "page"])
    return joined.select("doc_id", "page", "first_line", "last_line", "n_lines", (F.col("n_lines") / F.col("lines_in_page")).alias("line_ratio"))


def reading_order(blocks: DataFrame, groups: DataFrame, ratio: float = 0.7) -> DataFrame:
    """Blocks with `place`: in each two-column run of a page that is mostly columns, all left blocks, then all right ones.

    Runs come as column_groups gives them. Every block has a place; lookups.word_places leaves out those to be dropped.
    """
    wide = groups.where(F.col("line_ratio") >= ratio).select("doc_id", "page", "first_line", "last_line")
    inside = blocks.alias("b").join(wide.alias("g"), (F.expr("b.doc_id = g.doc_id and b.page = g.page and b.line between g.first_line and g.last_line")), "left")
    start = F.coalesce("g.first_line", "b.line")
    side = F.when(F.col("g.first_line").isNotNull() & (F.col("b.x1") >= 5000), 1).otherwise(0)
    keyed = inside.select("b.*", start.alias("__start"), side.alias("__side"))
    w = Window.partitionBy("doc_id").orderBy("page", "__start", "__side", "line", "block")
    return keyed.withColumn("place", (F.row_number().over(w) - 1).cast("int")).drop("__start", "__side")


def last_known(rows: DataFrame, by: list[str], order: Column, value: Column, name: str) -> DataFrame:
    """As-of: the last non-null value up to each row."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))
