"""Numbering sequences, their relations, and the table of contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_GAP = 4


def chain_pairs(items: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """(key..., i, j, gap, dist): later items whose value is one to MOST_GAP above an earlier one's; dist counts the items between them."""
    at = F.row_number().over(Window.partitionBy(*key).orderBy(order)) - 1
    ranked = items.select(*key, at.alias("at"), F.col(value).alias("v"))
    a = ranked.select(*key, F.col("at").alias("j"), F.explode(F.sequence(F.col("v") + 1, F.col("v") + MOST_GAP)).alias("v"), F.col("v").alias("vj"))
    b = ranked.select(*key, F.col("at").alias("i"), "v")
    pairs = a.join(b, [*key, "v"]).where("j < i")
    return pairs.select(*key, "i", "j", (F.col("v") - F.col("vj")).alias("gap"), (F.col("i") - F.col("j") - 1).alias("dist"))


def sequence_badness(rows: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """(key..., n, total_gap, max_gap, total_diff2): how far a sequence is from counting by ones."""
    w = Window.partitionBy(*key).orderBy(order)
    step = rows.withColumn("gap", F.col(value) - F.lag(value).over(w) - 1)
    return step.groupBy(*key).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("gap"), F.lit(0)).alias("total_gap"), F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap"), F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).alias("total_diff2")
    )


def span_relations(spans: DataFrame, key: list[str]) -> DataFrame:
    """(key..., a, b, relation) of sequences (key..., seq, first, last): before, after, same, includes, included or overlaps."""
    a = spans.select(*key, F.col("seq").alias("a"), F.col("first").alias("fa"), F.col("last").alias("la"))
    b = spans.select(*key, F.col("seq").alias("b"), F.col("first").alias("fb"), F.col("last").alias("lb"))
    rel = (
        F.when((F.col("fa") == F.col("fb")) & (F.col("la") == F.col("lb")), "same")
        .when(F.col("la") < F.col("fb"), "before")
        .when(F.col("fa") > F.col("lb"), "after")
        .when((F.col("fa") <= F.col("fb")) & (F.col("la") >= F.col("lb")), "includes")
        .when((F.col("fa") >= F.col("fb")) & (F.col("la") <= F.col("lb")), "included")
        .otherwise("overlaps")
    )
    return a.join(b, key).where("a <> b").select(*key, "a", "b", rel.alias("relation"))


def sequence_ranks(relations: DataFrame, badness: DataFrame, key: list[str]) -> DataFrame:
    """(key..., seq, rank): sequences included less three times those overlapped less five times the badness of an item."""
    c = relations.groupBy(*key, F.col("a").alias("seq")).agg(F.sum(F.when(F.col("relation") == "includes", 1).otherwise(0)).alias("inc"), F.sum(F.when(F.col("relation") == "overlaps", 1).otherwise(0)).alias("over"))
    joined = badness.join(c, [*key, "seq"], "left")
    rank = F.coalesce("inc", F.lit(0)) - 3 * F.coalesce("over", F.lit(0)) - 5 * (F.col("total_gap") + F.col("total_diff2")) / F.col("n")
    return joined.select(*key, "seq", rank.alias("rank"))


def main_sequence(ranks: DataFrame, key: list[str]) -> DataFrame:
    """The sequence of highest rank; ties to the smallest number."""
    return ranks.groupBy(*key).agg(F.max_by("seq", F.struct("rank", -F.col("seq"))).alias("seq"))


def parents(items: DataFrame, key: str = "doc_id", levels: int = 12) -> DataFrame:
    """Items (key, item, level) with parent: the latest item seen one level above, not cleared when a level closes."""
    w = Window.partitionBy(key).orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col("level") == k, F.col("item")), ignorenulls=True).over(w) for k in range(levels + 1)]
    return items.withColumn("parent", F.coalesce(*(F.when(F.col("level") == k + 1, last[k]) for k in range(levels))))


def ends(items: DataFrame, key: str = "doc_id", levels: int = 12) -> DataFrame:
    """Items (key, item, level, para_no) with end_para: the paragraph before the next item of the same or a higher level.

    One window for each level instead of a self-join.
    """
    w = Window.partitionBy(key).orderBy("item").rowsBetween(1, Window.unboundedFollowing)
    following = [F.first(F.when(F.col("level") <= k, F.col("para_no")), ignorenulls=True).over(w) for k in range(levels + 1)]
    return items.withColumn("end_para", F.coalesce(*(F.when(F.col("level") == k, following[k] - 1) for k in range(levels + 1))))


def bad_levels(items: DataFrame) -> DataFrame:
    """Levels above 12 or below 1 become 10, which readers of index files drop."""
    return items.withColumn("level", F.when((F.col("level") > 12) | (F.col("level") < 1), 10).otherwise(F.col("level")))


def build(paragraphs: DataFrame) -> DataFrame:
    """The table of contents of each document: numbering.contents of (doc_id, para_no, page, text)."""
    from . import numbering

    return numbering.contents(paragraphs)


def summary(items: DataFrame, key: str = "doc_id", top: int = 2) -> DataFrame:
    """(key, n_items, n_top, n_nested, total_gap) of items (key, item, level): how many stand at the top, open a deeper level, and are missing between."""
    w = Window.partitionBy(key).orderBy("item")
    step = items.withColumn("deeper", F.col("level") > F.lag("level").over(w)).withColumn("gap", F.col("item") - F.lag("item").over(w) - 1)
    count_if = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return step.groupBy(key).agg(F.count("*").alias("n_items"), count_if(F.col("level") == top).alias("n_top"), count_if(F.col("deeper")).alias("n_nested"), F.coalesce(F.sum("gap"), F.lit(0)).alias("total_gap"))


def sequence_tree(relations: DataFrame, roots: DataFrame, key: list[str], root_level: int = 2, deepest: int = 12) -> DataFrame:
    """(key..., seq, parent, level): the sequences that the root (key..., seq) includes, each below the one that includes it most closely.

    relations: key..., a, b, relation, as span_relations gives them. A sequence's level is the root's and one more for each
    sequence on the way, so that no recursion is needed: whatever includes it within the root's own lies on it. The closest is the
    one that most others include, ties to the smallest number. Levels below `deepest` stay at it.
    """
    inside = relations.where("relation = 'includes'").select(*key, F.col("a").alias("outer"), F.col("b").alias("seq"))
    root = roots.select(*key, F.col("seq").alias("root"))
    below = inside.join(root, key).where("outer = root").select(*key, "seq", "root")
    pairs = inside.join(below.select(*key, F.col("seq").alias("outer")), [*key, "outer"]).join(below.select(*key, "seq"), [*key, "seq"])
    depth = pairs.groupBy(*key, "seq").agg(F.count("*").alias("n"))
    near = pairs.join(depth.select(*key, F.col("seq").alias("outer"), F.col("n").alias("m")), [*key, "outer"], "left")
    parent = near.groupBy(*key, "seq").agg(F.max_by("outer", F.struct(F.coalesce("m", F.lit(0)), -F.col("outer"))).alias("parent"))
    tree = below.join(depth, [*key, "seq"], "left").join(parent, [*key, "seq"], "left")
    level = F.least(F.coalesce("n", F.lit(0)) + root_level + 1, F.lit(deepest))
    children = tree.select(*key, "seq", F.coalesce("parent", "root").alias("parent"), level.cast("int").alias("level"))
    return children.unionByName(root.select(*key, F.col("root").alias("seq"), F.lit(None).cast(dict(roots.dtypes)["seq"]).alias("parent"), F.lit(root_level).alias("level")))


def marked_styles(items: DataFrame, key: list[str]) -> DataFrame:
    """(key..., n, marked): whether any section string of a sequence has a full stop or a bracket; plain letters without one are no numbering."""
    return items.groupBy(*key).agg(F.count("*").alias("n"), F.bool_or(F.col("section").rlike("[.)]")).alias("marked"))


def sequence_tallies(items: DataFrame, key: list[str], header: str = "header", long: int = 80) -> DataFrame:
    """(key..., n, n_caps, n_period, too_long): headers of a sequence in capitals, with a full stop at the end, and whether most are longer than `long`."""
    h = F.col(header)
    count_if = lambda c: F.sum(F.when(c, 1).otherwise(0))
    caps = h.rlike("[A-Z]") & ~h.rlike("[a-z]")
    return items.groupBy(*key).agg(F.count("*").alias("n"), count_if(caps).alias("n_caps"), count_if(F.rtrim(h).endswith(".")).alias("n_period"), (count_if(F.length(h) > long) * 2 > F.count("*")).alias("too_long"))
