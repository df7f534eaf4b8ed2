"""Protection that spreads over references, and deletion of what it doesn't reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import durable


def protected(seeds: DataFrame, references: DataFrame, most_hops: int | None = None) -> DataFrame:
    """(kind, id, hops) of all rows that the seeds (kind, id) protect over references (kind, id, to_kind, to_id).

    Semi-naive: each round follows the references of the rows found last only, drops what is known, and
    writes the rest, so that a round costs what it finds; it ends when nothing new comes, or after
    most_hops rounds. hops is the least number of references on the way. Cycles are no matter. Null ids
    protect nothing. A row with very many references is a skewed join, which AQE splits.
    """
    edges = durable(references.where("id is not null and to_id is not null").distinct())
    frontier = durable(seeds.where("id is not null").select("kind", "id").distinct().withColumn("hops", F.lit(0)))
    known, n = [frontier], 0
    while (most_hops is None or n < most_hops) and not frontier.isEmpty():
        n += 1
        found = frontier.select("kind", "id").join(edges, ["kind", "id"]).select(F.col("to_kind").alias("kind"), F.col("to_id").alias("id")).distinct()
        for part in known:
            found = found.join(part.select("kind", "id"), ["kind", "id"], "left_anti")
        frontier = durable(found.withColumn("hops", F.lit(n)))
        known.append(frontier)
        if len(known) > 4:  # few parts to compare with, however long the chains
            known = [durable(_union(known[:-1])), frontier]
    return _union(known)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def unprotected_rows(tables: dict[str, tuple[DataFrame, str]], marks: DataFrame, only: str = "true") -> dict[str, DataFrame]:
    """Each table without its rows that may go: those that fulfil `only` (a program's rows, say) and aren't marked.

    tables: kind to (rows, name of the id). One join a table with the distinct marks; rows with a null id are never
    protected. Returns kind to the rows that stay.
    """
    out = {}
    for kind, (rows, key) in tables.items():
        ids = marks.where(F.col("kind") == kind).select(F.col("id").alias("__id"), F.lit(True).alias("__marked"))
        marked = rows.join(ids, F.col(key) == F.col("__id"), "left")
        out[kind] = marked.where(F.coalesce("__marked", F.lit(False)) | ~F.coalesce(F.expr(only), F.lit(False))).drop("__id", "__marked")
    return out
