"""What the operators of this subpackage share: durable intermediate results and connected components."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Edges that one task may hold when components are finished.
FEW_EDGES = 1 << 20


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to the shared checkpoint folder and read them from there.

    The folder is the one the session names in spark.checkpoint.dir; only where that is unset
    and Spark runs on one machine (tests) is a temporary folder taken.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="foliospark-"))
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with a gapless number from 0 in the order given, sorted and written to the checkpoint folder.

    Rows are dealt by ranges of the order and sorted in their partitions; each partition's count gives
    the next one's start, as many values as there are partitions. Rows that are equal in the order are
    numbered as they lie; give it a tie breaker where that matters.
    """
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.shiftright(at, 33), "__nth": at.bitwiseAND((1 << 33) - 1)})
    rows = durable(rows)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__nth")).drop("__part", "__nth", "__start")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches of this session hold at most so many rows from now on: texts are long, and each task's workers hold a few batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def sparing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of batches; at a task's end the worker returns to the system what it holds free.

    Spark keeps workers for later tasks and takes them in turn, so that all that the steps of a job
    have started lie beside those at work and count to their executor.
    """

    def lean(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc, whose allocator numpy uses
        if trim:
            trim(0)

    return lean


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def find_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, for edges a[i]-b[i] over nodes 0..n-1.

    Min-label hooking with pointer jumping: a few vectorised rounds, each linear.
    """
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace each batch's edges by stars around each local component's smallest id."""
    for pdf in batches:
        if len(pdf):
            ids, at = np.unique(np.concatenate([pdf.u.to_numpy(), pdf.v.to_numpy()]), return_inverse=True)
            root = find_roots(len(ids), at[: len(pdf)], at[len(pdf) :])
            child = np.flatnonzero(root != np.arange(len(ids)))
            yield pd.DataFrame({"u": ids[child], "v": ids[root[child]]})


def _one_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All edges of one task to (id, component)."""
    held = [pdf for pdf in batches if len(pdf)]
    if held:
        u, v = (np.concatenate([pdf[c].to_numpy() for pdf in held]) for c in ("u", "v"))
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = find_roots(len(ids), at[: len(u)], at[len(u) :])
        yield pd.DataFrame({"id": ids, "component": ids[root]})


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of each id in edges (u long, v long): rows (id, component), component the smallest id reachable.

    Alternating large-star and small-star rounds. Minima are taken with partial aggregation and
    joined back, so that a node with very many neighbours is a skewed join (which AQE splits), not
    one group; every round's edges are written to the shared checkpoint folder. Ids that occur in
    no edge, and self-links, give no row; null ends are ignored. No edges: no rows. Once at most
    FEW_EDGES are left, of 16 bytes each, one task finishes them, with the same result.
    """
    stars = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = durable(stars.mapInPandas(sparing(_local_forest), "u long, v long").distinct())
    seen = None
    while True:
        mark = stars.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == seen or not mark.n:
            break
        if mark.n <= FEW_EDGES:
            return stars.coalesce(1).mapInPandas(sparing(_one_forest), "id long, component long")
        seen = mark
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written, so that both sides of a join come from exchanges of their own and a hot node can be split
        least = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = durable(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = durable(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        stars = durable(small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct())
    pairs = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return pairs.union(stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
