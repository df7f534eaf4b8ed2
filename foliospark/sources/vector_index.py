"""A stored inverted file of vectors: cells are partitions of a table, and a search reads only the cells near its queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Vectors that the centres are fitted on at most, rounds of fitting, and most cells.
SAMPLE, ROUNDS, MOST_CELLS = 20_000, 8, 1024


def _unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length one, marks of rows that have one) of a list column; rows must be of one length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()])
    width = int(size.max(initial=0))
    good = (size == width) & (size > 0)
    flat = np.array([x for x, g in zip(lists.to_pylist(), good.tolist(), strict=True) if g], float).reshape(-1, max(width, 1))
    norm = np.sqrt((flat * flat).sum(axis=1))
    fine = np.isfinite(norm) & (norm > 0)
    good[np.flatnonzero(good)[~fine]] = False
    return flat[fine] / norm[fine, None], good


def fit_centres(vectors: DataFrame, col: str = "embedding", cells: int | None = None, seed: int = 5) -> np.ndarray:
    """Centres of spherical k-means, fitted on at most SAMPLE vectors drawn by hash: root of the sample's size many, if not given."""
    share = max(1, vectors.count() // SAMPLE)
    drawn = vectors.where(F.pmod(F.xxhash64(col), F.lit(share)) == 0).select(col).limit(SAMPLE)
    unit, _ = _unit(drawn.toArrow().column(0))
    k = max(1, min(cells or int(np.sqrt(len(unit))), MOST_CELLS, len(unit))) if len(unit) else 0
    centres = unit[np.random.default_rng(seed).choice(len(unit), k, replace=False)] if k else np.zeros((0, 1))
    for _ in range(ROUNDS if k else 0):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(norm[:, None] > 0, sums / np.maximum(norm, 1e-300)[:, None], centres)
    return centres


def _nearest(df: DataFrame, centres, n: int, col: str) -> DataFrame:
    """Rows with cells, the n nearest centres of each; rows without a direction have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        for batch in batches:
            unit, good = _unit(batch.column(batch.schema.get_field_index(col)))
            found: list[list[int]] = [[] for _ in range(batch.num_rows)]
            if len(unit) and len(c) and unit.shape[1] == c.shape[1]:
                near = np.argsort(-(unit @ c.T), axis=1, kind="stable")[:, :n]
                for row, cells in zip(np.flatnonzero(good).tolist(), near.tolist(), strict=True):
                    found[row] = cells
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))


def write_index(vectors: DataFrame, path: str, key: str = "vec_id", col: str = "embedding", cells: int | None = None) -> None:
    """Write every vector to its nearest centre's partition (cell=...), and the centres beside them.

    Vectors are those of one length; null, zero and non-finite ones have no direction and are left out.
    A cell's rows are spread over files by the writing tasks, so that a hot cell is no single task.
    """
    spark = vectors.sparkSession
    centres = fit_centres(vectors, col, cells)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, "cell int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centres")
    placed = _nearest(vectors.select(key, col), spark.sparkContext.broadcast(centres), 1, col)
    placed.where(F.size("cells") > 0).withColumn("cell", F.col("cells")[0]).drop("cells").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")


def search_index(spark: SparkSession, path: str, queries: DataFrame, k: int = 3, probes: int = 8, key: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(query, vec_id, score, rank): the k most alike of each query's `probes` nearest cells, by cosine in double precision.

    The cells that the queries need are a filter on the partition column, so that others are not read.
    Each query meets the vectors of its own cells only, by an equal key; vectors and queries of a cell
    that many want are a skewed join. Equal scores go by key.
    """
    centres = np.array([r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])  # MOST_CELLS rows at most
    shared = spark.sparkContext.broadcast(centres)
    double = lambda c: F.transform(c, lambda x: x.cast("double"))
    q = _nearest(queries.select(F.col(key).alias("query"), F.col(col)), shared, probes, col).select("query", double(F.col(col)).alias("a"), F.explode("cells").alias("cell"))
    wanted = [r.cell for r in q.select("cell").distinct().collect()]  # cells at most
    v = spark.read.parquet(f"{path}/vectors").where(F.col("cell").isin(wanted)).select(key, "cell", double(F.col(col)).alias("b"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda n, x: n + x)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda n, x: n + x * x))
    scored = v.join(q, "cell").where(F.col("query") != F.col(key)).select("query", key, (dot / (norm(F.col("a")) * norm(F.col("b")))).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), key))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def share_of_files(spark: SparkSession, path: str, queries: DataFrame, probes: int = 8, key: str = "vec_id", col: str = "embedding") -> float:
    """The share of the index's files that a search of the queries reads."""
    whole = spark.read.parquet(f"{path}/vectors")
    centres = np.array([r.centre for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()])
    near = _nearest(queries.select(key, col), spark.sparkContext.broadcast(centres), probes, col)
    wanted = [r.cell for r in near.select(F.explode("cells").alias("cell")).distinct().collect()]
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    return files(whole.where(F.col("cell").isin(wanted))) / max(1, files(whole))
