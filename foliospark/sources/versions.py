"""Keyed updates of a stored table: touched buckets are written anew under a manifest that is swapped last."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest-"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the newest manifest; (0, no buckets) where there is none."""
    fs, at = _files(spark, path)
    if not fs.exists(at(path)):
        return 0, {"buckets": {}, "n": 0}
    numbers = [int(s.getPath().getName()[len(MANIFEST) :]) for s in fs.listStatus(at(path)) if s.getPath().getName().startswith(MANIFEST)]
    if not numbers:
        return 0, {"buckets": {}, "n": 0}
    newest = max(numbers)
    body = spark.read.text(f"{path}/{MANIFEST}{newest}", wholetext=True).first().value
    return newest, json.loads(body)


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Write the manifest beside its place and rename it there: readers see the old one or the new one, and a second writer of one number fails."""
    fs, at = _files(spark, path)
    draft = at(f"{path}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    goal = at(f"{path}/{MANIFEST}{number}")
    if fs.exists(goal) or not fs.rename(draft, goal):
        fs.delete(draft, False)
        raise RuntimeError(f"another run wrote version {number} of {path}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version."""
    number, held = _manifest(spark, path)
    if not number:
        raise FileNotFoundError(f"no version of {path}")
    folders = sorted({f"{path}/{f}" for f in held["buckets"].values()})
    return spark.read.schema(held["schema"]).parquet(*folders) if folders else spark.createDataFrame([], held["schema"])


def _bucket(keys: list[str], n: int):
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _write(df: DataFrame, path: str, keys: list[str], n: int) -> dict[str, str]:
    """Buckets of the rows in a folder of their own: bucket to folder."""
    name = f"data-{uuid.uuid4().hex}"
    df.withColumn("__bucket", _bucket(keys, n)).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{path}/{name}")
    fs, at = _files(df.sparkSession, path)
    found = [s.getPath().getName() for s in fs.listStatus(at(f"{path}/{name}")) if s.isDirectory()]
    return {f.split("=")[1]: f"{name}/{f}" for f in found}


def write_table(df: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """A new version that holds just these rows, dealt to buckets by their keys."""
    number, _ = _manifest(df.sparkSession, path)
    _commit(df.sparkSession, path, number + 1, {"buckets": _write(df, path, keys, buckets), "n": buckets, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "keys": keys})


def update_table(spark: SparkSession, path: str, changes: DataFrame, deleted: DataFrame | None = None) -> None:
    """Set columns of the rows with the keys of `changes` (keys and the columns to set), and delete those with the keys of `deleted`.

    Only buckets that a key falls into are read and written anew, in a new folder; the others stay in
    the new manifest as they are. The manifest is swapped last, so that a run that dies before it leaves
    the old state, with files that nothing names. Keys that no row has change nothing; of several
    changes of one key any one is taken. Null keys match nothing.
    """
    number, held = _manifest(spark, path)
    keys, n = held["keys"], held["n"]
    gone = deleted.select(*keys).distinct() if deleted is not None else changes.select(*keys).where("false")
    touched = changes.select(*keys).unionByName(gone).where(" and ".join(f"`{k}` is not null" for k in keys))
    numbers = [str(r.b) for r in touched.select(_bucket(keys, n).alias("b")).distinct().collect()]  # buckets at most
    folders = [f"{path}/{held['buckets'][b]}" for b in numbers if b in held["buckets"]]
    if not folders:
        return
    old = spark.read.schema(held["schema"]).parquet(*folders)
    new = [c for c in changes.columns if c not in keys]
    once = changes.dropDuplicates(keys).select(*keys, F.struct(*new).alias("__new"))
    merged = old.join(once, keys, "left").join(gone, keys, "left_anti")
    whole = merged.select(*(F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in old.columns))
    fresh = _write(whole, path, keys, n)
    buckets = {b: f for b, f in held["buckets"].items() if b not in numbers} | fresh
    _commit(spark, path, number + 1, held | {"buckets": buckets})


def remove_unnamed(spark: SparkSession, path: str) -> int:
    """Delete data folders that the newest manifest doesn't name, and older manifests; returns how many. Not beside running readers."""
    number, held = _manifest(spark, path)
    fs, at = _files(spark, path)
    named = {f.split("/")[0] for f in held["buckets"].values()} | {f"{MANIFEST}{number}"}
    old = [s.getPath() for s in fs.listStatus(at(path)) if s.getPath().getName() not in named]
    for p in old:
        fs.delete(p, True)
    return len(old)
