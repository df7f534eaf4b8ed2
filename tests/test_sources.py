"""Parts of results, stored vectors and versions of tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.operators import parts as retrieval
from foliospark.sources import parts, vector_index, versions


def job(folder, name, sizes, done=True, skip=()):
    (folder / name).mkdir(parents=True)
    names = ["first", *(f"t{i}" for i in range(1, len(sizes)))]
    nth = 0
    for i, n in enumerate(sizes):
        blocks = [{"BlockType": "WORD", "Id": f"{name}-{nth + k}", "Page": i + 1, "Text": f"w{nth + k}", "Confidence": 90 + k} for k in range(n)]
        nth += n
        if names[i] not in skip:
            (folder / name / f"{names[i]}.json").write_text(json.dumps({"Blocks": blocks, "NextToken": names[i + 1] if i + 1 < len(sizes) else None}))
    if done:
        (folder / name / "done").write_text("")


def test_parts_in_a_batch_and_as_a_stream(spark, tmp_path):
    spark.dataSource.register(parts.Parts)
    src = tmp_path / "jobs"
    job(src, "a", [3, 2, 1])
    job(src, "b", [0, 4])
    batch = spark.read.format("ocr_parts").load(str(src))
    assert batch.rdd.getNumPartitions() == 5 and batch.count() == 10
    assert [r.part for r in batch.where("job = 'a'").orderBy("id").collect()] == [1, 1, 1, 2, 2, 3]

    def run():
        stream = spark.readStream.format("ocr_parts").load(str(src))
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(once=True).start()
        q.awaitTermination(120)
        return {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run() == {tuple(r) for r in batch.collect()}
    job(src, "c", [2])
    job(src, "d", [5], done=False)
    got = run()
    assert len(got) == 12 and {r[0] for r in got} == {"a", "b", "c"}
    job(tmp_path / "bad", "x", [1, 1, 1], skip=("t1",))
    with pytest.raises(Exception, match="part t1 of x is missing"):
        spark.read.format("ocr_parts").load(str(tmp_path / "bad")).count()


def test_vector_index(spark, tmp_path):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(30, 24))
    rows = [(i, [float(x) for x in centres[i % 30] + 0.4 * rnd.normal(size=24)]) for i in range(3000)] + [(9001, None), (9002, [0.0] * 24), (9003, [float("nan")] * 24)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).cache()
    path = str(tmp_path / "index")
    vector_index.write_index(vectors, path)
    assert spark.read.parquet(f"{path}/vectors").count() == 3000
    queries = vectors.where("vec_id % 300 = 0 and vec_id < 3000")
    exact = {(r["query"], r.vec_id) for r in retrieval.top_similar(queries, vectors.where("vec_id < 9000"), 5).collect()}
    found = {(r["query"], r.vec_id) for r in vector_index.search_index(spark, path, queries, 5, probes=8).collect()}
    assert len(exact & found) >= 0.95 * len(exact)
    assert 0 < vector_index.share_of_files(spark, path, queries.limit(2), probes=4) < 0.5
    every = {(r["query"], r.vec_id) for r in vector_index.search_index(spark, path, queries, 5, probes=1000).collect()}
    assert every == exact


def test_versions_of_a_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr("id as doc_id", "cast(id % 7 as int) as line", "'old' as text")
    versions.write_table(rows, path, ["doc_id"], buckets=16)
    changes = spark.createDataFrame([(5, "new"), (77, "new"), (5000, "none"), (None, "none")], "doc_id long, text string")
    gone = spark.createDataFrame([(8,), (9,)], "doc_id long")
    before = set(versions._manifest(spark, path)[1]["buckets"].values())
    versions.update_table(spark, path, changes, gone)
    got = versions.read_table(spark, path)
    assert got.count() == 998 and {r.doc_id for r in got.where("text = 'new'").collect()} == {5, 77}
    assert got.where("line is null").count() == 0
    after = set(versions._manifest(spark, path)[1]["buckets"].values())
    assert 11 <= len(before & after) <= 15

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        versions.update_table(spark, path, spark.createDataFrame([(1, "lost")], "doc_id long, text string"))
    monkeypatch.undo()
    assert versions.read_table(spark, path).where("text = 'lost'").count() == 0 and versions.read_table(spark, path).count() == 998
    assert versions.remove_unnamed(spark, path) >= 2
    assert versions.read_table(spark, path).count() == 998
    number = versions._manifest(spark, path)[0]
    with pytest.raises(RuntimeError, match="another run"):
        versions._commit(spark, path, number, {})
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, str(tmp_path / "none"))
    versions.update_table(spark, path, changes.where("false"))
    assert versions._manifest(spark, path)[0] == number


def test_set_nulls(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_table(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, text string, n int"), path, ["k"], 4)
    versions.update_table(spark, path, spark.createDataFrame([(1, None)], "k int, text string"))
    assert sorted(map(tuple, versions.read_table(spark, path).select("k", F.coalesce("text", F.lit("-")), "n").collect())) == [(1, "-", 1), (2, "b", 2)]
