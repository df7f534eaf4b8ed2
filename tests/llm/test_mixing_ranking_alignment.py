"""Mixing, ranked search and cross-tokenizer alignment against plain versions; odd rows, hot groups, small blocks."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from foliospark.llm import alignment, mixing, queries, ranking

from . import brute
from .test_operators import SCHEMA, corpus, tables

PATHS = str(queries.TOKENIZER), str(queries.PIECES)


@pytest.fixture(scope="module")
def rows():
    return corpus(11, 50)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, f"s{i % 7}" if i % 9 else None, 0.5, "x", 3) for i, t in rows], SCHEMA).repartition(3).cache()


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Water filling by the letter: share by weight, stop what is above, share the rest anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped = set()
    while True:
        left = [s for s in names if s not in stopped]
        if not left:
            return {s: float(most * sizes[s]) for s in names}
        level = (share * sum(sizes.values()) - sum(most * sizes[s] for s in stopped)) / sum(weight[s] for s in left)
        above = {s for s in left if weight[s] * level > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in stopped else weight[s] * level for s in names}
        stopped |= above


def check_mix(got, rows):
    sizes, largest = Counter(), Counter()
    for i, t, s in rows:
        n = len(brute.BLANKED.findall(t or ""))
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want = targets(sizes)
    taken = Counter()
    assert len(got) == len(rows)
    for r, (i, t, s) in zip(sorted(got, key=lambda r: r.doc_id), sorted(rows), strict=True):
        n = len(brute.BLANKED.findall(t or ""))
        assert (r.doc_id, r.size, r.source_size) == (i, n, sizes[s])
        assert r.target == pytest.approx(want[s], rel=1e-12)
        assert r.taken in (0, n, 2 * n) and r.taken >= n * (want[s] // sizes[s] if sizes[s] else 0)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_mixing(spark, docs, rows):
    given = [(i, t, f"s{i % 7}" if i % 9 else None) for i, t in rows]
    got = mixing.mix_rates(docs).collect()
    check_mix(got, given)
    again = mixing.mix_rates(docs.repartition(5)).collect()
    assert sorted(got) == sorted(again)
    kept = mixing.mix_rates(docs.withColumn("Taken", F.lit("k")), keep=("Taken", "source", "kept"))
    assert kept.columns == ["source", "kept", "doc_id", "size", "source_size", "target", "rate", "copies", "taken"]
    mix = mixing.mix_documents(docs.withColumn("COPY", F.lit(1)))
    assert mix.columns == ["doc_id", "text", "source", "score", "kept", "shard", "copy"]
    assert {r.doc_id: r.n for r in mix.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {r.doc_id: r.copies for r in got if r.copies}


def test_mixing_many_and_odd_sources(spark, monkeypatch):
    """A source with a third of all rows, very small ones, one without words, a very long text; rates joined by salt."""
    rnd = random.Random(3)
    given = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(1, 40))), "hot" if i % 3 == 0 else f"é{i % 17}") for i in range(600)]
    given += [(600, "", "blank"), (601, None, "blank"), (602, "long " * 200_000, "zz"), (603, "one", "a"), (604, "\n\t ", None)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(4)
    few = mixing.mix_rates(docs).collect()
    check_mix(few, given)
    monkeypatch.setattr(mixing, "FEW_SOURCES", 2)
    assert sorted(mixing.mix_rates(docs).collect()) == sorted(few)


def test_mixing_odd_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix_rates(spark.createDataFrame([], schema)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c", None), (None, "a b c", None), (7, None, "s"), (7, "x y", "s"), (7, "x y", "s")]
    got = mixing.mix_rates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and {r.source_size for r in got} == {6, 4}
    assert sum(r.taken for r in got if r.source_size == 6) in range(3, 13)
    only = mixing.mix_rates(spark.createDataFrame([(1, None, "s"), (2, "", None)], schema)).collect()
    assert {(r.size, r.target, r.taken) for r in only} == {(0, 0.0, 0)}


def check_ranks(got, docs, items, most=20):
    have = defaultdict(list)
    for r in got:
        have[r.item_id].append((r["rank"], r.doc_id, r.score))
    assert {k: sorted(v) for k, v in have.items()} == brute.op12(docs, items, most)


@pytest.mark.parametrize("small", [False, True])
def test_ranking(spark, docs, rows, small, monkeypatch):
    items = [(k, t) for k, t in rows if k % 5 == 0] + [(1000, "the THE the of"), (1001, "nothing-here? unknownword"), (1002, None), (1003, "été Über über ÉTÉ x1 x1")]
    if small:  # many blocks of queries, buckets of a few documents
        for name, value in (("BLOCK", 3000), ("HELD", 12), ("BUCKET", 5), ("POSTINGS", 60), ("CELLS", 64), ("PART", 500)):
            monkeypatch.setattr(ranking, name, value)
        items = items[-9:]
    got = ranking.rank_documents(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    check_ranks(got, rows, items)


def test_ranking_hot_groups(spark):
    """A large group of exact copies: ties at the last rank go to the smallest ids."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 30))) for _ in range(200)]
    texts += ["w1 w2 copied passage w3"] * 300 + ["w1 " * 50_000 + "copied"]
    given = list(enumerate(texts))
    rnd.shuffle(given)
    items = [(0, "copied passage"), (1, "w1 w2"), (2, "w7 " * 5 + "w8")]
    got = ranking.rank_documents(spark.createDataFrame(given, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")).collect()
    check_ranks(got, given, items)


def test_ranking_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, "a c"), (3, "a c"), (4, None), (5, "")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "b"), ("i", "c a"), ("i", "c a"), ("j", "")], "item_id string, text string").withColumn("rank", F.lit("kept out"))
    got = ranking.rank_documents(docs, items, most=3).collect()
    by = Counter((r.item_id, r["rank"], r.doc_id) for r in got)
    assert by[(None, 1, None)] == by[(None, 2, None)] == 1 and by[("i", 1, 3)] == by[("i", 2, 3)] == 2
    assert ranking.rank_documents(docs.limit(0), items).count() == 0
    assert ranking.rank_documents(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranking.rank_documents(docs, items.limit(0)).count() == 0


def check_alignment(got, rows):
    want = brute.op13(rows, *PATHS)
    have = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got}
    assert have == want


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, docs, rows, small, monkeypatch, tmp_path):
    if small:  # several bitmaps a task, dense ones, counts joined by salt
        for name, value in (("PART", 200), ("ENCODED", 700), ("POSTINGS", 500), ("FEW_PAIRS", 10), ("OPEN", 1)):
            monkeypatch.setattr(alignment, name, value)
    documents, pairs = alignment.align_tokenizers(docs, *PATHS)
    check_alignment(documents.collect(), rows)
    links = brute.links_of(rows, *PATHS)
    want = Counter(p for doc in links.values() for p in doc)
    seen = Counter(p for doc in links.values() for p in set(doc))
    assert {(r.a, r.b): (r.n_links, r.n_docs) for r in pairs.collect()} == {p: (want[p], seen[p]) for p in want}


def test_alignment_odd_texts(spark):
    texts = ["<|endoftext|> and <s> </s> <unk>", "▁ block", "\x00 zero", "tab\tnew\n\n  line ", "日本語テキスト 😀", "é combining", "﻿mark", "a" * 5000, " ", "x  y   z"]
    rows = list(enumerate([None, "", *texts]))
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, n_links string")
    documents, _ = alignment.align_tokenizers(docs, *PATHS, keep=("doc_id", "n_links"))
    assert documents.columns[:3] == ["doc_id", "n_a", "n_b"]
    check_alignment(documents.collect(), rows)
    assert alignment.align_tokenizers(docs.limit(0), *PATHS)[0].count() == 0
    twice = spark.createDataFrame([(None, "two words"), (None, "two words")], "doc_id long, text string")
    found = alignment.align_tokenizers(twice, *PATHS)[0].collect()
    assert len(found) == 2 and found[0] == found[1] and found[0].count_sum == 2 * found[0].n_links


def test_bitmaps_keep_every_posting():
    """Sparse and dense planes, multiplicities over several planes."""
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    key, times = [], []
    for pair, n in ((3, 1), (9, 4095), (10, 4096), (2**40, 60000), (77, 65536)):
        docs = np.sort(rnd.choice(65536, n, replace=False))
        key.append(pair << 16 | docs)
        times.append(rnd.integers(1, 9, n) if pair != 77 else np.ones(n, np.int64))
    key, times = np.concatenate(key), np.concatenate(times)
    pairs, planes = alignment.bitmaps(key, times)
    back = Counter()
    for row, plane, doc in alignment.members(planes.slice(1)):
        for r, p, d in zip(row.tolist(), plane.tolist(), doc.tolist(), strict=True):
            back[int(pairs[r + 1]) << 16 | d] += 1 << p
    assert back == {int(k): int(t) for k, t in zip(key, times, strict=True) if k >> 16 != 3}
    counts = pa.Table.from_batches(alignment._popcounts([pa.RecordBatch.from_arrays([pa.array(pairs), planes], ["pair", "planes"])])).to_pydict()
    assert counts["n_docs"] == [1, 4095, 4096, 65536, 60000] and sum(counts["n_links"]) == times.sum()
