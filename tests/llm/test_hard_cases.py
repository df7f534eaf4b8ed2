"""Words and texts that break hashes, windows and folds: colliding families, very long texts, very many matches, clashing columns."""

import json
import random
import time
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliospark.llm import bpe, decontaminate, licenses, minhash, queries, runtime, secrets, sharding, suffixes, toxicity, wordpieces, words

from . import brute

SCHEMA = "doc_id long, text string"


def thue_morse(n, a, b, turn=0):
    out = ""
    for i in range(n):
        out += b if (bin(i).count("1") + turn) % 2 else a
    return out


PAIRS = [(thue_morse(n, "a", "b"), thue_morse(n, "a", "b", 1)) for n in (1024, 4096)] + [(thue_morse(1024, "in", "th"), thue_morse(1024, "in", "th", 1))]


@pytest.fixture(scope="module")
def twins(spark):
    texts = [x for p in PAIRS for x in p] + ["x " * 3 + x for p in PAIRS for x in p]
    rows = list(enumerate(texts))
    return rows, spark.createDataFrame(rows, SCHEMA).coalesce(1).cache()


def test_colliding_words_are_told_apart(spark, twins, tmp_path):
    rows, docs = twins
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_bpe(spark, str(tmp_path)).collect()}
    assert got == brute.op2(rows, str(queries.TOKENIZER))
    for n, percent in ((3, 85), (5, 80)):
        found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, n, percent).collect()}
        assert found == brute.op9(rows, n, percent)
    items = [(k, p[0]) for k, p in enumerate(PAIRS)]
    hits = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string")).withColumn("n", decontaminate.hit_words()).collect()
    assert {r.doc_id: (r.n_words, r.n, len(r["items"]), brute.sha(",".join(r["items"])), r.n > 0) for r in hits} == brute.op10(rows, items)
    for length in (200, 1100):
        cut = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.find_repeats(docs, length).collect()}
        assert cut == brute.op7(rows, length)


def greedy(text):
    vocab = {"".join(piece) for piece in json.load(open(queries.TOKENIZER, encoding="utf-8"))["model"]["vocab"]}
    char = {b: c for c, b in bpe._byte_of_char().items()}
    out = []
    for word in brute.BLANKED.findall(text or ""):
        s, at, n = "".join(char[b] for b in b" " + word.encode()), 0, 0
        while at < len(s):
            at += next(k for k in range(140, 0, -1) if s[at : at + k] in vocab)
            n += 1
        out.append(n)
    return len(out), sum(out), max(out, default=0)


def test_colliding_words_have_counts_of_their_own(twins):
    rows, docs = twins
    got = {r.doc_id: (r.n_words, r.n_tokens, r.most) for r in wordpieces.count_tokens(docs, str(queries.TOKENIZER)).collect()}
    assert got == {i: greedy(t) for i, t in rows}


def test_spans_of_equal_hash_are_compared():
    body = np.frombuffer(b"aa bb aa cc bb", np.uint8)
    start = np.array([0, 3, 6, 9, 12])
    first, of = words.distinct_spans(body, start, start + 2, np.zeros(5, np.uint64))
    assert [bytes(body[start[k] : start[k] + 2]) for k in first[of]] == [b"aa", b"bb", b"aa", b"cc", b"bb"] and len(first) == 3


@pytest.fixture(scope="module")
def long_rows():
    rnd = random.Random(3)
    vocab = [f"w{rnd.randrange(10**6)}" for _ in range(5000)] + ["éa", "ñ", "😀"]
    prose = " ".join(rnd.choice(vocab) for _ in range(110_000))
    solid = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(1_000_000))
    assert len(prose) > 700_000
    return [(0, prose), (1, prose[:650_000] + " end"), (2, solid), (3, solid[:300_000] + "-" + solid[300_000:]), (4, "short text"), (5, None), (6, "")]


@pytest.fixture(scope="module")
def long_docs(spark, long_rows):
    return spark.createDataFrame(long_rows, SCHEMA).repartition(2).cache()


def test_long_texts_of_bpe_and_counts(spark, long_docs, long_rows, tmp_path):
    long_docs.write.parquet(f"{tmp_path}/documents.parquet")
    began = time.time()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_bpe(spark, str(tmp_path)).collect()}
    counts = {r.doc_id: (r.n_words, r.n_tokens, r.most) for r in wordpieces.count_tokens(long_docs, str(queries.TOKENIZER)).collect()}
    assert time.time() - began < 90
    assert got == brute.op2(long_rows, str(queries.TOKENIZER))
    assert counts == {i: greedy(t) for i, t in long_rows}


def test_long_texts_of_near_duplicates_and_decontamination(spark, long_docs, long_rows):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(long_docs, 5, 80).collect()}
    assert got == brute.op9(long_rows, 5, 80)
    items = [(1, long_rows[0][1][640_000:640_400]), (2, long_rows[2][1]), (3, "no such words")]
    hits = decontaminate.find_contamination(long_docs, spark.createDataFrame(items, "item_id long, text string")).withColumn("n", decontaminate.hit_words()).collect()
    assert {r.doc_id: (r.n_words, r.n, len(r["items"]), brute.sha(",".join(r["items"])), r.n > 0) for r in hits} == brute.op10(long_rows, items)


def test_long_texts_of_repeats(long_docs, long_rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.find_repeats(long_docs).collect()}
    assert got == brute.op7(long_rows)


def test_very_many_matches_in_one_text(spark):
    log = "".join(f"{i:016x} {'MIT License ' if i % 2 else ''}" for i in range(40_000))
    docs = spark.createDataFrame([(1, log, "s"), (2, None, None)], SCHEMA + ", source string")
    began = time.time()
    found = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    named = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert time.time() - began < 60
    assert [(s.start, s.end) for s in found[1].base] == [(a, a + 16) for a in brute_starts(log)]
    assert clean[1] == "".join(f"[secret] {'MIT License ' if i % 2 else ''}" for i in range(40_000)) and clean[2] is None
    assert list(named[1].places) == [k for k, word in enumerate(log.split()) if word == "MIT"]


def brute_starts(log):
    return [k for k in range(len(log)) if log[k : k + 1] in "0123456789abcdef" and (k == 0 or log[k - 1] == " ") and log[k + 16 : k + 17] == " "]


def test_values_that_look_live(spark):
    one, shown = "kJ8sdf92LKmn3bVcX0pQ", "exampleKey000AAAbbb1"
    rows = [(1, f"a {one} b password: {one}", "a"), (2, f"{shown}", "b"), (3, "token = aaaaaaaaaaaaaaaaaaaa", "c"), (4, "ünï 0123456789abcdef0123", "d")]
    got = {r.doc_id: ([(s.kind, s.start) for s in r.spans], r.n_live, r.n_example) for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA + ", source string")).collect()}
    assert got == {1: ([(3, 2), (0, 25), (3, 35)], 3, 0), 2: ([], 0, 1), 3: ([(0, 0), (2, 8)], 0, 0), 4: ([(2, 4)], 0, 0)}


@pytest.mark.parametrize("k", range(len(licenses.TEMPLATES)))
def test_each_template_in_any_corpus(spark, k):
    label, _, text = licenses.TEMPLATES[k]
    others = [(10 + i, f"license notice number {i} of the software and this work") for i in range(30)]
    for rest in ([], others):
        docs = spark.createDataFrame([(1, text.title()), *rest], SCHEMA)
        first = licenses.scan_licenses(docs).where("doc_id = 1").first()
        assert label in first.labels and first.score == pytest.approx(1)


def test_a_torn_cluster_is_compared_in_full(spark, monkeypatch):
    rnd = random.Random(9)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(80):  # a chain: each differs a little from the one before
        base[rnd.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute.op9(rows, 3, 85)
    for block, hubs in ((512, 32), (6, 1), (3, 2)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "HUBS", hubs)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 3, 85).collect()} == want


def test_spanning_links_join_what_all_pairs_join():
    rnd = np.random.default_rng(4)
    for _ in range(20):
        sets = [np.unique(rnd.integers(0, 40, rnd.integers(1, 30))) for _ in range(40)]
        at = np.cumsum([0, *map(len, sets)])
        every = [(i, j) for i in range(40) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 50 * len(np.union1d(sets[i], sets[j]))]
        a, b = minhash.spanning_links(np.concatenate(sets), at, 50)
        assert brute.components(range(40), every) == brute.components(range(40), list(zip(a.tolist(), b.tolist(), strict=True)))


def test_weights_of_tokens_by_hand():
    yes, no, share = np.array([8.0, 1.0]), np.array([2.0, 30.0]), np.array([0.001, 0.5])
    odds, z = toxicity.log_odds(yes, no, 100.0, 400.0, share)
    for k in range(2):
        prior = 100 * share[k] + 0.01
        want = np.log((yes[k] + prior) / 200) - np.log((no[k] + prior) / 500)
        assert odds[k] == pytest.approx(want) and z[k] == pytest.approx(want / np.sqrt(1 / (yes[k] + prior) + 1 / (no[k] + prior)))
    model = toxicity.ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -1.0, 0.7, 0.01, np.zeros(3))
    assert model.worth(5.0, 200) == pytest.approx(3.5 - np.log(3))
    assert toxicity.worths(model, np.array([5.0, 1.0]), 200) == (pytest.approx(3.5 - np.log(3)), pytest.approx(3.5 - np.log(3)))


def test_shards_against_a_plain_version(spark):
    rnd = random.Random(6)
    rows = [(i, "x" * rnd.randrange(200)) for i in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1).sortWithinPartitions("doc_id")
    size, total, done, slots, want = [len(t) + 8 for _, t in rows], 0, 0, {}, {}
    total = sum(size)
    for (i, _), n in zip(rows, size, strict=True):
        shard = (2 * done + n) * 24 // (2 * total)
        done += n
        want[i] = (n, shard, slots.setdefault(shard, 0))
        slots[shard] += 1
    assert {r.doc_id: (r["size"], r.shard, r.slot) for r in sharding.shard_by_bytes(docs, 24).collect()} == want


def test_kept_columns_named_like_results(spark):
    docs = spark.createDataFrame([(1, "password: abcdefgh1234 MIT License", "s", 5, 6)], SCHEMA + ", source string, score int, items int").withColumns({c: F.lit(7) for c in ("n_words", "base", "spans", "labels", "passages", "n_tokens")})
    keep = tuple(c for c in docs.columns if c != "text")
    bench = spark.createDataFrame([(1, "mit license")], "item_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    for out in (secrets.scan_secrets(docs, keep=keep), licenses.scan_licenses(docs, keep=keep), decontaminate.find_contamination(docs, bench, keep=keep), toxicity.score_toxicity(docs, model, keep=keep)):
        assert len({c.lower() for c in out.columns}) == len(out.columns) and out.count() == 1
    docs = docs.withColumns({c: F.lit(9) for c in ("size", "shard", "SLOT", "part", "nth", "row", "most", "ids_sha256")})
    keep = tuple(c for c in docs.columns if c != "text")
    path = str(queries.TOKENIZER)
    for out in (sharding.shard_by_bytes(docs, 3, keep=keep), wordpieces.count_tokens(docs, path, keep=keep), bpe.bpe_digests(bpe.bpe_encode(docs, path), path, keep=keep)):
        assert len({c.lower() for c in out.columns}) == len(out.columns) and out.count() == 1
    placed = sharding.shard_by_bytes(docs, 3, keep=keep).first()
    assert (placed.part, placed.nth, placed.row, placed["shard"], placed["slot"]) == (9, 9, 9, 1, 0)


@pytest.mark.parametrize("n", [1, 300, 3000])
def test_notices_need_no_other_words(spark, n):
    """A key phrase with the rest of its notice is found whatever else stands in the text and however many texts there are."""
    notices = [(label, t) for label, _, t in licenses.TEMPLATES]
    plain = [f"quiet words w{i % 50} of no licence" for i in range(n)]
    texts = [t for _, t in notices] + [f"before x {t} behind y" for _, t in notices] + ["Creative Commons Attribution 4.0 International"] * 2 + plain
    found = {r.doc_id: r["labels"] for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    for i, (label, _) in enumerate(notices * 2):
        assert label in found[i]
    assert all(not found[i] for i in range(2 * len(notices) + 2, len(texts)))
    alone = spark.createDataFrame(list(enumerate(["Creative Commons Attribution 4.0 International"] * 2 + plain)), SCHEMA)
    assert [r["labels"] for r in licenses.scan_licenses(alone).orderBy("doc_id").limit(2).collect()] == [["cc-by-4.0"]] * 2


def test_stages_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, items string, component_id long, hit_spans int, n_words int, ids int, Kept int"
    odd = [(None, None), (None, ""), (1, "calm words here"), (1, "calm words here"), (2, "token: abcdefgh123456 " * 3000), (3, " "), (4, "😀 ünï token: abcdefgh123456")]
    docs = spark.createDataFrame([(*x, None, None, None, 0.5, "x", 1, 1, 1, 1, 1) for x in odd], schema)
    spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of these words"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table, left in ((docs, [7, 6, 6, 6, 6]), (docs.where("false"), [0] * 5)):
        step = table
        for (name, stage), n in zip(corpus_pipeline.STAGES, left, strict=True):
            step = stage(spark, step, str(tmp_path))
            assert step.count() == n, name
            if name != "tokens":
                assert step.columns == docs.columns
    assert stage_texts(corpus_pipeline.redact(spark, docs, str(tmp_path)))[4] == "😀 ünï [secret]"


def test_components_in_one_task_and_in_rounds(spark, monkeypatch):
    rnd = random.Random(5)
    links = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(900 + i, 901 + i) for i in range(90)]
    df = spark.createDataFrame(links, "u long, v long").repartition(4)
    real = [(a, b) for a, b in links if a != b]
    want = brute.components({x for e in real for x in e}, real)
    for few in (1 << 20, 0):
        monkeypatch.setattr(runtime, "FEW_EDGES", few)
        assert {r.id: r.component for r in runtime.connected_components(df).collect()} == want


def stage_texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def own_memory():
    """MB of this process that are no file's."""
    return sum(int(x.split()[1]) for x in Path("/proc/self/smaps_rollup").read_text().splitlines() if x.startswith("Pss_Anon")) / 1024


def test_workers_return_what_they_hold_free():
    """Workers wait beside others: 180 MB in small blocks, one of the last still in use, don't stay with a worker."""
    kept = []

    def run(batches):
        for batch in batches:
            held = [np.ones(60_000, np.uint8) for _ in range(3000)]
            kept.append(held[-1])
            del held
            yield batch

    before = own_memory()
    assert list(runtime.sparing(run)(iter([1, 2]))) == [1, 2] and own_memory() - before < 60


def test_a_worker_encodes_in_little_memory():
    """Texts of a batch are encoded by parts; what one part takes at once counts twice to an executor of two cores."""
    draw = random.Random(5)
    words = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(20_000)]
    texts = [" ".join(draw.choices(words, k=400)) for _ in range(bpe.PART // 2600)]
    model = bpe.load(str(queries.TOKENIZER))
    tracemalloc.start()
    ids, at = model.encode(texts)
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert most < 100 and all(model.decode(ids[at[k] : at[k + 1]].tolist()) == texts[k] for k in range(0, len(texts), 50))


def test_surroundings_that_share_an_anchor_only_are_not_transformed(monkeypatch):
    """Only what may hold an equal window goes into the transform, and all of that: by windows at every place about an anchor."""
    draw = random.Random(11)
    length, common = 200, bytes(draw.choices(range(97, 123), k=500))
    texts = [bytes(draw.choices(range(97, 123), k=400)) + common[a : a + size] + bytes(draw.choices(range(97, 123), k=400)) for size in (60, 199, 200, 201, 230) for a in range(0, 240, 40)]
    rows = []
    for i, text in enumerate(texts):
        for key, _, first, last in zip(*(x.tolist() for x in suffixes.anchors(np.frombuffer(text, np.uint8), length)), strict=True):
            rows.append((int(np.uint64(key).view(np.int64)), 0, 0, i, 0, first, text[first : last + length], False))
    rows.sort(key=lambda r: r[0])
    keys, windows = {}, {}
    for k, r in enumerate(rows):
        keys.setdefault(r[0], set()).add(k)
        for j in range(len(r[6]) - length + 1):
            windows.setdefault(r[6][j : j + length], set()).add(k)
    equal = {k for held in windows.values() if len(held) > 1 for k in held}
    beside = {k for held in keys.values() if len(held) > 1 for k in held}
    at = np.cumsum([0, *(len(r[6]) for r in rows)])
    body = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    kept = set(suffixes.meeting(np.array([r[0] for r in rows]), body, at, np.zeros(len(rows), bool), length).tolist())
    assert equal and equal <= kept < beside
    seen = []
    whole = suffixes.repeated_starts
    monkeypatch.setattr(suffixes, "repeated_starts", lambda text, n: (seen.append(len(text)), whole(text, n))[1])
    kinds = [pa.int64()] * 6 + [pa.binary(), pa.bool_()]
    for few in (rows, [rows[k] for k in sorted(beside - kept)]):
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*few, strict=True), kinds, strict=True)], suffixes._NAMES)
        found = [r for b in suffixes._transform(length)(iter([batch])) for r in b.to_pylist()]
        marked = {(r["id"], p) for r in found for p in range(r["from"], r["to"] - length + 1)}
        assert marked == {(r[3], r[5] + j) for r in few for j in range(len(r[6]) - length + 1) if len(windows[r[6][j : j + length]]) > 1}
    assert seen[0] < sum(len(rows[k][6]) for k in kept) + len(kept) and seen[1] <= 1


def test_boundaries_within_the_first_eight_bytes_are_those_of_extension():
    draw = random.Random(12)
    for _ in range(300):
        text = bytes(draw.choices(b"ab" if draw.random() < 0.5 else b"abcdefgh", k=draw.randint(0, 150)))
        text += text[: draw.randint(0, 60)]
        n = draw.choice([1, 2, 7, 8, 9, 16, 20])
        starts = [text[i : i + n] for i in range(len(text) - n + 1)]
        want = [starts.count(x) > 1 for x in starts] + [False] * (len(text) - len(starts))
        assert suffixes.repeated_starts(np.frombuffer(text, np.uint8), n).tolist() == want
