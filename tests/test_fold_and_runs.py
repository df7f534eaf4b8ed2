"""Contents against body, and words read as several: fixtures and plain versions."""

import random
from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.operators import fold, runs
from foliospark.plans import records

HEADERS = ["Premises", "Term of Lease", "Base Rent", "Security Deposit", "Use of Premises", "Repairs", "Insurance", "Default", "Notices"]


def lists(spark, a, b):
    make = lambda side: spark.createDataFrame([(7, i, h) for i, h in enumerate(side)] + [(8, 0, None)], "doc_id long, item int, header string")
    return fold.fold_contents(make(a), make(b)).where("doc_id = 7").collect()


def test_inserted_dropped_and_moved(spark):
    body = [*HEADERS[:3], "Parking", *HEADERS[3:6], "Notices", "Insurance", ""]
    got = {(r.side, r.header): r for r in lists(spark, [*HEADERS, ""], body)}
    assert {h: got["a", h].state for h in HEADERS} == {h: "dropped" if h == "Default" else "kept" for h in HEADERS} | {"Insurance": got["a", "Insurance"].state, "Notices": got["a", "Notices"].state}
    assert {got["a", "Insurance"].state, got["a", "Notices"].state} == {"kept", "moved"}
    assert got["b", "Parking"].state == "inserted" and got["a", ""].state == "dropped" and got["b", ""].state == "inserted"
    moved = next(h for h in ("Insurance", "Notices") if got["a", h].state == "moved")
    assert got["a", moved].partner == body.index(moved) and got["b", moved].partner == HEADERS.index(moved)
    assert got["a", "Premises"].partner == 0 and got["b", "Premises"].good


def test_sides_that_windows_have_dealt(spark):
    """Each side comes from a window by document, and AQE joins the partitions of the longer side less."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.unionOutputPartitioning")}
    for k, v in zip(old, ("20k", "false", "1b", "true"), strict=True):
        spark.conf.set(k, v)
    try:
        number = F.row_number().over(Window.partitionBy("doc_id").orderBy("n")).alias("item")
        make = lambda n, size: spark.range(40 * n).select((F.col("id") % 40).alias("doc_id"), F.floor(F.col("id") / 40).alias("n"), F.concat(F.lit("line "), F.floor(F.col("id") / 40).cast("string"), F.lit("-" * 40), F.repeat(F.sha2(F.col("id").cast("string"), 512), F.lit(size))).alias("header")).select("doc_id", number, "header")
        states = fold.fold_contents(make(5, 4), make(3, 1)).groupBy("state").count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r["state"]: r["count"] for r in states} == {"kept": 40 * 3 * 2, "dropped": 40 * 2}


def test_clumps(spark):
    body = ["Rent", *["x%d" % i for i in range(5)], "Terms", "y", "Use", "9 Law"]
    got = {r.header: r for r in lists(spark, ["Rent", "Terms", "Use", "9 Law"], body) if r.side == "b"}
    assert got["Rent"].clump != got["Terms"].clump == got["Use"].clump != got["9 Law"].clump
    assert [got[h].good for h in ("Rent", "Terms", "9 Law")] == [False, True, False]


def test_patience_pairs_what_reads_the_same():
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ([rnd.choice("abcdefgh"[: rnd.choice([3, 8])]) for _ in range(rnd.randint(0, 12))] for _ in "ab")
        pairs = fold.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < u and y < v for (x, y), (u, v) in zip(pairs[:-1], pairs[1:], strict=True))
    order = list(range(3000))
    other = [x for x in order if x % 7] + [10**6]
    assert fold.patience(order, other) == [(x, i) for i, x in enumerate(x for x in order if x % 7)]
    for _ in range(100):
        p = rnd.sample(range(30), 30)
        longest = max(len(fold.rising(p)), 0)
        assert not any(all(p[x] < p[y] for x, y in zip(c[:-1], c[1:], strict=True)) for c in combinations(range(30), longest + 1)) if longest < 3 else True
        assert all(p[x] < p[y] for x, y in zip(fold.rising(p)[:-1], fold.rising(p)[1:], strict=True))


def test_bounds_of_contents(spark):
    rows = [(1, i, 2, h) for i, h in enumerate(HEADERS)] + [(1, 20 + i, 4 + i, h) for i, h in enumerate(HEADERS)]
    rows += [(2, i, 2, h) for i, h in enumerate(HEADERS[:4])] + [(2, 20 + i, 4 + i, h) for i, h in enumerate(HEADERS[:4])]
    rows = [(1, -1, 1, "LEASE"), (1, 19, 3, "LEASE"), *rows]
    items = spark.createDataFrame(rows, "doc_id long, item int, page int, header string")
    assert [tuple(r) for r in fold.contents_bounds(items).collect()] == [(1, 0, 20)]
    assert fold.contents_bounds(items.where("false")).count() == 0


def tokens(spark, rows):
    return spark.createDataFrame([(1, 1, line, sn, t, x1, x2, conf, known) for line, sn, t, x1, x2, conf, known in rows], "doc_id long, page int, line int, sn int, text string, x1 int, x2 int, conf int, known boolean")


def test_split_and_joined_words_on_both_sides(spark):
    a = tokens(spark, [(1, 0, "regulation", 1000, 2000, 80, True), (1, 1, "of", 2100, 2300, 70, True), (1, 2, "the", 2350, 2600, 70, True), (1, 3, "unlike", 3000, 3600, 90, True), (2, 4, "landlord's", 1000, 2000, 60, False), (2, 5, None, 0, 1, 1, None)])
    b = tokens(spark, [(1, 0, "regula-", 1010, 1500, 90, False), (1, 1, "tion", 1550, 1990, 90, False), (1, 2, "ofthe", 2110, 2590, 95, False), (1, 3, "zq", 3010, 3200, 90, False), (1, 4, "xw", 3250, 3590, 90, False), (2, 5, "landlord", 1000, 1600, 90, False), (2, 6, "s", 1800, 1900, 90, False)])
    got = {(r.first_a, r.last_a, r.first_b, r.last_b): (r.chosen, r.chosen_text) for r in runs.matched_runs(a, b).collect()}
    assert got == {(0, 0, 0, 1): ("a", "regulation"), (1, 2, 2, 2): ("a", "of the"), (4, 4, 5, 6): ("b", "landlord s")}
    assert runs.matched_runs(a.where("false"), b).count() == 0


def test_best_intervals_equal_all_choices():
    rnd = random.Random(2)
    for _ in range(300):
        found = []
        for _ in range(rnd.randint(0, 8)):
            a, b = rnd.randint(0, 6), rnd.randint(0, 6)
            found.append((a, a + rnd.randint(0, 2), b, b + rnd.randint(0, 2), rnd.randint(1, 9)))

        def fits(some):
            some = sorted(some)
            return all(p[1] < q[0] and p[3] < q[2] for p, q in zip(some[:-1], some[1:], strict=True))

        best = max(sum(x[4] for x in some) for n in range(len(found) + 1) for some in combinations(found, n) if fits(some))
        chosen = [found[k] for k in runs.best_intervals(found)]
        assert fits(chosen) and sum(x[4] for x in chosen) == best


def test_words_of_lines_need_no_exchange(spark, tmp_path):
    spark.createDataFrame([(1, "a bc regulations of the x y z in an end"), (2, ""), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    t = records.lines_of_words(spark, str(tmp_path))
    assert "Exchange" not in t._jdf.queryExecution().executedPlan().toString()
    got = {r.sn: (r.after if r.joined else None, bool(r.split), bool(r.second)) for r in t.collect()}
    assert got == {0: ("bc", False, False), 1: (None, False, True), 2: (None, True, False), 3: (None, False, False), 4: ("x", False, False), 5: (None, False, True), 6: ("z", False, False), 7: (None, False, True), 8: ("an", False, False), 9: (None, False, True), 10: (None, False, False)}
