"""Protection, pairwise alignment and nesting against plain versions."""

import random
import time

from foliospark.functions import nesting
from foliospark.operators import pairwise, protection


def test_protection_spreads_over_four_hops(spark):
    refs = [("a", 1, "b", 10), ("b", 10, "c", 100), ("c", 100, "d", 1000), ("d", 1000, "e", 5), ("e", 5, "a", 1), ("a", 2, "b", 20), ("b", 20, "c", None), ("x", None, "c", 7)]
    references = spark.createDataFrame(refs, "kind string, id long, to_kind string, to_id long")
    seeds = spark.createDataFrame([("a", 1), ("a", 1), ("a", None)], "kind string, id long")
    marks = protection.protected(seeds, references)
    assert {tuple(r) for r in marks.collect()} == {("a", 1, 0), ("b", 10, 1), ("c", 100, 2), ("d", 1000, 3), ("e", 5, 4)}
    assert protection.protected(seeds, references, most_hops=2).count() == 3
    assert protection.protected(seeds.where("false"), references).count() == 0
    table = spark.createDataFrame([(10, "p"), (20, "p"), (30, "q"), (None, "p"), (40, None)], "id long, program string")
    stays = protection.unprotected_rows({"b": (table, "id")}, marks, "program = 'p'")["b"]
    assert {r.id for r in stays.collect()} == {10, 30, 40}
    assert [r.id for r in protection.unprotected_rows({"b": (table, "id")}, marks)["b"].collect()] == [10]


def test_protection_of_long_chains_and_cycles(spark):
    edges = spark.createDataFrame([("n", i, "n", (i + 1) % 12) for i in range(12)] + [("n", 3, "n", 9)], "kind string, id long, to_kind string, to_id long")
    marks = protection.protected(spark.createDataFrame([("n", 0)], "kind string, id long"), edges).collect()
    assert {r.id: r.hops for r in marks} == {i: min(i, 4 + (i - 9) if i >= 9 else i) for i in range(12)}


def plain_alignment(a, b):
    special = lambda x: not (x.isascii() and x.isalnum())
    alike = {(x, y) for x, y in pairwise.ALIKE} | {(y, x) for x, y in pairwise.ALIKE}
    pair = lambda x, y: 0 if special(x) and special(y) and ord(x) < 256 and ord(y) < 256 else 2 if x == y or (x, y) in alike else -1
    gap = lambda x: 0 if special(x) and ord(x) < 256 else -1
    t = {(0, 0): (0, 0)}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i and j:
                ways = [(t[i, j - 1][0] + gap(b[j - 1]), 1), (t[i - 1, j - 1][0] + pair(a[i - 1], b[j - 1]), 2), (t[i - 1, j][0] + gap(a[i - 1]), 3)]
                t[i, j] = max(ways, key=lambda w: (w[0], -w[1]))
            elif i or j:
                t[i, j] = (-(i + j), 3 if i else 1)
    i, j, left, right = len(a), len(b), "", ""
    while i or j:
        w = t[i, j][1]
        left = ("$" if w == 1 else a[i - 1]) + left
        right = ("$" if w == 3 else b[j - 1]) + right
        i, j = i - (w >= 2), j - (w <= 2)
    return t[len(a), len(b)][0], left, right, (2 * len(left) - len(a) - len(b)) / max(1, len(a), len(b))


def test_alignment_equals_the_plain_table():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abdJGzAmyFCcLlD.-_ é日") for _ in range(rnd.randint(0, 14))) for _ in range(600)]
    first, second = words[:300], words[300:]
    assert pairwise.align_batch(first, second) == [plain_alignment(a, b) for a, b in zip(first, second, strict=True)]
    assert pairwise.align_batch([], []) == []


def test_alignment_of_many_pairs(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcdefgh .") for _ in range(rnd.randint(5, 30))) for _ in range(2000)]
    pairs = spark.range(100_000).selectExpr("id as key", "cast(id % 2000 as int) as i", "cast(id * 7 % 2000 as int) as j")
    named = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    pairs = pairs.join(named.selectExpr("n as i", "t as a"), "i").join(named.selectExpr("n as j", "t as b"), "j").cache()
    pairs.count()
    began = time.perf_counter()
    found = pairwise.align_pairs(pairs).selectExpr("count(*) as n", "sum(score) as s").first()
    assert found.n == 100_000 and time.perf_counter() - began < 120
    odd = spark.createDataFrame([(1, None, "ab"), (2, "", None), (3, "rent", "rent")], "key long, a string, b string")
    assert {r.key: (r.score, r.a, r.b, r.distance) for r in pairwise.align_pairs(odd).collect()} == {1: (-2, "$$", "ab", 1.0), 2: (0, "", "", 0.0), 3: (8, "rent", "rent", 0.0)}


def plain_nesting(text):
    stack, depth, least, good, inside, i = [], 0, 0, True, False, 0
    while i < len(text):
        c = text[i]
        if c == "\\":
            run = 1
            while i + run < len(text) and text[i + run] == "\\":
                run += 1
            i += run + (run % 2 and i + run < len(text) and text[i + run] == '"')
            continue
        if c == '"':
            inside = not inside
        elif not inside and c in "{[(":
            stack.append(c)
            depth += 1
        elif not inside and c in "}])":
            depth -= 1
            least = min(least, depth)
            good = good and bool(stack) and "{[(".index(stack.pop()) == "}])".index(c)
        i += 1
    return depth, least, good and depth == 0


def test_nesting(spark):
    assert [nesting.bracket_scan(t) for t in ("", "{}", "}{", "([)]", '{"}": [1, (2)]}', '"{"', "{{}", '{"a\\"}": 1}')] == [(0, 0, True), (0, 0, True), (0, -1, False), (0, 0, False), (0, 0, True), (0, 0, True), (1, 0, False), (0, 0, True)]
    rnd = random.Random(7)
    for _ in range(2000):
        t = "".join(rnd.choice('{}[]()"\\ a') for _ in range(rnd.randint(0, 14)))
        assert nesting.bracket_scan(t) == plain_nesting(t), t
    assert nesting.bracket_scan('[{"x": "}"}]' * 1_000_000) == (0, 0, True)
    rows = spark.createDataFrame([(1, "{[]}"), (2, "}{"), (3, None)], "id int, t string")
    assert [(r.n.nested if r.n else None) for r in rows.select("id", nesting.nesting(rows.t).alias("n")).orderBy("id").collect()] == [True, False, None]
