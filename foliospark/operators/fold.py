"""Headers of a table of contents against the headings of the body: where the one ends, what is kept, inserted, dropped and moved."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .numbering import fold_columns

#: Pairs on a page that make it one of contents, places between clumps that are joined, and the worth above which a clump counts.
PAGE_PAIRS, CLOSE, WORTH = 5, 3, 11
#: Worth of a number in front of a header, and of its first and last place in a clump.
NUMBERED, EDGE = 2, 2


def header_pairs(items: DataFrame) -> DataFrame:
    """(doc_id, item, partner, page): each header (doc_id, item, page, header) and the next later item of its document that reads the same.

    Headers are compared by the letters and digits of their first 41 characters, case kept; empty ones
    pair with nothing. One window, no pairs of all.
    """
    named = items.withColumn("key", text.normal_header(F.col("header"), keep_case=True)).where("key <> ''")
    following = F.lead("item").over(Window.partitionBy("doc_id", "key").orderBy("item"))
    return named.select("doc_id", "item", following.alias("partner"), "page").where("partner is not null")


def contents_bounds(items: DataFrame) -> DataFrame:
    """(doc_id, first, rest): the first item that pairs with a later one on a page of PAGE_PAIRS such items or more, and that later one.

    Items from first up to rest are the table of contents, those from rest on the body. Documents
    without such a page give no row.
    """
    pairs = header_pairs(items)
    counted = pairs.withColumn("n", F.count("*").over(Window.partitionBy("doc_id", "page"))).where(F.col("n") >= PAGE_PAIRS)
    return counted.groupBy("doc_id").agg(F.min(F.struct("item", "partner")).alias("m")).select("doc_id", F.col("m.item").alias("first"), F.col("m.partner").alias("rest"))


def rising(values: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back[i] = ends[k - 1] if k else -1
        if k == len(tops):
            tops.append(v)
            ends.append(i)
        else:
            tops[k], ends[k] = v, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places of two lists that read the same, rising in both.

    Equal ends are paired; of what is left, keys that stand once in each list are put in the longest
    rising order, and the stretches between them are treated alike. A stretch without such keys pairs
    equal keys from the left as they come.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        at_a: dict = {}
        at_b: dict = {}
        for at, side, lo, hi in ((at_a, a, i, m), (at_b, b, j, n)):
            for k in range(lo, hi):
                at[side[k]] = -1 if side[k] in at else k
        anchors = [(k, at_b[a[k]]) for k in range(i, m) if at_a[a[k]] == k and at_b.get(a[k], -1) >= 0]
        if anchors:
            chosen = [anchors[k] for k in rising([y for _, y in anchors])]
            out += chosen
            for (x, y), (u, v) in zip([(i - 1, j - 1), *chosen], [*chosen, (m, n)], strict=True):
                todo.append((x + 1, u, y + 1, v))
            continue
        places: dict = {}
        for k in range(n - 1, j - 1, -1):
            places.setdefault(b[k], []).append(k)
        floor = j
        for k in range(i, m):
            held = places.get(a[k], [])
            while held and held[-1] < floor:
                held.pop()
            if held:
                floor = held.pop() + 1
                out.append((k, floor - 1))
    return sorted(out)


def fold_contents(contents: DataFrame, body: DataFrame) -> DataFrame:
    """(doc_id, side, item, header, state, partner, clump, good) of two lists (doc_id, item, header) of each document.

    side a is the contents, b the body. state: kept where both have the header in one order, moved where
    the other list has it elsewhere (partner is its item there), dropped (a) or inserted (b) else. Kept
    headers less than CLOSE places apart in the body are a clump, unless one with a number of its own
    begins a new one; good says that the clump's worth is above WORTH: its letters, and NUMBERED or EDGE
    for each header with a number, and for its ends. Empty headers are never kept.
    """
    side = lambda t, s: t.select("doc_id", F.lit(s).alias("side"), "item", F.coalesce("header", F.lit("")).alias("header"))
    both = side(contents, "a").unionByName(side(body, "b")).withColumn("key", text.normal_header(F.col("header"), keep_case=True))

    def step(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        names = c["key"].tolist()
        cut = int((c["side"] == "a").sum())
        a = [(k,) if k else ("", i) for i, k in enumerate(names[:cut])]
        b = [(k,) if k else ("", -1 - i) for i, k in enumerate(names[cut:])]
        state = ["dropped"] * cut + ["inserted"] * len(b)
        partner: list[int | None] = [None] * len(names)
        clump: list[int | None] = [None] * len(names)
        good: list[bool | None] = [None] * len(names)
        item, header = c["item"].tolist(), c["header"].tolist()
        kept = patience(a, b)
        for i, j in kept:
            state[i] = state[cut + j] = "kept"
            partner[i], partner[cut + j] = item[cut + j], item[i]
        left: dict = {}
        for j, key in enumerate(b):
            if state[cut + j] == "inserted" and len(key) == 1:
                left.setdefault(key, []).append(j)
        for i, key in enumerate(a):
            if state[i] == "dropped" and left.get(key):
                j = left[key].pop(0)
                state[i] = state[cut + j] = "moved"
                partner[i], partner[cut + j] = item[cut + j], item[i]
        k = 0
        while k < len(kept):
            e = k + 1
            while e < len(kept) and kept[e][1] - kept[e - 1][1] < CLOSE and not header[cut + kept[e][1]][:1].isdigit():
                e += 1
            run = [cut + j for _, j in kept[k:e]]
            worth = sum(len(names[r]) + NUMBERED * header[r][:1].isdigit() for r in run) + 2 * EDGE
            for i, j in kept[k:e]:
                clump[i] = clump[cut + j] = k
                good[i] = good[cut + j] = worth > WORTH
            k = e
        return {"doc_id": c["doc_id"], "side": c["side"], "item": c["item"], "header": c["header"], "state": state, "partner": partner, "clump": clump, "good": good}

    kind = contents.schema["doc_id"].dataType.simpleString()
    return fold_columns(both, ["doc_id"], ["side", "item"], f"doc_id {kind}, side string, item int, header string, state string, partner int, clump int, good boolean", step)
