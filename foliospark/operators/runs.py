"""Second round of matching: one engine's word that the other reads as several, by weighted intervals on each line."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import fold_columns

#: Distance of the texts, as a share of the longer, up to which a run reads as the word.
MOST = 0.5
#: Tokens of a run, and how far its boxes may stick out of the word's.
LONGEST, SLACK = 8, 60


def edit_distance(a: str, b: str) -> int:
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best_intervals(found: list[tuple[int, int, int, int, float]]) -> list[int]:
    """Candidates (first and last place in a, first and last in b, worth) of most worth together, no two sharing or crossing.

    Ordered by their ends, each takes the best chain that ends before it on both sides.
    """
    order = sorted(range(len(found)), key=lambda k: (found[k][1], found[k][3], k))
    best: list[float] = []
    back: list[int] = []
    for p, k in enumerate(order):
        a, _, b, _, worth = found[k]
        before = [q for q in range(p) if found[order[q]][1] < a and found[order[q]][3] < b]
        top = max(before, key=lambda q: (best[q], -q), default=-1)
        best.append(worth + (best[top] if top >= 0 else 0.0))
        back.append(top)
    p = max(range(len(order)), key=lambda q: (best[q], -q), default=-1)
    out = []
    while p >= 0:
        out.append(order[p])
        p = back[p]
    return out[::-1]


def _candidates(x1, x2, word, other_x1, other_x2, other, flip):
    """Runs of two words and more of the other side that lie within a word's box and read like it."""
    for i, left in enumerate(x1):
        start = end = bisect_left(other_x1, left - SLACK)
        while end < len(other) and end - start < LONGEST and other_x2[end] <= x2[i] + SLACK:
            end += 1
        for lo in range(start, end):
            for hi in range(lo + 2, end + 1):
                joined = "".join(other[lo:hi])
                size = max(len(word[i]), len(joined), 1)
                if abs(len(word[i]) - len(joined)) > MOST * size:
                    continue
                off = edit_distance(word[i], joined) / size if joined != word[i] else 0.0
                if off <= MOST:
                    span = (i, i, lo, hi - 1)
                    yield ((*span[2:], *span[:2]) if flip else span), (1 - off) * size


def matched_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(doc_id, page, line, first_a, last_a, first_b, last_b, text_a, text_b, chosen, chosen_text) of two engines' unmatched tokens.

    Tokens: doc_id, page, line, sn, text, x1, x2, conf, known (in the dictionary, or of a category). A word of
    one engine goes with a run of two words and more of the other's line that lie within its box and
    whose joined letters are at most MOST of the longer text apart; of all such pairs of a line those of
    most worth together (letters that agree) are taken, none sharing a token or crossing. chosen is the
    side all of whose words are known if the other's aren't, else the one of higher mean confidence, a
    for equal ones. Null texts and boxes are left out. A line is one group.
    """
    cols = ["doc_id", "page", "line", "sn", "x1", "x2", "conf", "known"]
    side = lambda t, s: t.where("text is not null and x1 is not null and x2 is not null").select(*cols, "text", F.regexp_replace("text", "[^A-Za-z0-9]", "").alias("plain"), F.lit(s).alias("side"))
    both = side(a, "a").unionByName(side(b, "b")).withColumn("known", F.coalesce("known", F.lit(False)).cast("int"))

    def step(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        # plain lists: a line has few words, and most have no run
        cols = {k: v.tolist() for k, v in c.items() if k not in ("doc_id", "page", "line")}
        cut = cols["side"].count("a")
        out: dict[str, list] = {k: [] for k in ("doc_id", "page", "line", "first_a", "last_a", "first_b", "last_b", "text_a", "text_b", "chosen", "chosen_text")}
        if not 0 < cut < len(cols["side"]):
            return out
        p = {k: v[:cut] for k, v in cols.items()}
        q = {k: v[cut:] for k, v in cols.items()}
        found = [(*s, w) for s, w in _candidates(p["x1"], p["x2"], p["plain"], q["x1"], q["x2"], q["plain"], False)]
        found += [(*s, w) for s, w in _candidates(q["x1"], q["x2"], q["plain"], p["x1"], p["x2"], p["plain"], True)]
        if not found:
            return out
        own = tuple(c[k][0] for k in ("doc_id", "page", "line"))
        for i, j, k, m in (found[x][:4] for x in best_intervals(found)):
            sides = ((p, i, j + 1), (q, k, m + 1))
            sure = [all(t["known"][x:y]) for t, x, y in sides]
            conf = [sum(t["conf"][x:y]) / (y - x) for t, x, y in sides]
            pick_a = sure[0] if sure[0] != sure[1] else conf[0] >= conf[1]
            texts = [" ".join(t["text"][x:y]) for t, x, y in sides]
            values = (*own, p["sn"][i], p["sn"][j], q["sn"][k], q["sn"][m], *texts, "a" if pick_a else "b", texts[0 if pick_a else 1])
            for name, v in zip(out, values, strict=True):
                out[name].append(v)
        return out

    kind = a.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, page int, line int, first_a int, last_a int, first_b int, last_b int, text_a string, text_b string, chosen string, chosen_text string"
    return fold_columns(both, ["doc_id", "page", "line"], ["side", "x1", "sn"], schema, step)
