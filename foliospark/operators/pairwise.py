"""Alignment of many pairs of strings side by side: one table of scores a batch, filled by anti-diagonals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Cells of the tables of one batch.
CELLS = 8 << 20
#: Scores of a match, of a mismatch or gap, and of characters that are neither letters nor digits.
MATCH, MISMATCH, SPECIAL = 2, -1, 0
#: Letters of layout codes that count as alike, both ways.
ALIKE = ["dJ", "dj", "Jj", "GA", "Ga", "aA", "az", "Az", "my", "dm", "FC", "Fc", "Ff", "Cc", "Cf", "cf", "LD", "lD"]


def _tables(alike: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(class of each code point below 256, scores of two classes); others share one class and match only themselves."""
    score = np.full((257, 257), MISMATCH, np.int32)
    plain = np.array([not (chr(i).isascii() and chr(i).isalnum()) for i in range(256)] + [False])
    score[np.ix_(plain, plain)] = SPECIAL
    for i in np.flatnonzero(~plain[:256]).tolist():
        score[i, i] = MATCH
    for pair in alike:
        a, b = map(ord, pair)
        score[a, b] = score[b, a] = MATCH
    gap = np.where(plain, SPECIAL, MISMATCH).astype(np.int32)
    return score, gap


def align_batch(first: list[str], second: list[str], alike: list[str] = ALIKE) -> list[tuple[int, str, str, float]]:
    """(score, first with gaps, second with gaps, relative distance) of each pair.

    All pairs of a batch are cells of one table, which is filled diagonal by diagonal, each for all
    pairs at once; so is the way back walked. Of equal choices a gap in the first string is taken
    before a pair, and a pair before a gap in the second. The distance is the number of gaps by the
    longer string's length.
    """
    score, gap = _tables(alike)
    n = len(first)
    size_a, size_b = (np.array([len(x) for x in side], np.int64) for side in (first, second))
    la, lb = int(size_a.max(initial=0)), int(size_b.max(initial=0))
    code = lambda side, width: np.array([np.pad(np.frombuffer(x.encode("utf-32-le"), np.uint32), (0, width - len(x))) for x in side], np.int64).reshape(n, width)
    a, b = code(first, la), code(second, lb)
    ka, kb = np.minimum(a, 256), np.minimum(b, 256)
    way = np.zeros((n, la + 1, lb + 1), np.uint8)  # 1: gap in the first, 2: pair, 3: gap in the second
    way[:, 0, 1:], way[:, 1:, 0] = 1, 3
    total = np.zeros(n, np.int64)
    # cells by their place in the first string; borders cost one a character
    before = np.full((n, la + 1), 0, np.int32)
    last = np.full((n, la + 1), 0, np.int32)
    for d in range(la + lb + 1):
        now = np.zeros((n, la + 1), np.int32)
        lo, hi = max(0, d - lb), min(la, d)
        if lo == 0:
            now[:, 0] = -d
        if hi == d:
            now[:, d] = -d
        i = np.arange(max(1, lo), min(la, d - 1) + 1)
        if len(i):
            j = d - i
            x, y = ka[:, i - 1], kb[:, j - 1]
            same = score[x, y]
            wide = (x == 256) & (y == 256)
            if wide.any():
                same = np.where(wide & (a[:, i - 1] == b[:, j - 1]), MATCH, same)
            down = last[:, i - 1] + gap[x]
            across = last[:, i] + gap[y]
            pair = before[:, i - 1] + same
            best = np.maximum(np.maximum(down, across), pair)
            now[:, i] = best
            way[:, i, j] = np.where(across == best, 1, np.where(pair == best, 2, 3))
        done = np.flatnonzero(size_a + size_b == d)
        total[done] = now[done, size_a[done]]
        before, last = last, now
    i, j = size_a.copy(), size_b.copy()
    steps: list[np.ndarray] = []
    rows = np.arange(n)
    while True:
        w = way[rows, i, j]
        if not w.any():
            break
        steps.append(w)
        i -= w >= 2
        j -= (w == 1) | (w == 2)
    ways = np.array(steps[::-1], np.uint8).reshape(len(steps), n).T
    out = []
    for k in range(n):
        p, q = iter(first[k]), iter(second[k])
        path = ways[k][ways[k] > 0].tolist()
        left = "".join("$" if s == 1 else next(p) for s in path)
        right = "".join("$" if s == 3 else next(q) for s in path)
        gaps = 2 * len(path) - len(first[k]) - len(second[k])
        out.append((int(total[k]), left, right, gaps / max(1, len(first[k]), len(second[k]))))
    return out


def align_pairs(pairs: DataFrame, alike: list[str] = ALIKE) -> DataFrame:
    """(key, score, a, b, distance): global alignment of each pair (key, a, b), gaps shown as $.

    Null strings are empty. No shuffle: each Arrow batch is ordered by length and cut so that the tables
    of a cut hold at most CELLS cells (or one pair).
    """
    schema = T.StructType([pairs.schema["key"], *T.StructType.fromDDL("score int, a string, b string, distance double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([x or "" for x in batch.column(k).to_pylist()] for k in (1, 2))
            order = sorted(range(len(a)), key=lambda i: (len(a[i]), len(b[i])))
            found: list[tuple] = [()] * len(a)
            i = 0
            while i < len(order):
                j, la, lb = i, 0, 0
                while j < len(order) and (j == i or (j - i + 1) * (max(la, len(a[order[j]])) + 1) * (max(lb, len(b[order[j]])) + 1) <= CELLS):
                    la, lb = max(la, len(a[order[j]])), max(lb, len(b[order[j]]))
                    j += 1
                for k, r in zip(order[i:j], align_batch([a[k] for k in order[i:j]], [b[k] for k in order[i:j]], alike), strict=True):
                    found[k] = r
                i = j
            columns = list(zip(*found, strict=True)) or [[], [], [], []]
            kinds = (pa.int32(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], schema.names)

    return pairs.select("key", "a", "b").mapInArrow(run, schema)
