"""Exact removal of byte strings that occur twice.

Where in the corpus a string of the threshold length can occur twice is found by anchors: in every
window of that length the run of ANCHOR bytes with the least hash. Equal windows have equal anchors,
so an anchor that occurs once rules its windows out, and surroundings that occur twice as a whole
hold repeated strings only. Where surroundings of one anchor differ, each different one goes into a
Burrows-Wheeler transform once, and breadth-first backward extension of its intervals derives common
prefixes by increasing length and stops at the threshold; suffixes that no boundary divides by then
start repeated strings. Surroundings that share with no others of their anchor even the middle part
that an equal window would have them share are left out before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable, small_batches, sparing
from .words import mix, pieces, text_bytes

_U = np.uint64
ANCHOR = 32
#: Bytes of surroundings that are transformed together, at least.
BATCH = 1 << 20
#: Different surroundings of one anchor that may meet in one task; beyond, their windows meet by their own content instead.
CROWD = 20_000
_PART = 1 << 20
_BASE = _U(0x9E3779B97F4A7C15)
_UP = np.multiply.accumulate(np.append(_U(1), np.full(1 << 18, _BASE)))
_DOWN = np.multiply.accumulate(np.append(_U(1), np.full(1 << 18, _U(pow(int(_BASE), -1, 1 << 64)))))
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def _string_hashes(body: np.ndarray, n: int) -> np.ndarray:
    """A hash of every string of n bytes."""
    out = np.empty(max(0, len(body) - n + 1), np.uint64)
    step = (1 << 18) - n
    for i in range(0, len(out), step):
        part = body[i : i + step + n - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[part] * _UP[: len(part)])])
        k = len(part) - n + 1
        out[i : i + k] = (sums[n:] - sums[:k]) * _DOWN[:k]
    return mix(out)


def _running(values: np.ndarray, w: int, take) -> np.ndarray:
    """take.reduce over every w consecutive values."""
    n = len(values)
    rows = -(-n // w) + 1
    fill = np.iinfo(values.dtype).max if take is np.minimum else 0
    padded = np.full(rows * w, fill, values.dtype)
    padded[:n] = values
    grid = padded.reshape(rows, w)
    left = take.accumulate(grid, axis=1).reshape(-1)
    right = take.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return take(right[: n - w + 1], left[w - 1 : n])


def anchors(body: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, first, last): the anchors and the first and last window start that each stands for (the leftmost least hash of the window)."""
    none = np.zeros(0, np.int64)
    if len(body) < length:
        return none.astype(np.uint64), none, none, none
    h = _string_hashes(body, ANCHOR)
    w = length - ANCHOR + 1
    least = _running(h, w, np.minimum)
    n = len(least)
    # places that are the least of some window that holds them
    most = _running(np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)]), w, np.maximum)
    candidate = np.flatnonzero(h == most)
    # the window's anchor: the first of them from its start on that has its least value
    nxt = np.searchsorted(candidate, np.arange(n), "left")
    wrong = np.flatnonzero(h[candidate[nxt]] != least)
    while len(wrong):
        nxt[wrong] += 1
        wrong = wrong[h[candidate[nxt[wrong]]] != least[wrong]]
    place = candidate[nxt]
    cut = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    last = np.append(cut[1:], n) - 1
    return h[place[cut]], place[cut], cut, last


def _first_bytes(text: np.ndarray) -> np.ndarray:
    """The first eight bytes of each suffix as one number."""
    n = len(text)
    padded = np.append(text, np.full(8, 0xFE, np.uint8))  # no byte of UTF-8
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << _U(8) | padded[k : n + k].astype(np.uint64)
    return key


def suffix_array(text: np.ndarray, depth: int, key: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in order of their first `depth` bytes at least, by doubling of the sorted length. key: _first_bytes of the text, where known."""
    n = len(text)
    key = _first_bytes(text) if key is None else key
    sa = np.argsort(key)
    head = np.append(True, key[sa[1:]] != key[sa[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    at = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = at
    done = 8
    while done < depth:
        size = np.diff(np.append(np.flatnonzero(head), n))
        open_ = np.flatnonzero(np.repeat(size, size) > 1)
        if not len(open_):
            break
        rows = sa[open_]
        second = rank[np.minimum(rows + done, n)] + 1
        by = np.argsort(at[open_] * (n + 1) + second, kind="stable")
        rows, second = rows[by], second[by]
        sa[open_] = rows
        group = at[open_]
        fresh = np.append(True, (group[1:] != group[:-1]) | (second[1:] != second[:-1]))
        head[open_] = fresh
        at = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[sa] = at
        done *= 2
    return sa


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """Marks the places of a text where a string of `length` bytes starts that also starts elsewhere in it.

    The last length - 1 places are never marked. Boundaries between neighbouring suffixes are set in
    order of the length of their common prefix: those of length v + 1 follow from those of length v
    by one step of backward extension over the transform. Each interval that a new boundary splits is
    walked once; for each symbol that precedes suffixes on both sides, the extended strings part at
    the place where the transform maps the first of the far side. The boundaries of prefixes below
    eight bytes are those of the numbers that the suffixes are sorted by first.
    """
    if len(text) <= length:
        return np.zeros(len(text), bool)
    text = np.append(text, np.uint8(0xFD))  # an end of its own, so that no string runs over it
    n = len(text)
    marked = np.zeros(n, bool)
    key = _first_bytes(text)
    sa = suffix_array(text, length + 1, key)
    bwt = text[sa - 1]
    order = np.argsort(bwt, kind="stable").astype(np.int32)
    forward = np.empty(n, np.int32)
    forward[order] = np.arange(n, dtype=np.int32)
    following = np.full(n, n, np.int32)
    same = bwt[order[1:]] == bwt[order[:-1]]
    following[order[:-1][same]] = order[1:][same]
    depth = min(8, length)  # bytes that the numbers tell apart
    apart = (key[sa[1:]] ^ key[sa[:-1]]) >> _U(64 - 8 * depth)
    edge = np.ones(n + 1, bool)
    edge[1:n] = apart >> _U(8) != 0
    cuts = np.flatnonzero(edge).astype(np.int32)
    begin, end = np.repeat(cuts[:-1], np.diff(cuts)), np.repeat(cuts[1:], np.diff(cuts))
    fresh = (np.flatnonzero((apart != 0) & ~edge[1:n]) + 1).astype(np.int32)
    edge[fresh] = True
    for _ in range(depth, length):
        if not len(fresh):
            break
        lo = begin[fresh]
        lo = lo[np.append(True, lo[1:] != lo[:-1])]
        size = end[lo] - lo
        head = np.cumsum(size, dtype=np.int32) - size
        k = np.repeat(lo - head, size) + np.arange(head[-1] + size[-1], dtype=np.int32)
        step = np.zeros(len(k), np.int32)
        nth = np.searchsorted(lo, fresh, "right") - 1
        step[head[nth] + fresh - lo[nth]] = 1
        part = np.cumsum(step, dtype=np.int32)  # the number of fresh boundaries up to each place
        upto = end[k]
        bounds = np.concatenate([[0], fresh, [n]]).astype(np.int32)
        far = following[k]
        inside = np.flatnonzero(far < upto)
        far = far[inside]
        goal = forward[far[far >= bounds[part[inside] + 1]]]
        begin[k] = np.maximum(begin[k], bounds[part])
        end[k] = np.minimum(upto, bounds[part + 1])
        fresh = np.unique(goal[~edge[goal]])
        edge[fresh] = True
    alike = np.flatnonzero(~edge[1:n]) + 1
    marked[sa[alike]] = marked[sa[alike - 1]] = True
    marked[n - length :] = False
    return marked[:-1]


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans that are sorted by start."""
    upto = np.maximum.accumulate(end)
    cut = np.flatnonzero(np.append(True, start[1:] > upto[:-1]))
    return start[cut], upto[np.append(cut[1:], len(start)) - 1]


_ANCHORS = "deal long, key long, hi long, lo long, id long, dig long, first long, last long, lead int"


def _digests(raw: bytes, start: list[int], end: list[int]) -> np.ndarray:
    """A cryptographic digest of each span, as two numbers."""
    parts = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start, end, strict=True)]
    return np.frombuffer(b"".join(parts), np.int64).reshape(-1, 2)


def _find_anchors(length: int):
    """(id, dig, text) to anchors with the digest of what surrounds them.

    Of equal surroundings in one batch, two are dealt by anchor; the others (lead 0) anywhere. Of
    equal texts in one batch, one is read: it has copies, which the caller removes as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for i, j in pieces(texts, _PART):
                body, at = text_bytes(texts.slice(i, j - i))
                ids, digs = batch.column(0).slice(i, j - i).to_numpy(), batch.column(1).slice(i, j - i).to_numpy()
                out: list[tuple] = []
                seen: set[bytes] = set()
                for r in range(j - i):
                    own = body[at[r] : at[r + 1]]
                    raw = own.tobytes()
                    if len(own) < length or raw in seen:
                        continue
                    seen.add(raw)
                    key, _, first, last = anchors(own, length)
                    out.append((key.view(np.int64), *_digests(raw, first.tolist(), (last + length).tolist()).T, np.full(len(key), ids[r]), np.full(len(key), digs[r]), first, last))
                if out:
                    cells = [np.concatenate(c) for c in zip(*out, strict=True)]
                    by = np.lexsort((cells[2], cells[1], cells[0]))
                    again = np.append(False, np.all([c[by][1:] == c[by][:-1] for c in cells[:3]], axis=0))
                    nth = np.arange(len(by)) - np.maximum.accumulate(np.where(again, 0, np.arange(len(by))))
                    lead = np.empty(len(by), np.int32)
                    lead[by] = np.where(nth < 2, nth + 1, 0)
                    deal = np.where(lead > 0, cells[0], mix(cells[1].view(np.uint64) + cells[5].astype(np.uint64) * _BASE + cells[3].view(np.uint64)).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (deal, *cells, lead)], ["deal", "key", "hi", "lo", "id", "dig", "first", "last", "lead"])

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors sorted by deal, key and digest: those that occur twice, with what is known by then.

    heavy: the same surroundings occur again. nth: the number of different surroundings of the anchor
    up to this row, or 0 where another row stands for the same. All that is held is the last row.
    """
    held: pa.RecordBatch | None = None
    before: tuple = ()  # what is known of the row held: whether its surroundings, its anchor came before, and nth

    def known(batch: pa.RecordBatch) -> tuple:
        deal, key, hi, lo = (batch.column(k).to_numpy() for k in range(4))
        new_key = np.append(True, (deal[1:] != deal[:-1]) | (key[1:] != key[:-1]))
        new_run = new_key | np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))
        run_before, key_before, nth = ~new_run, ~new_key, np.cumsum(new_run)
        nth = nth - np.maximum.accumulate(np.where(new_key, nth, 0)) + 1
        if before:
            run_before[0], key_before[0] = before[:2]
            end = int(np.append(np.flatnonzero(new_key[1:]) + 1, len(key))[0])
            nth[:end] += before[2] - 1
        return run_before, key_before, nth

    def judge(batch: pa.RecordBatch, n: int) -> pa.RecordBatch:
        """The first n rows; the one behind them is still to come."""
        run_before, key_before, nth = known(batch)
        follower = batch.column(8).to_numpy() == 0
        heavy = follower | run_before | np.append(run_before[1:], False)
        pick = np.flatnonzero((heavy | key_before | np.append(key_before[1:], False))[:n])
        own = np.where(run_before | follower, 0, nth)[pick]
        return pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(pick)) for k in range(1, 8)), pa.array(heavy[pick]), pa.array(own)], ["key", "hi", "lo", "id", "dig", "first", "last", "heavy", "nth"])

    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows > 1:
            yield judge(batch, batch.num_rows - 1)
            before = tuple(x[-1] for x in known(batch))
        held = batch.slice(batch.num_rows - 1) if batch.num_rows else held
    if held is not None:
        yield judge(held, 1)


_CUT = "key long, hi long, lo long, id long, dig long, first long, bytes binary, heavy boolean"
_NAMES = ["key", "hi", "lo", "id", "dig", "first", "bytes", "heavy"]


def _cut_out(length: int):
    """(id, dig, text, asked) to the surroundings that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in pieces(batch.column(2), _PART):
                part = batch.slice(i, j - i)
                body, at = text_bytes(part.column(2))
                asked = part.column(3)
                flat = asked.flatten()
                row = np.repeat(np.arange(j - i), asked.value_lengths().to_numpy(zero_copy_only=False))
                first, last = (flat.field(k).to_numpy(zero_copy_only=False) for k in (3, 4))
                lo, hi = at[row] + first, at[row] + last + length
                raw = body.tobytes()
                cells = pa.array([raw[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary())
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(flat.field(k) for k in range(3)), part.column(0).take(pick), part.column(1).take(pick), pa.array(first), cells, flat.field(5)], _NAMES)

    return run


def meeting(key: np.ndarray, body: np.ndarray, at: np.ndarray, heavy: np.ndarray, length: int) -> np.ndarray:
    """The surroundings (body[at[i]:at[i + 1]], of anchor key[i]) that may hold a window of others of their anchor, heavy ones only where one of these isn't.

    An equal window lies about both anchors alike, `before` bytes of it in front. For before in
    [g, g + step), the length - step + 1 bytes from g in front of the anchor on are part of the
    window, and so equal too. Of surroundings whose hash of these recurs for no g, the window is not.
    """
    step = (length - ANCHOR) // 3 + 1
    size = length - step + 1
    found = np.flatnonzero(_string_hashes(body, ANCHOR).view(np.int64) == np.repeat(key, np.diff(at))[: max(0, len(body) - ANCHOR + 1)])
    found = found[np.searchsorted(at, found + ANCHOR, "left") == np.searchsorted(at, found, "right")]  # within one row
    row, first = np.unique(np.searchsorted(at, found, "right") - 1, return_index=True)
    place = found[first]  # the leftmost: another in front would be the anchor
    h = _string_hashes(body, size)
    rows, marks = [], []
    for g in range(0, length - ANCHOR + 1, step):
        fits = np.flatnonzero((place - g >= at[row]) & (place - g + size <= at[row + 1]))
        rows.append(row[fits])
        marks.append(mix(h[place[fits] - g] + mix(key[row[fits]].view(np.uint64) + _U(g))))
    rows, marks = np.concatenate(rows), np.concatenate(marks)
    _, of, n = np.unique(marks, return_inverse=True, return_counts=True)
    light = np.zeros(len(n), bool)
    light[of[~heavy[rows]]] = True
    return np.unique(rows[(n[of] > 1) & light[of]])


def _transform(length: int, anchored: bool = True):
    """Surroundings sorted by key to the spans of repeated strings in those that aren't heavy; whole keys at a time. anchored: the keys are anchors'."""

    def decide(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        if anchored:
            body, at = text_bytes(rows.column(6))
            rows = rows.take(pa.array(meeting(rows.column(0).to_numpy(), body, at, rows.column(7).to_numpy(), length)))
        ids, digs, first, heavy = (rows.column(k).to_numpy() for k in (3, 4, 5, 7))
        cells = rows.column(6).to_pylist()
        by = np.lexsort((first, digs, ids))
        segments: list[bytearray] = []  # of one text, overlapping ones made one
        shift = np.empty(len(by), np.int64)  # of each row, its place in the text that is transformed
        at, before, reach = 0, None, 0
        for r in by.tolist():
            place = int(first[r])
            if (ids[r], digs[r]) == before and place <= reach:
                segments[-1] += cells[r][reach - place :]
            else:
                at += len(segments[-1]) + 1 if segments else 0
                segments.append(bytearray(cells[r]))
                before, begin = (ids[r], digs[r]), place
                reach = place
            shift[r] = at + place - begin
            reach = max(reach, place + len(cells[r]))
        text = np.frombuffer(b"\xff".join(segments) or b"\xff", np.uint8)
        start = np.flatnonzero(repeated_starts(text, length))
        own = np.flatnonzero(~heavy)
        windows = np.array([len(cells[r]) - length + 1 for r in own.tolist()], np.int64)
        a, b = np.searchsorted(start, shift[own]), np.searchsorted(start, shift[own] + windows)
        row = np.repeat(own, b - a)
        k = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())
        lo = start[k] - shift[row]
        cut = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (lo[1:] > lo[:-1] + length))[: len(row)])
        to = np.append(cut[1:], len(row))[: len(cut)] - 1
        at = first[row[cut]]
        return pa.RecordBatch.from_arrays([pa.array(ids[row[cut]]), pa.array(digs[row[cut]]), pa.array(at + lo[cut]), pa.array(at + lo[to] + length)], ["id", "dig", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        key, size = None, 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            lens = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(6)).to_numpy())])
            i = 0
            for j in cuts[1:]:
                if j == i:
                    continue
                if size >= BATCH and keys[i] != key:
                    yield decide(parts)
                    parts, size = [], 0
                parts.append(batch.slice(i, j - i))
                size += int(lens[j] - lens[i])
                key = keys[i]
                i = j
        if parts:
            yield decide(parts)

    return run


def _windows(length: int):
    """Surroundings to a row for each window: its digest (h, g), whether it is heavy, where it is, and its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw = batch.column(6)[r].as_py()
                n = len(raw) - length + 1
                digest = _digests(raw, list(range(n)), list(range(length, n + length)))
                heavy, own, dig = (batch.column(k).slice(r, 1).take(pa.array(np.zeros(n, np.int64))) for k in (7, 3, 4))
                place = pa.array(np.arange(n) + batch.column(5)[r].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(digest[:, 0]), pa.array(digest[:, 1]), heavy, own, dig, place, pa.array([raw[k : k + length] for k in range(n)], pa.binary())], ["h", "g", "heavy", "id", "dig", "first", "bytes"])

    return run


def _report(names: list[str]):
    """Each row's numbers and digest, from its text and its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in pieces(batch.column(1), 8 << 20):
                part = batch.slice(i, j - i)
                body, at = text_bytes(part.column(1))
                spans = part.column(2)
                flat = spans.flatten()
                n = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                lo, hi = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                upto = np.cumsum(n)
                out: list[list] = [[], [], [], [], []]
                for r in range(j - i):
                    raw = body[at[r] : at[r + 1]].tobytes()
                    a, b = lo[upto[r] - n[r] : upto[r]], hi[upto[r] - n[r] : upto[r]]
                    if len(a):
                        by = np.argsort(a, kind="stable")
                        a, b = _merge(a[by], np.minimum(b[by], len(raw)))
                    edges = [0, *np.stack([a, b], axis=1).reshape(-1).tolist(), len(raw)]
                    kept = b"".join(raw[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                    cells = (len(raw), len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), [{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist(), strict=True)])
                    for held, cell in zip(out, cells, strict=True):
                        held.append(cell)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    return run


def find_repeats(docs: DataFrame, length: int = 200, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): bytes of each text in strings of `length` bytes that occur twice.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same
    text or another; strings are judged on the texts as given, and never cross texts. spans are the
    maximal removed runs (start, end) in bytes. A null text counts as empty; texts shorter than
    `length` lose nothing. Repeated rows are repeats of one another, so that a repeated text of
    `length` bytes or more goes as a whole. Rows may have null or equal ids. No rows give no rows.

    A text of which the corpus holds another copy (by SHA-256) goes as a whole, and so do surroundings
    of an anchor (by a 128-bit digest); in all else the transform decides. What is shuffled: a narrow
    row for each anchor, the texts twice (once to cut out surroundings, once for the result), and
    each different surroundings of the anchors of which some occur once. So a passage in very many
    texts meets in no task more than once. An anchor with more than CROWD different surroundings has
    its windows dealt by their own digests instead, and two copies of each that occurs twice go into a transform.
    """
    small_batches(docs.sparkSession)
    none = F.lit(-(1 << 63)).cast("long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), none).alias("id"), F.xxhash64(text).alias("dig"), text.alias("text"))

    copies = rows.where(F.octet_length("text") >= length).select("id", "dig", F.octet_length("text").cast("long").alias("end"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    twice = durable(copies.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1"))
    whole = copies.join(twice, "digest").select("id", "dig", F.lit(0).cast("long").alias("from"), F.col("end").alias("to")).distinct()

    found = rows.select("id", "dig", "text").mapInArrow(sparing(_find_anchors(length)), _ANCHORS)
    judged = found.repartition("deal").sortWithinPartitions("deal", "key", "hi", "lo")
    judged = durable(judged.mapInArrow(sparing(_settle), "key long, hi long, lo long, id long, dig long, first long, last long, heavy boolean, nth long"))
    spans = judged.where("heavy").select("id", "dig", F.col("first").alias("from"), (F.col("last") + length).alias("to"))

    various = judged.where("nth > 0").groupBy("key").agg(F.max("nth").alias("most"), F.min("heavy").alias("settled")).where("most > 1 and not settled").select("key", "most")
    asked = judged.where("nth > 0").join(durable(various), "key")
    crowded = not asked.where(F.col("most") > CROWD).isEmpty()
    asked = asked.groupBy("id", "dig").agg(F.collect_list(F.struct("key", "hi", "lo", "first", "last", "heavy", (F.col("most") > CROWD).alias("crowd"))).alias("asked"))
    around = rows.join(asked, ["id", "dig"]).select("id", "dig", "text", "asked")
    part = lambda crowd: around.withColumn("asked", F.filter("asked", lambda x: x["crowd"] == F.lit(crowd))).mapInArrow(sparing(_cut_out(length)), _CUT)
    decided = "id long, dig long, from long, to long"
    spans = spans.union(part(False).repartition("key").sortWithinPartitions("key").mapInArrow(sparing(_transform(length)), decided))
    if crowded:
        windows = durable(part(True).mapInArrow(sparing(_windows(length)), "h long, g long, heavy boolean, id long, dig long, first long, bytes binary"))
        place = F.struct("id", "dig", "first")
        met = windows.groupBy("h", "g").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("heavy").alias("heavy"), F.first("bytes").alias("bytes")).where("a <> b or heavy")
        pair = met.select("h", "g", "bytes", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("k"))
        pair = pair.select(F.col("h").alias("key"), "h", F.col("g").alias("lo"), F.col("h").alias("id"), F.col("g").alias("dig"), (F.col("k") * 2 * length).alias("first"), "bytes", F.lit(False).alias("heavy"))
        sure = pair.repartition("key").sortWithinPartitions("key").mapInArrow(sparing(_transform(length, anchored=False)), decided).select(F.col("id").alias("h"), F.col("dig").alias("g")).distinct()
        fresh = windows.where("not heavy").join(durable(sure), ["h", "g"])
        spans = spans.union(fresh.select("id", "dig", F.col("first").alias("from"), (F.col("first") + length).alias("to")))
    spans = spans.union(whole).groupBy("id", "dig").agg(F.collect_list(F.struct("from", "to")).alias("removed"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    given = F.when(F.col("id") != none, F.col("id")).alias("doc_id")
    out = rows.join(spans, ["id", "dig"], "left").select(given, "text", F.coalesce("removed", F.array().cast("array<struct<from:long,to:long>>")).alias("removed"))
    return out.mapInArrow(sparing(_report(names)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")

