"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are the benchmark's windows of words. A shift table over blocks of two words tells how
far the search may jump; where it says nothing may be skipped, the hash of the suffix and prefix
blocks selects a bucket of test strings. The test strings stay a table of their own: what the tables
let through is joined with it on the words themselves, which is the direct comparison. Texts are cut
into strips that are searched side by side, so that each step is one vectorised operation.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import durable, small_batches, sparing
from .words import ALPHANUMERIC, mix, normal_words, pieces, text_bytes, word_hashes

_U = np.uint64
_STRIP = 256
#: Slots of the tables for each test string, and the most slots of a table: with more test strings it lets more through, and loses nothing.
SLOTS, MOST_BITS = 64, 24


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _U(0x9E3779B97F4A7C15) + b)


class WuManber:
    """Shift and bucket tables of test strings of m words each."""

    def __init__(self, m: int, bits: int, shift: np.ndarray | None = None, bucket: np.ndarray | None = None):
        self.m, self.bits, self.block = m, bits, min(2, m)
        self.shift = np.full(1 << bits, min(255, m - self.block + 1), np.uint8) if shift is None else shift
        self.bucket = np.zeros(1 << bits, np.uint8) if bucket is None else bucket

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return (values >> _U(64 - self.bits)).astype(np.int64)

    def _blocks(self, words: np.ndarray) -> np.ndarray:
        return mix(words[:, 0]) if self.block == 1 else _pair(words[:, 0], words[:, 1])

    def add(self, strings: np.ndarray) -> None:
        """Enter test strings: a row of word hashes each."""
        for end in range(self.block - 1, self.m):
            np.minimum.at(self.shift, self._slot(self._blocks(strings[:, end - self.block + 1 : end + 1])), min(255, self.m - 1 - end))
        self.bucket[self._slot(_pair(self._blocks(strings[:, -self.block :]), self._blocks(strings[:, : self.block])))] = 1

    def search(self, h: np.ndarray, word_at: np.ndarray) -> np.ndarray:
        """First word of every place in a row where a test string may stand: all that do, and few others."""
        m, empty = self.m, np.zeros(0, np.int64)
        lo, hi = word_at[:-1] + m - 1, word_at[1:]
        strips = np.maximum(0, -(-(hi - lo) // _STRIP))
        if not strips.sum():
            return empty
        nth = np.arange(strips.sum()) - np.repeat(np.cumsum(strips) - strips, strips)
        pos = np.repeat(lo, strips) + nth * _STRIP
        end = np.minimum(pos + _STRIP, np.repeat(hi, strips))
        blocks = mix(h) if self.block == 1 else np.append(_U(0), _pair(h[:-1], h[1:]))
        slot = self._slot(blocks)
        found = []
        while len(pos):
            jump = self.shift[slot[pos]]
            stop = jump == 0
            if stop.any():
                found.append(pos[stop])
            pos = pos + np.maximum(jump, 1)
            keep = pos < end
            pos, end = pos[keep], end[keep]
        if not found:
            return empty
        last = np.concatenate(found)
        key = _pair(blocks[last], blocks[last - m + self.block])
        return np.sort(last[self.bucket[self._slot(key)] > 0] - m + 1)


def _test_strings(window: int):
    """(item, text) to a row for each test string: (m, string, item)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in pieces(batch.column(1), 1 << 18):
                raw, start, end, word_at = normal_words(*text_bytes(batch.column(1).slice(i, j - i)), ALPHANUMERIC)
                names = batch.column(0).slice(i, j - i)
                count = np.diff(word_at)
                m = np.minimum(count, window)
                each = np.where(count > 0, count - m + 1, 0)
                row = np.repeat(np.arange(j - i), each)
                head = word_at[row] + np.arange(len(row)) - (np.cumsum(each) - each)[row]
                strings = [raw[a:b] for a, b in zip(start[head].tolist(), end[head + m[row] - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(m[row], pa.int32()), pa.array(strings, pa.binary()), names.take(pa.array(row))], ["m", "string", "item"])

    return run


def _enter(bits: dict[int, int]):
    """(m, string) to a part of the tables: (m, shift, bucket) for each length that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools: dict[int, WuManber] = {}
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            for m in np.unique(lengths).tolist():
                some = batch.column(1).take(pa.array(np.flatnonzero(lengths == m)))
                body, at = text_bytes(some.cast(pa.large_binary()))
                raw, start, end, _ = normal_words(body, at, ALPHANUMERIC)
                tools.setdefault(m, WuManber(m, bits[m])).add(word_hashes(np.frombuffer(raw, np.uint8), start, end).reshape(-1, m))
        for m, tool in tools.items():
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([tool.shift.tobytes()], pa.binary()), pa.array([tool.bucket.tobytes()], pa.binary())], ["m", "shift", "bucket"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of tables to whole tables; two are held for each length."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k in range(batch.num_rows):
            m = batch.column(0)[k].as_py()
            part = [np.frombuffer(batch.column(c)[k].as_buffer(), np.uint8) for c in (1, 2)]
            if m in held:
                np.minimum(held[m][0], part[0], out=held[m][0])
                np.maximum(held[m][1], part[1], out=held[m][1])
            else:
                held[m] = [p.copy() for p in part]
    for m, (shift, bucket) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([shift.tobytes()], pa.binary()), pa.array([bucket.tobytes()], pa.binary())], ["m", "shift", "bucket"])


def _tables(strings: DataFrame) -> list[WuManber]:
    """The tables, filled and merged by Spark tasks; at most 2 << MOST_BITS bytes for each length of test string come to the driver."""
    sizes = {r.m: r["count"] for r in strings.groupBy("m").count().collect()}  # window rows at most
    bits = {m: min(MOST_BITS, max(8, (SLOTS * n).bit_length())) for m, n in sizes.items()}
    layout = "m int, shift binary, bucket binary"
    parts = strings.select("m", "string").mapInArrow(sparing(_enter(bits)), layout)
    whole = parts.repartition("m").mapInArrow(sparing(_merge), layout)
    return [WuManber(r.m, bits[r.m], np.frombuffer(r.shift, np.uint8), np.frombuffer(r.bucket, np.uint8)) for r in whole.toLocalIterator()]


_CANDIDATES = T.ArrayType(T.StructType([T.StructField("m", T.IntegerType()), T.StructField("string", T.BinaryType()), T.StructField("at", T.ArrayType(T.LongType()))]))


def _search(shared, n_keep: int, names: list[str]):
    """(keep..., text) to (keep..., n_words, candidates)."""
    kind = pa.list_(pa.struct([("m", pa.int32()), ("string", pa.binary()), ("at", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = shared.value
        for batch in batches:
            for i, j in pieces(batch.column(n_keep), 4 << 20):
                raw, start, end, word_at = normal_words(*text_bytes(batch.column(n_keep).slice(i, j - i)), ALPHANUMERIC)
                h = word_hashes(np.frombuffer(raw, np.uint8), start, end)
                cells: list[dict] = [defaultdict(list) for _ in range(j - i)]
                for tool in tools:
                    first = tool.search(h, word_at)
                    rows = np.searchsorted(word_at, first, "right") - 1
                    spans = zip(rows.tolist(), (first - word_at[rows]).tolist(), start[first].tolist(), end[first + tool.m - 1].tolist(), strict=True)
                    for r, at, a, b in spans:
                        cells[r][tool.m, raw[a:b]].append(at)
                found = pa.array([[{"m": m, "string": s, "at": at} for (m, s), at in c.items()] for c in cells], kind)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, j - i) for k in range(n_keep)), pa.array(np.diff(word_at), pa.int64()), found], names)

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, list of (m, at)) to (row, hit_spans): the union of the places."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for cell in batch.column(1).to_pylist():
            start = np.concatenate([np.array(x["at"], np.int64) for x in cell])
            end = start + np.concatenate([np.full(len(x["at"]), x["m"]) for x in cell])
            by = np.argsort(start, kind="stable")
            start, end = start[by], np.maximum.accumulate(end[by])
            cut = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
            out.append([{"start": a, "end": b} for a, b in zip(start[cut].tolist(), end[np.append(cut[1:], len(start)) - 1].tolist(), strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["__row", "hit_spans"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), item_col: str = "item_id") -> DataFrame:
    """Rows (keep..., n_words long, hit_spans array of (start, end) words, items array of strings).

    Words are runs of digits, ASCII letters (capital and small alike) and other non-ASCII characters.
    A test string is `window` consecutive words of a benchmark item, or all words of a shorter one. A
    document's hit_spans are the maximal runs of words inside any occurrence, and items the sorted
    item names of which a test string occurs. A null or empty text has no words; items without words
    or without a name are ignored; equal items and repeated rows each count as they stand. A kept
    column named like one of the results gives way to it. Empty tables give no rows or no hits.

    Texts are not shuffled; the kept columns are written once. The benchmark's test strings are a
    distributed table. What is broadcast are tables of bytes, of at most 2 << MOST_BITS for each
    length of test string; places that they let through are joined with the test strings on all words.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c.lower() not in ("n_words", "hit_spans", "items"))
    cells = benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    strings = cells.mapInArrow(sparing(_test_strings(window)), "m int, string binary, item string").groupBy("m", "string").agg(F.collect_set("item").alias("items"))
    strings = durable(strings)
    shared = docs.sparkSession.sparkContext.broadcast(_tables(strings))

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("n_words", T.LongType()), T.StructField("__found", _CANDIDATES)])
    found = docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(sparing(_search(shared, len(keep), schema.names)), schema)
    found = durable(found.withColumn("__row", F.monotonically_increasing_id()))
    shared.unpersist()
    places = found.where("size(__found) > 0").select("__row", F.explode("__found").alias("f")).select("__row", "f.m", "f.string", "f.at")
    hits = durable(places.join(strings, ["m", "string"]).select("__row", "m", "at", "items"))
    spans = hits.groupBy("__row").agg(F.collect_list(F.struct("m", "at")).alias("p")).mapInArrow(sparing(_spans), "__row long, hit_spans array<struct<start:long,end:long>>")
    items = hits.select("__row", F.explode("items").alias("i")).groupBy("__row").agg(F.sort_array(F.collect_set("i")).alias("items"))
    out = found.drop("__found").join(spans.join(items, "__row"), "__row", "left")
    nothing = F.array().cast("array<struct<start:long,end:long>>")
    return out.select(*keep, "n_words", F.coalesce("hit_spans", nothing).alias("hit_spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def hit_words(spans: str = "hit_spans"):
    """Number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows whose text holds no test string, all columns as they are; a null text holds none.

    Contaminated texts are named by their SHA-256 digest, so that no text is written or shuffled
    for the search; where few are contaminated, their digests are broadcast by the planner.
    """
    digest = F.sha2(F.col(text_col).cast("binary"), 256)
    texts = docs.where(F.col(text_col).isNotNull()).select(digest.alias("__digest"), F.col(text_col).alias("__body"))
    found = find_contamination(texts, benchmark.select(item_col, F.col(text_col).alias("__body")), window, "__body", ("__digest",), item_col)
    bad = durable(found.where("size(hit_spans) > 0").select("__digest").distinct())
    return docs.withColumn("__digest", digest).join(bad, "__digest", "left_anti").select(*docs.columns)
