"""BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a part of a partition are laid out as one array of symbols. An index maps
each adjacent pair that a merge rule covers to all positions where it occurs; the rules that occur
are applied in ascending rank, each at all its positions at once, and only the lists of the pairs
that a merge changes are updated. A symbol is made by a rule before any rule that uses it, so one
ascending pass gives the same ids as merging every word by itself.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .runtime import small_batches, sparing
from .words import code_values, distinct_spans, pieces, span_hashes

#: Bytes of text whose distinct pre-tokens are encoded together, and characters cut into pre-tokens at once.
PART = 2 << 20
SPLIT = 1 << 18
_FAR = 1 << 30


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
#: Code points of white space.
_WHITE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kind = np.array([{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x110000)], np.uint8)
    kind[_WHITE] = _SPACE
    return kind


def pre_tokens(code: np.ndarray, lengths: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and runs of the pre-tokens of runs of text whose code points are joined in `code`.

    The byte-level rules: a run of letters, of numbers or of other characters, each with one space
    before it; the endings 's 't 're 've 'm 'll 'd; white space, of which the last character stays
    apart if something follows. A run marked as special is one pre-token.
    """
    n = len(code)
    kind = _kinds()[code]
    run_at = np.cumsum(lengths) - lengths
    head = np.zeros(n + 1, bool)
    head[run_at] = head[n] = True
    cut = head.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(cut)
    last = begin[1:] - 1
    after = last[(kind[last] == _SPACE) & ~head[last + 1]]
    cut[after] = True
    cut[after[code[after] == 32] + 1] = False
    quote = np.flatnonzero((code == 39) & cut[:n])
    if len(quote):
        padded = np.append(code, [0, 0, 0])
        one, two = padded[quote + 1], padded[quote + 2]
        near = np.append(head, [True, True])
        short = ~near[quote + 1] & np.isin(one, [ord(c) for c in "stmd"])
        long = ~near[quote + 1] & ~near[quote + 2] & np.isin(one * 65536 + two, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])
        for chosen, size in ((short, 2), (long, 3)):
            at = quote[chosen]
            cut[at + 1] = False
            end = at + size
            end = end[~near[end]]
            cut[end[kind[end] == _LETTER]] = True
    if (special >= 0).any():
        for a, size in zip(run_at[special >= 0].tolist(), lengths[special >= 0].tolist(), strict=True):
            cut[a + 1 : a + size] = False
    begin = np.flatnonzero(cut)
    start, end = begin[:-1], begin[1:]
    return start, end, np.searchsorted(run_at, start, "right") - 1


class BytePairEncoder:
    """The model of one tokenizer file: byte-level BPE without normaliser, prefix space or word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        if model.get("dropout") or model.get("ignore_merges") or any(x[flag] for x in spec["added_tokens"] for flag in ("lstrip", "rstrip", "single_word")):
            raise ValueError("dropout, ignore_merges and added tokens that take in blanks or stand as words alone are not supported")
        byte_of = _byte_of_char()
        vocab = model["vocab"]
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for piece, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in piece)
        for piece, i in added.items():
            self.bytes_of[i] = piece.encode()
        self.added = added
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.byte_id = np.full(256, -1, np.int32)
        for c, b in byte_of.items():
            self.byte_id[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        key = self.left.astype(np.int64) << 32 | self.right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the rule for each pair, or _FAR."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], _FAR)

    @staticmethod
    def _register(index: dict[int, list[np.ndarray]], active: list[int], at: np.ndarray, rank: np.ndarray) -> None:
        known = rank < _FAR
        at, rank = at[known], rank[known]
        if not len(at):
            return
        by = np.argsort(rank, kind="stable")
        at, rank = at[by], rank[by]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(active, r)

    def encode_pieces(self, words: list[bytes | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and the words' offsets in them. An int stands for an added token."""
        raw = [b"\0" if isinstance(w, int) else w for w in words]
        body = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(w) for w in raw])
        n = len(body)
        sym = np.append(self.byte_id[body], np.int32(-1))
        for i in [i for i, w in enumerate(words) if isinstance(w, int)]:
            sym[ends[i] - 1] = words[i]
        nxt = np.arange(1, n + 2, dtype=np.int32)
        nxt[ends - 1] = n
        prv = np.arange(-1, n, dtype=np.int32)
        prv[ends - np.array([len(w) for w in raw])] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []
        at = np.flatnonzero(nxt[:n] != n).astype(np.int32)
        first = self.ranks(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256))
        self._register(index, active, at, first[body[at].astype(np.int32) * 256 + body[at + 1]])
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            pos = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, c = self.left[r], self.right[r], self.made[r]
            pos = pos[(sym[pos] == a) & (sym[nxt[pos]] == b)]
            if a == b and len(pos) > 1:  # of a run of equal symbols every second pair merges
                pos = np.unique(pos)
                fresh = np.append(True, nxt[pos[:-1]] != pos[1:])
                k = np.arange(len(pos))
                pos = pos[(k - np.maximum.accumulate(np.where(fresh, k, 0))) % 2 == 0]
            if not len(pos):
                continue
            gone = nxt[pos]
            after = nxt[gone]
            sym[pos] = c
            sym[gone] = -2
            nxt[pos] = after
            prv[after] = pos
            before = prv[pos]
            before = before[before != n]
            near = np.concatenate([pos[after != n], before[sym[before] != c]])
            if len(near):
                self._register(index, active, near, self.ranks(sym[near], sym[nxt[near]]))
        alive = sym[:n] >= 0
        total = np.concatenate([[0], np.cumsum(alive)])
        return sym[:n][alive], total[np.concatenate([[0], ends]).astype(np.int64)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the texts' offsets in them."""
        runs: list[str] = []  # texts, cut at added tokens
        owner: list[int] = []
        special: list[int] = []  # the added token's id, or -1
        for i, text in enumerate(texts):
            for k, part in enumerate(self.cut.split(text) if self.cut and self.cut.search(text) else (text,)):
                if part:
                    runs.append(part)
                    owner.append(i)
                    special.append(self.added[part] if k % 2 else -1)
        codes, starts, ends, run_of = [], [], [], []
        i = done = 0
        while i < len(runs):
            j, size = i, 0
            while j < len(runs) and (j == i or size + len(runs[j]) <= SPLIT):
                size += len(runs[j])
                j += 1
            code = np.frombuffer("".join(runs[i:j]).encode("utf-32-le"), np.uint32)
            s, e, r = pre_tokens(code, np.array([len(x) for x in runs[i:j]]), np.array(special[i:j]))
            for held, value in ((codes, code), (starts, s + done), (ends, e + done), (run_of, r + i)):
                held.append(value)
            done += len(code)
            i = j
        if not codes:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        code, start, end, run = (np.concatenate(x) for x in (codes, starts, ends, run_of))
        # an added token's string never stands in another run, so that equal symbols are of one sort
        first, use = distinct_spans(code, start, end, span_hashes(code, start, end, code_values))
        where = zip(start[first].tolist(), end[first].tolist(), run[first].tolist(), strict=True)
        words = [special[r] if special[r] >= 0 else code[s:e].tobytes().decode("utf-32-le").encode() for s, e, r in where]
        ids, at = self.encode_pieces(words)
        size = np.diff(at)[use]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = ids[np.repeat(at[:-1][use] - upto[:-1], size) + np.arange(upto[-1])]
        of_text = np.array(owner)[run]
        return out, upto[np.searchsorted(of_text, np.arange(len(texts) + 1), "left")]

    def decode(self, ids: list[int]) -> str:
        of = self.bytes_of
        if ids and not 0 <= min(ids) <= max(ids) < len(of):
            ids = [i for i in ids if 0 <= i < len(of)]
        return b"".join(map(of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> BytePairEncoder:
    return BytePairEncoder(path)


def with_column(df: DataFrame, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    """The columns to keep and the schema with one more; a column of that name gives way."""
    kept = [f for f in df.schema.fields if f.name.lower() != name.lower()]
    return [f.name for f in kept], T.StructType([*kept, T.StructField(name, kind)])


def bpe_encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """Every row with ids_col, an array of the token ids of its whole text.

    Encodes as the tokenizer in the file does without special tokens added; an added token's own
    string in a text gives that token. A null or empty text gives an empty array. Rows are kept as
    they are, repeated ones too; a column already named ids_col gives way. No shuffle.

    With decoded_col, the string that the ids stand for is a further column, decoded by the same
    worker: one Python process a task instead of the two that bpe_decode after bpe_encode takes.
    """
    small_batches(df.sparkSession)
    kept, schema = with_column(df, ids_col, T.ArrayType(T.IntegerType()))
    if decoded_col:
        kept = [c for c in kept if c.lower() != decoded_col.lower()]
        schema = T.StructType([*(f for f in schema.fields if f.name.lower() != decoded_col.lower()), T.StructField(decoded_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for i, j in pieces(texts, PART):
                ids, at = model.encode([t or "" for t in texts.slice(i, j - i).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                part = batch.slice(i, j - i)
                made = [lists]
                if decoded_col:
                    made.append(pa.array([model.decode(ids[a:b].tolist()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), *made], schema.names)

    return df.mapInArrow(sparing(run), schema)


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Every row with text_col, the string that its ids stand for; broken UTF-8 becomes U+FFFD.

    Null ids give null, unknown ids and null members nothing. A column already named text_col gives way.
    """
    small_batches(df.sparkSession)
    kept, schema = with_column(df, text_col, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                lists = part.column(part.schema.get_field_index(ids_col))
                at = lists.offsets.to_numpy().tolist()
                flat = lists.values.slice(at[0], at[-1] - at[0]).fill_null(-1).to_numpy().tolist()
                there = lists.is_valid().to_pylist()
                texts = [model.decode(flat[at[k] - at[0] : at[k + 1] - at[0]]) if there[k] else None for k in range(len(at) - 1)]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(texts, pa.string())], [*kept, text_col])

    return df.mapInArrow(sparing(run), schema)


def bpe_digests(df: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (keep..., n_tokens, ids_sha256, decoded_sha256): digests of each row's ids and of the text they decode to.

    For checking a round trip without carrying the texts on. ids are hashed as little-endian unsigned
    32-bit integers, the text as UTF-8; null ids count as none. A kept column named like one of the
    results gives way to it; an empty table gives no rows.
    """
    small_batches(df.sparkSession)
    keep = tuple(c for c in keep if c.lower() not in ("n_tokens", "ids_sha256", "decoded_sha256"))
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            lists = batch.column(len(keep)).fill_null([]) if batch.column(len(keep)).null_count else batch.column(len(keep))
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            coded = [flat[at[i] : at[i + 1]] for i in range(len(lists))]
            columns = [pa.array(np.diff(at), pa.int64()), pa.array([sha(c.tobytes()) for c in coded], pa.string()), pa.array([sha(model.decode(c.tolist()).encode()) for c in coded], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *columns], schema.names)

    return df.select(*keep, ids_col).mapInArrow(sparing(run), schema)
