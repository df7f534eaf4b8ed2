"""Cross-tokenizer alignment: an inverted index from pairs of token ids to compressed bitmaps of documents, with planes for multiplicities."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .bpe import BytePairEncoder
from .runtime import durable, small_batches
from .words import pieces

#: Bytes of text that are aligned and that are encoded by A at once, and postings that a task holds before it writes their bitmaps.
PART = 1 << 20
ENCODED = 6 << 20
POSTINGS = 2 << 20
#: Documents of one bitmap, members from which on it is written as bits, and bytes of it then.
CHUNK = 1 << 16
DENSE = 4096
BITS = CHUNK // 8
#: A table of at most so many pairs (of 17 bytes each) is broadcast; a larger one is joined by pair and a salt.
FEW_PAIRS = 1 << 20
SALTS = 16
#: Chunks whose scores a task holds (1 MB each).
OPEN = 64
DOC = "uid long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class TokenPair:
    """Two tokenizers and their tokens' bytes: byte-level BPE of a space and the text, and a piece model that adds the space itself."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = BytePairEncoder(path_a)
        self.a.cut = None  # strings of added tokens are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        piece = self.b.id_to_piece
        self.bytes_b = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.n_a, self.n_b = len(self.a.bytes_of), len(self.bytes_b)
        if self.n_a * self.n_b >= 1 << 47:
            raise ValueError("the vocabularies have too many pairs for 47 bits")
        self.size_a, self.size_b = (np.array([len(x) for x in of], np.int64) for of in (self.a.bytes_of, self.bytes_b))
        # each id's decimal digits with the sign that follows it: within a group, or at the end of its side
        self.names = [f"{i}{sign}".encode() for n, last in ((self.n_a, "|"), (self.n_b, ";")) for i in range(n) for sign in (",", last)]

    def encode_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all texts, and the texts' offsets in them. A's bytes are always those of the space and the text."""
        return self.a.encode([" " + t if t else "" for t in texts])

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """B's ids of each text, none for texts that are empty or whose bytes B changes."""
        some = [i for i, t in enumerate(texts) if t]
        out: list[list[int]] = [[] for _ in texts]
        given = [texts[i] for i in some]
        of = self.bytes_b.__getitem__
        for i, text, ids in zip(some, given, self.b.encode(given, num_threads=1) if given else [], strict=True):
            if b"".join(map(of, ids)) == b" " + text.encode():
                out[i] = ids
        return out


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> TokenPair:
    return TokenPair(path_a, path_b)


def align_texts(model: TokenPair, texts: list[str], a: np.ndarray, at_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, n_links, digests of groups, links' texts, links' pairs) of a few texts and A's ids of them.

    The ends of A's and B's tokens, merged, cut the bytes into stretches of one A and one B token each:
    these are the links. Ends that both have close a group. Each end is a mark at its byte, so that
    counts of marks give every stretch its tokens.
    """
    ids = model.encode_b(texts)
    n_b = np.array([len(x) for x in ids], np.int64)
    n_a = np.where(n_b > 0, np.diff(at_a), 0)
    a = a[np.repeat(n_b > 0, np.diff(at_a))].astype(np.int64)
    b = np.fromiter(chain.from_iterable(ids), np.int64, int(n_b.sum()))
    end_a, end_b = np.cumsum(model.size_a[a]), np.cumsum(model.size_b[b])
    mark_a, mark_b = (np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, bool) for _ in "ab")
    mark_a[end_a] = True
    mark_b[end_b] = True
    last_a, last_b = mark_b[end_a], mark_a[end_b]
    cuts = np.flatnonzero(mark_a | mark_b)
    in_a, in_b = mark_a[cuts], mark_b[cuts]
    of_a, of_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # a token's place in its text's list: behind the other side's tokens of the groups before it, or of its own group too
    upto_a, upto_b = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (last_a, last_b))
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + upto_b[group_a]] = 2 * a + last_a
    order[np.arange(len(b)) + upto_a[group_b + 1]] = 2 * (model.n_a + b) + last_b
    at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    names = model.names.__getitem__
    digests = [hashlib.sha256(b"".join(map(names, order[i:j].tolist()))[:-1]).hexdigest() if j > i else "" for i, j in zip(at[:-1], at[1:], strict=True)]
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    link_doc = doc_a[of_a]
    count = lambda docs: np.bincount(docs, minlength=len(texts))
    return n_a, n_b, count(doc_a[last_a]), count(link_doc), digests, link_doc, a[of_a] * model.n_b + b[of_b]


def bitmaps(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(pairs, planes) of postings: key pair << 16 | document, each once, and how often the document has the pair.

    Plane k of a pair is the bitmap of documents whose multiplicity has bit k: as 16-bit numbers in
    rising order, or as 65,536 bits where it has DENSE members or more.
    """
    by = np.argsort(key)
    key, times = key[by], times[by]
    pairs, first, row = np.unique(key >> 16, return_index=True, return_inverse=True)
    row = row.reshape(-1)
    depth = np.frexp(np.maximum.reduceat(times, first).astype(float))[1].astype(np.int64) if len(key) else np.zeros(0, np.int64)
    start = np.concatenate([[0], np.cumsum(depth)])
    slots, members = [], []
    for k in range(int(depth.max(initial=0))):
        with_bit = np.flatnonzero(times >> k & 1)
        slots.append(start[row[with_bit]] + k)
        members.append(key[with_bit] & 0xFFFF)
    slot = np.concatenate(slots) if slots else np.zeros(0, np.int64)
    member = np.concatenate(members).astype("<u2") if slots else np.zeros(0, "<u2")
    by = np.argsort(slot, kind="stable")
    member = member[by]
    size = np.bincount(slot, minlength=start[-1])
    at = np.concatenate([[0], np.cumsum(size)])
    data, done = [], 0
    for s in np.flatnonzero(size >= DENSE).tolist():
        bits = np.zeros(CHUNK, np.uint8)
        bits[member[at[s] : at[s + 1]]] = 1
        data += [member[done : at[s]].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
        done = at[s + 1]
    data.append(member[done:].tobytes())
    where = np.concatenate([[0], np.cumsum(np.where(size >= DENSE, BITS, 2 * size))])
    planes = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(where.astype(np.int32).tobytes()), pa.py_buffer(b"".join(data))])
    return pairs, pa.ListArray.from_arrays(pa.array(start, pa.int32()), planes)


def members(planes: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, plane, document) of all members of a column of planes, in some steps of bounded size."""
    at = planes.offsets.to_numpy().astype(np.int64)
    flat = planes.values.slice(at[0], at[-1] - at[0])
    at = at - at[0]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    plane = np.arange(len(row)) - at[row]
    raw, where = flat.buffers()[2], np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    body = np.frombuffer(raw, np.uint8) if raw is not None and len(flat) else np.zeros(0, np.uint8)
    size = np.diff(where)
    i = 0
    while i < len(row):
        j = max(i + 1, int(np.searchsorted(where, where[i] + (4 << 20), "right")) - 1)
        part, dense = body[where[i] : where[j]], size[i:j] == BITS
        listed = np.repeat(~dense, size[i:j])
        yield np.repeat(row[i:j], np.where(dense, 0, size[i:j] // 2)), np.repeat(plane[i:j], np.where(dense, 0, size[i:j] // 2)), part[listed].view("<u2").astype(np.int64)
        for s in (i + np.flatnonzero(dense)).tolist():
            docs = np.flatnonzero(np.unpackbits(body[where[s] : where[s] + BITS], bitorder="little"))
            yield np.full(len(docs), row[s]), np.full(len(docs), plane[s]), docs
        i = j


def _steps(texts: pa.Array, nth: int) -> Iterator[tuple[int, int]]:
    """Ranges of about PART bytes that don't cross chunks, the first text being the task's nth."""
    for i, j in pieces(texts, PART):
        while i < j:
            end = min(j, i + CHUNK - (nth + i) % CHUNK)
            yield i, end
            i = end


def _index(docs: DataFrame, path_a: str, path_b: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Rows of documents (doc) and of bitmaps (part): one pass over the texts, nothing moved."""
    kept = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    doc_type = T.StructType([*T.StructType.fromDDL(DOC).fields, *kept])
    part_type = T.StructType.fromDDL("chunk long, pair long, planes array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path_a, path_b)
        arrow_doc = to_arrow_schema(T.StructType([T.StructField("doc", doc_type)])).field(0).type
        base = TaskContext.get().partitionId() << 40
        nth, open_chunk, n_held = 0, base >> 16, 0
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                pairs, planes = bitmaps(np.concatenate(keys), np.concatenate(times))
                keys.clear()
                times.clear()
                for i in range(0, len(pairs), 20000):
                    some = pairs[i : i + 20000]
                    part = pa.StructArray.from_arrays([pa.array(np.full(len(some), open_chunk)), pa.array(some), planes.slice(i, 20000)], ["chunk", "pair", "planes"])
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(some), arrow_doc), part], ["doc", "part"])

        for batch in batches:
            texts = batch.column(0)
            for lo, hi in pieces(texts, ENCODED):
                some = [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]
                ids, at = model.encode_a(some)
                for i, end in _steps(texts.slice(lo, hi - lo), nth):
                    uid = base + nth + np.arange(end - i)
                    n_a, n_b, n_groups, n_links, digests, link_doc, pair = align_texts(model, some[i:end], ids[at[i] : at[end]], at[i : end + 1] - at[i])
                    doc = pa.StructArray.from_arrays(
                        [pa.array(uid), pa.array(n_a), pa.array(n_b), pa.array(n_groups, pa.int64()), pa.array(n_links, pa.int64()), pa.array(digests, pa.string()), *(batch.column(1 + k).slice(lo + i, end - i) for k in range(len(kept)))],
                        [f.name for f in doc_type.fields],
                    )
                    part = pa.nulls(len(doc), pa.struct([("chunk", pa.int64()), ("pair", pa.int64()), ("planes", pa.list_(pa.binary()))]))
                    yield pa.RecordBatch.from_arrays([doc, part], ["doc", "part"])
                    if int(uid[0]) >> 16 != open_chunk or n_held >= POSTINGS:
                        yield from flush()
                        open_chunk, n_held = int(uid[0]) >> 16, 0
                    key, count = np.unique(pair << 16 | (uid[link_doc] & 0xFFFF), return_counts=True)
                    keys.append(key)
                    times.append(count)
                    n_held += len(key)
                    nth += end - i
        yield from flush()

    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc", doc_type), T.StructField("part", part_type)])
    return docs.select(text_col, *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep))).mapInArrow(run, schema)


def _popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n_docs, n_links) of each bitmap: members of all planes together, and of each plane times its worth."""
    for batch in batches:
        links = np.zeros(batch.num_rows, np.int64)
        seen = []
        for row, plane, doc in members(batch.column(1)):
            np.add.at(links, row, np.int64(1) << plane)
            seen.append(row << 16 | doc)
        docs = np.bincount(np.unique(np.concatenate(seen)) >> 16, minlength=batch.num_rows) if seen else links
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(docs, pa.int64()), pa.array(links)], ["pair", "n_docs", "n_links"])


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, n_best, count_sum): what the postings of (chunk, planes, n_links, best) bring to their documents, summed by chunk."""
    open_: dict[int, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for chunk, table in open_.items():
            docs = np.flatnonzero(table[1])
            for i in range(0, len(docs), 10000):
                some = docs[i : i + 10000]
                yield pa.RecordBatch.from_arrays([pa.array(chunk << 16 | some), pa.array(table[0][some]), pa.array(table[1][some])], ["uid", "n_best", "count_sum"])
        open_.clear()

    for batch in batches:
        chunk, links, best = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3))
        for row, plane, doc in members(batch.column(1)):
            for c in np.unique(chunk[row]).tolist():
                if c not in open_ and len(open_) >= OPEN:
                    yield from flush()
                table = open_.setdefault(c, np.zeros((2, CHUNK), np.int64))
                here = chunk[row] == c
                times = np.int64(1) << plane[here]
                np.add.at(table[0], doc[here], times * best[row[here]])
                np.add.at(table[1], doc[here], times * links[row[here]])
    yield from flush()


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): how the tokens of two tokenizers lie over each other in every whole text.

    A (a byte-level BPE file, encoded by BytePairEncoder) encodes a space and the text, B (a sentencepiece
    model that adds the space) the text, both without special tokens, whose strings count as plain
    text. An A and a B token are linked where their bytes overlap; bytes at which tokens of both end cut
    the text into groups.

    documents: keep..., n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair is the most linked
    one of its B id in the corpus, ties included), count_sum (of each link, how often its pair is linked
    in the corpus), groups_sha256 (of the groups written as a1,a2|b1;a3|b2). Texts that are null or
    empty, or whose bytes one tokenizer changes, have no tokens: zeros and ''. Repeated rows are
    documents of their own and count as such. An empty table gives no rows. Kept columns named like
    results give way.

    pairs: a, b, n_docs (documents that link them), n_links, best (most linked of its b).

    Each task turns the links of its documents into an inverted index: for each pair and each 65,536
    documents, compressed bitmaps, one plane for each bit of the multiplicity. Bitmaps of batches are
    merged in the task; popcounts of the planes' union and of each plane give the counts, which are
    summed by pair (with partial sums, so that a pair of every document is one row a task). The bitmaps
    stay where they were made: the pairs' counts are broadcast to them, or joined by pair and salt if
    there are more than FEW_PAIRS, and the postings give each document its sums. Texts are read once.
    """
    gone = {f.name for f in T.StructType.fromDDL(DOC).fields} | {"n_best", "count_sum"}
    keep = tuple(c for c in keep if c.lower() not in gone)
    rows = durable(_index(docs, path_a, path_b, text_col, keep))
    n_b = _pieces(path_b)
    parts = rows.where("part is not null").select("part.*")
    counts = parts.select("pair", "planes").mapInArrow(_popcounts, "pair long, n_docs long, n_links long").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    b = F.expr(f"pair % {n_b}")
    most = F.max("n_links").over(Window.partitionBy("b"))  # at most as many rows as A has tokens
    counts = durable(counts.withColumn("b", b).withColumn("best", F.col("n_links") == most))
    scored = counts.select("pair", "n_links", F.col("best").cast("long").alias("best"))
    if scored.count() <= FEW_PAIRS:
        joined = parts.join(F.broadcast(scored), "pair")
    else:
        salted = scored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = parts.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(SALTS)).cast("int")).join(salted, ["pair", "salt"])
    sums = joined.select("chunk", "planes", "n_links", "best").mapInArrow(_scores, "uid long, n_best long, count_sum long")
    sums = sums.groupBy(F.col("uid").alias("of")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    found = rows.where("doc is not null").select("doc.*").join(sums, F.col("uid") == F.col("of"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    documents = found.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
    pairs = counts.select(F.expr(f"pair div {n_b}").alias("a"), "b", "n_docs", "n_links", "best")
    return documents, pairs


@lru_cache(maxsize=4)
def _pieces(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
