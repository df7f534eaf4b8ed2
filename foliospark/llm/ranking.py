"""Ranked lexical search by norm buckets: impact vectors in order of length, pruned by Cauchy-Schwarz and by coordinates, survivors scored in integers."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import durable, small_batches
from .words import ALPHANUMERIC, EXACT, differing, pieces, small_letters, text_bytes, word_hashes, word_spans

#: Bytes of the queries that are searched together (each counts ITEM bytes besides its text); more of them are further blocks.
BLOCK = 16 << 20
ITEM = 1 << 10
#: Bytes of text whose terms are found at once.
PART = 6 << 20
#: Shares of the documents, longest impact vectors first, after which the queries' bars are raised for all tasks.
SHARES = (1 / 32, 1 / 4)
#: Documents held, documents and postings of a bucket, and cells of a table of queries by documents.
HELD, BUCKET, POSTINGS, CELLS = 8192, 1024, 1 << 19, 1 << 21
#: Rounding of sums in double precision, far above what it can be.
SLACK = 1e-9
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(_TERM.findall((t or "").encode().lower())) for t in batch.column(1).to_pylist()]
        size = pa.array([ITEM + sum(map(len, c)) for c in counts], pa.int64())
        terms = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), size, terms, pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], ["item", "bytes", "terms", "tf"])


class Vocabulary:
    """Distinct terms, found by hash and told apart by their bytes."""

    def __init__(self, terms: list[bytes]):
        self.of = {t: i for i, t in enumerate(terms)}
        self.body = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.hashes, self.first = np.unique(word_hashes(self.body, self.starts, self.ends, EXACT), return_index=True)

    def find(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each word's number, -1 for words that aren't terms."""
        if not len(self.hashes) or not len(starts):
            return np.full(len(starts), -1, np.int64)
        hashes = word_hashes(body, starts, ends, EXACT)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = np.flatnonzero(self.hashes[at] == hashes)
        term = self.first[at[known]]
        n = len(known)
        # the words, then the terms that they may be, as spans of one array
        s = np.concatenate([starts[known], self.starts[term] + len(body)])
        e = np.concatenate([ends[known], self.ends[term] + len(body)])
        other = np.concatenate([np.arange(n, 2 * n), np.arange(n, 2 * n)])
        wrong = np.flatnonzero(differing(np.concatenate([body, self.body]), s, e, other)[:n])
        for k in wrong.tolist():
            i = known[k]
            term[k] = self.of.get(body[starts[i] : ends[i]].tobytes(), -1)
        out = np.full(len(starts), -1, np.int64)
        out[known] = term
        return out


class Queries:
    """A block of queries as sparse vectors over one vocabulary, terms of a query by falling weight."""

    def __init__(self, rows: list, weight: np.ndarray, of: dict[bytes, int]):
        n = [len(r.terms) for r in rows]
        query = np.repeat(np.arange(len(rows)), n)
        term = np.array([of[bytes(t)] for r in rows for t in r.terms], np.int64)
        tf = np.array([c for r in rows for c in r.tf], np.int64)
        there = weight[term] > 0 if len(term) else np.zeros(0, bool)
        query, term, tf = query[there], term[there], tf[there]
        value = tf * np.sqrt(weight[term])
        by = np.lexsort((-value, query))
        self.query, self.term, self.tf, self.value = query[by], term[by], tf[by], value[by]
        self.at = np.searchsorted(self.query, np.arange(len(rows) + 1))
        upto = np.concatenate([[0], np.cumsum(self.tf**2 * weight[self.term])])
        self.rest = np.sqrt(upto[self.at[self.query + 1]] - upto[:-1]) * (1 + SLACK)  # length of what is left from each coordinate on
        self.n = len(rows)


def _expand(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers at[i] .. at[i] + size[i] - 1, one run after another."""
    upto = np.cumsum(size)
    return np.repeat(at - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)


class Ranking:
    """The best documents so far of every query of a block, in one task."""

    def __init__(self, queries: Queries, weight: np.ndarray, most: int, bar: np.ndarray):
        self.q, self.weight, self.most = queries, weight, most
        self.root = np.sqrt(weight)
        self.bar = np.maximum(bar, 1)
        none = np.zeros(0, np.int64)
        self.best = [none, none, none, none.astype(bool)]  # query, score, id, id is null

    def bucket(self, ids: np.ndarray, null: np.ndarray, at: np.ndarray, term: np.ndarray, impact: np.ndarray, norm: np.ndarray) -> None:
        """Take in a bucket of documents: their ids, and impact vectors over the vocabulary."""
        q, longest, n = self.q, float(norm.max()) * (1 + SLACK), len(ids)
        doc = np.repeat(np.arange(n), np.diff(at))
        value = self.root[term] * impact
        key = doc * len(self.weight) + term  # rising: the terms of a document are in order
        by = np.argsort(term, kind="stable")
        post_at = np.searchsorted(term[by], np.arange(len(self.weight) + 1))
        # a query needs a document with one of its first coordinates: by Cauchy-Schwarz the others are not enough
        use = np.flatnonzero(q.rest * longest >= self.bar[q.query])
        size = np.diff(post_at)[q.term[use]]
        first = np.searchsorted(q.query[use], np.arange(q.n + 1))
        work = np.concatenate([[0], np.cumsum(size)])[first]
        some = np.flatnonzero(np.diff(work))
        i = 0
        while i < len(some):
            room = int(np.searchsorted(work[some + 1], work[some[i]] + CELLS, "right"))
            j = max(i + 1, min(room, i + max(1, CELLS // n)))
            self._score(some[i:j], use, first, size, post_at, by, doc, value, norm, key, impact, ids, null)
            i = j

    def _score(self, some, use, first, size, post_at, by, doc, value, norm, key, impact, ids, null) -> None:
        q, n = self.q, len(ids)
        lo, hi = first[some], first[some + 1]
        mine = _expand(lo, hi - lo)
        row = np.repeat(np.arange(len(some)), hi - lo)
        coordinate, many = use[mine], size[mine]
        posting = by[_expand(post_at[q.term[coordinate]], many)]
        cell = np.repeat(row * n, many) + doc[posting]
        held = value[posting]
        lower = np.bincount(cell, np.repeat(q.value[coordinate], many) * held, len(some) * n).reshape(len(some), n)
        seen = np.bincount(cell, held * held, len(some) * n).reshape(len(some), n)
        after = q.at[some] + (hi - lo)  # the first coordinate that wasn't looked at
        left = np.where(after < q.at[some + 1], q.rest[np.minimum(after, len(q.rest) - 1)], 0.0)
        upper = lower + left[:, None] * np.sqrt(np.maximum(norm**2 - seen, 0) + SLACK * norm**2)
        bar = self.bar[some].astype(float)
        if n > self.most:  # what is surely reached raises the bar at once
            bar = np.maximum(bar, np.partition(lower, n - self.most, axis=1)[:, n - self.most] * (1 - SLACK))
        r, d = np.nonzero((upper * (1 + SLACK) >= bar[:, None]) & (lower > 0))
        step = max(1, CELLS // max(1, int(np.diff(q.at)[some].max())))
        for i in range(0, len(r), step):
            self._exact(some[r[i : i + step]], d[i : i + step], key, impact, ids, null)

    def _exact(self, query, d, key, impact, ids, null) -> None:
        q = self.q
        many = np.diff(q.at)[query]
        c = _expand(q.at[query], many)
        wanted = np.repeat(d, many) * len(self.weight) + q.term[c]
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        part = np.where(key[at] == wanted, q.tf[c] * self.weight[q.term[c]] * impact[at], 0)
        score = np.add.reduceat(part, np.cumsum(many) - many)
        good = score >= self.bar[query]
        best = [np.concatenate(x) for x in zip(self.best, (query[good], score[good], ids[d[good]], null[d[good]]), strict=True)]
        by = np.lexsort((best[2], best[3], -best[1], best[0]))
        best = [x[by] for x in best]
        nth = np.arange(len(by)) - np.searchsorted(best[0], best[0])
        last = nth == self.most - 1
        np.maximum.at(self.bar, best[0][last], best[1][last])
        self.best = [x[nth < self.most] for x in best]


def _find_terms(vocabulary, docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Rows (doc_id, n, terms, tf): each document's number of terms, and those of the vocabulary in rising order with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary.value
        for batch in batches:
            for i, j in pieces(batch.column(1), PART):
                body, at = text_bytes(batch.column(1).slice(i, j - i))
                body = small_letters(body)
                starts, ends, word_at = word_spans(body, at, ALPHANUMERIC)
                term = vocab.find(body, starts, ends)
                row = np.repeat(np.arange(j - i), np.diff(word_at))
                known = term >= 0
                pairs, tf = np.unique(row[known] * (len(vocab.of) + 1) + term[known], return_counts=True)
                where = pa.array(np.searchsorted(pairs // (len(vocab.of) + 1), np.arange(j - i + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(where, pa.array(x, pa.int32())) for x in (pairs % (len(vocab.of) + 1), tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(word_at), pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column(batch.schema.get_field_index(name))
    at = lists.offsets.to_numpy().astype(np.int64)
    return at - at[0], lists.values.slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False).astype(np.int64)


def _impacts(batch: pa.RecordBatch, weight: np.ndarray, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, terms, impacts, lengths) of a batch's vectors; terms of no weight have no impact."""
    at, term = _lists(batch, "terms")
    _, tf = _lists(batch, "tf")
    n = batch.column(batch.schema.get_field_index("n")).to_numpy()
    m = np.repeat(75 + (25 * n * n_docs) // max(1, n_terms), np.diff(at))
    impact = np.where(weight[term] > 0, (1_000_000_000 * tf) // (1000 * tf + 12 * m), 0) if len(term) else tf
    squares = np.zeros(len(n))
    some = np.flatnonzero(np.diff(at))
    if len(some):
        squares[some] = np.add.reduceat(weight[term] * impact.astype(float) ** 2, at[some])
    return at, term, impact, np.sqrt(squares) * (1 + SLACK)


def _best(rows: DataFrame, most: int) -> DataFrame:
    """The `most` best rows of each query with their rank; of each 64th part first, so that no task gets all candidates of a query."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["query", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["query"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)
    return rows


def _search_block(docs: DataFrame, items: DataFrame, size: tuple[int, int] | None, most: int, text_col: str, id_col: str) -> tuple[DataFrame, tuple[int, int]]:
    """Ranks of one block of queries, and the numbers of documents and terms of the corpus."""
    spark = docs.sparkSession
    rows = items.collect()  # one block: BLOCK bytes at most, or one query
    vocab = Vocabulary(sorted({bytes(t) for r in rows for t in r.terms}))
    vectors = durable(_find_terms(spark.sparkContext.broadcast(vocab), docs, text_col, id_col))
    if size is None:
        one = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        size = one.docs, one.terms
    n_docs, n_terms = size
    n_vocab = len(vocab.of)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            df = np.bincount(_lists(batch, "terms")[1], minlength=1)
            term = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df[term], pa.int64())], ["term", "df"])

    vectors = vectors.where(F.size("terms") > 0)
    weight = np.zeros(n_vocab + 1, np.int64)
    for r in vectors.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row a term of the block
        weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
    queries = Queries(rows, weight, vocab.of)
    shared = spark.sparkContext.broadcast((queries, weight))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_impacts(batch, shared.value[1], n_docs, n_terms)[3], pa.float64())], ["norm"])

    cuts = vectors.mapInArrow(lengths, "norm double").where("norm > 0").approxQuantile("norm", [1 - s for s in SHARES], 0.01)
    found, bars = None, np.ones(queries.n, np.int64)
    for most_norm, least_norm in zip([math.inf, *cuts], [*cuts, 0.0], strict=True):
        ranked = vectors.mapInArrow(_ranker(shared, spark.sparkContext.broadcast(bars), least_norm, most_norm, n_docs, n_terms, most), "query int, score long, doc_id long")
        found = durable(_best(ranked if found is None else ranked.unionByName(found.drop("rank")), most))
        bars = np.ones(queries.n, np.int64)
        for r in found.where(F.col("rank") == most).select("query", "score").collect():  # a number a query of the block
            bars[r.query] = r.score
    kind = items.schema["item"].dataType
    names = spark.createDataFrame([(k, r["item"]) for k, r in enumerate(rows)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item", kind)]))
    return found.join(F.broadcast(names), "query"), size


def _ranker(shared, bars, least_norm: float, most_norm: float, n_docs: int, n_terms: int, most: int):
    """A task over vectors whose lengths lie in [least_norm, most_norm): its best documents of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = shared.value
        ranking = Ranking(queries, weight, most, bars.value)
        held: list[tuple] = []

        def flush() -> None:
            if not held:
                return
            ids, null, many, term, impact, norm = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            by = np.argsort(-norm, kind="stable")
            at = np.cumsum(many) - many
            upto = np.cumsum(many[by])
            i, width = 0, 64
            while i < len(by):  # buckets of falling length; the first are small, as they raise the bars
                done = int(upto[i - 1]) if i else 0
                j = max(i + 1, min(i + width, int(np.searchsorted(upto, done + POSTINGS, "right"))))
                rows = by[i:j]
                place = _expand(at[rows], many[rows])
                ranking.bucket(ids[rows], null[rows], np.concatenate([[0], np.cumsum(many[rows])]), term[place], impact[place], norm[rows])
                i, width = j, min(BUCKET, 2 * width)

        n_held = n_postings = 0
        for batch in batches:
            at, term, impact, norm = _impacts(batch, weight, n_docs, n_terms)
            rows = np.flatnonzero((norm >= least_norm) & (norm < most_norm) & (norm > 0))
            if not len(rows):
                continue
            place = _expand(at[rows], np.diff(at)[rows])
            place = place[impact[place] > 0]
            row = np.searchsorted(at, place, "right") - 1
            many = np.bincount(row, minlength=len(norm))[rows]
            column = batch.column(batch.schema.get_field_index("doc_id"))
            null = column.is_null().to_numpy(zero_copy_only=False)
            held.append((column.fill_null(0).to_numpy()[rows], null[rows], many, term[place], impact[place], norm[rows]))
            n_held, n_postings = n_held + len(rows), n_postings + len(place)
            if n_held >= HELD or n_postings >= 8 * POSTINGS:
                flush()
                n_held = n_postings = 0
        flush()
        query, score, ids, null = ranking.best
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.int64(), mask=null)], ["query", "score", "doc_id"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, most: int = 20, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """Rows (item_col, rank, id_col, score): the `most` best documents of each item's text, scores above 0.

    Terms are runs of digits, ASCII letters (capital and small alike) and characters beyond ASCII. A
    document's impact of a term is (10^9 tf) div (1000 tf + 12 m), m = 75 + (25 n N) div L; a score sums
    weight times impact over the item's terms, repeats included; equal scores rank by ascending id,
    which must be a whole number, null last.

    A document is a vector of impacts over the items' terms, an item one of occurrences, each times the
    root of the term's weight. Vectors are taken in order of length: the longest share of all documents
    first, which gives every item a bar (its last rank's score) for the next share. In a task, buckets
    of falling length are skipped by items whose length times the bucket's stays below their bar; of
    the others only documents with one of the item's heaviest coordinates can reach the bar, and the
    partial product over these and the length of what is left bound them once more. What survives is
    scored in 64-bit integers. So the result is exact; no document or item is left out.

    Items go to all tasks in blocks of BLOCK bytes (each pass over the documents searches one block), so
    that neither the broadcast nor the driver holds more than that, or one item. Documents' texts are
    read once a block; their vectors are written to the checkpoint folder and stay where they are.

    Repeated documents and items are rows of their own: an item that stands twice has its ranks twice.
    Null and empty texts have no terms. No items or no documents: no rows. Columns are taken by the
    names given; others are not looked at.
    """
    listed = items.select(F.col(item_col).alias("item"), F.col(text_col)).mapInArrow(_query_terms, T.StructType([T.StructField("item", items.schema[item_col].dataType), *T.StructType.fromDDL("bytes long, terms array<binary>, tf array<long>").fields]))
    at = F.monotonically_increasing_id()
    listed = durable(listed.withColumns({"part": F.shiftright(at, 33), "nth": at}))
    starts = listed.groupBy("part").agg(F.sum("bytes").alias("b"))
    starts = starts.select("part", F.coalesce(F.sum("b").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    within = F.sum("bytes").over(Window.partitionBy("part").orderBy("nth"))
    listed = durable(listed.withColumn("upto", within).join(F.broadcast(starts), "part").withColumn("block", F.floor((F.col("start") + F.col("upto") - 1) / BLOCK)))
    out, size = None, None
    for (block,) in listed.select("block").distinct().orderBy("block").collect():  # a number a block
        found, size = _search_block(docs, listed.where(F.col("block") == block).select("item", "terms", "tf"), size, most, text_col, id_col)
        found = found.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = items.sparkSession.createDataFrame([], T.StructType([T.StructField(item_col, items.schema[item_col].dataType), *T.StructType.fromDDL(f"rank int, {id_col} long, score long").fields]))
    return out
