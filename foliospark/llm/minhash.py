"""MinHash near-duplicates with an LSH forest.

Each tree of the forest sorts all documents by a MinHash signature of its own. Documents that follow
one another in a tree's order and share a prefix of enough signature values are candidates; where a
prefix is shared by a crowd, a longer one is asked for. Candidates only say which documents may
belong together (clusters); links are then decided on full shingle sets, each cluster in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import connected_components, durable, small_batches, sparing
from .words import BLANK_SEPARATED, exact_shingles, mix, normal_words, pieces, text_bytes

_U = np.uint64
#: Trees that decide how many values a prefix has at least; as many more are planted as the longest prefix asks for.
TREES = 24
#: The chance to miss a pair at the threshold by all trees, at most.
MISS = 5e-6
#: Rows that share a prefix before a longer one is asked for, and how many values longer it may get.
CROWD = 256
DEEPER = 2
#: Documents, and shingles of documents, of a cluster that are compared in one task at least; a larger cluster is dealt to blocks.
BLOCK, BLOCK_SHINGLES = 512, 500_000
#: Documents of a large cluster that every block of it is compared with, about so many.
HUBS = 32
_CARRY = 1 << 20


def prefix_depth(percent: int) -> int:
    """Longest prefix for which a pair at the threshold is missed by all trees with a chance of MISS at most."""
    depth = 1
    while (1 - (percent / 100) ** (depth + 1)) ** TREES <= MISS:
        depth += 1
    return depth


def tree_count(percent: int) -> int:
    """Fewest trees by which a pair at the threshold is missed with a chance of MISS at most where prefixes are longest."""
    trees = TREES
    while (1 - (percent / 100) ** (prefix_depth(percent) + DEEPER)) ** trees > MISS:
        trees += 1
    return trees


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, n + 1, dtype=np.uint64)
    return mix(k * _U(0xD1342543DE82EF95)) | _U(1), mix(k * _U(0xAF251AF3B0F025B5))


def signatures(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values of each set; every set has members."""
    a, b = _functions(n)
    out = np.empty((len(at) - 1, n), np.uint64)
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + (1 << 15), "right")) - 1)
        v, cuts = values[at[i] : at[j]], at[i:j] - at[i]
        held = np.empty_like(v)
        for k in range(n):
            np.multiply(v, a[k], out=held)
            np.add(held, b[k], out=held)
            out[i:j, k] = np.minimum.reduceat(held, cuts)
        i = j
    return out


def word_digests(body: np.ndarray, at: np.ndarray) -> list[bytes]:
    """A cryptographic digest of each row's words, small letters and single blanks between them."""
    raw, start, end, word_at = normal_words(body, at, BLANK_SEPARATED)
    spans = [(int(start[i]), int(end[j - 1])) if j > i else (0, 0) for i, j in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True)]
    return [hashlib.blake2b(raw[i:j], digest_size=16).digest() for i, j in spans]


_SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("lo", T.LongType()),
        T.StructField("forest", T.BinaryType()),
    ]
)


def _sign(n_words: int, depth: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in pieces(batch.column(1), 2 << 20):
                body, rows_at = text_bytes(batch.column(1).slice(i, j - i))
                _, values, at = exact_shingles(body, rows_at, BLANK_SEPARATED, n_words)
                size = np.diff(at)
                some = np.flatnonzero(size)
                forest = [b""] * len(size)
                if len(some):
                    cuts = at[some]
                    sig = signatures(values, np.append(cuts, at[-1]), trees * (depth + DEEPER)).reshape(len(some), trees, depth + DEEPER)
                    key = np.broadcast_to(mix(np.arange(trees, dtype=np.uint64) + _U(1)), (len(some), trees))
                    for k in range(depth):
                        key = mix(key * _U(0x9E3779B97F4A7C15) + sig[:, :, k])
                    rest = np.zeros_like(key)
                    for k in range(DEEPER):
                        rest = rest << _U(31) | mix(sig[:, :, depth + k]) >> _U(33)
                    both = np.stack([key, rest], axis=2).view(np.int64)
                    for r, cell in zip(some.tolist(), both, strict=True):
                        forest[r] = cell.tobytes()
                digest = np.frombuffer(b"".join(word_digests(body, rows_at)), np.int64).reshape(-1, 2)
                columns = [batch.column(0).slice(i, j - i), pa.array(size, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(forest, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, _SIGNED.names)

    return run


def _plant(trees: int):
    """(rep, forest) to a row for each tree: the prefix, the values below it and the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                cells = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64).reshape(-1, 2)
                ids = np.repeat(part.column(0).to_numpy(), trees)
                yield pa.RecordBatch.from_arrays([pa.array(cells[:, 0]), pa.array(cells[:, 1]), pa.array(ids)], ["key", "rest", "id"])

    return run


def _neighbours(key: np.ndarray, rest: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that follow one another and share a prefix as long as their region asks for."""
    region = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
    for level in range(DEEPER):
        crowded = np.bincount(region)[region] > CROWD
        if not crowded.any():
            break
        value = rest >> 31 * (DEEPER - 1 - level)
        apart = (region[1:] != region[:-1]) | crowded[1:] & (value[1:] != value[:-1])
        region = np.concatenate([[0], np.cumsum(apart)])
    near = np.flatnonzero((region[1:] == region[:-1]) & (ids[1:] != ids[:-1]))
    return ids[near], ids[near + 1]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by prefix; the last region of a batch waits for the next batch."""
    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        rows = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
        if not len(rows[0]):
            continue
        cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if len(rows[0]) - cut > _CARRY:
            cut = len(rows[0]) - 1
        a, b = _neighbours(*(r[: cut + 1] for r in rows)) if cut else (held[0][:0], held[0][:0])
        held = [r[cut:] for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])
    if len(held[0]):
        a, b = _neighbours(*held)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])


def spanning_links(values: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all pairs of sets with 100 * intersection >= percent * union, decided on the full sets.

    values: each set's members, as numbers. Intersections are counted through lists of the sets that
    hold a member; sets that are linked leave the lists whenever half of those in them have been.
    """
    size = np.diff(at)
    n = len(size)
    row = np.repeat(np.arange(n), size)
    by = np.argsort(values, kind="stable")
    held, holder = values[by], row[by]
    listed = n
    waiting = np.ones(n, bool)
    a, b = [], []
    for first in range(n):
        if not waiting[first]:
            continue
        waiting[first] = False
        queue = [first]
        while queue:
            left = int(waiting.sum())
            if not left:
                break
            if 2 * left < listed:
                keep = waiting[holder]
                held, holder, listed = held[keep], holder[keep], left
            s = queue.pop()
            own = values[at[s] : at[s + 1]]
            lo, hi = np.searchsorted(held, own, "left"), np.searchsorted(held, own, "right")
            k = hi - lo
            met = holder[np.repeat(lo - (np.cumsum(k) - k), k) + np.arange(k.sum())]
            shared = np.bincount(met, minlength=n)
            near = np.flatnonzero(waiting & (shared > 0))
            linked = near[100 * shared[near] >= percent * (size[near] + size[s] - shared[near])]
            waiting[linked] = False
            queue += linked.tolist()
            a += [s] * len(linked)
            b += linked.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _verify(n_words: int, percent: int):
    """(task, id, text) sorted by task to links."""

    def decide(ids: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
        which = np.concatenate([x.to_numpy() for x in ids])
        values, _, at = exact_shingles(*text_bytes(pa.concat_arrays(texts)), BLANK_SEPARATED, n_words)
        full = np.flatnonzero(np.diff(at))
        a, b = spanning_links(values, np.append(at[full], at[-1]), percent)
        return pa.RecordBatch.from_arrays([pa.array(which[full][a]), pa.array(which[full][b])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, texts = None, [], []
        for batch in batches:
            tasks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if task != tasks[i] and ids:
                    yield decide(ids, texts)
                    ids, texts = [], []
                task = tasks[i]
                ids.append(batch.column(1).slice(i, j - i))
                texts.append(batch.column(2).slice(i, j - i))
        if ids:
            yield decide(ids, texts)

    return run


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_shingles long, component_id, kept): documents linked by equal or similar texts.

    A document's set holds the distinct shingles of n_words words (capital ASCII letters count as
    small, words end at ASCII white space); with fewer words, the whole sequence is one shingle.
    Documents are linked if 100 * intersection >= percent * union. component_id is the smallest id
    reachable by links, the document's own included; kept says that it is the document's own.

    A null, empty or wordless text has no shingles and is linked with nothing. A row with a null id
    is linked with nothing and kept, its component_id null. Rows of equal id count as one document.
    An empty table gives no rows; columns other than the two named are not read.

    Equal sequences of words are represented by their smallest id before anything is compared. The
    forest only says which documents may be linked (clusters); each link is confirmed on the words of
    both texts. A cluster of more than BLOCK documents is dealt to blocks, each of which is compared
    in itself and with some HUBS documents of the cluster. Where that leaves a cluster in more than
    one component, the documents outside its largest component are compared with all others, block
    by block; pairs within one component need no comparison. No set, link or component goes to the driver.
    """
    small_batches(docs.sparkSession)
    depth, trees = prefix_depth(percent), tree_count(percent)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = durable(rows.mapInArrow(sparing(_sign(n_words, depth, trees)), _SIGNED))
    linkable = signed.where("doc_id is not null and n_shingles > 0")
    reps = linkable.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "n_shingles", "forest")).alias("r"))
    reps = durable(reps.select("hi", "lo", F.col("r.doc_id").alias("rep"), "r.n_shingles", F.col("r.forest").alias("forest")))

    forest = reps.select("rep", "forest").mapInArrow(sparing(_plant(trees)), "key long, rest long, id long")
    pairs = forest.repartition("key").sortWithinPartitions("key", "rest", "id").mapInArrow(sparing(_walk), "u long, v long")
    clusters = connected_components(pairs).withColumnRenamed("component", "cluster")
    clusters = durable(clusters.join(reps.select(F.col("rep").alias("id"), "n_shingles"), "id"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = durable(clusters.groupBy("cluster").agg(blocks.alias("blocks"), F.count("*").alias("documents")))
    members = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    # texts of clustered documents only, written once for both rounds
    known = durable(rows.withColumnRenamed("doc_id", "id").join(clusters.select("id"), "id").select("id", "text"))

    def confirmed(tasks: DataFrame) -> DataFrame:
        texts = known.join(tasks, "id").select("task", "id", "text")
        return durable(texts.repartition("task").sortWithinPartitions("task").mapInArrow(sparing(_verify(n_words, percent)), "u long, v long"))

    hub = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("id", F.lit(1)), F.ceil(F.col("documents") / HUBS)) == 0)
    visited = F.when(hub, F.expr("sequence(0, blocks - 1)")).otherwise(F.array("block"))
    links = confirmed(members.select("id", F.col("cluster"), F.explode(visited).alias("k")).select("id", F.xxhash64("cluster", "k").alias("task")))
    linked = durable(connected_components(links))

    # clusters of several blocks that are in more than one component yet
    parts = members.where("blocks > 1").join(linked, "id", "left").select("id", "cluster", "n_shingles", F.coalesce("component", "id").alias("root"))
    roots = durable(parts.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")))
    torn = roots.groupBy("cluster").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots"), F.sum("n").alias("all"), F.max("n").alias("most"), F.sum("s").alias("s")).where("roots > 1")
    # at the mean length, so many documents fill a block
    fill = F.least(F.lit(float(BLOCK)), F.greatest(F.lit(1.0), F.col("all") * F.lit(float(BLOCK_SHINGLES)) / F.col("s")))
    torn = durable(torn.select("cluster", "main", F.ceil(F.col("most") / fill).cast("int").alias("n_main"), F.ceil((F.col("all") - F.col("most")) / fill).cast("int").alias("n_rest")))
    if not torn.isEmpty():
        parts = parts.join(torn, "cluster").withColumn("draw", F.xxhash64("id", F.lit(2)))
        mine = F.pmod(F.col("draw"), F.when(F.col("root") == F.col("main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int")
        parts = parts.withColumn("mine", mine)
        everywhere = F.expr("transform(sequence(0, n_rest - 1), k -> struct(k as first, -1 - mine as second))")
        others = F.expr("concat(transform(sequence(0, n_main - 1), k -> struct(mine as first, -1 - k as second)), transform(sequence(0, n_rest - 1), k -> struct(least(mine, k) as first, greatest(mine, k) as second)))")
        tasks = parts.select("id", "cluster", F.explode(F.when(F.col("root") == F.col("main"), everywhere).otherwise(others)).alias("t"))
        links = durable(links.union(confirmed(tasks.select("id", F.xxhash64("cluster", "t.first", "t.second").alias("task")))))
        linked = connected_components(links)

    named = durable(reps.drop("forest", "n_shingles").join(linked, F.col("rep") == F.col("id"), "left").select("hi", "lo", F.coalesce("component", "rep").alias("component")))
    with_sets = signed.where("doc_id is not null and n_shingles > 0").select("doc_id", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    alone = signed.where("doc_id is null or n_shingles = 0")
    out = with_sets.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    out = out.union(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
