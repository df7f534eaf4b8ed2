"""Embedding near-duplicates: spherical k-means cells, blocked cosine products between near cells.

A unit vector x of cell p links with a vector y of cell q at a distance of at most r only if both are
within r of the plane between the two centroids, and their distances from it add up to r at most. So
pairs of cells are compared on the vectors near their border alone, and no link is lost, whatever the
centroids are. Products are bounded first, by the leading components and the lengths of the rest in
single precision; what the bound lets through is computed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import connected_components, durable, find_roots
from .words import mix

#: Vectors, and components of vectors, that the centroids are fitted on, at most; all vectors are assigned and compared.
SAMPLE, SAMPLE_VALUES = 20_000, 1 << 22
#: Cells for each vector length, at most: with more vectors cells get fuller, and full cells are dealt to several groups.
MOST_CELLS = 4096
ROUNDS = 6
#: Components of vectors in a group of cells; two groups are compared in one task. Fewer where vectors are few.
GROUP_VALUES = 1 << 22
LEAST_GROUPS = 4
#: Vectors on either side of one product.
STRIPE, BLOCK = 512, 8192
#: Leading components of the bound, at most, and what single precision may be off by.
LEADING, SLACK = 64, 1e-4
_U = np.uint64


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Unit rows in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(cells: pa.Array, kind: str) -> np.ndarray:
    """The raw rows of binary cells of one length."""
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    _, where, data = cells.buffers()
    at = np.frombuffer(where, np.int32)[cells.offset : cells.offset + len(cells) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind).reshape(len(cells), -1)


def _pack(kind: str):
    """(vec_id, embedding) to (vec_id, dim, vec): the raw components, or null where nothing can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            at = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values
            holes = flat.is_null().to_numpy(zero_copy_only=False)
            flat = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(kind)
            here = np.asarray(lists.is_valid()) & np.asarray(ids.is_valid())
            size = np.where(here, np.diff(at), 0)
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                x = flat[at[rows][:, None] + np.arange(dim)]
                fine = ~holes[at[rows][:, None] + np.arange(dim)].any(axis=1) & np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                ends = np.concatenate([[0], np.cumsum(fine * (dim * x.itemsize))]).astype(np.int32)
                body = pa.py_buffer(np.ascontiguousarray(x[fine]))
                valid = pa.array(fine).buffers()[1]
                vec = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [valid, pa.py_buffer(ends), body])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)).cast(pa.int64()), pa.array(np.full(len(rows), dim, np.int32)), vec], ["vec_id", "dim", "vec"])

    return run


def spherical_kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """k unit centroids (fewer if the rows are fewer) of unit rows; fixed seed."""
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        home = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    return c


def _fit(kind: str, k: int, groups: int):
    """One task: the sample's vectors to the model: centroids ordered by neighbourhood, and leading directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = unit_rows(np.concatenate([_matrix(b.column(0), kind) for b in batches if b.num_rows]))
        c = spherical_kmeans(x, k)
        near = (c @ spherical_kmeans(c, groups).T).argmax(axis=1)
        c = c[np.argsort(near, kind="stable")]
        lead = min(x.shape[1], LEADING, max(8, x.shape[1] // 4))
        _, axes = np.linalg.eigh(x.T @ x)
        for part, rows in (("centroid", c), ("axis", axes[:, ::-1].T[:lead])):
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows)), pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())], ["part", "vec"])

    return run


class Cells:
    """The centroids of one vector length, the leading directions, and the groups that cells are dealt to."""

    def __init__(self, centroids: np.ndarray, axes: np.ndarray):
        self.centroids, self.axes = centroids, axes
        self.gaps = np.sqrt(np.maximum(0, 2 - 2 * (centroids @ centroids.T)))
        self.first = self.last = np.zeros(len(centroids), np.int64)

    def deal(self, sizes: np.ndarray, room: int, base: int) -> int:
        """Put cells into groups of about `room` vectors, in order; a fuller cell spans several. Returns the next group's number."""
        upto = np.cumsum(sizes)
        self.first = base + (upto - sizes) // room
        self.last = base + np.maximum(upto - sizes, upto - 1) // room
        return int(self.last.max(initial=base)) + 1

    def margins(self, x: np.ndarray, home: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
        """How far each vector is from the border between its own cell and each of the others (all, unless given); 0 to its own."""
        others = np.arange(len(self.centroids)) if others is None else others
        own = (x * self.centroids[home]).sum(axis=1)
        gap = self.gaps[home[:, None], others]
        return np.where(gap > 1e-9, (own[:, None] - x @ self.centroids[others].T) / np.maximum(gap, 1e-9), 0)


def _assign(kind: str, cells: dict[int, Cells]):
    """(rep, copies, dim, vec) with the home cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            home = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), 2048):
                    some = rows[at : at + 2048]
                    home[some] = (unit_rows(_matrix(batch.column(3).take(pa.array(some)), kind)) @ cells[dim].centroids.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], ["rep", "copies", "dim", "vec", "home"])

    return run


def _deal(kind: str, shared, reach: float):
    """Each vector to the pairs of groups that it may have links in: (task, side, rep, copies, dim, vec, home)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                dims = batch.column(2).to_numpy()
                rows, tasks, sides = [], [], []
                for dim in np.unique(dims).tolist():
                    model = cells[dim]
                    some = np.flatnonzero(dims == dim)
                    part = batch.take(pa.array(some))
                    home = part.column(4).to_numpy().astype(np.int64)
                    near = model.margins(unit_rows(_matrix(part.column(3), kind)), home) <= reach
                    span = model.last - model.first + 1
                    own = model.first[home] + (mix(part.column(0).to_numpy().astype(np.uint64)) >> _U(33)).astype(np.int64) % span[home]
                    row, cell = np.nonzero(near)
                    k = span[cell]
                    row, other = np.repeat(row, k), np.repeat(model.first[cell] - (np.cumsum(k) - k), k) + np.arange(k.sum())
                    met = np.unique(row << 32 | other)
                    row, other = met >> 32, met & 0xFFFFFFFF
                    mine = own[row]
                    rows.append(some[row])
                    tasks.append(np.minimum(mine, other) << 32 | np.maximum(mine, other))
                    sides.append((mine > other).astype(np.int8))
                take = batch.take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tasks)), pa.array(np.concatenate(sides)), *take.columns], ["task", "side", *batch.schema.names])

    return run


class _Side:
    """The vectors of one group in a task, in order of their cells, and what their products need."""

    def __init__(self, rows: pa.Table, kind: str, model: Cells):
        home = rows.column("home").to_numpy()
        by = np.argsort(home, kind="stable")
        rows, self.home = rows.take(pa.array(by)), home[by].astype(np.int64)
        self.ids, self.copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        self.x = unit_rows(_matrix(rows.column("vec"), kind))
        lead = self.x @ model.axes.T
        rest = np.sqrt(np.maximum(0, 1 - (lead * lead).sum(axis=1)))
        self.bound = np.concatenate([lead, rest[:, None]], axis=1).astype(np.float32)

    def measure(self, model: Cells, others: np.ndarray) -> None:
        """Margins to the cells of the other side."""
        self.margin = np.empty((len(self.x), len(others)), np.float32)
        for k in range(0, len(self.x), 4096):
            self.margin[k : k + 4096] = model.margins(self.x[k : k + 4096], self.home[k : k + 4096], others)


def _near_pairs(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows i of a and j of b with a product of `least` and more."""
    u, v = np.nonzero(a.bound[i] @ b.bound[j].T >= least - SLACK)
    out = []
    if 16 * len(u) > len(i) * len(j):
        u, v = np.nonzero(a.x[i] @ b.x[j].T >= least)
        return i[u], j[v]
    for k in range(0, len(u), 1 << 15):
        p, q = i[u[k : k + (1 << 15)]], j[v[k : k + (1 << 15)]]
        good = (a.x[p] * b.x[q]).sum(axis=1) >= least
        out.append((p[good], q[good]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (i[:0], j[:0])


def _compare(kind: str, shared, least: float, reach: float):
    """All rows of each task: links counted, and each linked vector with the smallest id it meets."""

    def decide(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        task, model = rows.column(0)[0].as_py(), shared.value[rows.column("dim")[0].as_py()]
        alone = task >> 32 == (task & 0xFFFFFFFF)
        side = rows.column(1).to_numpy()
        if not alone and (side.min() or not side.max()):  # no vector of the other group comes near
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["id", "links", "root"])
        a = _Side(rows.filter(pa.array(side == 0)), kind, model)
        b = a if alone else _Side(rows.filter(pa.array(side == 1)), kind, model)
        their, at = np.unique(b.home, return_inverse=True)
        ours = np.unique(a.home)
        a.measure(model, their)
        if not alone:
            b.measure(model, ours)
        shift = 0 if alone else len(a.ids)
        ids = a.ids if alone else np.concatenate([a.ids, b.ids])
        order = np.argsort(ids, kind="stable")
        node = np.empty(len(ids), np.int64)
        node[order] = np.arange(len(ids))
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for nth, cell in enumerate(ours.tolist()):
            lo, hi = np.searchsorted(a.home, [cell, cell + 1])
            # by distance from any border, so that a stripe of inner vectors meets few others
            inner = np.argsort(a.margin[lo:hi][:, their != cell].min(axis=1, initial=4), kind="stable") + lo
            for s in range(0, hi - lo, STRIPE):
                i = inner[s : s + STRIPE]
                left = reach - a.margin[i].min(axis=0)
                j = np.flatnonzero(b.margin[:, nth] <= left[at])
                if alone:  # a pair within one group is met once
                    j = j[j > i.min()]
                for t in range(0, len(j), BLOCK):
                    p, q = _near_pairs(a, b, i, j[t : t + BLOCK], least)
                    if alone:
                        once = p < q
                        p, q = p[once], q[once]
                    if len(p):
                        np.add.at(links, p, b.copies[q])
                        np.add.at(links, q + shift, a.copies[p])
                        u, v = node[p], node[q + shift]
                        root = find_roots(len(root), np.concatenate([u, np.arange(len(root))]), np.concatenate([v, root]))
        met = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(ids[met]), pa.array(links[met]), pa.array(ids[order][root[node[met]]])], ["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parts = None, []
        for batch in batches:
            tasks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(tasks[1:] != tasks[:-1]) + 1).tolist(), len(tasks)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if parts and tasks[i] != task:
                    yield decide(parts)
                    parts = []
                task = tasks[i]
                parts.append(batch.slice(i, j - i))
        if parts:
            yield decide(parts)

    return run


def near_embeddings(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept): vectors linked by cosine >= least, in double precision.

    n_links counts the other vectors linked directly, component_id is the smallest id reachable by
    links (its own included), kept says that it is the vector's own. Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, nor do rows with a null id, which
    are kept with a null component_id. Vectors of different length are not compared. Equal vectors
    are compared once and counted as often as they occur; repeated rows count as vectors of their own;
    different vectors under one id count as one node, each with the links of both.

    Centroids are fitted in a task of their own on at most SAMPLE vectors (those of smallest id hash)
    and SAMPLE_VALUES components; every vector is assigned, and every pair that can link meets in one
    task: cells are dealt to groups of GROUP_VALUES components, and a vector goes to the pairs of its
    own group with those in which some cell's border is near. Only centroids, leading directions
    and the sizes of cells, for MOST_CELLS cells of each vector length, pass through the driver.
    """
    spark = vectors.sparkSession
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    value = "float" if kind == "<f4" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{value}>").alias("e"))
    packed = durable(rows.mapInArrow(_pack(kind), "vec_id long, dim int, vec binary"))
    digest = F.unhex(F.sha2("vec", 256)).alias("digest")
    fine = packed.where("vec is not null")
    reps = fine.groupBy(digest).agg(F.min(F.struct("vec_id", "dim", "vec")).alias("r"), F.count("*").alias("copies"))
    reps = durable(reps.select("digest", F.col("r.vec_id").alias("rep"), "copies", "r.dim", "r.vec"))

    cells: dict[int, Cells] = {}
    counts = {r.dim: r["count"] for r in reps.groupBy("dim").count().collect()}  # a row for each vector length
    for dim, n in sorted(counts.items()):
        sample = reps.where(F.col("dim") == dim).orderBy(F.xxhash64("rep")).limit(max(1, min(SAMPLE, SAMPLE_VALUES // dim))).select("vec").coalesce(1)
        k = int(min(MOST_CELLS, max(1, n**0.5 / 4)))
        fitted = sample.mapInArrow(_fit(kind, k, max(LEAST_GROUPS, -(-n * dim // GROUP_VALUES))), "part string, vec binary").collect()
        part = lambda name, fitted=fitted: np.stack([np.frombuffer(r.vec, np.float64) for r in fitted if r.part == name])
        cells[dim] = Cells(part("centroid"), part("axis"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)) + 1e-6)
    placed = durable(reps.select("rep", "copies", "dim", "vec").mapInArrow(_assign(kind, cells), "rep long, copies long, dim int, vec binary, home int"))
    base = 0
    sizes = placed.groupBy("dim", "home").count().collect()  # a row for each cell
    for dim, model in cells.items():
        filled = np.zeros(len(model.centroids), np.int64)
        for r in sizes:
            if r.dim == dim:
                filled[r.home] = r["count"]
        base = model.deal(filled, max(1, min(GROUP_VALUES // dim, -(-counts[dim] // LEAST_GROUPS))), base)
    shared = spark.sparkContext.broadcast(cells)
    dealt = placed.mapInArrow(_deal(kind, shared, reach), "task long, side byte, rep long, copies long, dim int, vec binary, home int")
    met = durable(dealt.repartition("task").sortWithinPartitions("task").mapInArrow(_compare(kind, shared, least, reach), "id long, links long, root long"))
    shared.unpersist()
    linked = connected_components(met.select(F.col("id").alias("u"), F.col("root").alias("v")))
    counted = met.groupBy("id").agg(F.sum("links").alias("links"))
    named = reps.select("digest", "rep", "copies").join(counted, F.col("rep") == counted.id, "left").drop("id").join(linked, F.col("rep") == F.col("id"), "left")
    named = durable(named.select("digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = fine.select("vec_id", digest).join(named, "digest", "left").select("vec_id", "n_links", "component_id")
    out = out.union(packed.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
