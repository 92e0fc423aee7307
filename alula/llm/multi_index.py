"""Near-duplicate vectors with an inverted multi-index.

Unit vectors are cut into halves, and each half gets its own codebook; a vector's cell is the pair of its nearest centroids. A
query visits cells in the multi-sequence order, that is by the sum of the two centroid distances, until the target recall is
reached. How many cells that takes is measured, not guessed: the recall of the first n cells is taken from true neighbours of
a sample of queries (found by comparing them with *all* vectors), and from directions drawn at exactly the threshold; the
larger n counts. What meets in a cell is verified with double-precision cosines.

Codebooks are fitted on a bounded sample; every vector is indexed and every vector is a query. Equal vectors are one class. Cells
are cut into blocks of members and blocks of queries, so that no task holds a whole crowded cell, and a block
returns link counts and a spanning forest of its links, never its pairs.

Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing. Vectors link with vectors of
their own length only, and every length has its own index. Rows that share an id are linked; a row without an id links
with nothing, stays, and has no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import unit_hash, written
from alula.llm.components import connected_components

THRESHOLD = 0.9
#: Vectors that codebooks are fitted on at most, queries whose neighbours are all looked up, and the largest codebook.
SAMPLE, PROBES, LARGEST_CODEBOOK = 8192, 256, 4096
#: Vectors that a cell should hold on average; sizes of the blocks that meet.
CELL_ROWS, BLOCK_ROWS = 128, 1024
#: Recall to reach over true neighbours, and for pairs exactly at the threshold.
TARGET_RECALL, EDGE_RECALL = 0.999, 0.95


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.maximum(np.abs(v).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """k-means from distinct sample points, without randomness: the points come in hash order."""
    centroids = np.unique(points, axis=0)
    order = np.argsort((np.arange(len(centroids)) * 2654435761) % (1 << 32))
    centroids = centroids[order[:size]].copy()
    for _ in range(rounds):
        nearest = squared(points, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centroids))
        for k in np.flatnonzero(counts):
            centroids[k] = points[nearest == k].mean(axis=0)
    return centroids


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, up to a constant per point."""
    return (centroids**2).sum(axis=1) - 2 * points @ centroids.T


@dataclass
class MultiIndex:
    left: np.ndarray
    right: np.ndarray
    visits: int = 1

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return squared(unit[:, :half], self.left), squared(unit[:, half:], self.right)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def nearest_cells(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` cells of each query in multi-sequence order.

        A cell among the n nearest has ranks i, j (from 1) in the two sorted lists with i * j <= n, because all i * j cells of
        better or equal ranks are at least as near; only those are summed up and sorted."""
        a, b = self.distances(unit)
        n = min(n, a.shape[1] * b.shape[1])
        first, second = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        i, j = np.meshgrid(np.arange(min(n, a.shape[1])), np.arange(min(n, b.shape[1])), indexing="ij")
        inside = (i + 1) * (j + 1) <= n
        i, j = i[inside], j[inside]
        sums = np.take_along_axis(a, first, 1)[:, i] + np.take_along_axis(b, second, 1)[:, j]
        chosen = np.argsort(sums, axis=1, kind="stable")[:, :n]
        return first[np.arange(len(unit))[:, None], i[chosen]] * b.shape[1] + second[np.arange(len(unit))[:, None], j[chosen]]

    def ranks(self, queries: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Cells that a query visits up to the one that holds its found neighbour (row by row)."""
        a, b = self.distances(queries)
        cell = self.cells(found)
        i, j = cell // len(self.right), cell % len(self.right)
        at = np.arange(len(queries))
        limit = a[at, i] + b[at, j]
        b = np.sort(b, axis=1)
        out = np.zeros(len(queries), dtype=np.int64)
        for k in range(a.shape[1]):
            out += (b < (limit - a[:, k])[:, None]).sum(axis=1)
        return out + 1


def valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fit_index(classes: DataFrame, n: int) -> MultiIndex:
    """Codebooks sized for ``n`` classes (id, vector), and the number of visits that reaches the target recall."""
    spark = classes.sparkSession
    sample = classes.orderBy(unit_hash("id", seed=8), "id").limit(SAMPLE).collect()
    unit = unit_rows(np.array([r["vector"] for r in sample]))
    half = unit.shape[1] // 2
    size = int(min(LARGEST_CODEBOOK, max(1, round((n / CELL_ROWS) ** 0.5))))
    index = MultiIndex(fit_codebook(unit[:, :half], size), fit_codebook(unit[:, half:], size))

    probes = unit[:PROBES]
    ids = np.array([r["id"] for r in sample[:PROBES]])
    shared = spark.sparkContext.broadcast((index, probes, ids))

    def true_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, queries, query_ids = shared.value
        counts: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            own = unit_rows(_matrix(batch.column("vector")))
            near = (queries @ own.T >= THRESHOLD) & (query_ids[:, None] != batch.column("id").to_numpy()[None, :])
            q, m = np.nonzero(near)
            for at in range(0, len(q), 4096):
                for rank in fitted.ranks(queries[q[at : at + 4096]], own[m[at : at + 4096]]).tolist():
                    counts[rank] = counts.get(rank, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["rank", "n"])

    found = classes.select("id", "vector").mapInArrow(true_ranks, "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n")).orderBy("rank").collect()
    total, seen, needed = sum(r["n"] for r in found), 0, 1
    for r in found:
        if seen >= TARGET_RECALL * total:
            break
        seen, needed = seen + r["n"], r["rank"]

    rng = np.random.default_rng(8)
    base = unit[:2048]
    noise = rng.normal(size=base.shape)
    noise -= (noise * base).sum(axis=1, keepdims=True) * base
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    edge = THRESHOLD * base + (1 - THRESHOLD**2) ** 0.5 * noise / np.where(length > 1e-9, length, 1.0)
    at_edge = int(np.quantile(index.ranks(base, edge), EDGE_RECALL, method="higher"))
    index.visits = max(needed, at_edge)
    return index


def _forest(hits: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id reachable within the block, for both sides of a boolean matrix of links."""
    a, b = left.copy(), right.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(a, np.where(hits, b[None, :], top).min(axis=1, initial=top))
        new_b = np.minimum(b, np.where(hits, new_a[:, None], top).min(axis=0, initial=top))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


def _met(queries: pa.Table, members: pa.Table) -> pa.Table:
    """Links of a block of queries with a block of members: (id, links, smallest id of its part of the forest).

    A pair counts for the query. It counts for the member too where the member does not visit the query's own cell, and so
    does not find the pair itself."""
    names = ["id", "links", "root"]
    empty = pa.table([pa.array([], pa.int64())] * 3, names=names)
    if not queries.num_rows or not members.num_rows:
        return empty
    left, right = queries.column("ask_id").to_numpy(), members.column("id").to_numpy()
    copies, visits = members.column("copies").to_numpy(), _matrix(members.column("visits"))
    own_cell, own_copies = queries.column("ask_own").to_numpy(), queries.column("ask_copies").to_numpy()
    u, v = unit_rows(_matrix(queries.column("ask_vector"))), unit_rows(_matrix(members.column("vector")))
    out = []
    for at in range(0, len(left), BLOCK_ROWS):
        part = left[at : at + BLOCK_ROWS]
        hits = (u[at : at + BLOCK_ROWS] @ v.T >= THRESHOLD) & (part[:, None] != right[None, :])
        rows, columns = hits.any(axis=1), hits.any(axis=0)
        if not rows.any():
            continue
        hits = hits[rows][:, columns]
        a, b = _forest(hits, part[rows], right[columns])
        asks, found = np.nonzero(hits)
        one_way = (visits[columns][found] != own_cell[at : at + BLOCK_ROWS][rows][asks][:, None]).all(axis=1)
        back = np.zeros(len(b), dtype=np.int64)
        np.add.at(back, found[one_way], own_copies[at : at + BLOCK_ROWS][rows][asks[one_way]])
        out.append(pa.table([pa.array(part[rows]), pa.array(hits @ copies[columns]), pa.array(a)], names=names))
        out.append(pa.table([pa.array(right[columns]), pa.array(back), pa.array(b)], names=names))
    return pa.concat_tables(out) if out else empty


def near_vectors(classes: DataFrame, index: MultiIndex) -> DataFrame:
    """(id, links, root) partial results of all classes (id, copies, vector): sum the links, connect id and root."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                unit = unit_rows(_matrix(part.column("vector")))
                visited = fitted.nearest_cells(unit, fitted.visits).astype(np.int64)
                offsets = pa.array(np.arange(len(unit) + 1, dtype=np.int32) * visited.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(visited.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fitted.cells(unit).astype(np.int64)), lists], ["id", "copies", "vector", "cell", "visits"])

    columns = classes.select("id", "copies", "vector")
    ddl = f"id long, copies long, vector {columns.schema['vector'].dataType.simpleString()}, cell long, visits array<long>"
    placed = written(columns.mapInArrow(place, ddl), "placed-vectors")
    visits = placed.select("id", F.explode("visits").alias("cell"))
    members = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("member_blocks"))
    queries = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("query_blocks"))
    blocks = written(members.join(queries, "cell"), "cell-blocks")

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    asking = placed.select("id", "copies", "vector", F.col("cell").alias("own"), F.explode("visits").alias("cell")).join(blocks, "cell")
    asking = asking.withColumn("q", block("query_blocks")).withColumn("m", every("member_blocks")).select("cell", "q", "m", "id", "copies", "own", "vector")
    held = placed.select("id", "copies", "vector", "cell", "visits").join(blocks, "cell")
    held = held.withColumn("m", block("member_blocks")).withColumn("q", every("query_blocks")).select("cell", "q", "m", "id", "copies", "visits", "vector")
    asking = asking.toDF(*[f"ask_{c}" for c in asking.columns])
    pairs = asking.groupBy("ask_cell", "ask_q", "ask_m").cogroup(held.groupBy("cell", "q", "m"))
    return pairs.applyInArrow(_met, "id long, links long, root long")


def near_duplicate_vectors(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per row: vec_id, n_links (other vectors linked directly), component_id (smallest id reachable), kept."""
    all_rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    usable = valid(F.col("vector")) & F.col("vec_id").isNotNull()
    lone = F.when(F.col("vec_id").isNotNull(), F.col("vec_id"))
    classes = all_rows.where(usable).groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes, "vector-classes")
    sizes = classes.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect()
    if not sizes:
        return all_rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), lone.alias("component_id"), F.lit(True).alias("kept"))
    # Each length's links are written on their own, so that one index at a time is held.
    partials = [rows.sparkSession.createDataFrame([], "id long, links long, root long")]
    for r in sizes:
        if r["count"] == 1:
            continue
        same = classes.where(F.size("vector") == r["d"])
        partials.append(written(near_vectors(same, fit_index(same, r["count"])), "vector-links"))
    partial = reduce(DataFrame.unionByName, partials)
    counts = partial.groupBy("id").agg(F.sum("links").alias("links"))
    found = connected_components(partial.where("id <> root").select("id", "root"))
    named = classes.join(counts, "id", "left").join(found, classes["id"] == found["node"], "left")
    linked = named.where("copies > 1 or component is not null").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    linked = written(linked, "linked-classes")
    key = F.when(usable, F.col("vector"))
    joined = all_rows.withColumn("key", key).join(linked.withColumnRenamed("vector", "key"), "key", "left")
    component = F.coalesce("component_id", lone)
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
