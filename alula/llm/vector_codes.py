"""Product codes of vectors, with the nearest codebook entry found by Orchard's search.

Components become integers floor(1024 x). A vector is cut into ``PARTS`` parts; each part position has a codebook of up to
``ENTRIES`` entries, which starts as that part of the vectors with the smallest ids and is moved to the means of its parts in
``ROUNDS`` rounds. A code is the list of the nearest entries' numbers.

Search: every entry has a list of all entries, sorted by their distance from it. A part starts at an entry (the one it
had in the round before), looks through that entry's list, marks what it has seen, and jumps to the list of an entry that is nearer,
or as near with a lower number. It ends where the list is beyond twice the current distance: by the triangle inequality, nothing
further down can be as near. All parts of a batch go through their lists together, a few entries at a time. Distances are integers,
so results are exact.

A round is one pass over the table: tasks return sums per entry, and the codebooks (of fixed size) are all that reaches the driver.

Vectors that are null or hold a null, NaN or infinite component are dropped. Others are padded with zeros to the longest
one's length, rounded up to a multiple of ``PARTS``; components beyond +-2^16 count as +-2^16. The smallest ids decide the
codebooks; rows that share an id come in the order of their vectors, rows without an id last. Fewer rows than ``ENTRIES`` make smaller
codebooks. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import extended, slices, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of a list that are looked at together; rows searched together.
AHEAD, BATCH_ROWS = 8, 1024
LARGEST = 1 << 26


@dataclass
class Codebook:
    """Entries of one part position, with each entry's list of all entries by distance."""

    entries: np.ndarray
    lists: np.ndarray = field(init=False, repr=False)
    reach: np.ndarray = field(init=False, repr=False)  # squared distances along the lists

    def __post_init__(self) -> None:
        apart = np.stack([((self.entries - e) ** 2).sum(axis=1) for e in self.entries])
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.reach = np.take_along_axis(apart, self.lists, axis=1)

    def nearest(self, points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (the lowest of equally near ones) and the squared distance, for integer points."""
        n, k = len(points), len(self.entries)
        best = start.astype(np.int64)
        distance = ((points - self.entries[best]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), dtype=bool)
        seen[np.arange(n), best] = True
        at = np.ones(n, dtype=np.int64)  # a list begins with the entry itself, or one equal to it
        at[self.lists[best, 0] != best] = 0
        active = np.arange(n)
        steps = np.arange(AHEAD)
        while len(active):
            place = np.minimum(at[active, None] + steps, k - 1)
            own = best[active]
            offered, far = self.lists[own[:, None], place], self.reach[own[:, None], place]
            limit = 4 * distance[active]
            look = (far <= limit[:, None]) & ~seen[active[:, None], offered] & (at[active, None] + steps < k)
            who, column = np.nonzero(look)
            entry = offered[who, column]
            seen[active[who], entry] = True
            found = np.full(look.shape, np.iinfo(np.int64).max)
            found[who, column] = ((points[active[who]] - self.entries[entry]) ** 2).sum(axis=1)
            least = found.min(axis=1)
            number = np.where(found == least[:, None], offered, k).min(axis=1)
            jump = (least < distance[active]) | ((least == distance[active]) & (number < own))
            over = ~jump & ((far[:, -1] > limit) | (at[active] + AHEAD >= k))
            moved = active[jump]
            best[moved], distance[moved] = number[jump], least[jump]
            at[active] = np.where(jump, 0, at[active] + AHEAD)
            active = active[~over]
        return best, distance


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of integers, padded with zeros."""
    values = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _parts(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    return np.split(integers(batch.column("vector"), width), PARTS, axis=1)


def _entry_sums(rows: DataFrame, books: list[Codebook], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per part position: the number of parts nearest to every entry, and their sums."""
    size, k = width // PARTS, len(books[0].entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(PARTS * k, dtype=np.int64), np.zeros((PARTS * k, size), dtype=np.int64)
        last = np.zeros(PARTS, dtype=np.int64)
        for batch in slices(batches, BATCH_ROWS):
            for p, (book, points) in enumerate(zip(books, _parts(batch, width))):
                best = book.nearest(points, np.full(len(points), last[p]))[0]
                last[p] = np.bincount(best).argmax()
                counts += np.bincount(best + p * k, minlength=PARTS * k)
                np.add.at(sums, best + p * k, points)
        used = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * size, pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used]), lists], ["slot", "n", "s"])

    partial = rows.select("vector").mapInArrow(run, "slot int, n long, s array<long>")
    entries = partial.select("slot", "n", F.posexplode("s").alias("pos", "s")).groupBy("slot", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    counts, sums = np.zeros(PARTS * k, dtype=np.int64), np.zeros((PARTS * k, size), dtype=np.int64)
    for r in entries.collect():  # PARTS * ENTRIES rows per component, whatever the table's size
        counts[r["slot"]], sums[r["slot"], r["pos"]] = r["n"], r["s"]
    return list(zip(counts.reshape(PARTS, k), sums.reshape(PARTS, k, size)))


def fit_codebooks(rows: DataFrame) -> tuple[list[Codebook], int]:
    """Codebooks of ``rows`` (id, vector), all usable, and the padded length; none for an empty table."""
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return [], 0
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(ENTRIES).select("vector").collect()
    start = integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), width)
    books = [Codebook(e) for e in np.split(start, PARTS, axis=1)]
    for _ in range(ROUNDS):
        moved = []
        for book, (n, s) in zip(books, _entry_sums(rows, books, width)):
            moved.append(Codebook(np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], book.entries)))
        books = moved
    return books, width


def codebooks_sha256(books: list[Codebook]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    books, width = fit_codebooks(rows.select("id", "vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros(PARTS, dtype=np.int64)
        for batch in slices(batches, BATCH_ROWS):
            total, code = np.zeros(batch.num_rows, dtype=np.int64), np.zeros((batch.num_rows, PARTS), dtype=np.uint8)
            for p, (book, points) in enumerate(zip(books, _parts(batch, width))):
                best, distance = book.nearest(points, np.full(len(points), last[p]))
                last[p] = np.bincount(best).argmax() if len(best) else 0
                code[:, p] = best
                total += distance
            codes = pa.array([c.tobytes().hex() for c in code], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), codes, pa.array(total)], ["vec_id", "label", "code", "error"])

    schema = extended(rows.select(F.col("id").alias("vec_id"), "label").schema, "code string, error long")
    coded = written(rows.mapInArrow(run, schema), "vector-codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))
