"""Procrustes superimposition: one-pass alignment and the consensus iteration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from alula.functions import shapes as G
from alula.operators.arrow import append_arrow, complex_shapes, exploded_points, gathered, list_column, summed_vectors
from alula.operators.dataset import EmptyDatasetError, majority_point_count
from alula.operators.ordering import Order, order_key
from alula.schema import DOUBLES, SchemaError
from alula.session import broadcast_bytes, pinned

ALIGNED = [T.StructField("ax", DOUBLES), T.StructField("ay", DOUBLES)]


def unit_shapes(batch: pa.RecordBatch, label: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Centred shapes of size 1 and their raw centroid sizes."""
    z = complex_shapes(batch, "x", "y")
    z = z - z.mean(axis=1, keepdims=True)
    size = np.sqrt((z.real**2 + z.imag**2).sum(axis=1))
    if (size == 0).any():
        who = batch.column(label).filter(pa.array(size == 0))[:10].to_pylist() if label else "?"
        raise ValueError(f"degenerate specimen (centroid size = 0): {who}")
    return z / size[:, None], size


def standardized(df: DataFrame, label: str | None = None) -> DataFrame:
    """Replaces ``x``/``y`` by centred, unit-size ``xs``/``ys`` and the raw ``centroid_size``.

    A shape of size 0 stops the query and names the row. Every column of ``df``
    travels through Arrow, so select what is needed first."""

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        z, size = unit_shapes(batch, label)
        return [pa.array(size), list_column(z.real), list_column(z.imag)]

    fields = [T.StructField("centroid_size", T.DoubleType()), T.StructField("xs", DOUBLES), T.StructField("ys", DOUBLES)]
    return append_arrow(df, fields, kernel, drop=("x", "y"))


def rotated_onto(df: DataFrame, rx: str, ry: str) -> DataFrame:
    """Replaces ``xs``/``ys`` by ``ax``/``ay``, rotated onto the reference held in each row."""

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        z = rotate_rows(complex_shapes(batch, "xs", "ys"), complex_shapes(batch, rx, ry))
        return [list_column(z.real), list_column(z.imag)]

    return append_arrow(df, ALIGNED, kernel, drop=("xs", "ys", rx, ry))


def align_to_reference(df: DataFrame, reference: np.ndarray, label: str | None = None) -> DataFrame:
    """Single-pass alignment onto a frozen (p, 2) shape: ``x``/``y`` become ``ax``/``ay``.

    Adds the centroid size and the Procrustes distance.

    One Arrow pass: measured five times faster than the same arithmetic as
    higher-order array functions, and the arrays are computed once whatever is
    filtered or exploded afterwards. Another landmark count is an error."""
    ref = np.asarray(reference)[:, 0] + 1j * np.asarray(reference)[:, 1]

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        z, size = unit_shapes(batch, label)
        if z.shape[1] != len(ref):
            raise ValueError(f"shape mismatch with the reference: {z.shape[1]} landmarks, expected {len(ref)}")
        a = rotate_rows(z, ref)
        distance = np.sqrt((np.abs(a - ref) ** 2).sum(axis=1))
        return [pa.array(size), list_column(a.real), list_column(a.imag), pa.array(distance)]

    size, distance = (T.StructField(n, T.DoubleType()) for n in ("centroid_size", "procrustes_distance"))
    return append_arrow(df, [size, *ALIGNED, distance], kernel, drop=("x", "y"))


# --- consensus ---------------------------------------------------------------------------


@dataclass
class Consensus:
    """Result of the iteration. ``aligned`` is aligned to the last-but-one mean."""

    aligned: DataFrame
    mean_shape: np.ndarray  # (p, 2)
    n_iterations: int
    n_specimens: int
    cached: DataFrame

    def release(self) -> None:
        self.cached.unpersist()


def unit(vector: np.ndarray) -> np.ndarray:
    return vector / np.sqrt((np.abs(vector) ** 2).sum())


def rotate_rows(z: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """Rows of complex shapes rotated onto ``ref`` (one shape or one per row)."""
    inner = (np.conj(z) * ref).sum(axis=1)
    length = np.abs(inner)
    turn = np.where(length == 0, 1.0 + 0j, inner / np.where(length == 0, 1.0, length))
    return z * turn[:, None]


def aligned_columns(df: DataFrame, ref: np.ndarray) -> DataFrame:
    """Arrow form of the rotation, for frames that are scanned repeatedly."""

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        z = rotate_rows(complex_shapes(batch, "xs", "ys"), ref)
        return [list_column(z.real), list_column(z.imag)]

    return append_arrow(df, ALIGNED, kernel, drop=("xs", "ys"))


def _starts(order: Order) -> list[Column]:
    """First shape in order and the range of landmark counts."""
    return [
        F.min_by(F.struct("xs", "ys"), order_key(order)).alias("s"),
        F.min(F.size("xs")).alias("lo"),
        F.max(F.size("xs")).alias("hi"),
        F.count(F.lit(1)).alias("n"),
    ]


def _common_points(rows: Sequence[Row]) -> int:
    counts = {c for r in rows for c in (r["lo"], r["hi"])}
    if not counts or None in counts:
        raise EmptyDatasetError("no specimen to superimpose")
    if len(counts) > 1:
        raise SchemaError(f"landmark counts differ: {min(counts)} to {max(counts)}")
    return counts.pop()


def consensus(df: DataFrame, order: Order = ("ord",), max_iter: int = 100, tol: float = 1e-8,
              label: str | None = None) -> Consensus:
    """Generalised Procrustes analysis over the whole table.

    The standardised frame is kept (memory, spilling to disk) and scanned once
    per iteration; each task returns one partial sum, so 2p numbers per task are
    all that ever moves."""
    base = standardized(df, label).persist(StorageLevel.MEMORY_AND_DISK)
    first = base.agg(*_starts(order)).first()
    p, start = _common_points([first]), first["s"]
    ref = np.array(start["xs"]) + 1j * np.array(start["ys"])
    previous, done, count = ref, 0, 0
    slim = base.select("xs", "ys")
    for done in range(1, max_iter + 1):
        def fold(batches: Iterator[pa.RecordBatch], ref: np.ndarray = ref) -> Iterator[tuple]:
            acc, n = np.zeros(len(ref), dtype=complex), 0
            for batch in batches:
                if batch.num_rows:
                    acc += rotate_rows(complex_shapes(batch, "xs", "ys"), ref).sum(axis=0)
                    n += batch.num_rows
            if n:
                yield n, np.concatenate([acc.real, acc.imag])

        count, flat = gathered(summed_vectors(slim, [], fold), 2 * p)
        mean = unit(flat[:p] + 1j * flat[p:])
        shift = np.sqrt((np.abs(mean - ref) ** 2).sum())
        previous, ref = ref, mean
        if shift < tol:
            break
    aligned = aligned_columns(base, previous)
    return Consensus(aligned, np.column_stack([ref.real, ref.imag]), done, count, base)


@dataclass
class GroupedConsensus:
    """Per-group consensus: aligned rows and one row per group with its mean."""

    aligned: DataFrame
    means: DataFrame  # group, mean_x, mean_y, n, n_iterations
    cached: DataFrame

    def release(self) -> None:
        self.cached.unpersist()


def consensus_by_group(df: DataFrame, group: str, order: Order = ("ord",), max_iter: int = 100,
                       tol: float = 1e-8, label: str | None = None) -> GroupedConsensus:
    """One consensus per group, all groups iterating together.

    Groups that have converged are left alone. The references travel to the
    tasks while their measured size fits the broadcast bound; beyond it they
    stay a table joined to the rows in every pass."""
    spark = df.sparkSession
    base = standardized(df, label).filter(F.col(group).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    starts = base.groupBy(group).agg(*_starts(order))
    span = starts.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("groups")).first()
    p = _common_points([span])
    # a reference is 2p numbers; sums and the previous reference double it twice
    if span["groups"] * p * 2 * 8 * 4 > broadcast_bytes(spark):
        return _joined_consensus(base, starts, group, p, max_iter, tol)
    rows = starts.collect()
    names = [r[group] for r in rows]
    refs = np.array([np.array(r["s"]["xs"]) + 1j * np.array(r["s"]["ys"]) for r in rows])
    previous = refs.copy()
    passes = np.zeros(len(names), dtype=int)
    active = np.ones(len(names), dtype=bool)
    slim = base.select(group, "xs", "ys")
    for step in range(1, max_iter + 1):
        live = [i for i in range(len(names)) if active[i]]
        fold = _group_fold(group, pa.array([names[i] for i in live]), refs[live])
        sums = np.zeros((len(live), 2 * p))
        at = {names[i]: k for k, i in enumerate(live)}
        for r in summed_vectors(slim, [group], fold).collect():
            sums[at[r[group]], r["pos"]] = r["total"]
        for k, i in enumerate(live):
            mean = unit(sums[k, :p] + 1j * sums[k, p:])
            shift = np.sqrt((np.abs(mean - refs[i]) ** 2).sum())
            previous[i], refs[i], passes[i] = refs[i], mean, step
            active[i] = shift >= tol
        if not active.any():
            break
    keys = pa.array(names)

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        at_row = pc.index_in(batch.column(group), value_set=keys).to_numpy(zero_copy_only=False)
        z = rotate_rows(complex_shapes(batch, "xs", "ys"), previous[at_row.astype(int)])
        return [list_column(z.real), list_column(z.imag)]

    aligned = append_arrow(base, ALIGNED, kernel, drop=("xs", "ys"))
    means = spark.createDataFrame(
        [
            (names[i], refs[i].real.tolist(), refs[i].imag.tolist(), rows[i]["n"], int(passes[i]))
            for i in range(len(names))
        ],
        T.StructType([
            base.schema[group],
            T.StructField("mean_x", DOUBLES), T.StructField("mean_y", DOUBLES),
            T.StructField("n", T.LongType()), T.StructField("n_iterations", T.IntegerType()),
        ]),
    )
    return GroupedConsensus(aligned, means, base)


def _group_fold(group: str, keys: pa.Array, refs: np.ndarray):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        acc = np.zeros(refs.shape, dtype=complex)
        count = np.zeros(len(refs), dtype=np.int64)
        for batch in batches:
            at = pc.index_in(batch.column(group), value_set=keys)
            keep = at.is_valid().to_numpy(zero_copy_only=False)
            if not keep.any():
                continue
            index = at.drop_null().to_numpy(zero_copy_only=False).astype(int)
            z = rotate_rows(complex_shapes(batch, "xs", "ys")[keep], refs[index])
            np.add.at(acc, index, z)
            np.add.at(count, index, 1)
        for i in np.flatnonzero(count):
            yield keys[int(i)].as_py(), int(count[i]), np.concatenate([acc[i].real, acc[i].imag])

    return fold


def _joined_consensus(base: DataFrame, starts: DataFrame, group: str, p: int, max_iter: int, tol: float) -> GroupedConsensus:
    """The same iteration with the references held in a table."""
    spread = lambda v: F.transform(F.sequence(F.lit(0), F.lit(p - 1)), v)
    state = starts.select(
        group, "n", F.col("s.xs").alias("rx"), F.col("s.ys").alias("ry"),
        F.col("s.xs").alias("px"), F.col("s.ys").alias("py"),
        F.lit(0).alias("n_iterations"), F.lit(True).alias("active"),
    )
    state = pinned(state)
    for step in range(1, max_iter + 1):
        live = state.filter("active").select(group, F.col("rx").alias("__rx"), F.col("ry").alias("__ry"))
        turned = rotated_onto(base.select(group, "xs", "ys").join(live, group), "__rx", "__ry")
        points = exploded_points(turned, [group])
        sums = points.groupBy(group, F.col("i").alias("pos")).agg(F.avg("px").alias("x"), F.avg("py").alias("y"))
        # p entries per group, by construction
        shape = sums.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("m"))
        raw = shape.select(group, spread(lambda i: F.get("m", i)["x"]).alias("mx"), spread(lambda i: F.get("m", i)["y"]).alias("my"))
        scaled = raw.withColumn("k", 1.0 / F.sqrt(G.dot(F.col("mx"), F.col("mx")) + G.dot(F.col("my"), F.col("my"))))
        mean = scaled.select(group, G.scaled(F.col("mx"), F.col("k")).alias("mx"), G.scaled(F.col("my"), F.col("k")).alias("my"))
        joined = state.join(mean, group, "left")
        moved = F.col("mx").isNotNull()
        shift = G.shape_distance(F.col("mx"), F.col("my"), F.col("rx"), F.col("ry"))
        state = pinned(joined.select(
            group, "n",
            F.when(moved, F.col("mx")).otherwise(F.col("rx")).alias("rx"),
            F.when(moved, F.col("my")).otherwise(F.col("ry")).alias("ry"),
            F.when(moved, F.col("rx")).otherwise(F.col("px")).alias("px"),
            F.when(moved, F.col("ry")).otherwise(F.col("py")).alias("py"),
            F.when(moved, F.lit(step)).otherwise(F.col("n_iterations")).alias("n_iterations"),
            F.when(moved, shift >= tol).otherwise(F.lit(False)).alias("active"),
        ))
        if state.filter("active").isEmpty():
            break
    refs = state.select(group, F.col("px").alias("__rx"), F.col("py").alias("__ry"))
    joined = base.join(refs, group)
    aligned = rotated_onto(joined, "__rx", "__ry")
    means = state.select(group, F.col("rx").alias("mean_x"), F.col("ry").alias("mean_y"), "n", "n_iterations")
    return GroupedConsensus(aligned, means, base)


def reference_shape(df: DataFrame, order: str = "ord", n_points: int | None = None, drop_point: int | None = None,
                    max_iter: int = 100) -> np.ndarray:
    """Frozen reference: consensus of the shapes with the expected landmark count."""
    expected = n_points if n_points is not None else majority_point_count(df, tie="smallest", order=order)
    result = consensus(df.filter(F.size("x") == expected), [order], max_iter)
    result.release()
    shape = result.mean_shape
    return shape if drop_point is None else np.delete(shape, drop_point, axis=0)

