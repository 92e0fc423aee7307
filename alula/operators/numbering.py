"""Renumbering of unordered landmark clouds against a frozen reference shape.

The operator is a table job: Arrow batches of clouds, each batch solved for all
its rows and all starts at once. The batched assignment solver is a small numpy
helper; Spark spreads the batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alula.operators.arrow import append_arrow
from alula.operators.logs import status_counts
from alula.operators.medians import grouped_medians
from alula.operators.ordering import Order
from alula.operators.outliers import HEAVY_FRACTION, MAD_FACTOR, MIN_GROUP_SIZE, flag_by_group
from alula.schema import DOUBLES, FAILED, OK, SUSPECT

# Fixed values of the published method.
START_ANGLES = (0, 90, 180, 270)
MIRRORS = (False, True)
MAX_ROUNDS = 15

#: Entries of the cost tables that are solved together: what a task holds does not grow with its rows.
CELLS = 1 << 21

Method = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def assign_batch(cost: np.ndarray) -> np.ndarray:
    """Minimum-cost assignment of many equal-size square problems.

    cost: (m, n, n). Returns the column of every row, (m, n). All problems grow
    their shortest augmenting paths in step, after a greedy start on row minima."""
    m, n, _ = cost.shape
    u = cost.min(axis=2)
    reduced = cost - u[:, :, None]
    v = reduced.min(axis=1)
    reduced -= v[:, None, :]
    tight = reduced <= 0
    del reduced
    col_of = np.full((m, n), -1)
    row_of = np.full((m, n), -1)
    open_col = np.ones((m, n), dtype=bool)
    for i in range(n):
        usable = tight[:, i] & open_col
        r = np.flatnonzero(usable.any(axis=1))
        j = usable[r].argmax(axis=1)
        open_col[r, j] = False
        row_of[r, j] = i
        col_of[r, i] = j
    for i in range(n):
        todo = np.flatnonzero(col_of[:, i] < 0)
        if len(todo):
            _augment(cost, u, v, col_of, row_of, todo, i)
    return col_of


def _augment(cost, u, v, col_of, row_of, todo, start) -> None:
    """Matches row ``start`` in the problems ``todo`` along cheapest alternating paths.

    Finished problems are masked, and dropped from the working arrays once they
    are a third of them. A closed column gets potential -inf, so it is never
    reached again."""
    k, n = len(todo), cost.shape[1]
    all_path, all_lift = np.empty((k, n), dtype=np.int64), np.empty((k, n))
    all_end, all_cost = np.empty(k, dtype=np.int64), np.empty(k)
    at, where = np.arange(k), todo
    vl, ul = v[todo], u[todo]
    open_, final = np.full((k, n), np.inf), np.zeros((k, n))
    closed, path = np.zeros((k, n), dtype=bool), np.zeros((k, n), dtype=np.int64)
    row, reached = np.full(k, start), np.zeros(k)
    alive, idx = np.ones(k, dtype=bool), np.arange(k)
    while True:
        slack = cost[where, row]
        slack += (reached - ul[idx, row])[:, None]
        slack -= vl
        better = slack < open_
        np.copyto(open_, slack, where=better)
        np.copyto(path, row[:, None], where=better)
        j = open_.argmin(axis=1)
        run = np.flatnonzero(alive)
        jr = j[run]
        reached[run] = open_[run, jr]
        final[run, jr] = reached[run]
        closed[run, jr] = True
        open_[run, jr] = np.inf
        vl[run, jr] = -np.inf
        owner = row_of[where[run], jr]
        ended = owner < 0
        e = run[ended]
        if len(e):
            g = at[e]
            all_end[g], all_cost[g], all_path[g] = j[e], reached[e], path[e]
            all_lift[g] = np.where(closed[e], reached[e][:, None] - final[e], 0.0)
            alive[e] = False
            vl[e] = -np.inf
        row[run[~ended]] = owner[~ended]
        left = int(alive.sum())
        if not left:
            break
        if 3 * left < 2 * len(alive):
            keep = np.flatnonzero(alive)
            at, where, vl, ul, open_, final, closed, path, row, reached = (
                a[keep] for a in (at, where, vl, ul, open_, final, closed, path, row, reached)
            )
            alive, idx = np.ones(left, dtype=bool), np.arange(left)
    # potentials: closed columns down, their rows and the start row up
    v[todo] -= all_lift
    owners = row_of[todo]
    rise = np.zeros((k, n))
    np.put_along_axis(rise, np.where(owners < 0, start, owners), np.where(owners < 0, 0.0, all_lift), axis=1)
    rise[:, start] = all_cost
    u[todo] += rise
    # flip the path from the free column back to the start row
    live, j = np.arange(k), all_end
    while len(live):
        i = all_path[live, j]
        row_of[todo[live], j] = i
        before = col_of[todo[live], i]
        col_of[todo[live], i] = j
        more = i != start
        live, j = live[more], before[more]


def solved_together(points: int, starts: int = 1) -> int:
    """How many clouds of so many points are solved at once, from so many starts each."""
    return max(1, CELLS // (starts * points * points))


def squared_gaps(clouds: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Squared distance of every point of every cloud to every point of the reference."""
    out = clouds.real[:, :, None] - reference.real
    out *= out
    across = clouds.imag[:, :, None] - reference.imag
    across *= across
    out += across
    return out


def rotate_and_match(z: np.ndarray, reference: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Assignment alternated with a similarity fit, best of several starts.

    z: (m, n) complex clouds; reference: (n,) complex. Returns the order of the
    points (point ``order[r, k]`` is landmark k) and the mean squared residual.
    Every fit starts again from the original centred cloud, so two starts that
    agree on an assignment in the same round stay equal: only one continues."""
    m, n = z.shape
    centred = z - z.mean(axis=1, keepdims=True)
    power = (np.abs(centred) ** 2).sum(axis=1)
    starts = []
    for angle in START_ANGLES:
        turn = np.exp(1j * np.deg2rad(angle))
        for mirror in MIRRORS:
            starts.append(turn * (-np.conj(centred) if mirror else centred))
    k = len(starts)
    current = np.stack(starts, axis=1).reshape(m * k, n)
    source = np.repeat(centred, k, axis=0)
    weight = np.repeat(power, k)
    assigned = np.full((m * k, n), -1)
    live = survivors = np.arange(m * k)
    for _ in range(MAX_ROUNDS):
        found = assign_batch(squared_gaps(current[live], reference))
        same = (found == assigned[live]).all(axis=1)
        live, found = live[~same], found[~same]
        if not len(live):
            break
        assigned[live] = found
        _, first = np.unique(np.column_stack([live // k, found]), axis=0, return_index=True)
        first = np.sort(first)
        survivors = np.setdiff1d(survivors, np.delete(live, first), assume_unique=True)
        live, found = live[first], found[first]
        target = reference[found]
        middle = target.mean(axis=1, keepdims=True)
        factor = (np.conj(source[live]) * (target - middle)).sum(axis=1) / weight[live]
        current[live] = factor[:, None] * source[live] + middle
    # starts merged into an earlier one never win: they keep an unfinished fit
    settled = np.zeros(m * k, dtype=bool)
    settled[survivors] = True
    residual = np.where(settled, (np.abs(current - reference[assigned]) ** 2).mean(axis=1), np.inf).reshape(m, k)
    best = residual.argmin(axis=1)
    chosen = assigned.reshape(m, k, n)[np.arange(m), best]
    order = np.empty_like(chosen)
    np.put_along_axis(order, chosen, np.arange(n)[None, :].repeat(m, axis=0), axis=1)
    return order, residual[np.arange(m), best]


METHODS: dict[str, Method] = {"hungarian_umeyama": rotate_and_match}


def register_method(name: str, method: Method) -> None:
    """Adds a numbering method: (clouds, reference) -> (order, score)."""
    METHODS[name] = method


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
    return values, sizes, np.r_[0, np.cumsum(sizes)[:-1]]


def _gather(values: np.ndarray, first: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    return values[first[rows][:, None] + np.arange(width)]


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows hashed over all cores where the input is so small that it is read by fewer tasks than there are cores: solving costs far
    more than moving a row. Larger inputs are not shuffled."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        return df
    return df.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))), F.xxhash64(key))


def number_landmarks(
    df: DataFrame, reference: np.ndarray, method: str = "hungarian_umeyama", row_id: str = "ord"
) -> DataFrame:
    """Adds ``nx``/``ny`` (reference order), ``status``, ``registration_cost``, ``error_reason``.

    A cloud with another point count, or with all points in one place, is FAILED
    with infinite cost and keeps its original order."""
    zones = np.asarray(reference)[:, 0] + 1j * np.asarray(reference)[:, 1]
    n = len(zones)
    solve, together = METHODS[method], solved_together(n, len(START_ANGLES) * len(MIRRORS))

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        xs, sizes, first = _ragged(batch.column("x"))
        ys = batch.column("y").flatten().to_numpy(zero_copy_only=False)
        rows = len(sizes)
        status = np.full(rows, OK, dtype=object)
        reason = np.full(rows, "", dtype=object)
        cost = np.full(rows, np.inf)
        nx, ny = xs.copy(), ys.copy()
        wrong = np.flatnonzero(sizes != n)
        status[wrong] = FAILED
        for r in wrong:
            reason[r] = f"{sizes[r]} landmarks, {n} expected"
        fit = np.flatnonzero(sizes == n)
        if len(fit):
            z = _gather(xs, first, fit, n) + 1j * _gather(ys, first, fit, n)
            flat = np.abs(z - z.mean(axis=1, keepdims=True)).max(axis=1) == 0
            status[fit[flat]] = FAILED
            reason[fit[flat]] = "degenerate specimen: landmarks coincide"
            fit, z = fit[~flat], z[~flat]
        for lo in range(0, len(fit), together):
            part, cloud = fit[lo : lo + together], z[lo : lo + together]
            order, score = solve(cloud, zones)
            cost[part] = score
            slots = first[part][:, None] + np.arange(n)
            moved = np.take_along_axis(cloud, order, axis=1)
            nx[slots], ny[slots] = moved.real, moved.imag
        offsets = pa.array(np.r_[first, len(xs)].astype(np.int32))
        return [
            pa.ListArray.from_arrays(offsets, pa.array(nx)),
            pa.ListArray.from_arrays(offsets, pa.array(ny)),
            pa.array(status, type=pa.string()), pa.array(cost), pa.array(reason, type=pa.string()),
        ]

    fields = [
        T.StructField("nx", DOUBLES), T.StructField("ny", DOUBLES), T.StructField("status", T.StringType()),
        T.StructField("registration_cost", T.DoubleType()), T.StructField("error_reason", T.StringType()),
    ]
    return append_arrow(spread_rows(df, row_id), fields, kernel)


def renumber(
    landmarks: DataFrame,
    reference: np.ndarray,
    biology: DataFrame | None = None,
    method: str = "hungarian_umeyama",
    row_id: str = "ord",
    order: Order = ("ord",),
    mad_factor: float = MAD_FACTOR,
    heavy_fraction: float = HEAVY_FRACTION,
    min_group: int = MIN_GROUP_SIZE,
    max_iter: int = 100,
) -> DataFrame:
    """Numbered landmarks with status; with biology, atypical labelled shapes are SUSPECT.

    FAILED rows stay in the result (the log); ``usable`` tells which belong in
    the numbered landmark file."""
    numbered = number_landmarks(landmarks, reference, method, row_id)
    usable = F.col("status") != FAILED
    if biology is None:
        return numbered.withColumn("n_outlier_landmarks", F.lit(None).cast("long")).withColumn("usable", usable)
    species = biology.filter(F.col("species").isNotNull()).select("inv_id", "species")
    labelled = (
        numbered.filter(usable)
        .drop("species")
        .join(species, "inv_id")
        .select(row_id, *[c for c in order if isinstance(c, str) and c != row_id], "species",
                F.col("nx").alias("x"), F.col("ny").alias("y"))
    )
    flags = flag_by_group(labelled, "species", row_id, order, max_iter, mad_factor, heavy_fraction, min_group)
    joined = numbered.join(flags.select(row_id, "n_outlier_landmarks", "heavy"), row_id, "left")
    suspect = F.coalesce(F.col("heavy"), F.lit(False))
    return (
        joined.withColumn("status", F.when(suspect, SUSPECT).otherwise(F.col("status")))
        .drop("heavy")
        .withColumn("usable", usable)
    )


def numbering_log(result: DataFrame) -> DataFrame:
    return result.select(
        "photo_id", "inv_id", "tps_id", "image_path", "status", "registration_cost", "n_outlier_landmarks", "error_reason"
    )


def numbered_landmarks(result: DataFrame) -> DataFrame:
    """Usable rows with their coordinates replaced by the numbered ones."""
    keep = [c for c in result.columns if c not in ("nx", "ny", "usable", "status", "registration_cost",
                                                   "n_outlier_landmarks", "error_reason")]
    return result.filter("usable").select(
        *[F.col("nx").alias("x") if c == "x" else F.col("ny").alias("y") if c == "y" else F.col(c) for c in keep]
    )


# --- localisation error ------------------------------------------------------------------------------


def matched_distances(df: DataFrame, px: str, py: str, tx: str, ty: str) -> DataFrame:
    """Adds ``distances`` of the minimum-total-distance pairing, ``n_missed`` and ``n_spurious``."""

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        x1, n1, f1 = _ragged(batch.column(px))
        y1 = batch.column(py).flatten().to_numpy(zero_copy_only=False)
        x2, n2, f2 = _ragged(batch.column(tx))
        y2 = batch.column(ty).flatten().to_numpy(zero_copy_only=False)
        found: list[list[float]] = [[] for _ in range(len(n1))]
        shapes = np.unique(np.column_stack([n1, n2]), axis=0)
        for a, b in shapes:
            if a == 0 or b == 0:
                continue
            every = np.flatnonzero((n1 == a) & (n2 == b))
            together = solved_together(max(a, b))
            for lo in range(0, len(every), together):
                rows = every[lo : lo + together]
                p = _gather(x1, f1, rows, a) + 1j * _gather(y1, f1, rows, a)
                t = _gather(x2, f2, rows, b) + 1j * _gather(y2, f2, rows, b)
                dist = np.abs(p[:, :, None] - t[:, None, :])
                size = max(a, b)
                square = np.zeros((len(rows), size, size))
                square[:, :a, :b] = dist
                col = assign_batch(square)[:, :a]
                real = col < b
                picked = np.take_along_axis(dist, np.minimum(col, b - 1)[:, :, None], axis=2)[:, :, 0]
                for r, d, ok in zip(rows, picked, real):
                    found[r] = d[ok].tolist()
        matched = np.minimum(n1, n2)
        return [
            pa.array(found, type=pa.list_(pa.float64())),
            pa.array((n2 - matched).astype(np.int32)),
            pa.array((n1 - matched).astype(np.int32)),
        ]

    fields = [
        T.StructField("distances", DOUBLES), T.StructField("n_missed", T.IntegerType()),
        T.StructField("n_spurious", T.IntegerType()),
    ]
    return append_arrow(df, fields, kernel)


def localization_error(matched: DataFrame, status: Column | None = None) -> DataFrame:
    """One row: counts, mean and median error, shares within 5 and 10 pixels."""
    tag = F.lit(0).alias("__all")
    per_row = matched.select(tag, "distances", "n_missed", "n_spurious", (status if status is not None else F.lit(OK)).alias("status"))
    rows = per_row.groupBy("__all").agg(
        F.count(F.lit(1)).alias("n_specimens"),
        *status_counts(F.col("status"))[1:],
        F.sum(F.size("distances")).cast("long").alias("n_matched_points"),
        F.sum("n_missed").alias("n_missed_points"),
        F.sum("n_spurious").alias("n_spurious_points"),
    )
    points = per_row.select("__all", F.explode("distances").alias("d"))
    errors = points.groupBy("__all").agg(
        F.avg("d").alias("mean_error_px"),
        F.avg((F.col("d") <= 5).cast("int")).alias("pct_within_5px"),
        F.avg((F.col("d") <= 10).cast("int")).alias("pct_within_10px"),
    )
    middle = grouped_medians(points, ["__all"], {"median_error_px": F.col("d")})
    return rows.join(errors, "__all", "left").join(middle, "__all", "left").drop("__all", "skipped")

