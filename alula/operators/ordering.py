"""First/last rows, running totals and numbering that survive heavy keys.

"First in file order" decides most ties in this domain, so each operator takes
explicit order columns. First and latest rows are aggregates (partial sums on
the map side, no per-key sort); running totals choose between one window per
key and a range-split two-step plan after looking at the key sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from alula.session import hot_group_rows, pinned

Order = Sequence["str | Column"]


def as_columns(names: Order) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def order_key(order: Order) -> Column:
    """One comparable value for a list of order columns.

    Order columns hold no NULL. A single column is used as it is, which keeps
    ``min`` and ``max`` over numbers in the hash aggregate."""
    if len(order) == 1:
        return as_columns(order)[0]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(as_columns(order))])


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality over several keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def evaluated_once(df: DataFrame) -> DataFrame:
    """Keeps later filters from being merged into the expressions of ``df``.

    A one-row explode is a boundary the optimizer does not move predicates
    across, so long expressions are computed once per row."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("r")).select("r.*")


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """NULL-safe many-to-one join that keeps the key columns of ``rows``."""
    renamed = table.select([F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in table.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return rows.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def _edge_rows(df: DataFrame, keys: Sequence[str], order: Order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(pick(F.struct(*rest), order_key(order)).alias("__row"))
    return packed.select(*keys, "__row.*").select(df.columns)


def first_rows(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key: the first in the given order."""
    return _edge_rows(df, keys, order, F.min_by)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per key: the last in the given order."""
    return _edge_rows(df, keys, order, F.max_by)


def with_repeats(
    df: DataFrame, keys: Sequence[str], order: Order, eligible: Column | None = None, out: str = "is_repeat"
) -> DataFrame:
    """Marks every row that comes after the first (eligible) row of its key.

    Only keys that really repeat are joined back, so the joined side is as
    small as the number of duplicated keys."""
    source = df if eligible is None else df.filter(eligible)
    firsts = (
        source.groupBy(*keys)
        .agg(F.min(order_key(order)).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
        .drop("__n")
    )
    later = F.coalesce(order_key(order) > F.col("__first"), F.lit(False))
    if eligible is not None:
        later = later & F.coalesce(eligible, F.lit(False))
    return lookup(df, firsts, keys).withColumn(out, later).drop("__first")


def _heaviest(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[bool, int]:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("top"), F.sum("n").alias("total")).first()
    return (row["top"] or 0) > limit, row["total"] or 0


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Order, measures: Mapping[str, Column], sizes_from: DataFrame | None = None
) -> DataFrame:
    """Inclusive running sums of integer measures per key, in ``order``.

    While every key fits comfortably in one task this is a plain window. When
    one key is heavier than the limit, rows are range-split on (key, order),
    each slice is summed on its own and the sums of earlier slices are added.
    The split is pinned first because both steps must see the same slices.
    ``sizes_from`` is a cheaper frame with the same keys and at least as many
    rows, for looking at the sizes."""
    spark = df.sparkSession
    limit = hot_group_rows(spark)
    heavy, total = _heaviest(df if sizes_from is None else sizes_from, keys, limit)
    ordered = as_columns(order)
    if not heavy:
        # a constant key keeps Spark from treating the frame as one unkeyed window
        window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*ordered)
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *[F.sum(m).over(window).cast("long").alias(n) for n, m in measures.items()])

    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * ceil(total / limit))
    placed = pinned(
        df.select("*", *[m.alias(f"__m_{n}") for n, m in measures.items()])
        .repartitionByRange(slices, *[F.col(k) for k in keys], *ordered)
        .withColumn("__slice", F.spark_partition_id())
    )
    part_keys = ["__slice", *keys]
    inside = Window.partitionBy(*part_keys).orderBy(*ordered)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(f"__m_{n}").over(inside).alias(n) for n in measures])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__slice")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*part_keys)
        .agg(*[F.sum(f"__m_{n}").alias(f"__t_{n}") for n in measures])
        .select(
            *part_keys,
            *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in measures],
        )
    )
    joined = lookup(local, offsets, part_keys)
    return joined.select(
        *df.columns, *[(F.col(n) + F.col(f"__o_{n}")).cast("long").alias(n) for n in measures]
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Order, out: str, start: int = 1, sizes_from: DataFrame | None = None
) -> DataFrame:
    """Dense numbering per key (or over the whole table for no keys)."""
    counted = running_totals(df, keys, order, {out: F.lit(1)}, sizes_from)
    return counted if start == 1 else counted.withColumn(out, F.col(out) + (start - 1))


def sequential_ids(df: DataFrame, out: str = "tps_id", by: str = "photo_id", tie: Order = ("ord",)) -> DataFrame:
    """Ids 1..N by photo id (missing = empty text); replaces an existing column."""
    base = df.drop(out)
    return numbered(base, [], [F.coalesce(F.col(by), F.lit("")), *tie], out)


def failure_runs(df: DataFrame, order: Order, failed: Column) -> DataFrame:
    """Lengths of uninterrupted runs of failed rows, in the given order.

    The count of non-failed rows seen so far is constant inside a run, so one
    running total plus one aggregate finds every run."""
    bad = F.coalesce(failed, F.lit(False))
    marked = running_totals(df, [], order, {"run_key": F.when(bad, 0).otherwise(1)})
    return (
        marked.filter(bad)
        .groupBy("run_key")
        .agg(F.count(F.lit(1)).alias("run_length"), F.min(order_key(order)).alias("run_start"))
    )


def check_failure_runs(df: DataFrame, order: Order, failed: Column, limit: int = 5) -> None:
    """Raises when ``limit`` or more rows fail in a row."""
    worst = failure_runs(df, order, failed).agg(F.max("run_length")).first()[0] or 0
    if worst >= limit:
        raise RuntimeError(f"{worst} consecutive unreadable items (limit {limit})")
