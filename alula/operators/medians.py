"""Exact medians per group, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alula.operators.ordering import lookup
from alula.session import hot_group_rows, pinned

#: Distinct values of a group that one task may hold for the built-in median.
MEDIAN_ROWS = 200_000
#: Bits that a pass of the selection settles, from the highest; 64 in all.
PASSES = (4, 10, 10, 10, 10, 10, 10)


def grouped_medians(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column], heaviest: int | None = None
) -> DataFrame:
    """Exact median of each value per key.

    Groups of at most ``MEDIAN_ROWS`` rows (and the hot-group limit) use the built-in exact aggregate. If some group is
    larger, its middle order statistics are found by radix selection, which never gathers a group anywhere. Pass
    ``heaviest`` when the largest group size is already known."""
    limit = min(hot_group_rows(df.sparkSession), MEDIAN_ROWS)
    top = heaviest
    if top is None:
        top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if top <= limit:
        return df.groupBy(*keys).agg(*[F.median(v).alias(n) for n, v in values.items()])
    result = None
    for name, value in values.items():
        one = _selected_median(df.select(*keys, value.cast("double").alias("__v")), keys, name)
        result = one if result is None else lookup(result, one, keys)
    return result


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Doubles as long integers in the same order: the bits of a negative one are turned round, and zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def from_ordered_bits(codes: np.ndarray) -> np.ndarray:
    return (codes ^ ((codes >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


@F.arrow_udf(T.LongType())
def _coded(values: pa.Array) -> pa.Array:
    return pa.array(ordered_bits(np.ascontiguousarray(values.to_numpy(zero_copy_only=False), dtype=np.float64)), pa.int64())


@F.arrow_udf(T.DoubleType())
def _decoded(codes: pa.Array) -> pa.Array:
    return pa.array(from_ordered_bits(codes.to_numpy(zero_copy_only=False).astype(np.int64)), pa.float64())


def _selected_median(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Both middle ranks of every group together, by radix selection on the values' ordered bits.

    A pass counts the next bits of the values that share a rank's bits so far, and the counts say which bits the rank has.
    Seven passes settle all 64 bits, whatever the values; a pass shuffles counts only, at most 1024 per rank."""
    base = pinned(df.filter(F.col("__v").isNotNull()).select(*keys, _coded("__v").alias("__c")))
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ranks = F.array_distinct(F.array(F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)))
    state = sizes.select(*keys, F.explode(ranks).alias("rank")).select(*keys, "rank", F.col("rank").alias("want"), F.lit(0).cast("long").alias("prefix"))
    settled = 0
    # with the sign bit turned round, unsigned digits are in order
    unsigned = F.col("__c").bitwiseXOR(F.lit(-(1 << 63)))
    for width in PASSES:
        rest = 64 - settled - width
        digit = F.shiftrightunsigned(unsigned, rest).bitwiseAND(F.lit((1 << width) - 1))
        rows = lookup(base, state, keys, "inner")
        if settled:
            rows = rows.filter(F.shiftrightunsigned(unsigned, 64 - settled) == F.col("prefix"))
        counts = rows.groupBy(*keys, "rank", "want", "prefix", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        bins = counts.groupBy(*keys, "rank", "want", "prefix").agg(F.sort_array(F.collect_list(F.struct("digit", "n"))).alias("bins"))
        none = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("digit"))
        hit = F.aggregate(
            "bins", none,
            lambda a, b: F.when(a["digit"].isNotNull(), a).when(a["seen"] + b["n"] >= F.col("want"), F.struct(a["seen"].alias("seen"), b["digit"].alias("digit")))
            .otherwise(F.struct((a["seen"] + b["n"]).alias("seen"), a["digit"].alias("digit"))),
        )
        found = bins.withColumn("hit", hit)
        state = pinned(found.select(*keys, "rank", (F.col("want") - F.col("hit.seen")).alias("want"), F.shiftleft("prefix", width).bitwiseOR(F.col("hit.digit")).alias("prefix")))
        settled += width
    values = state.select(*keys, _decoded(F.col("prefix").bitwiseXOR(F.lit(-(1 << 63)))).alias("__m"))
    # halves are added, so that two large values do not overflow
    middle = F.when(F.count(F.lit(1)) == 1, F.max("__m")).otherwise(F.sum(F.col("__m") / F.lit(2)))
    return values.groupBy(*keys).agg(middle.alias(name))
