"""Robust per-group outliers of aligned shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.operators.arrow import exploded_points
from alula.operators.medians import grouped_medians
from alula.operators.ordering import Order, lookup
from alula.operators.superimposition import consensus_by_group
from alula.session import pinned

# Fixed values of the published rule.
MIN_GROUP_SIZE = 10
MAD_FACTOR = 6.0
HEAVY_FRACTION = 0.55


def group_sizes(df: DataFrame, group: str, min_group: int) -> tuple[DataFrame, int]:
    """Groups large enough to judge, and the size of the largest."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_group)
    return sizes.select(group), sizes.agg(F.max("__n")).first()[0] or 0


def landmark_outliers(
    aligned: DataFrame, group: str, row_id: str, mad_factor: float = MAD_FACTOR, min_group: int = MIN_GROUP_SIZE
) -> DataFrame:
    """One row per (shape, landmark) with its distance, threshold and flag.

    Groups below ``min_group`` are left out (never flagged)."""
    large, heaviest = group_sizes(aligned, group, min_group)
    judged = lookup(aligned.select(row_id, group, "ax", "ay"), large, [group], "inner")
    return _outlying_points(judged, group, row_id, mad_factor, heaviest)


def _outlying_points(judged: DataFrame, group: str, row_id: str, mad_factor: float, heaviest: int) -> DataFrame:
    points = exploded_points(judged, [row_id, group])
    keys = [group, "i"]
    centre = grouped_medians(points, keys, {"mx": F.col("px"), "my": F.col("py")}, heaviest)
    dx, dy = F.col("px") - F.col("mx"), F.col("py") - F.col("my")
    # three more passes follow: keep the distances instead of realigning each time
    far = pinned(lookup(points, centre, keys).select(row_id, *keys, F.sqrt(dx * dx + dy * dy).alias("dist")))
    middle = grouped_medians(far, keys, {"md": F.col("dist")}, heaviest)
    spread = lookup(far, middle, keys)
    mad = grouped_medians(spread, keys, {"mad": F.abs(F.col("dist") - F.col("md"))}, heaviest)
    limits = lookup(middle, mad, keys).select(*keys, (F.col("md") + mad_factor * F.col("mad")).alias("threshold"))
    return lookup(far, limits, keys).withColumn("is_outlier", F.col("dist") > F.col("threshold"))


def _per_shape(points: DataFrame, row_id: str, heavy_fraction: float) -> DataFrame:
    counts = points.groupBy(row_id).agg(
        F.count_if("is_outlier").alias("n_outlier_landmarks"), F.count(F.lit(1)).alias("__p")
    )
    return counts.withColumn("heavy", F.col("n_outlier_landmarks") >= heavy_fraction * F.col("__p")).drop("__p")


def _everyone(rows: DataFrame, flagged: DataFrame, row_id: str, group: str) -> DataFrame:
    return rows.select(row_id, group).join(flagged, row_id, "left").select(
        row_id,
        group,
        F.coalesce("n_outlier_landmarks", F.lit(0)).alias("n_outlier_landmarks"),
        F.coalesce("heavy", F.lit(False)).alias("heavy"),
    )


def shape_flags(
    aligned: DataFrame,
    group: str,
    row_id: str,
    mad_factor: float = MAD_FACTOR,
    heavy_fraction: float = HEAVY_FRACTION,
    min_group: int = MIN_GROUP_SIZE,
) -> DataFrame:
    """Per shape: number of outlying landmarks and whether the whole shape is suspect."""
    points = landmark_outliers(aligned, group, row_id, mad_factor, min_group)
    return _everyone(aligned, _per_shape(points, row_id, heavy_fraction), row_id, group)


def flag_by_group(
    df: DataFrame,
    group: str = "species",
    row_id: str = "ord",
    order: Order = ("ord",),
    max_iter: int = 100,
    mad_factor: float = MAD_FACTOR,
    heavy_fraction: float = HEAVY_FRACTION,
    min_group: int = MIN_GROUP_SIZE,
) -> DataFrame:
    """Consensus per group, then the robust rule on the aligned shapes.

    Groups below ``min_group`` are not superimposed at all; they come back unflagged."""
    large, heaviest = group_sizes(df, group, min_group)
    if not heaviest:
        return df.select(row_id, group, F.lit(0).cast("long").alias("n_outlier_landmarks"), F.lit(False).alias("heavy"))
    fitted = consensus_by_group(df.join(large, group, "left_semi"), group, order, max_iter)
    points = _outlying_points(fitted.aligned.select(row_id, group, "ax", "ay"), group, row_id, mad_factor, heaviest)
    return _everyone(df, _per_shape(points, row_id, heavy_fraction), row_id, group)
