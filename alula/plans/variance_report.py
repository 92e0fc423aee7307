"""Nested shape-variance report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.operators.dataset import (
    EmptyDatasetError, complete_individuals, filtered, with_complete_levels, with_large_groups,
)
from alula.operators.superimposition import consensus
from alula.operators.variance import nested_anova, shape_vector


def variance_report(
    data: DataFrame, levels: Sequence[str], devices: Sequence[str] | None = None, balanced_devices: bool = False,
    min_top_level: int = 5, n_perm: int = 0, seed: int = 0, max_iter: int = 100, order: str = "ord",
) -> DataFrame:
    """Filters, one consensus over what is left, nested sums of squares."""
    rows = filtered(data, devices=devices)
    if balanced_devices:
        if not devices:
            raise ValueError("balanced_devices needs devices")
        rows = complete_individuals(rows, devices)
    rows = with_large_groups(with_complete_levels(rows, levels), levels[0], min_top_level)
    if rows.limit(3).count() < 3:
        raise EmptyDatasetError("fewer than 3 specimens after filtering")
    fitted = consensus(rows.select(order, *levels, "x", "y"), [order], max_iter, label=order)
    vectors = fitted.aligned.select(order, *[F.col(c) for c in levels], shape_vector().alias("v"))
    return nested_anova(vectors, levels, n_perm=n_perm, seed=seed, row_id=order)
