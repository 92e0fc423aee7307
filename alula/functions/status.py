"""Row-level status rules and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from alula.schema import CORNER_COLUMNS, FAILED, OK, SUSPECT


def should_skip(
    status: Column, overwrite: Column, retry_failed: Column, output_exists: Column
) -> Column:
    """Resume rule over the latest logged status (NULL = never processed)."""
    return (
        F.when(status.isNull(), F.lit(False))
        .when(status.isin(OK, SUSPECT), output_exists & ~overwrite)
        .when(status == FAILED, ~retry_failed)
        .otherwise(F.lit(False))
    )


def has_full_date(yyyy: Column, mm: Column, dd: Column) -> Column:
    return yyyy.isNotNull() & mm.isNotNull() & dd.isNotNull()


def is_atypical(distance: Column, threshold: float = 0.3) -> Column:
    return distance > threshold


def is_low_confidence(confidence: Column, threshold: float = 0.6) -> Column:
    return confidence < threshold


def review_match(status: Column, wanted: Sequence[str] | None, needle: str, *fields: Column) -> Column:
    """Status filter plus case-insensitive substring over some id columns."""
    keep = status.isin(list(wanted)) if wanted else F.lit(True)
    if needle:
        found = F.lit(False)
        for field in fields:
            found = found | F.coalesce(F.lower(field).contains(needle.lower()), F.lit(False))
        keep = keep & found
    return keep


def quad_problem(columns: Sequence[str] = tuple(CORNER_COLUMNS), clip: bool = False) -> Column:
    """Reason a four-corner box is unusable, NULL when it is fine."""
    values = [F.col(c).try_cast("double") for c in columns]
    absent = F.lit(False)
    not_number = F.lit(False)
    not_finite = F.lit(False)
    outside = F.lit(False)
    for name, v in zip(columns, values):
        absent = absent | F.col(name).isNull() | F.coalesce(F.isnan(v), F.lit(False))
        not_number = not_number | v.isNull()
        not_finite = not_finite | F.coalesce(F.abs(v) == float("inf"), F.lit(False))
        outside = outside | F.coalesce((v < 0.0) | (v > 1.0), F.lit(False))
    if clip:
        values = [F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) for v in values]
    xs, ys = values[0::2], values[1::2]
    area2 = F.lit(0.0)
    for k in range(4):
        area2 = area2 + xs[k] * ys[(k + 1) % 4] - ys[k] * xs[(k + 1) % 4]
    rule = (
        F.when(absent, "missing coordinate")
        .when(not_number, "invalid coordinate")
        .when(not_finite, "non-finite coordinate")
    )
    if not clip:
        rule = rule.when(outside, "coordinate outside [0,1]")
    return rule.when(F.abs(area2) < 1e-10, "degenerate quadrilateral")
