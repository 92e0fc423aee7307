"""Planar shape arithmetic on parallel ``x`` / ``y`` arrays.

In the plane the best rotation without reflection has a closed form. With
``A = sum(xs*xt + ys*yt)`` and ``B = sum(xs*yt - ys*xt)`` the angle is
``atan2(B, A)`` and the optimal scale numerator ``hypot(A, B)``, so alignment
stays a JVM expression and needs neither an SVD nor a Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda p, q: p * q))


def scaled(c: Column, factor: Column) -> Column:
    return F.transform(c, lambda v: v * factor)


def centered(c: Column) -> Column:
    mean = total(c) / F.size(c)
    return F.transform(c, lambda v: v - mean)


def centroid_size(x: Column, y: Column) -> Column:
    cx, cy = centered(x), centered(y)
    return F.sqrt(dot(cx, cx) + dot(cy, cy))


def interleaved(x: Column, y: Column) -> Column:
    """x1, y1, x2, y2, ..."""
    return F.flatten(F.zip_with(x, y, lambda a, b: F.array(a, b)))


def shape_distance(x: Column, y: Column, rx: Column, ry: Column) -> Column:
    dx = F.zip_with(x, rx, lambda a, b: (a - b) * (a - b))
    dy = F.zip_with(y, ry, lambda a, b: (a - b) * (a - b))
    return F.sqrt(total(dx) + total(dy))


def rotation_terms(xs: Column, ys: Column, xt: Column, yt: Column) -> tuple[Column, Column]:
    """(A, B) of the closed-form rotation of a centred source onto a target."""
    return dot(xs, xt) + dot(ys, yt), dot(xs, yt) - dot(ys, xt)


def dropped_point(c: Column, index: int) -> Column:
    """Array without its ``index``-th (0-based) entry."""
    return F.filter(c, lambda _, i: i != index)


def flipped_y(y: Column, height: Column) -> Column:
    return F.transform(y, lambda v: height - v)


def count_outside(x: Column, y: Column, width: float, height: float) -> Column:
    bad = F.filter(
        F.arrays_zip(x.alias("x"), y.alias("y")),
        lambda p: (p["x"] < 0) | (p["x"] >= width) | (p["y"] < 0) | (p["y"] >= height),
    )
    return F.size(bad)


def similarity_fit(xs: Column, ys: Column, xt: Column, yt: Column) -> Column:
    """struct(angle, scale, cx, cy, tx, ty) of the best similarity without reflection.

    target = scale * R(angle) (source - (cx, cy)) + (tx, ty). Coincident source
    points have no fit and stop the query."""
    sx, sy, tx, ty = (centered(c) for c in (xs, ys, xt, yt))
    a, b = rotation_terms(sx, sy, tx, ty)
    power = dot(sx, sx) + dot(sy, sy)
    problem = F.raise_error(F.lit("degenerate specimen: landmarks coincide (zero variance)")).cast("double")
    return F.struct(
        F.atan2(b, a).alias("angle"),
        (F.sqrt(a * a + b * b) / F.when(power == 0, problem).otherwise(power)).alias("scale"),
        *[(total(c) / F.size(c)).alias(n) for c, n in ((xs, "cx"), (ys, "cy"), (xt, "tx"), (yt, "ty"))],
    )
