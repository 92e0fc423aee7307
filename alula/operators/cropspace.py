"""Landmark coordinates between raw-image space and the normalised crop.

The geometry of a crop depends on four box corners and the image size only, so
it is a table of ten numbers per photo; moving landmarks is a join and two
affine expressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.functions.shapes import count_outside
from alula.schema import CORNER_COLUMNS, OK, SUSPECT

# Defaults of the crop step.
PADDING = 0.10
OUT_WIDTH, OUT_HEIGHT = 512, 256
RATIO_SLACK = 0.02

TRANSFORM_TYPE = (
    "m00 double, m01 double, m02 double, m10 double, m11 double, m12 double, "
    "left double, top double, right double, bottom double, aspect_ratio double, valid boolean"
)


def _enclosing_rectangle(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Smallest rectangle around four points: corners, side lengths, long direction.

    Its side lies along a line through two of the points, so six directions
    are enough to look at."""
    pairs = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    d = np.stack([p[:, b] - p[:, a] for a, b in pairs], axis=1)
    length = np.linalg.norm(d, axis=2, keepdims=True)
    e = np.where(length > 0, d / np.where(length > 0, length, 1.0), np.array([1.0, 0.0]))
    f = np.stack([-e[..., 1], e[..., 0]], axis=2)
    along = np.einsum("rkc,rpc->rkp", e, p)
    across = np.einsum("rkc,rpc->rkp", f, p)
    lo_a, hi_a = along.min(axis=2), along.max(axis=2)
    lo_f, hi_f = across.min(axis=2), across.max(axis=2)
    best = ((hi_a - lo_a) * (hi_f - lo_f)).argmin(axis=1)
    r = np.arange(len(p))
    e, f = e[r, best], f[r, best]
    lo_a, hi_a, lo_f, hi_f = lo_a[r, best], hi_a[r, best], lo_f[r, best], hi_f[r, best]
    corners = np.stack(
        [a[:, None] * e + b[:, None] * f for a, b in ((lo_a, lo_f), (hi_a, lo_f), (hi_a, hi_f), (lo_a, hi_f))], axis=1
    )
    w, h = hi_a - lo_a, hi_f - lo_f
    direction = np.where((w >= h)[:, None], e, f)
    return corners, w, h, direction


def _axis_window(middle: np.ndarray, want: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of a window on one axis: whole pixels around the middle, kept within [0, limit]."""
    start, end = np.rint(middle - want / 2), np.rint(middle + want / 2)
    length = np.minimum(end - start, limit)
    return np.clip(start, 0.0, limit - length), length


def _fitted_size(size: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Size of the window of the wanted ratio for each (width, height), and whether it is a larger one.

    A size near the ratio stays. Else the first of three candidates that fits inside is taken (same width, same height); where rounding
    lets neither fit, both sides take their larger value."""
    by_width = np.stack([size[:, 0], np.maximum(1, np.rint(size[:, 0] / ratio))], axis=1)
    by_height = np.stack([np.maximum(1, np.rint(size[:, 1] * ratio)), size[:, 1]], axis=1)
    candidates = np.stack([size, by_width, by_height, np.maximum(by_width, by_height)], axis=1)
    suits = (candidates <= size[:, None, :]).all(axis=2)
    suits[:, 0] = np.abs(size[:, 0] / np.maximum(size[:, 1], 1) - ratio) <= RATIO_SLACK
    suits[:, 3] = True
    choice = suits.argmax(axis=1)
    return candidates[np.arange(len(size)), choice], choice == 3


def window_geometry(corners: np.ndarray, width: np.ndarray, height: np.ndarray, padding: float, ratio: float) -> pd.DataFrame:
    """Affine map and crop window for rows of eight normalised corner values."""
    p = corners.astype(np.float32).reshape(-1, 4, 2) * np.stack([width, height], axis=1)[:, None, :].astype(np.float32)
    p = p.astype(np.float64)
    usable = np.isfinite(p).all(axis=(1, 2))
    p = np.where(usable[:, None, None], p, 0.0)
    box, w, h, long_side = _enclosing_rectangle(p)
    usable &= (w >= 1) & (h >= 1)
    angle = np.mod(np.degrees(np.arctan2(long_side[:, 1], long_side[:, 0])) + 90.0, 180.0) - 90.0
    c, s = np.cos(np.deg2rad(angle)), np.sin(np.deg2rad(angle))
    cx, cy = width / 2.0, height / 2.0
    canvas_w = np.trunc(height * np.abs(s) + width * np.abs(c))
    canvas_h = np.trunc(height * np.abs(c) + width * np.abs(s))
    m02 = (1 - c) * cx - s * cy + canvas_w / 2.0 - cx
    m12 = s * cx + (1 - c) * cy + canvas_h / 2.0 - cy
    bx = c[:, None] * box[..., 0] + s[:, None] * box[..., 1] + m02[:, None]
    by = -s[:, None] * box[..., 0] + c[:, None] * box[..., 1] + m12[:, None]
    x0, x1, y0, y1 = bx.min(axis=1), bx.max(axis=1), by.min(axis=1), by.max(axis=1)
    pad_w, pad_h = np.maximum(1.0, x1 - x0) * padding / 2.0, np.maximum(1.0, y1 - y0) * padding / 2.0
    x0, x1, y0, y1 = x0 - pad_w, x1 + pad_w, y0 - pad_h, y1 + pad_h
    span_w, span_h = x1 - x0, y1 - y0
    wide = span_w >= ratio * span_h
    want_w = np.where(wide, span_w, span_h * ratio)
    want_h = np.where(wide, span_w / ratio, span_h)
    mid_x, mid_y = (x0 + x1) / 2.0, (y0 + y1) / 2.0
    left, inside_w = _axis_window(mid_x, want_w, canvas_w)
    top, inside_h = _axis_window(mid_y, want_h, canvas_h)
    usable &= (inside_w > 0) & (inside_h > 0)
    inside = np.stack([inside_w, inside_h], axis=1)
    size, larger = _fitted_size(inside, ratio)
    # a larger window grows about the middle, a smaller one keeps its upper left corner
    shift = np.where(larger[:, None], np.floor((size - inside) / 2), 0.0)
    left, top = left - shift[:, 0], top - shift[:, 1]
    right, bottom = left + size[:, 0], top + size[:, 1]
    return pd.DataFrame({
        "m00": c, "m01": s, "m02": m02, "m10": -s, "m11": c, "m12": m12,
        "left": left, "top": top, "right": right, "bottom": bottom,
        "aspect_ratio": np.maximum(w, h) / np.maximum(np.minimum(w, h), 1e-6), "valid": usable,
    })


def crop_transform(
    corners: Sequence[Column], width: Column, height: Column, padding: float = PADDING,
    ratio: float = OUT_WIDTH / OUT_HEIGHT,
) -> Column:
    """struct of affine map, crop window, aspect ratio and validity."""

    @F.pandas_udf(TRANSFORM_TYPE)
    def geometry(c: pd.DataFrame, w: pd.Series, h: pd.Series) -> pd.DataFrame:
        return window_geometry(
            c.to_numpy(dtype=float), w.to_numpy(dtype=float), h.to_numpy(dtype=float), padding, ratio
        )

    return geometry(F.struct(*[c.cast("double").alias(n) for c, n in zip(corners, CORNER_COLUMNS)]), width, height)


def to_crop(x: Column, y: Column, t: Column, out_width: int = OUT_WIDTH, out_height: int = OUT_HEIGHT) -> tuple[Column, Column]:
    """Raw-image points into crop space; points outside are kept as they are."""
    sx = F.lit(float(out_width)) / (t["right"] - t["left"])
    sy = F.lit(float(out_height)) / (t["bottom"] - t["top"])
    return (
        F.zip_with(x, y, lambda a, b: (t["m00"] * a + t["m01"] * b + t["m02"] - t["left"]) * sx),
        F.zip_with(x, y, lambda a, b: (t["m10"] * a + t["m11"] * b + t["m12"] - t["top"]) * sy),
    )


def to_raw(x: Column, y: Column, t: Column, out_width: int = OUT_WIDTH, out_height: int = OUT_HEIGHT) -> tuple[Column, Column]:
    """Crop-space points back into the raw image (exact inverse)."""
    sx = (t["right"] - t["left"]) / F.lit(float(out_width))
    sy = (t["bottom"] - t["top"]) / F.lit(float(out_height))

    def rx(a: Column) -> Column:
        return a * sx + t["left"] - t["m02"]

    def ry(b: Column) -> Column:
        return b * sy + t["top"] - t["m12"]

    # the rotation part is orthogonal: its inverse is its transpose
    return (
        F.zip_with(x, y, lambda a, b: t["m00"] * rx(a) + t["m10"] * ry(b)),
        F.zip_with(x, y, lambda a, b: t["m01"] * rx(a) + t["m11"] * ry(b)),
    )


def reproject(
    landmarks: DataFrame,
    manifest: DataFrame,
    detections: DataFrame,
    padding: float = PADDING,
    out_width: int = OUT_WIDTH,
    out_height: int = OUT_HEIGHT,
    direction: str = "to_raw",
    flip_y: bool = False,
) -> DataFrame:
    """Landmarks moved between spaces, with the reason a row cannot be.

    ``manifest``: photo_id, path, width, height; ``detections``: photo_id,
    status and eight corners. Adds rx, ry, raw_path, aspect_ratio, reproject_reason."""
    images = manifest.select(
        "photo_id", F.col("path").alias("raw_path"), F.col("width").alias("__w"), F.col("height").alias("__h"),
        F.lit(True).alias("__known"),
    )
    boxes = detections.select(
        "photo_id", F.col("status").alias("__status"),
        *[F.col(c).try_cast("double").alias(f"__{c}") for c in CORNER_COLUMNS],
    )
    joined = landmarks.join(images, "photo_id", "left").join(boxes, "photo_id", "left")
    corners = [F.col(f"__{c}") for c in CORNER_COLUMNS]
    numeric = F.lit(True)
    for c in corners:
        numeric = numeric & c.isNotNull()
    before = (
        F.when(F.col("__known").isNull(), "photo_id not found in manifest.csv")
        .when(~F.col("__status").eqNullSafe(F.lit(OK)), "no OK detection row in detection.csv (OBB unavailable)")
        .when(F.col("__w").isNull() | F.col("__h").isNull(), "unreadable_image")
        .when(~numeric, "invalid OBB corners in detection.csv")
    )
    framed = joined.withColumn("__before", before).withColumn(
        "__t", crop_transform(corners, F.col("__w").cast("double"), F.col("__h").cast("double"), padding, out_width / out_height)
    )
    reason = F.coalesce(F.col("__before"), F.when(~F.col("__t.valid"), "degenerate OBB geometry"))
    t = F.col("__t")
    if direction == "to_raw":
        x, y = to_raw(F.col("x"), F.col("y"), t, out_width, out_height)
    else:
        source_y = F.transform("y", lambda v: F.col("__h") - v) if flip_y else F.col("y")
        x, y = to_crop(F.col("x"), source_y, t, out_width, out_height)
    good = F.col("reproject_reason").isNull()
    return framed.withColumn("reproject_reason", reason).select(
        *landmarks.columns,
        F.when(good, x).alias("rx"),
        F.when(good, y).alias("ry"),
        F.when(good, F.col("raw_path")).alias("raw_path"),
        F.when(good, F.col("__t.aspect_ratio")).alias("aspect_ratio"),
        "reproject_reason",
    )


def bounds_status(df: DataFrame, x: str = "rx", y: str = "ry", width: int = OUT_WIDTH, height: int = OUT_HEIGHT) -> DataFrame:
    """Adds the number of points outside the crop; any makes the row SUSPECT."""
    counted = df.withColumn("n_out_of_bounds", count_outside(F.col(x), F.col(y), width, height))
    return counted.withColumn("status", F.when(F.col("n_out_of_bounds") > 0, SUSPECT).otherwise(OK))
