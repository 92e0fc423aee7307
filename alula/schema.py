"""Row types, fixed value sets and schema checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------
OK, SUSPECT, FAILED, SKIPPED = "OK", "SUSPECT", "FAILED", "SKIPPED"
STATUSES = ["OK", "SUSPECT", "SKIPPED", "FAILED"]
REVIEW_STATUSES = ["OK", "SUSPECT", "FAILED"]
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "heic", "heif", "tif", "tiff", "bmp"]
EXPORT_SUFFIXES = ["biological_data.csv", "failed.csv", "landmarks_crop.tps", "landmarks_raw.tps"]
COMPARE_COLUMNS = ["genus", "species", "caste", "dd", "mm", "yyyy"]
PHOTO_LEVEL_COLUMNS = ["photo_id", "device_type", "device", "photo_index", "photographer", "source_type"]
MANIFEST_COLUMNS = [
    "photo_id", "inv_id", "source_type", "device_type", "device", "photo_index",
    "photographer", "ext", "content_hash", "file_size_bytes", "path", "status", "status_reason",
]
MAPPING_COLUMNS = ["source_type", "original_id", "inv_num", "inv_id", "inv_name", "resolved_conflict", "frozen_at"]
EXPORT_BIO_COLUMNS = ["tps_id", "photo_id", "inv_id", "species", "caste", "device", "device_tag"]
EXCLUSION_COLUMNS = ["photo_id", "inv_id", "stage", "reason"]
PREFERRED_METRICS = [
    "model_name", "eval_tag", "landmarks_source", "n", "n_points", "accuracy_top1", "accuracy_top3",
]
CORNER_COLUMNS = ["x1", "y1", "x2", "y2", "x3", "y3", "x4", "y4"]
# -------------------------------------------------------------------------

DOUBLES = T.ArrayType(T.DoubleType())

LANDMARKS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("ord", T.LongType()),
    T.StructField("n_points", T.IntegerType()),
    T.StructField("x", DOUBLES),
    T.StructField("y", DOUBLES),
    T.StructField("image_path", T.StringType()),
    T.StructField("tps_id", T.DecimalType(20, 0)),
    T.StructField("photo_id", T.StringType()),
    T.StructField("inv_id", T.StringType()),
])

MAPPING = T.StructType([
    T.StructField("source_type", T.StringType()),
    T.StructField("original_id", T.StringType()),
    T.StructField("inv_num", T.LongType()),
    T.StructField("inv_id", T.StringType()),
    T.StructField("inv_name", T.StringType()),
    T.StructField("resolved_conflict", T.BooleanType()),
    T.StructField("frozen_at", T.StringType()),
])

STEP_STATS = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("approach", T.StringType()),
    T.StructField("total", T.LongType()),
    T.StructField("ok", T.LongType()),
    T.StructField("suspect", T.LongType()),
    T.StructField("skipped", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("mean_time_s", T.DoubleType()),
    T.StructField("total_time_s", T.DoubleType()),
    T.StructField("updated_at", T.StringType()),
])


class SchemaError(ValueError):
    """A table lacks columns or holds values an operator cannot accept."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> DataFrame:
    absent = missing_columns(df, required)
    if absent:
        raise SchemaError(f"{what}: missing column(s) {absent}")
    return df


def wide_landmark_columns(n_points: int) -> list[str]:
    return [f"{axis}{i}" for i in range(n_points) for axis in ("x", "y")]


def biological_columns(columns: Sequence[str], path_column: str) -> list[str]:
    """Everything that is neither photo-level, the path nor the specimen key."""
    other = {*PHOTO_LEVEL_COLUMNS, path_column, "inv_id"}
    return [c for c in columns if c not in other]


def keep_present(df: DataFrame, ordered: Sequence[str]) -> DataFrame:
    """Canonical column order, optional columns only where present."""
    return df.select([c for c in ordered if c in df.columns])


def lead_with(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    lead = [c for c in columns if c in df.columns]
    return df.select(lead + [c for c in df.columns if c not in lead])
