"""CSV and Parquet tables: reading, appending, upserting, freezing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alula.functions.strings import blank_to_null, dataset_folder_name
from alula.operators.logs import upsert
from alula.schema import MAPPING, STEP_STATS
from alula.session import pinned


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Replaces ``target`` by ``source``. The old table is kept beside it until the new one is in place."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    old = target.rstrip("/") + "__old"
    if system.exists(path(target)):
        system.delete(path(old), True)
        if not system.rename(path(target), path(old)):
            raise OSError(f"could not put {target} aside")
    if not system.rename(path(source), path(target)):
        system.rename(path(old), path(target))
        raise OSError(f"could not move {source} to {target}")
    system.delete(path(old), True)


def restore_interrupted(spark: SparkSession, target: str) -> None:
    """Puts the old table back if a replacement stopped between its two moves."""
    old = target.rstrip("/") + "__old"
    if path_exists(spark, old) and not path_exists(spark, target):
        path = spark._jvm.org.apache.hadoop.fs.Path
        path(target).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(old), path(target))


def broken_in_quotes(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Files in which a line ends inside quotes: some line of them has an odd number of quotes."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    name = lines.metadataColumn("_metadata")["file_path"].alias("file")
    return [r["file"] for r in lines.where(quotes % 2 == 1).select(name).distinct().collect()]  # at most one row per file


def read_text_table(spark: SparkSession, path: str | Sequence[str], order: bool = False) -> DataFrame:
    """CSV with header, all columns text, blanks as NULL, a leading BOM ignored.

    Files are read in splits. Only those with a line break inside quotes are read whole, by one task each; a scan of the
    quotes, line by line, finds them. ``order`` adds ``ord``, increasing in file order within each file."""
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("escape", '"')
    whole = broken_in_quotes(spark, path)
    raw = reader.option("multiLine", bool(whole)).csv(paths)
    if whole:
        in_splits = reader.option("multiLine", False).schema(raw.schema).csv(paths)
        raw = _of_files(in_splits, whole, False).union(_of_files(raw, whole, True))
    names = [c.lstrip("﻿") for c in raw.columns]
    cleaned = raw.toDF(*names).select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in names])
    return cleaned.withColumn("ord", F.monotonically_increasing_id()) if order else cleaned


def _of_files(df: DataFrame, files: list[str], inside: bool) -> DataFrame:
    """Rows of the files listed, or of the others; the scan skips files that the filter excludes."""
    listed = df.metadataColumn("_metadata")["file_path"].isin(files)
    return df.where(listed if inside else ~listed)


def with_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a schema, cast; absent ones are NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def append_log(df: DataFrame, path: str, first: bool = False) -> None:
    """Adds a batch to a log; the first batch of a run replaces it, an empty one does nothing."""
    if df.isEmpty():
        return
    df.write.mode("overwrite" if first else "append").parquet(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Frozen id mapping, or an empty table with its schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MAPPING)
    return with_columns(spark.read.parquet(path), MAPPING)


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside ``path`` and then swaps, so ``df`` may read ``path`` itself."""
    spark = df.sparkSession
    fresh = path.rstrip("/") + "__new"
    df.write.mode("overwrite").parquet(fresh)
    move_path(spark, fresh, path)


def update_step_stats(
    spark: SparkSession, path: str, counters: DataFrame, step: str, approach: str, total_time_s: float, now: str
) -> DataFrame:
    """One row per (step, approach): the run's own row replaced, others kept.

    ``counters`` is one row with total, ok, suspect, skipped, failed."""
    mean = F.coalesce(F.try_divide(F.lit(float(total_time_s)), F.col("total")), F.lit(0.0))
    row = counters.select(
        F.lit(step).alias("step"), F.lit(approach).alias("approach"), "total", "ok", "suspect", "skipped", "failed",
        F.round(mean, 4).alias("mean_time_s"), F.round(F.lit(float(total_time_s)), 4).alias("total_time_s"),
        F.lit(now).alias("updated_at"),
    )
    restore_interrupted(spark, path)
    existing = spark.read.parquet(path) if path_exists(spark, path) else spark.createDataFrame([], STEP_STATS)
    merged = pinned(upsert(with_columns(existing, STEP_STATS), with_columns(row, STEP_STATS), ["step", "approach"]))
    replace_table(merged, path)
    return spark.read.parquet(path)


def write_dataset_config(spark: SparkSession, path: str, name: str, manifest: DataFrame, biology: DataFrame) -> DataFrame:
    """Name and sizes of a dataset as one JSON row."""
    sizes = manifest.agg(F.count(F.lit(1)).alias("n_photos")).join(
        biology.agg(F.count(F.lit(1)).alias("n_specimens")), F.lit(True)
    )
    row = sizes.select(dataset_folder_name(F.lit(name)).alias("dataset_name"), "n_photos", "n_specimens")
    row.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.json(path)
