"""Manifest building: path verification, photo ids, duplicate rules, combination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators.ordering import Order, first_rows, numbered, with_repeats
from alula.schema import FAILED, MANIFEST_COLUMNS, OK, SUSPECT, keep_present


def verify_paths(
    df: DataFrame, files: DataFrame, path_column: str, base_dir: str | None, also: Sequence[str] = ()
) -> DataFrame:
    """Resolves each path against a file scan (path, content_hash, file_size_bytes).

    The scan holds a path once. Where it holds several files of one resolved path, ``also`` names the
    columns of both frames that tell them apart."""
    located = df.withColumn("__path", S.resolved_path(F.col(path_column), base_dir))
    found = files.select(
        F.col("path").alias("__path"),
        F.col("content_hash").alias("__hash"),
        F.col("file_size_bytes").alias("__size"),
        *also,
    )
    joined = located.join(found, ["__path", *also], "left")
    missing = F.col("__hash").isNull()
    technical = ["path", "ext", "content_hash", "file_size_bytes", "status", "status_reason"]
    return joined.select(
        *[c for c in df.columns if c not in technical],
        F.col("__path").alias("path"),
        S.path_extension(F.col("__path")).alias("ext"),
        F.col("__hash").alias("content_hash"),
        F.col("__size").alias("file_size_bytes"),
        F.when(missing, FAILED).otherwise(OK).alias("status"),
        F.when(missing, "unreadable_image_or_missing_file").otherwise("").alias("status_reason"),
    )


def fill_photo_ids(df: DataFrame, path_column: str, default_device_type: str, tie: Order = ()) -> DataFrame:
    """Derives device type, index and photo id where they are missing.

    Rows that already carry a value keep it; only the missing subset is numbered."""
    for column, kind in (("device_type", "string"), ("photo_index", "long"), ("photo_id", "string")):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast(kind))
    df = df.withColumn("device_type", S.filled(F.col("device_type"), default_device_type)).withColumn(
        "photo_index", S.blank_to_null(F.col("photo_index").cast("string")).try_cast("double").cast("long")
    )
    absent = F.col("photo_index").isNull()
    fresh = numbered(
        df.filter(absent).drop("photo_index"), ["inv_id", "device_type"], [path_column, *tie], "photo_index"
    )
    whole = df.filter(~absent).unionByName(fresh)
    derived = S.photo_key(F.col("inv_id").cast("string"), F.col("device_type"), F.col("photo_index"))
    return whole.withColumn("photo_id", F.coalesce(S.blank_to_null(F.col("photo_id")), derived)).select(df.columns)


def flag_duplicate_photo_ids(df: DataFrame, order: Order, key: Sequence[str] = ("photo_id",)) -> DataFrame:
    """Rows after the first of a repeated photo id become FAILED; FAILED rows stay as they are."""
    marked = with_repeats(df, list(key), order)
    hit = F.col("is_repeat") & (F.col("status") != FAILED)
    return _restate(marked, df.columns, hit, FAILED, "duplicate photo_id in input")


def flag_duplicate_content(df: DataFrame, order: Order) -> DataFrame:
    """Later copies of the same content become SUSPECT.

    Only readable rows with a recognised name claim a hash."""
    eligible = F.col("status") == OK
    marked = with_repeats(df, ["content_hash"], order, eligible)
    return _restate(
        marked, df.columns, F.col("is_repeat"), SUSPECT, "duplicate content of an earlier file in this run"
    )


def _restate(df: DataFrame, columns: Sequence[str], hit: Column, status: str, reason: str) -> DataFrame:
    new = {"status": status, "status_reason": reason}
    return df.select(
        *[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in columns]
    )


def scan_records(files: DataFrame, stem: Column, readable: Column | None = None) -> DataFrame:
    """Scan rows with parsed names and their first status (before duplicates).

    ``files`` has content_hash and whatever columns identify the file."""
    readable = F.lit(True) if readable is None else readable
    named = files.withColumn("__name", S.parsed_name(stem))
    name_ok = F.col("__name.name_ok")
    return named.select(
        *files.columns,
        F.col("__name.original_id").alias("original_id"),
        F.col("__name.device_type").alias("device_type"),
        F.col("__name.shot_index").alias("shot_index"),
        F.when(readable & name_ok, OK).otherwise(FAILED).alias("status"),
        F.when(~readable, "unreadable").when(~name_ok, "filename format not recognized").otherwise("").alias("status_reason"),
    )


def duplicate_members(scan: DataFrame, path: str = "raw_path") -> DataFrame:
    """Every file of every repeated content, one row per copy."""
    hashed = scan.filter(S.blank_to_null(F.col("content_hash")).isNotNull())
    sizes = hashed.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n_copies")).filter(F.col("n_copies") > 1)
    return hashed.select("content_hash", path).join(sizes, "content_hash")


def duplicate_groups(scan: DataFrame, path: str = "raw_path", paths_per_row: int = 10_000) -> DataFrame:
    """Identical contents: number of copies and their paths in one text.

    A content with more copies than fit one row continues in further parts, so
    no row and no task ever holds an unbounded group."""
    ranked = numbered(duplicate_members(scan, path), ["content_hash"], [path], "__rank")
    part = (F.floor((F.col("__rank") - 1) / paths_per_row) + 1).cast("int")
    return (
        ranked.groupBy("content_hash", "n_copies", part.alias("part"))
        .agg(F.array_join(F.sort_array(F.collect_list(path)), " | ").alias("paths"))
    )


def biological_table(
    df: DataFrame, bio_columns: Sequence[str], order: Order, device_values: Sequence[str] | None = None
) -> DataFrame:
    """One row per specimen plus a zero-filled photo count per device type."""
    order_names = [c for c in order if isinstance(c, str)]
    wanted = ["inv_id", *bio_columns]
    carried = df.select(*wanted, *[c for c in order_names if c not in wanted])
    specimens = first_rows(carried, ["inv_id"], order).select(wanted)
    if "device_type" not in df.columns:
        return specimens
    counts = df.groupBy("inv_id").pivot("device_type", list(device_values) if device_values else None).count()
    names = [c for c in counts.columns if c != "inv_id"]
    counts = counts.select(
        "inv_id", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(f"n_photos_{c}") for c in names]
    )
    return specimens.join(counts, "inv_id", "left")


def manifest_table(df: DataFrame) -> DataFrame:
    return keep_present(df, MANIFEST_COLUMNS)


class CollisionError(ValueError):
    """Combined roots share keys that must be unique; ``table`` has all of them, the message some."""

    table: DataFrame | None = None


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def combine_tables(frames: Sequence[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def combine_roots(roots: Sequence[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(manifest, biology) of several roots; any shared photo or specimen id is an error."""
    manifest = combine_tables([m for m, _ in roots])
    biology = combine_tables([b for _, b in roots])
    for frame, key in ((manifest, "photo_id"), (biology, "inv_id")):
        clash = [r[0] for r in repeated_keys(frame, key).orderBy(key).limit(50).collect()]
        if clash:
            error = CollisionError(f"{key} collision across combined roots: {clash}")
            error.table = repeated_keys(frame, key)
            raise error
    return manifest, biology
