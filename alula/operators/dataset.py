"""Analysis-ready tables: landmark, biology and manifest joined and filtered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators.ordering import first_rows
from alula.schema import OK, SchemaError, require_columns


class EmptyDatasetError(ValueError):
    """No row is left after joining or filtering."""


def matched_landmarks(landmarks: DataFrame, biology: DataFrame, manifest: DataFrame) -> DataFrame:
    """Photo grain: landmarks with biology (required) and device columns (optional)."""
    require_columns(biology, ["inv_id", "species", "caste"], "biological data")
    require_columns(manifest, ["photo_id", "device_type", "photo_index"], "manifest")
    devices = manifest.select(
        "photo_id",
        "device_type",
        (F.col("device") if "device" in manifest.columns else F.lit(None).cast("string")).alias("device"),
        S.device_tag(F.col("device_type"), F.col("photo_index")).alias("device_tag"),
    )
    taken = set(landmarks.columns) | {"device_type", "device", "device_tag"}
    bio = biology.select("inv_id", *[c for c in biology.columns if c not in taken])
    joined = landmarks.join(bio, "inv_id", "inner").join(devices, "photo_id", "left")
    return joined.withColumn("groupe", S.group_label(F.col("species"), F.col("caste")))


def unmatched_landmarks(landmarks: DataFrame, biology: DataFrame) -> DataFrame:
    return landmarks.join(biology.select("inv_id"), "inv_id", "left_anti")


def without_outliers(df: DataFrame, statuses: DataFrame) -> DataFrame:
    """Drops photos whose status is not OK; by photo id, else by file-local id."""
    require_columns(statuses, ["status"], "status table")
    key = next((k for k in ("photo_id", "tps_id") if k in statuses.columns and k in df.columns), None)
    if key is None:
        raise SchemaError("status table: expected 'photo_id' or 'tps_id'")
    bad = statuses.filter(~F.col("status").eqNullSafe(F.lit(OK))).select(key)
    return df.join(bad, key, "left_anti")


def majority_point_count(df: DataFrame, tie: str = "first", order: str = "ord") -> int:
    """Most frequent landmark count; ties by first seen or by smallest."""
    sizes = df.groupBy("n_points").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    second = F.col("first") if tie == "first" else F.col("n_points")
    top = sizes.orderBy(F.col("n").desc(), second.asc()).first()
    if top is None:
        raise EmptyDatasetError("no landmark configuration")
    return top["n_points"]


def with_majority_count(df: DataFrame, tie: str = "first", order: str = "ord") -> DataFrame:
    """Rows of the most frequent count, as one plan (the winner is one row)."""
    sizes = df.groupBy("n_points").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    second = F.col("first") if tie == "first" else F.col("n_points")
    winner = sizes.orderBy(F.col("n").desc(), second.asc()).limit(1).select("n_points")
    return df.join(F.broadcast(winner), "n_points", "left_semi")


def filtered(
    df: DataFrame,
    devices: Sequence[str] | None = None,
    species: Sequence[str] | None = None,
    castes: Sequence[str] | None = None,
    labeled_only: bool = True,
) -> DataFrame:
    if labeled_only:
        df = df.filter(F.col("species").isNotNull())
    for column, wanted in (("device_tag", devices), ("species", species), ("caste", castes)):
        if wanted:
            df = df.filter(F.col(column).isin(list(wanted)))
    return df


def load_dataset(
    landmarks: DataFrame,
    biology: DataFrame,
    manifest: DataFrame,
    statuses: DataFrame | None = None,
    devices: Sequence[str] | None = None,
    species: Sequence[str] | None = None,
    castes: Sequence[str] | None = None,
    labeled_only: bool = True,
    require_rows: bool = True,
) -> DataFrame:
    """The dataset join with every filter; ``statuses`` switches outlier exclusion on."""
    source = landmarks if statuses is None else without_outliers(landmarks, statuses)
    joined = with_majority_count(matched_landmarks(source, biology, manifest))
    result = filtered(joined, devices, species, castes, labeled_only)
    if require_rows and result.isEmpty():
        raise EmptyDatasetError("no specimen left -- check the filters and the input tables")
    return result


def select_images(manifest: DataFrame, photo_ids: DataFrame | None = None) -> DataFrame:
    """Photos with a usable file (status OK), optionally only those listed."""
    require_columns(manifest, ["photo_id", "inv_id", "path", "status"], "manifest")
    usable = manifest.filter(F.col("status") == OK)
    return usable if photo_ids is None else usable.join(photo_ids.select("photo_id"), "photo_id", "left_semi")


def complete_individuals(df: DataFrame, devices: Sequence[str], key: str = "inv_id") -> DataFrame:
    """Individuals that have every required device tag keep all their photos."""
    required = sorted(set(devices))
    covered = (
        df.filter(F.col("device_tag").isin(required))
        .groupBy(key)
        .agg(F.countDistinct("device_tag").alias("n_tags"))
        .filter(F.col("n_tags") == len(required))
    )
    return df.join(covered.select(key), key, "left_semi")


def singleton_classes(df: DataFrame, label: str, group: str = "inv_id") -> DataFrame:
    """Classes backed by exactly one specimen."""
    pairs = df.select(label, group).filter(F.col(label).isNotNull()).distinct()
    return pairs.groupBy(label).agg(F.count(group).alias("n")).filter(F.col("n") == 1).select(label)


def with_large_groups(df: DataFrame, label: str, min_rows: int = 5) -> DataFrame:
    """Rows whose group has at least ``min_rows`` rows."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
    return df.join(sizes.select(label), label, "left_semi")


def with_complete_levels(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(levels))


def target_column(df: DataFrame, level: str) -> str:
    if level == "caste":
        return "groupe"
    if level not in df.columns:
        raise SchemaError(f"level {level!r} unknown (expected 'species' or 'caste')")
    return level


# --- uploads -------------------------------------------------------------------


class UploadError(ValueError):
    """Uploaded files cannot be merged into a dataset."""


def merged_biology(frames: Sequence[DataFrame], order: str = "ord") -> DataFrame:
    """Concatenated uploads, first row per tps_id (else per inv_id)."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    try:
        require_columns(whole, ["inv_id", "species", "caste"], "uploaded table")
    except SchemaError as problem:
        raise UploadError(str(problem)) from problem
    key = "tps_id" if "tps_id" in whole.columns else "inv_id"
    return first_rows(whole, [key], [order])


def join_upload(landmarks: DataFrame, biology: DataFrame) -> DataFrame:
    """Landmarks with a specimen id: by their own comment ids when all have one,
    otherwise by position (``tps_id``)."""
    named = S.blank_to_null(F.col("inv_id"))
    absent = landmarks.filter(named.isNull()).limit(1).count()
    if not absent and not landmarks.isEmpty():
        shared = landmarks.select("inv_id").join(
            biology.select(F.col("inv_id").cast("string").alias("inv_id")), "inv_id", "left_semi"
        )
        if shared.isEmpty():
            raise UploadError("no inv_id in common between the landmark files and the table")
        return landmarks
    if "tps_id" not in biology.columns:
        raise UploadError("no inv_id in the landmark files and no 'tps_id' column to join by position")
    number = F.col("tps_id").try_cast("decimal(20,0)")
    if not biology.filter(number.isNull()).isEmpty():
        raise UploadError("'tps_id' must contain only integers")
    positions = biology.select(number.alias("tps_id"), F.col("inv_id").cast("string").alias("__inv"))
    keyed = landmarks.withColumn("tps_id", F.col("tps_id").cast("decimal(20,0)"))
    missing = [str(r[0]) for r in keyed.join(positions, "tps_id", "left_anti").select("tps_id").limit(10).collect()]
    if missing:
        raise UploadError(f"specimen(s) without a matching 'tps_id' row: {missing}")
    joined = keyed.join(positions, "tps_id", "inner")
    return joined.withColumn("inv_id", F.col("__inv")).select(landmarks.columns)


def upload_root(landmarks: DataFrame, biology: DataFrame, order: str = "ord") -> dict[str, DataFrame]:
    """Tables of a throw-away dataset root made from an upload."""
    named = landmarks.withColumn(
        "photo_id",
        S.filled(F.col("photo_id"), F.concat(F.lit("tps_"), F.col("tps_id").cast("string"))),
    )
    bio = first_rows(biology, ["inv_id"], [order]).drop("tps_id", order)
    manifest = named.select(
        "photo_id", F.lit(None).cast("string").alias("device_type"), F.lit(None).cast("long").alias("photo_index")
    )
    return {"landmarks": named, "biological_data": bio, "manifest": manifest}
