"""From raw scans and identification tables to a combined dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators import identity as I
from alula.operators import manifest as M
from alula.operators.logs import status_counters
from alula.operators.matching import authoritative_columns
from alula.operators.ordering import first_rows
from alula.schema import COMPARE_COLUMNS, MAPPING, OK, SchemaError, biological_columns, missing_columns, require_columns
from alula.session import pinned
from alula.sources.tables import write_dataset_config


def empty_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MAPPING)


@dataclass
class SourceConfig:
    source_type: str
    key_column: str
    device_column: str | None = None
    device_name_column: str = "device"
    compare_columns: Sequence[str] = tuple(COMPARE_COLUMNS)
    origin_codes: DataFrame | None = None
    origin_column: str = "collection_origin"
    image_group_by: Sequence[str] = ()
    default_device_type: str = "S"
    order: str = "ord"


@dataclass
class PreparedSource:
    mapping: DataFrame
    biology_all: DataFrame
    biology: DataFrame
    photos: DataFrame
    dataset: DataFrame
    conflicts: DataFrame
    excluded: DataFrame
    orphans: DataFrame
    device_types: DataFrame | None


def prepare_source(scan: DataFrame, ident: DataFrame, config: SourceConfig, mapping: DataFrame, frozen_at: str) -> PreparedSource:
    """One source: identity resolved and frozen, photos numbered, reports attached.

    Images are not copied; ``path`` is the scanned file and ``target_path`` the
    place it would have in a clean folder tree. The extended mapping is pinned
    once because every table below joins it."""
    key, order = config.key_column, [config.order]
    for column in ("dd", "mm", "yyyy"):
        if column not in ident.columns:
            ident = ident.withColumn(column, F.lit(None).cast("int"))
    needed = [key, *config.compare_columns, config.order]
    needed += [config.device_column] if config.device_column else []
    needed += [config.origin_column] if config.origin_codes is not None else []
    require_columns(ident, needed, "identification table")
    images = scan
    if "source_type" in scan.columns:
        images = images.filter(F.col("source_type") == config.source_type)
    if "status" in scan.columns:
        images = images.filter(F.col("status") != "FAILED").drop("status", "status_reason")
    images = images.withColumn("device_type", S.filled(F.col("device_type"), config.default_device_type))
    has_names = bool(config.device_column) and config.device_name_column in ident.columns
    devices = I.device_types(ident, config.device_column, config.device_name_column) if has_names else None

    codes = I.resolved_origin_codes(config.origin_codes) if config.origin_codes is not None else None
    named = I.assign_inv_name(ident, key, codes, config.origin_column)
    resolved = I.resolve_identification(named, key, order, config.device_column, config.compare_columns)
    conflicts = I.identity_conflicts(named, key, order, config.compare_columns)
    conflicted = conflicts.select(F.col(key).alias("original_id")).distinct().withColumn("__c", F.lit(True))
    specimens = first_rows(resolved.select(key, "inv_name", "dd", "mm", "yyyy", config.order), [key], order)
    specimens = (
        specimens.withColumnRenamed(key, "original_id")
        .join(conflicted, "original_id", "left")
        .select(
            F.lit(config.source_type).alias("source_type"), "original_id", "inv_name", "yyyy", "mm", "dd",
            F.coalesce("__c", F.lit(False)).alias("resolved_conflict"),
        )
    )
    keep_id = codes is not None
    grown = pinned(I.extend_mapping(mapping, specimens, frozen_at, embedded_numbering=not keep_id))

    def table(rows: DataFrame) -> DataFrame:
        return I.specimen_table(grown, rows, key, config.source_type, order, config.device_column, keep_id)

    kept = I.with_image(resolved, images, key)
    biology = table(kept)
    attach = lambda rows: I.attach_inv_id(rows, grown, key, config.source_type, keep_id)
    excluded = first_rows(attach(I.without_image(resolved, images, key)), ["inv_id"], order).drop(config.order)

    present = images.join(kept.select(F.col(key).alias("original_id")).distinct(), "original_id", "left_semi")
    own = grown.filter(F.col("source_type") == config.source_type)
    photos = I.assign_photo_ids(present, own).withColumn("source_type", F.lit(config.source_type))
    if has_names:
        names = I.specimen_devices(grown, resolved, key, config.source_type, config.device_column, config.device_name_column, order)
        photos = photos.join(names, ["inv_id", "device_type"], "left")
    if "photographer" in biology.columns:
        photos = authoritative_columns(photos, biology, "inv_id", ["photographer"])
    photos = _with_target(photos, biology, config.image_group_by)
    photos = photos.withColumn("path", F.col("raw_path")).withColumn("status", F.lit(OK)).withColumn("status_reason", F.lit(""))
    return PreparedSource(
        grown, table(resolved), biology, photos, _per_photo(photos, biology),
        attach(conflicts).withColumn("source_type", F.lit(config.source_type)),
        excluded, I.orphan_images(images, ident, key), devices,
    )


def _with_target(photos: DataFrame, biology: DataFrame, group_by: Sequence[str]) -> DataFrame:
    extra = [c for c in group_by if c in biology.columns and c not in photos.columns]
    wide = photos.join(biology.select("inv_id", *extra), "inv_id", "left") if extra else photos
    absent = missing_columns(wide, group_by)
    if absent:
        raise SchemaError(f"image_group_by names unknown column(s) {absent}")
    return wide.withColumn("target_path", S.grouped_relative_path(group_by, F.col("photo_id"), F.col("ext"))).drop(*extra)


def _per_photo(photos: DataFrame, biology: DataFrame) -> DataFrame:
    """Denormalised rows of usable photos."""
    administrative = {"inv_id", "inv_name", "resolved_conflict"}
    extra = [
        c for c in biology.columns
        if c not in administrative and not c.startswith("n_photos") and c not in photos.columns
    ]
    lead = [c for c in ("photo_id", "inv_id", "device_type", "device", "photo_index", "photographer", "path") if c in photos.columns]
    joined = photos.filter(F.col("status") == OK).join(biology.select("inv_id", *extra), "inv_id", "left")
    return joined.select(*lead, *extra)


@dataclass
class ManifestResult:
    complete: bool  # every row OK: manifest and biology are usable
    manifest: DataFrame
    biology: DataFrame | None
    conflicts: DataFrame
    counters: Mapping[str, int]


def build_manifest(
    df: DataFrame, files: DataFrame, path_column: str = "path", base_dir: str | None = None,
    default_device_type: str = "S", order: Sequence[str] = ("ord",),
) -> ManifestResult:
    """Structural validation; biology is built only when every row passes.

    ``files`` is a scan of the images; ``order`` the file order of ``df``."""
    absent = missing_columns(df, ["inv_id", "species", "caste", path_column])
    if absent:
        raise SchemaError(f"column(s) not found: {absent}")
    bio = [c for c in biological_columns(df.columns, path_column) if c not in order]
    verified = M.verify_paths(df, files, path_column, base_dir)
    path = path_column if path_column in verified.columns else "path"
    indexed = M.fill_photo_ids(verified, path, default_device_type, order)
    unique = M.flag_duplicate_photo_ids(indexed, order)
    checked = pinned(I.flag_inconsistent(unique, order, bio))
    conflicts = I.consistency_report(checked, order, bio)
    counters = status_counters(checked).first().asDict()
    complete = counters["total"] == counters["ok"]
    biology = M.biological_table(checked, bio, order) if complete else None
    return ManifestResult(complete, M.manifest_table(checked), biology, conflicts, counters)


@dataclass
class PreparedDataset:
    manifest: DataFrame
    biology: DataFrame
    mapping: DataFrame
    failed_sources: list[str]
    config: DataFrame


def prepare_dataset(
    spark: SparkSession,
    sources: Sequence[tuple[DataFrame, DataFrame, SourceConfig]],
    name: str,
    output: str,
    frozen_at: str,
    mapping: DataFrame | None = None,
) -> PreparedDataset:
    """Every source in turn over one growing mapping, then the combination.

    A source that fails validation is left out; none left is an error. Writes
    manifest, biological_data, mapping and the dataset description."""
    if not sources:
        raise ValueError("no source given")
    current = mapping if mapping is not None else empty_mapping(spark)
    roots, failed = [], []
    for scan, ident, config in sources:
        done = prepare_source(scan, ident, config, current, frozen_at)
        current = done.mapping
        files = done.photos.select("path", "content_hash", "file_size_bytes")
        result = build_manifest(done.dataset, files, "path", None, config.default_device_type, ["photo_id"])
        if result.complete:
            roots.append((result.manifest, result.biology))
        else:
            failed.append(config.source_type)
    if not roots:
        raise ValueError(f"no source produced a valid manifest: {failed}")
    manifest, biology = M.combine_roots(roots)
    for frame, part in ((manifest, "manifest"), (biology, "biological_data"), (current, "inv_id_mapping")):
        frame.write.mode("overwrite").parquet(f"{output}/{part}")
    manifest, biology = spark.read.parquet(f"{output}/manifest"), spark.read.parquet(f"{output}/biological_data")
    config_row = write_dataset_config(spark, f"{output}/dataset_config.json", name, manifest, biology)
    return PreparedDataset(manifest, biology, current, failed, config_row)
