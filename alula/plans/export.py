"""Export package: landmark files, biology and exclusions with shared dense ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators import cropspace as C
from alula.operators.dataset import load_dataset
from alula.operators.logs import exclusion_report
from alula.operators.ordering import check_failure_runs, numbered
from alula.schema import EXPORT_BIO_COLUMNS, EXCLUSION_COLUMNS
from alula.session import pinned
from alula.sources.landmark_files import write_landmarks
from alula.sources.ledger import slug_of

MAX_UNREADABLE_RUN = 5  # fixed value: this many unreadable images in a row mean a wrong folder


def export_tables(
    landmarks: DataFrame,
    biology: DataFrame,
    manifest: DataFrame,
    statuses: DataFrame,
    detections: DataFrame | None = None,
    exclude_outliers: bool = True,
    devices: Sequence[str] | None = None,
    species: Sequence[str] | None = None,
    castes: Sequence[str] | None = None,
    padding: float = C.PADDING,
    out_width: int = C.OUT_WIDTH,
    out_height: int = C.OUT_HEIGHT,
) -> dict[str, DataFrame]:
    """crop, raw (with detections), biological_data and failed.

    All come from one pinned frame, so ids and rows stay in step."""
    kept = load_dataset(landmarks, biology, manifest, statuses if exclude_outliers else None, devices, species, castes)
    failed = exclusion_report(statuses, manifest, biology, kept.select("tps_id"), bool(devices or species or castes))
    rows = kept.drop("tps_id")
    if detections is not None:
        moved = pinned(C.reproject(rows, manifest, detections, padding, out_width, out_height))
        check_failure_runs(moved, ["ord"], F.col("reproject_reason") == "unreadable_image", MAX_UNREADABLE_RUN)
        lost = moved.filter(F.col("reproject_reason").isNotNull()).select(
            F.coalesce("photo_id", F.lit("")).alias("photo_id"), F.coalesce("inv_id", F.lit("")).alias("inv_id"),
            F.lit("reprojection").alias("stage"), F.col("reproject_reason").alias("reason"),
        )
        failed = failed.unionByName(lost)
        rows = moved.filter(F.col("reproject_reason").isNull())
    final = pinned(numbered(rows, [], ["ord"], "tps_id"))
    anonymous = [F.lit(None).cast("string").alias(c) for c in ("photo_id", "inv_id")]
    shape = [F.col("ord"), F.col("n_points"), F.col("tps_id"), *anonymous]
    out = {
        "crop": final.select(*shape, "x", "y", "image_path"),
        "biological_data": final.select(
            "tps_id", *[S.text_or_empty(F.col(c)).alias(c) for c in EXPORT_BIO_COLUMNS if c != "tps_id"]
        ),
        "failed": failed.select(EXCLUSION_COLUMNS),
    }
    if detections is not None:
        out["raw"] = final.select(*shape, F.col("rx").alias("x"), F.col("ry").alias("y"), F.col("raw_path").alias("image_path"))
    return out


def write_package(tables: dict[str, DataFrame], path: str, name: str, single_file: bool = False) -> str:
    """Writes the package below ``<path>/<n>lm/``; returns that folder."""
    n_points = tables["crop"].select("n_points").first()[0]
    folder = f"{path}/{n_points}lm/{slug_of(tables["crop"].sparkSession, name)}"
    for part in ("crop", "raw"):
        if part in tables:
            write_landmarks(tables[part], f"{folder}-landmarks_{part}.tps", ["tps_id"], single_file)
    bio = tables["biological_data"].repartitionByRange("tps_id").sortWithinPartitions("tps_id")
    bio.write.mode("overwrite").option("header", True).csv(f"{folder}-biological_data.csv")
    tables["failed"].write.mode("overwrite").option("header", True).csv(f"{folder}-failed.csv")
    return f"{path}/{n_points}lm"


def write_upload_root(tables: dict[str, DataFrame], path: str, order: Sequence[str] = ("ord",)) -> str:
    """Writes the tables of ``operators.dataset.upload_root`` as a dataset root."""
    tables["biological_data"].write.mode("overwrite").parquet(f"{path}/biological_data")
    tables["manifest"].write.mode("overwrite").parquet(f"{path}/manifest")
    write_landmarks(tables["landmarks"], f"{path}/landmarks/landmarks_numbered.tps", order)
    return path
