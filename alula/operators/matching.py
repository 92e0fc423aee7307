"""Joins with reasons: path matching, crop plans, training pairs, set differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.functions.shapes import dropped_point
from alula.schema import OK, wide_landmark_columns


class PairingError(RuntimeError):
    """A join that must be one-to-one is not."""


def match_paths(images: DataFrame, manifest: DataFrame, image_path: str, raw_path: str, payload: Sequence[str]) -> DataFrame:
    """Two-tier path match: unique last-three-segments key, else unique basename.

    Keys are reduced to one row each before joining, so a file name shared by
    very many rows costs one counter rather than all pairs."""

    def unique_key(key) -> DataFrame:
        row = F.struct(*[F.col(c) for c in payload])
        return manifest.groupBy(key.alias("__key")).agg(F.count(F.lit(1)).alias("n"), F.any_value(row).alias("hit"))

    tails = unique_key(S.path_tail(F.col(raw_path))).filter(F.col("n") == 1)
    bases = unique_key(S.path_basename(F.col(raw_path)))
    tails = tails.select(F.col("__key").alias("__tail"), F.col("hit").alias("__tail_hit"))
    bases = bases.select(F.col("__key").alias("__base"), F.col("n").alias("__n"), F.col("hit").alias("__base_hit"))
    joined = (
        images.join(tails, S.path_tail(F.col(image_path)) == F.col("__tail"), "left")
        .join(bases, S.path_basename(F.col(image_path)) == F.col("__base"), "left")
    )
    by_tail = F.col("__tail_hit").isNotNull()
    by_base = F.col("__n") == 1
    method = (
        F.when(by_tail, "tail3")
        .when(by_base, "basename")
        .when(F.col("__n") > 1, F.format_string("ambiguous filename (%d candidates in manifest.csv)", F.col("__n")))
        .otherwise("no match in manifest.csv")
    )
    hit = F.when(by_tail, F.col("__tail_hit")).when(by_base, F.col("__base_hit"))
    return joined.select(*images.columns, method.alias("match_method"), *[hit[c].alias(c) for c in payload])


def crop_plan(detections: DataFrame, manifest: DataFrame) -> DataFrame:
    """Detections with their image path and the reason a row cannot be cropped."""
    images = manifest.select("photo_id", F.col("path").alias("image_path"), F.lit(True).alias("__known"))
    joined = detections.join(images, "photo_id", "left")
    reason = F.when(F.col("__known").isNull(), "photo_id_missing_from_manifest").when(
        ~F.col("status").eqNullSafe(F.lit(OK)), "detection_not_OK"
    )
    return joined.withColumn("plan_reason", reason).drop("__known")


def training_pairs(
    landmarks: DataFrame, crops: DataFrame, n_points: int, drop_point: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(wide training rows, skipped rows with reason); ``crops`` holds latest usable crops."""
    found = crops.select("photo_id", F.col("output_path").alias("crop_path"), F.col("inv_id").alias("__inv"))
    joined = landmarks.join(found, "photo_id", "left")
    reason = F.when(F.col("photo_id").isNull(), "no photo_id").when(
        F.col("crop_path").isNull(), "no matching crop in crops.csv"
    )
    judged = joined.withColumn("reason", reason)
    x, y = F.col("x"), F.col("y")
    if drop_point is not None:
        x, y = dropped_point(x, drop_point), dropped_point(y, drop_point)
    kept = n_points - (0 if drop_point is None else 1)
    wide = [
        F.get(x if name[0] == "x" else y, int(name[1:])).alias(name) for name in wide_landmark_columns(kept)
    ]
    good = judged.filter(F.col("reason").isNull()).select(
        "photo_id", F.coalesce("inv_id", "__inv").alias("inv_id"), "crop_path", *wide
    )
    missing_id = F.concat(F.lit("(tps_id="), F.col("tps_id").cast("string"), F.lit(")"))
    skipped = judged.filter(F.col("reason").isNotNull()).select(
        F.coalesce(F.col("photo_id"), missing_id).alias("photo_id"), "reason"
    )
    return good, skipped


def paired_one_to_one(left: DataFrame, right: DataFrame, key: str, agree: str, required: str) -> DataFrame:
    """Left rows with exactly one right row each.

    Checks: unique keys on both sides, every left row matched, and the
    ``agree`` column equal on both sides."""
    for side, frame in (("left", left), ("right", right)):
        dup = [r[0] for r in frame.groupBy(key).count().filter("count > 1").limit(20).collect()]
        if dup:
            raise PairingError(f"duplicated {key} on the {side} side: {sorted(map(str, dup))}")
    joined = left.join(right.select(key, F.col(agree).alias("__other"), required), key, "left")
    lost = [r[0] for r in joined.filter(F.col(required).isNull()).select(key).limit(20).collect()]
    if lost:
        raise PairingError(f"no matching {required} for {key}: {sorted(map(str, lost))}")
    odd = joined.filter(~F.col(agree).eqNullSafe(F.col("__other"))).select(key).limit(20).collect()
    if odd:
        raise PairingError(f"{agree} disagrees for {key}: {sorted(str(r[0]) for r in odd)}")
    return joined.drop("__other")


def reference_audit(existing: DataFrame, referenced: DataFrame, key: str) -> DataFrame:
    """Both set differences: files nobody references, references without a file."""
    have = existing.select(key).distinct()
    want = referenced.select(key).distinct()
    unused = have.join(want, key, "left_anti").withColumn("finding", F.lit("not_referenced"))
    lost = want.join(have, key, "left_anti").withColumn("finding", F.lit("not_found"))
    return unused.unionByName(lost)


def authoritative_columns(df: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns of ``df`` replaced by those of a table with one row per key."""
    return df.drop(*columns).join(source.select(key, *columns), key, "left")
