"""Status logs: latest state, counters, resume plans, reviews and exclusions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.functions.status import should_skip
from alula.operators.ordering import Order, latest_rows
from alula.schema import FAILED, OK, REVIEW_STATUSES, SKIPPED, STATUSES, SUSPECT, SchemaError, require_columns


def latest_status(log: DataFrame, order: Order, key: str = "photo_id") -> DataFrame:
    """Last row per photo of an append-only log."""
    return latest_rows(log, [key], order)


def usable_crops(log: DataFrame, order: Order, key: str = "photo_id") -> DataFrame:
    """Photos whose latest state is OK or SKIPPED (= already on disk)."""
    return latest_status(log, order, key).filter(F.col("status").isin(OK, SKIPPED))


def status_counts(status: Column) -> list[Column]:
    """total, ok, suspect, skipped, failed; other statuses only count in total."""
    return [
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(status == s).alias(s.lower()) for s in STATUSES],
    ]


def status_counters(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*status_counts(F.col("status")))


def step_stats(df: DataFrame, by: Sequence[str], seconds: str = "processing_time_s") -> DataFrame:
    """Counters plus total and mean seconds; the mean of nothing is 0."""
    total_s = F.coalesce(F.sum(seconds), F.lit(0.0))
    return df.groupBy(*by).agg(
        *status_counts(F.col("status")),
        F.coalesce(F.try_divide(total_s, F.count(F.lit(1))), F.lit(0.0)).alias("mean_time_s"),
        total_s.alias("total_time_s"),
    )


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the updates' keys are replaced, all others kept."""
    kept = existing.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(existing.columns).unionByName(updates.select(existing.columns))


def resume_plan(
    todo: DataFrame,
    log: DataFrame,
    order: Order,
    outputs: DataFrame | None = None,
    overwrite: bool = False,
    retry_failed: bool = False,
    key: str = "photo_id",
) -> DataFrame:
    """Adds ``skip`` to the work list, from the latest log row and existing outputs."""
    last = latest_status(log.select(key, "status", *[c for c in order if isinstance(c, str)]), order, key)
    joined = todo.join(last.select(key, F.col("status").alias("__last")), key, "left")
    exists = F.lit(True)
    if outputs is not None:
        joined = joined.join(outputs.select(key).distinct().withColumn("__out", F.lit(True)), key, "left")
        exists = F.coalesce(F.col("__out"), F.lit(False))
    skip = should_skip(F.col("__last"), F.lit(overwrite), F.lit(retry_failed), exists)
    return joined.withColumn("skip", skip).drop("__last", "__out")


def status_crosstab(df: DataFrame, rows: Sequence[str], column: str = "status") -> DataFrame:
    """Zero-filled counts with a fixed set of status columns and a total."""
    counts = df.groupBy(*rows).pivot(column, REVIEW_STATUSES).count()
    filled = [F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in REVIEW_STATUSES]
    table = counts.select(*rows, *filled)
    return table.withColumn("Total", sum((F.col(s) for s in REVIEW_STATUSES[1:]), F.col(REVIEW_STATUSES[0])))


def with_species(status: DataFrame, biology: DataFrame, columns: Sequence[str] = ("species", "caste")) -> DataFrame:
    """Status rows with biology; unknown values are shown as ``?``."""
    bio = biology.select("inv_id", *columns)
    return status.join(bio, "inv_id", "left").fillna("?", subset=list(columns))


# --- reviews -----------------------------------------------------------------------


def review_sheet(log: DataFrame, order: Order | None, extra: Sequence[str] = ()) -> DataFrame:
    """Editable sheet: automatic status, reviewed status (same to begin with)."""
    base = latest_status(log, order) if order else log
    return base.select(
        "photo_id", "inv_id", F.col("status").alias("auto_status"), F.col("status").alias("reviewed_status"), *extra
    )


def validated_review(sheet: DataFrame) -> DataFrame:
    require_columns(sheet, ["photo_id", "auto_status", "reviewed_status"], "review table")
    wrong = sheet.filter(~F.coalesce(F.col("reviewed_status"), F.lit("")).isin(REVIEW_STATUSES))
    bad = [r[0] for r in wrong.select("reviewed_status").distinct().limit(10).collect()]
    if bad:
        raise SchemaError(f"invalid reviewed_status value(s) {bad} (expected {REVIEW_STATUSES})")
    return sheet


def apply_review(original: DataFrame, review: DataFrame, keep_old_reason: bool) -> DataFrame:
    """Reviewed statuses replace automatic ones; the reason changes only where the status did.

    ``keep_old_reason`` quotes the previous reason (landmark reviews); crop
    reviews use one constant reason."""
    edits = review.select(
        "photo_id",
        F.col("reviewed_status").alias("__new"),
        (~F.col("auto_status").eqNullSafe(F.col("reviewed_status"))).alias("__changed"),
    )
    if keep_old_reason:
        old = F.coalesce(F.col("error_reason"), F.lit(""))
        reason = F.concat(F.lit("manual review override (was: "), old, F.lit(")"))
    else:
        reason = F.lit("excluded_by_manual_review")
    changed = F.coalesce(F.col("__changed"), F.lit(False))
    new = {
        "status": F.coalesce(F.col("__new"), F.col("status")),
        "error_reason": F.when(changed, reason).otherwise(F.col("error_reason").cast("string")),
    }
    joined = original.join(edits, "photo_id", "left")
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in original.columns])


def review_audit(review: DataFrame) -> DataFrame:
    return review.select("photo_id", "auto_status", "reviewed_status")


def carried_decisions(rows: DataFrame, previous: DataFrame, key: str = "photo_id") -> DataFrame:
    """Earlier keep decisions; ``keep_row`` is false for a negative one."""
    # fixed values: the accepted spellings of "no"
    negative = ["false", "0", "non", "no", "n"]
    text = F.trim(F.col("keep"))
    known = previous.select(key, F.when(text != "", text).alias("keep")).filter(F.col("keep").isNotNull())
    joined = rows.join(known, key, "left")
    keep = F.coalesce(F.col("keep"), F.lit(""))
    return joined.withColumn("keep", keep).withColumn("keep_row", ~F.lower(keep).isin(negative))


# --- exclusions -----------------------------------------------------------------------


def exclusion_report(
    statuses: DataFrame,
    manifest: DataFrame,
    biology: DataFrame,
    kept_ids: DataFrame,
    extra_filters: bool = False,
) -> DataFrame:
    """Why each photo of the dataset is absent from an export.

    ``statuses``: photo_id, inv_id, tps_id, status, error_reason;
    ``kept_ids``: tps_id of the exported rows."""
    own = F.when(F.col("inv_id") != "", F.col("inv_id"))
    rows = statuses.join(
        manifest.select("photo_id", F.col("inv_id").alias("__m_inv")), "photo_id", "inner"
    ).withColumn("inv_id", F.coalesce(own, F.col("__m_inv"), F.lit("")))
    kept = kept_ids.select(F.col("tps_id").alias("__kept"), F.lit(True).alias("__in")).distinct()
    rows = rows.join(kept, F.col("tps_id") == F.col("__kept"), "left")
    bio = biology.select("inv_id", F.col("species").alias("__species"), F.lit(True).alias("__bio"))
    rows = rows.join(bio, "inv_id", "left")
    status, reason = F.col("status"), F.col("error_reason")
    given = F.when(reason != "", reason)
    known = F.coalesce(F.col("__bio"), F.lit(False))
    named = F.coalesce(F.col("__species") != "", F.lit(False))
    stage = (
        F.when(status == FAILED, "landmark_placement")
        .when(status == SUSPECT, "outlier_registration")
        .when(status == OK, F.when(known & named, "other").otherwise("biological_metadata"))
        .otherwise("landmark_placement")
    )
    why = (
        F.when(status == FAILED, F.coalesce(reason, F.lit("")))
        .when(status == SUSPECT, F.coalesce(given, F.lit("flagged by per-species MAD outlier detection")))
        .when(
            status == OK,
            F.when(~known, "inv_id not found in biological_data.csv")
            .when(~named, "species missing in biological_data.csv")
            .otherwise("excluded while loading (e.g. inconsistent landmark count) -- see logs"),
        )
        .otherwise(F.concat(F.lit("unknown status '"), F.coalesce(status, F.lit("")), F.lit("'")))
    )
    listed = F.when(status == OK, ~(F.coalesce(F.col("__in"), F.lit(False)) | F.lit(extra_filters))).otherwise(True)
    return rows.filter(F.coalesce(listed, F.lit(True))).select("photo_id", "inv_id", stage.alias("stage"), why.alias("reason"))
