"""Review round trip: editable sheets out, reconciled logs back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from alula.operators.logs import apply_review, latest_status, review_audit, review_sheet, validated_review


def crop_sheet(log: DataFrame, order: str = "ord") -> DataFrame:
    return review_sheet(log, [order], ["error_reason", "output_path"])


def landmark_sheet(log: DataFrame) -> DataFrame:
    sheet = review_sheet(log, None, ["tps_id", "registration_cost", "n_outlier_landmarks", "error_reason"])
    lead = ["photo_id", "inv_id", "tps_id", "auto_status", "reviewed_status"]
    return sheet.select(*lead, "registration_cost", "n_outlier_landmarks", "error_reason")


def reconcile_crops(log: DataFrame, edited: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(reconciled log, audit table)."""
    review = validated_review(edited)
    return apply_review(latest_status(log, [order]), review, keep_old_reason=False), review_audit(review)


def reconcile_landmarks(log: DataFrame, edited: DataFrame) -> tuple[DataFrame, DataFrame]:
    review = validated_review(edited)
    return apply_review(log, review, keep_old_reason=True), review_audit(review)
