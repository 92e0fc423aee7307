"""Prediction tables and accuracy reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from alula.schema import require_columns


def ranked_choices(probabilities: Column, classes: Sequence[str], top: int = 3) -> Column:
    """Best ``top`` (label, p) pairs; equal probabilities rank by class order."""
    pairs = F.transform(
        probabilities, lambda p, i: F.struct((-p).alias("neg"), i.alias("rank"))
    )
    labels = F.array(*[F.lit(c) for c in classes])
    best = F.slice(F.array_sort(pairs), 1, top)
    return F.transform(best, lambda e: F.struct(F.get(labels, e["rank"]).alias("label"), (-e["neg"]).alias("p")))


def prediction_columns(df: DataFrame, level: str, classes: Sequence[str], probabilities: str = "proba") -> DataFrame:
    """Top-three columns from a probability array (aligned with ``classes``)."""
    ranked = df.withColumn("__top", ranked_choices(F.col(probabilities), classes))
    picks = [
        F.get("__top", 0)["label"].alias(f"predicted_{level}"),
        F.get("__top", 0)["p"].alias("confidence"),
    ]
    for rank, name in ((1, "second"), (2, "third")):
        picks += [
            F.get("__top", rank)["label"].alias(f"{name}_choice"),
            F.get("__top", rank)["p"].alias(f"{name}_confidence"),
        ]
    return ranked.select(*[c for c in df.columns if c != probabilities], *picks)


def with_correctness(df: DataFrame, level: str, truth: Column) -> DataFrame:
    """Truth and top-1 / top-3 hits; unknown truth is never a hit."""
    predicted = F.col(f"predicted_{level}")
    choices = F.array(predicted, F.col("second_choice"), F.col("third_choice"))
    true = F.col(f"true_{level}")
    return (
        df.withColumn(f"true_{level}", truth)
        .withColumn("correct_top1", F.coalesce(predicted == true, F.lit(False)))
        .withColumn("correct_top3", F.coalesce(F.array_contains(F.array_compact(choices), true), F.lit(False)))
    )


def attach_truth(predictions: DataFrame, truth: DataFrame, level: str, key: str = "tps_id") -> DataFrame:
    """Truth from a (key, label) table."""
    known = truth.select(key, F.col(level).alias("__truth"))
    joined = predictions.join(known, key, "left")
    return with_correctness(joined, level, F.col("__truth")).drop("__truth")


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    require_columns(df, ["correct_top1", "correct_top3"], "predictions without known truth")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("correct_top1").cast("int")).alias("accuracy_top1"),
        F.avg(F.col("correct_top3").cast("int")).alias("accuracy_top3"),
    )


def prediction_breakdown(df: DataFrame, level: str) -> DataFrame:
    column = f"predicted_{level}"
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def confidence_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("confidence").alias("mean_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
    )


def low_confidence(df: DataFrame, level: str, threshold: float = 0.6) -> DataFrame:
    wanted = ["tps_id", "inv_id", "image_path", f"predicted_{level}", "confidence", "second_choice"]
    return df.filter(F.col("confidence") < threshold).select([c for c in wanted if c in df.columns])


def confusion_counts(df: DataFrame, level: str) -> DataFrame:
    """Long confusion matrix over the labels present in the truth, zero-filled.

    The grid has one row per ordered pair of class labels."""
    true, predicted = f"true_{level}", f"predicted_{level}"
    counts = df.groupBy(true, predicted).agg(F.count(F.lit(1)).alias("n"))
    labels = df.filter(F.col(true).isNotNull()).select(true).distinct()
    every = labels.agg(F.sort_array(F.collect_set(true)).alias("labels"))
    # one row of class names rides along with each class: a lookup, not a product of data rows
    grid = every.select(F.explode("labels").alias(true), "labels").select(true, F.explode("labels").alias(predicted))
    return grid.join(counts, [true, predicted], "left").select(
        true, predicted, F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_matrix(df: DataFrame, level: str) -> DataFrame:
    true, predicted = f"true_{level}", f"predicted_{level}"
    return confusion_counts(df, level).groupBy(true).pivot(predicted).agg(F.first("n")).orderBy(true)


def class_report(df: DataFrame, level: str) -> DataFrame:
    """Per-class n, precision, recall and F1; an empty denominator gives 0."""
    true, predicted = f"true_{level}", f"predicted_{level}"
    cells = df.groupBy(true, predicted).agg(F.count(F.lit(1)).alias("n"))
    hit = F.col(true) == F.col(predicted)
    by_truth = cells.filter(F.col(true).isNotNull()).groupBy(F.col(true).alias(level)).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("tp")
    )
    by_prediction = cells.groupBy(F.col(predicted).alias(level)).agg(F.sum("n").alias("n_pred"))
    joined = by_truth.join(by_prediction, level, "left")

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    scored = joined.withColumn("precision", ratio(F.col("tp"), F.coalesce("n_pred", F.lit(0)))).withColumn(
        "recall", ratio(F.col("tp"), F.col("n"))
    )
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.select(level, "n", "precision", "recall", f1.alias("f1")).orderBy(level)


def device_report(df: DataFrame, level: str, device: str = "device") -> DataFrame:
    """Accuracy per device; empty when there are fewer than two devices."""
    known = df.filter(F.col(device).isNotNull())
    hit = (F.col(f"predicted_{level}") == F.col(f"true_{level}")).cast("int")
    per_device = known.groupBy(device).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(hit, F.lit(0))).alias("accuracy")
    )
    # a window over the already aggregated device table, a handful of rows
    counted = per_device.withColumn("__n_devices", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    return counted.filter(F.col("__n_devices") > 1).drop("__n_devices").orderBy(device)
