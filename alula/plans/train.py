"""Training, evaluation and reporting of shape classifiers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators import discriminant as LD
from alula.operators import reports as P
from alula.operators.dataset import singleton_classes, target_column
from alula.operators.superimposition import align_to_reference, consensus
from alula.sources import ledger as LG

FAMILY = "lda"


@dataclass
class TrainingRun:
    run_id: str
    model_path: str
    run_path: str
    metrics: Mapping
    predictions: DataFrame
    singletons: DataFrame


def _named(spark: SparkSession, column) -> str:
    return spark.range(1).select(column.alias("v")).first()["v"]


def train(
    spark: SparkSession, data: DataFrame, level: str, dataset_label: str, models: str, runs: str,
    model_name: str | None = None, n_axes: int = 2, max_iter: int = 100, order: str = "ord", params: Mapping | None = None,
    save: bool = True,
) -> TrainingRun:
    """Consensus, components, discriminant, leave-one-specimen-out accuracy, artifacts.

    Superimposition and components are fitted once on all photos; only the
    discriminant is cross-validated."""
    label = target_column(data, level)
    columns = [c for c in ("tps_id", "photo_id", "inv_id", "image_path") if c in data.columns]
    rows = data.filter(F.col(label).isNotNull()).select(order, *columns, F.col(label).alias("__class"), "x", "y")
    fitted = consensus(rows, [order], max_iter, label=order)
    shape = fitted.mean_shape
    slim = fitted.aligned.select(order, *columns, "__class", "ax", "ay")
    pca = LD.fit_components(slim, len(shape), shape.reshape(-1))
    scored = LD.with_scores(slim, pca).drop("ax", "ay")
    lda = LD.fit_discriminant(scored, "__class")
    base = model_name or _named(spark, S.run_id(F.lit(level), F.lit(dataset_label), F.lit(None).cast("array<string>"),
                                                F.lit(None).cast("string"), F.lit(None).cast("string")))
    base = f"{base}_{len(shape)}LM_{level}"
    run_id = LG.resolve_model_slug(spark, models, FAMILY, base)
    run_path, model_path = f"{runs}/{FAMILY}/{run_id}/train/{dataset_label}", f"{models}/{FAMILY}/{run_id}"
    alone = singleton_classes(scored, "__class")

    proba, classes = LD.leave_group_out(scored, "__class", "inv_id")
    table = P.with_correctness(P.prediction_columns(proba.drop("scores"), level, classes), level, F.col("__class"))
    table.drop("__class").write.mode("overwrite").parquet(f"{run_path}/loocv_predictions")
    predictions = spark.read.parquet(f"{run_path}/loocv_predictions")
    metrics = {
        "run_id": run_id, "model_name": base + run_id[len(LG.slug_of(spark, base)):], "level": level, "n_specimens": fitted.n_specimens,
        "n_points": len(shape), "n_pca_components": len(pca.loadings),
        "pca_explained_variance_cum": float(pca.explained_ratio.sum()), "gpa_n_iterations": fitted.n_iterations,
        **P.accuracy(predictions).first().asDict(),
    }
    fitted.release()
    log = (
        f"run_id={run_id} | level={level} | n={fitted.n_specimens} | {len(shape)} landmarks | consensus in "
        f"{fitted.n_iterations} iteration(s) | top-1 = {metrics['accuracy_top1']:.4f} | top-3 = {metrics['accuracy_top3']:.4f}"
    )
    LG.write_run(spark, run_path, {**(params or {}), "level": level, "dataset": dataset_label, "run_id": run_id, "family": FAMILY}, metrics, log)
    if save:
        meta = {"model_name": metrics["model_name"], "dataset_label": dataset_label, "n_train": fitted.n_specimens}
        model = LD.TrainedModel(shape, pca, lda, level, LD.projection_axes(len(lda.classes), n_axes), meta)
        LD.save_model(spark, model, model_path)
    return TrainingRun(run_id, model_path, run_path, metrics, predictions, alone)


def evaluate(
    spark: SparkSession, model_path: str, data: DataFrame, dataset_label: str, runs: str, run_id: str, order: str = "ord",
) -> DataFrame:
    """A stored model applied to labelled photos; predictions and metrics recorded.

    Parameters of the training run are inherited into the record."""
    model = LD.load_model(spark, model_path)
    inherited = LG.read_record(spark, f"{runs}/{FAMILY}/{run_id}/train/{model.meta['dataset_label']}", "params")
    label = target_column(data, model.level)
    columns = [c for c in ("tps_id", "photo_id", "inv_id", "image_path") if c in data.columns]
    rows = data.select(order, *columns, F.col(label).alias("__class"), "x", "y")
    table = P.with_correctness(LD.predict(model, rows).drop("x", "y"), model.level, F.col("__class")).drop("__class")
    path = f"{runs}/{FAMILY}/{run_id}/predict/{dataset_label}"
    table.write.mode("overwrite").parquet(f"{path}/predictions")
    predictions = spark.read.parquet(f"{path}/predictions")
    metrics = {
        "run_id": run_id, "model_name": model.label(run_id), "eval_tag": dataset_label, "model_path": model_path,
        "level": model.level, **P.accuracy(predictions).first().asDict(),
    }
    log = f"run_id={run_id} | eval_tag={dataset_label} | top-1 = {metrics['accuracy_top1']:.4f} | top-3 = {metrics['accuracy_top3']:.4f}"
    LG.write_run(spark, path, {**inherited, "eval_tag": dataset_label, "model_path": model_path}, metrics, log)
    return predictions


def classification_report(model: LD.TrainedModel, predictions: DataFrame, data: DataFrame, key: str = "tps_id") -> dict[str, DataFrame]:
    """Tables behind a report: confusion, per class, per device, aligned shapes, centroids, projection."""
    level = model.level
    label = target_column(data, level)
    devices = data.select(key, *[c for c in ("device", "device_tag") if c in data.columns])
    shown = data.join(predictions.select(key), key, "left_semi").select(key, F.col(label).alias("grp"), "x", "y")
    aligned = align_to_reference(shown, model.mean_shape, key).drop("x", "y")
    points = aligned.select("grp", F.posexplode_outer(F.arrays_zip("ax", "ay")).alias("i", "p"))
    projected = LD.score_shapes(model, shown, projection=True)
    tables = {
        "confusion": P.confusion_counts(predictions, level),
        "classes": P.class_report(predictions, level),
        "aligned": aligned,
        "centroids": points.groupBy("grp", "i").agg(F.avg("p.ax").alias("x"), F.avg("p.ay").alias("y")),
        "projection": projected.select(key, "grp", *[F.get("lda", k).alias(f"lda{k + 1}") for k in range(model.n_axes)]),
    }
    if "device" in devices.columns:
        tables["devices"] = P.device_report(predictions.join(devices, key, "left"), level)
    return tables
