"""Run ledger: JSON parameters and metrics of training and evaluation runs."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.functions.strings import slug
from alula.schema import PREFERRED_METRICS
from alula.sources.tables import path_exists


class LedgerError(LookupError):
    """A run or model cannot be found in the ledger."""


def to_json_text(values: Mapping) -> str:
    return json.dumps(values, indent=None, ensure_ascii=False, default=str)


def write_record(spark: SparkSession, folder: str, name: str, values: Mapping) -> None:
    """One JSON record (``params``, ``metrics``, ...) below a run folder."""
    row = spark.createDataFrame([(to_json_text(values),)], "value string").coalesce(1)
    row.write.mode("overwrite").text(f"{folder}/{name}.json")


def write_run(spark: SparkSession, folder: str, params: Mapping, metrics: Mapping, log: str) -> None:
    write_record(spark, folder, "params", params)
    write_record(spark, folder, "metrics", metrics)
    spark.createDataFrame([(log,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/run.log")


def read_record(spark: SparkSession, folder: str, name: str) -> dict:
    path = f"{folder}/{name}.json"
    if not path_exists(spark, path):
        raise LedgerError(f"{path} not found")
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))  # one record


def _listed(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def read_runs(spark: SparkSession, root: str, family: str = "lda") -> DataFrame:
    """Metrics of every run below ``root/family``, with ``run`` = id/step/tag.

    Heterogeneous keys become the union of columns."""
    pattern = f"{root}/{family}/*/*/*/metrics.json"
    raw = spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(pattern)
    run = F.regexp_extract("_metadata.file_path", rf"/{re.escape(family)}/([^/]+/(?:train|predict)/[^/]+)/metrics\.json", 1)
    return raw.select(F.lit(None).cast("string").alias("__none"), "*", run.alias("run")).drop("__none").filter(F.col("run") != "")


def comparison_table(runs: DataFrame) -> DataFrame:
    """One row per run, preferred columns first."""
    lead = [c for c in PREFERRED_METRICS if c in runs.columns]
    rest = [c for c in runs.columns if c not in PREFERRED_METRICS and c != "run"]
    return runs.select("run", *lead, *rest).orderBy("run")


def next_versions(names: DataFrame) -> DataFrame:
    """Per base slug, the next free name: ``slug`` if unused, else ``slug_v<n+1>``.

    ``names``: (base, existing) pairs; an unversioned name counts as version 1."""
    version = F.when(F.col("existing") == F.col("base"), 1).when(
        F.col("existing").startswith(F.concat(F.col("base"), F.lit("_v"))),
        F.regexp_extract(F.substring(F.col("existing"), F.length("base") + 1, F.length("existing")), r"^_v(\d+)$", 1).try_cast("int"),
    )
    tops = names.groupBy("base").agg(
        F.max(version).alias("top"), F.max((F.col("existing") == F.col("base")).cast("int")).alias("taken")
    )
    return tops.select(
        "base",
        F.when(F.coalesce("taken", F.lit(0)) == 0, F.col("base"))
        .otherwise(F.concat("base", F.lit("_v"), (F.col("top") + 1).cast("string")))
        .alias("slug"),
    )


def slug_of(spark: SparkSession, text: str) -> str:
    """A folder name for one text."""
    return spark.range(1).select(slug(F.lit(text)).alias("v")).first()["v"]


def resolve_model_slug(spark: SparkSession, root: str, family: str, base_name: str) -> str:
    """Folder name of a new run that clobbers no earlier one."""
    base = slug_of(spark, base_name)
    existing = _listed(spark, f"{root}/{family}") or [None]
    names = spark.createDataFrame([(base, e) for e in existing], "base string, existing string")
    return next_versions(names).first()["slug"]


def find_model(spark: SparkSession, models: str, runs: str, name: str, family: str = "lda") -> str:
    """Folder of a model by run id (slug) or by the name recorded in its metrics."""
    folder = f"{models}/{family}/{slug_of(spark, name)}"
    if path_exists(spark, folder):
        return folder
    hits = []
    for run_id in _listed(spark, f"{runs}/{family}"):
        for tag in _listed(spark, f"{runs}/{family}/{run_id}/train"):
            metrics = read_record(spark, f"{runs}/{family}/{run_id}/train/{tag}", "metrics")
            if metrics.get("model_name") == name and path_exists(spark, f"{models}/{family}/{run_id}"):
                hits.append(f"{models}/{family}/{run_id}")
            break
    if len(hits) == 1:
        return hits[0]
    if hits:
        raise LedgerError(f"{name!r} matches several models: {hits}")
    raise LedgerError(f"no model named {name!r}; available: {_listed(spark, f'{models}/{family}')}")
