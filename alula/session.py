"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A group heavier than this is split over several tasks instead of being
#: ranked, sorted or collected inside one (see ``operators.ordering``).
HOT_GROUP_ROWS = 2_000_000

#: Upper bound, in bytes, for anything shipped whole to every task.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "alula", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling switched on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def setting(spark: SparkSession, key: str, default: int) -> int:
    """An ``alula.*`` tuning knob read from the session."""
    return int(spark.conf.get(f"spark.alula.{key}", str(default)))


def hot_group_rows(spark: SparkSession) -> int:
    return setting(spark, "hotGroupRows", HOT_GROUP_ROWS)


def broadcast_bytes(spark: SparkSession) -> int:
    return setting(spark, "broadcastBytes", BROADCAST_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and the session runs on
    one machine (tests) is a temporary folder made."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: fixes row placement and cuts the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application."""
    import shutil
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    bundle = shutil.make_archive(tempfile.mkdtemp(prefix="spark-") + "/alula", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(bundle)
    _shipped.add(app)
