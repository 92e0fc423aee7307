"""Incremental jobs. Each processes what has arrived and stops (``availableNow``),
resumes from its checkpoint, and returns its result table.

Tables written batch by batch have a folder per batch (``batch=<id>``). A batch that is repeated after a crash
replaces its own folder, so it adds nothing, and several tables of one batch agree again."""

from __future__ import annotations

import contextlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alula.operators.discriminant import TrainedModel, score_shapes
from alula.operators.ordering import latest_rows
from alula.operators.reports import prediction_columns
from alula.schema import LANDMARKS
from alula.sources.landmark_files import parse_blocks, stream_blocks
from alula.sources.tables import path_exists

#: Parts of the table of contents already seen; a batch reads those that it touches.
CONTENT_PARTS = 64
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arriving(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files arriving in a folder; the schema comes from what is there."""
    reader = spark.readStream.schema(spark.read.parquet(folder).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _append(stream: DataFrame, target: str) -> None:
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", target + "__state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _store_batch(rows: DataFrame, target: str, batch_id: int, *parts: str) -> None:
    """The batch's folder of a table, replaced as a whole."""
    rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{target}/batch={batch_id}")


def _run_batches(stream: DataFrame, target: str, handle, mode: str = "append") -> None:
    query = (
        stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", target + "__state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_landmark_ingest(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Usable blocks of new landmark files appended to a table; files already seen are not read again.

    What is wrong with the other blocks goes to the table ``<target>__errors``: source, place of the block, line and message.
    A batch is parsed once for both tables."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDMARKS.fields if f.name != "ord"]

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_blocks(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _store_batch(parsed.filter("usable").select(*fields), target, batch_id)
            faults = parsed.select("source", "start", "pos", F.explode("problems").alias("p"))
            _store_batch(faults.select("source", "start", "pos", "p.line_in_block", "p.message"), f"{target}__errors", batch_id)
        finally:
            parsed.unpersist()

    _run_batches(stream_blocks(spark, folder), target, store)
    return spark.read.parquet(target).drop("batch")


@contextlib.contextmanager
def _keyed_state(spark: SparkSession):
    """State of queries started inside is kept by RocksDB: on disk, with changes only in its checkpoints."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run_latest_status(spark: SparkSession, folder: str, target: str, order: str = "ord", key: str = "photo_id",
                      files_per_batch: int | None = 2) -> DataFrame:
    """Latest log row per photo, whatever the order of arrival.

    The latest rows are keyed state. A batch writes the keys that it touched and nothing else; of a key's rows in the
    table, that of the last batch counts. Repeating a batch changes nothing."""
    stream = arriving(spark, folder, files_per_batch)
    names = stream.columns
    latest = stream.groupBy(key).agg(F.max_by(F.struct(*[c for c in names if c != key]), F.col(order)).alias("row"))

    def store(batch: DataFrame, batch_id: int) -> None:
        _store_batch(batch.select(key, "row.*").select(names), target, batch_id)

    with _keyed_state(spark):
        _run_batches(latest, target, store, "update")
    return latest_rows(spark.read.parquet(target), [key], ["batch"]).drop("batch")


def run_status_counters(spark: SparkSession, folder: str, target: str, files_per_batch: int | None = 2) -> DataFrame:
    """Running counts per (step, status); the stored table has one row per pair."""
    counts = arriving(spark, folder, files_per_batch).groupBy("step", "status").agg(F.count(F.lit(1)).alias("n"))

    def store(batch: DataFrame, _: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(target)

    query = (
        counts.writeStream.outputMode("complete").foreachBatch(store)
        .option("checkpointLocation", target + "__state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(target)


def windowed_counters(stream: DataFrame, width: str = "1 hour", delay: str = "2 hours", time: str = "processed_at") -> DataFrame:
    """Counts per time window, step and status; rows later than ``delay`` are dropped."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width), "step", "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def run_content_dedup(spark: SparkSession, folder: str, target: str, time: str | None = None, delay: str = "7 days",
                      files_per_batch: int | None = None) -> DataFrame:
    """First arrival of each content. With a time column the remembered hashes are state that expires after ``delay``.

    Without one nothing is kept in memory: the table itself, divided by a hash of the content, says what has been seen, and a batch
    is held against the hashes of the parts that it touches. One of several rows with a content in a batch stays."""
    if time:
        stream = arriving(spark, folder, files_per_batch)
        _append(stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"]), target)
        return spark.read.parquet(target)
    stream = arriving(spark, folder, files_per_batch)
    part = F.pmod(F.xxhash64("content_hash"), F.lit(CONTENT_PARTS)).cast("int")
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType()), T.StructField("part", T.IntegerType())])

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = batch.dropDuplicates(["content_hash"]).withColumn("part", part)
        if path_exists(session, target):
            touched = [r[0] for r in fresh.select("part").distinct().collect()]  # at most CONTENT_PARTS numbers
            # a repeated batch is not held against what it wrote before
            seen = session.read.schema(schema).parquet(target).where((F.col("batch") != batch_id) & F.col("part").isin(touched))
            seen = seen.select(F.col("content_hash").alias("seen_hash"))
            fresh = fresh.join(seen, F.col("content_hash").eqNullSafe(F.col("seen_hash")), "left_anti")
        _store_batch(fresh, target, batch_id, "part")

    _run_batches(stream, target, store)
    return spark.read.schema(schema).parquet(target).drop("batch", "part")


def run_scoring(spark: SparkSession, folder: str, target: str, model: TrainedModel) -> DataFrame:
    """Arriving shapes scored with a frozen model by the same code as a batch."""
    stream = arriving(spark, folder)
    scored = prediction_columns(score_shapes(model, stream), model.level, model.classes)
    _append(scored.drop("x", "y"), target)
    return spark.read.parquet(target)
