"""The driver tables seen as morphometric data: Spark frames and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PHOTO_SQL = """
photo as (
  select vec_id as ord, concat('S', label, '_', vec_id % 12) as inv_id, concat('sp', label) as species,
         case when (vec_id % 12) % 2 = 0 then 'worker' else 'queen' end as caste,
         case when (vec_id // 12) % 2 = 0 then 'P' else 'S' end as device_type
  from embeddings)
"""

PHOTO_COLUMNS = [
    "vec_id as ord",
    "concat('S', label, '_', vec_id % 12) as inv_id",
    "concat('sp', label) as species",
    "case when (vec_id % 12) % 2 = 0 then 'worker' else 'queen' end as caste",
    "case when (vec_id div 12) % 2 = 0 then 'P' else 'S' end as device_type",
]


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(*PHOTO_COLUMNS)


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings read as 32 planar points: even entries x, odd entries y."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        *PHOTO_COLUMNS,
        "32 as n_points",
        "transform(sequence(0, 31), i -> cast(embedding[2 * i] as double)) as x",
        "transform(sequence(0, 31), i -> cast(embedding[2 * i + 1] as double)) as y",
    )


POINTS_SQL = """
pts as (
  select vec_id as ord, i, cast(embedding[2 * i + 1] as double) as x, cast(embedding[2 * i + 2] as double) as y
  from embeddings, range(32) t(i))
"""

#: Shapes near one template, so that the consensus settles; every fiftieth is far off it in three fifths of its points.
_NEAR = "cos(2 * pi() * i / 32) * (1 + 0.3 * (i % 3)) + {w} * {x}", "sin(2 * pi() * i / 32) * (1 + 0.3 * (i % 3)) + {w} * {y}"
_NEAR_WEIGHT = "case when vec_id % 50 = 7 and i % 5 < 3 then 2.0e0 else 0.02e0 end"


def near_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (t.format(w=_NEAR_WEIGHT, x="cast(embedding[2 * i] as double)", y="cast(embedding[2 * i + 1] as double)") for t in _NEAR)
    return table(spark, sf_dir, "embeddings").selectExpr(
        *PHOTO_COLUMNS, "32 as n_points", f"transform(sequence(0, 31), i -> {x}) as x", f"transform(sequence(0, 31), i -> {y}) as y"
    )


NEAR_POINTS_SQL = "pts as (select vec_id as ord, i, {} as x, {} as y from embeddings, range(32) t(i))".format(
    *(t.format(w=_NEAR_WEIGHT, x="cast(embedding[2 * i + 1] as double)", y="cast(embedding[2 * i + 2] as double)") for t in _NEAR)
)

LOG_SQL = """
log as (
  select event_id as ord, user_id as photo_key,
         case event_type when 'view' then 'OK' when 'purchase' then 'OK' when 'click' then 'SKIPPED'
                         when 'signup' then 'SUSPECT' else 'FAILED' end as status,
         case event_id % 3 when 0 then 'detection' when 1 then 'normalization' else 'landmarks' end as step,
         value as processing_time_s, ts as processed_at
  from events)
"""

LOG_COLUMNS = [
    "event_id as ord",
    "user_id as photo_key",
    "case event_type when 'view' then 'OK' when 'purchase' then 'OK' when 'click' then 'SKIPPED' "
    "when 'signup' then 'SUSPECT' else 'FAILED' end as status",
    "case event_id % 3 when 0 then 'detection' when 1 then 'normalization' else 'landmarks' end as step",
    "value as processing_time_s",
    "ts as processed_at",
]


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*LOG_COLUMNS)


IDENT_SQL = """
ident as (
  select o_orderkey as ord, o_custkey as original_id, o_orderstatus as device_type, o_orderpriority as species,
         year(o_orderdate) as yyyy, case when o_orderkey % 7 = 0 then null else month(o_orderdate) end as mm,
         day(o_orderdate) as dd
  from orders)
"""


def identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as ord", "o_custkey as original_id", "o_orderstatus as device_type", "o_orderpriority as species",
        "year(o_orderdate) as yyyy", "case when o_orderkey % 7 = 0 then null else month(o_orderdate) end as mm",
        "day(o_orderdate) as dd",
    )


SPECIMEN_SQL = """
specimen as (
  select c_custkey as original_id, c_mktsegment as species, n_name as origin,
         case when n_nationkey % 5 = 0 then '' else concat('N', n_nationkey) end as inv_name
  from customer join nation on c_nationkey = n_nationkey)
"""


def specimens(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey as original_id", "c_mktsegment as species", "n_name as origin",
        "case when n_nationkey % 5 = 0 then '' else concat('N', n_nationkey) end as inv_name",
    )


SCAN_SQL = """
scan as (
  select doc_id as ord, source as root, text as content,
         case doc_id % 4 when 0 then concat('ID_', doc_id, '_s', doc_id % 3 + 1)
                         when 1 then concat('ID-', doc_id, '-P-', doc_id % 3 + 1)
                         when 2 then concat('ID', doc_id, '_', doc_id % 3 + 1)
                         else concat('bad', doc_id) end as stem
  from documents)
"""


def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id as ord", "source as root", "text as content",
        "case doc_id % 4 when 0 then concat('ID_', doc_id, '_s', doc_id % 3 + 1) "
        "when 1 then concat('ID-', doc_id, '-P-', doc_id % 3 + 1) "
        "when 2 then concat('ID', doc_id, '_', doc_id % 3 + 1) else concat('bad', doc_id) end as stem",
    )


PRED_SQL = """
pred as (
  select l.doc_id as ord, concat('q', quality) as true_species, concat('q', toxic) as predicted_species,
         lang as device
  from labels l join documents d on l.doc_id = d.doc_id)
"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").select("doc_id", "lang")
    return labels.join(docs, "doc_id").selectExpr(
        "doc_id as ord", "concat('q', quality) as true_species", "concat('q', toxic) as predicted_species",
        "lang as device",
    )


def with_sql(*parts: str) -> str:
    return "with " + ",".join(parts)
