"""Queries that write files Spark derives from the test tables and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alula.functions import strings as S
from alula.operators import discriminant as LD
from alula.operators import logs as L
from alula.operators import ordering as O
from alula.operators import ordering as O
from alula.plans import export as E
from alula.plans import prepare as PR
from alula.plans import train as T
from alula.session import scratch_path
from alula.sources import ledger as LG
from alula.sources import landmark_files as LF
from alula.sources import tables as TB
from alula.streaming import jobs as ST
from workload import views as V
from workload.registry import query
from workload.shape_queries import _model

# --- landmark files -------------------------------------------------------------------


def _landmarks(spark: SparkSession, d: str) -> DataFrame:
    return V.shapes(spark, d).selectExpr(
        "ord", "n_points", "x", "y", "concat('img/', ord, '.jpg') as image_path", "ord as tps_id",
        "concat('ph', ord) as photo_id", "case when ord % 4 <> 0 then inv_id end as inv_id", "species", "caste", "device_type",
    )


def _written(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "landmarks")
    LF.write_landmarks(_landmarks(spark, d), path)
    return path


@query("""
select vec_id as ord, 32 as n_points, concat('img/', vec_id, '.jpg') as image_path, vec_id as tps_id, concat('ph', vec_id) as photo_id,
       case when vec_id % 4 <> 0 then concat('S', label, '_', vec_id % 12) end as inv_id,
       round(list_sum([round(cast(v as double), 4) for v in embedding]), 4) as check_sum from embeddings""")
def landmark_file_round_trip(spark, d):
    rows = LF.read_landmarks(spark, _written(spark, d))
    total = F.aggregate(F.concat("x", "y"), F.lit(0.0), lambda a, v: a + v)
    return rows.select("ord", "n_points", "image_path", F.col("tps_id").cast("long").alias("tps_id"), "photo_id", "inv_id",
                       F.round(total, 4).alias("check_sum"))


# Blocks with every kind of damage; coordinates are thousandths of the vectors' own entries.
DAMAGE = """
case vec_id % 8 when 1 then 'expected 3 landmarks, found 2' when 2 then 'malformed landmark: ''7''' when 3 then 'non-numeric coordinate: ''1d 2f'''
                when 4 then 'no ID= found for this specimen' when 5 then 'non-integer ID: ''ID=x1''' when 6 then 'unreadable point count in ''LM=three''' end
"""


def _damaged(spark: SparkSession, d: str) -> str:
    """One file of three-point blocks; most kinds of damage occur in every eighth block each."""
    v = V.table(spark, d, "embeddings").select("vec_id", "embedding")
    value = "cast(round(cast(embedding[{}] as double) * 1000) as int)"
    pairs = ["concat({}, '{}', {})".format(value.format(2 * k), s, value.format(2 * k + 1)) for k, s in ((0, " "), (1, " "), (2, " "), (1, ","), (2, "\\t"))]
    plain = "concat_ws('\\n', {}, {}, {})".format(*pairs[:3])
    block = F.expr(f"""
      case vec_id % 8
        when 1 then concat('LM=3\\n1 2\\n3 4\\nIMAGE=i\\nID=', vec_id)
        when 2 then concat('LM=3\\n1 2\\n7\\n3 4\\n5 6\\nIMAGE=i\\nID=', vec_id)
        when 3 then concat('LM=3\\n1 2\\n1d 2f\\n3 4\\n5 6\\nID=', vec_id)
        when 4 then 'LM=3\\n1 2\\n3 4\\n5 6\\nIMAGE=i'
        when 5 then concat('LM=3\\n', {plain}, '\\nID=x1\\nID=', vec_id)
        when 6 then 'LM=three\\n8 9'
        when 7 then concat('\\tlm=3 \\t\\n\\n', {pairs[0]}, '\\n\\t', {pairs[3]}, '\\n', {pairs[4]}, ' 9\\t\\nscale=2\\n\\tid=', vec_id, '\\t\\nimage=a=b\\ncomment=photo_id=p', vec_id)
        else concat('LM=3\\n', {plain}, '\\nID=', vec_id, '\\nIMAGE=i\\nCOMMENT=free text') end""")
    path = scratch_path(spark, "damaged")
    v.select("vec_id", block.alias("value")).coalesce(1).sortWithinPartitions("vec_id").select("value").write.text(path)
    return path


@query(f"""
with b as (select vec_id, {DAMAGE} as message, case vec_id % 8 when 2 then 3 when 3 then 3 when 5 then 5 else 1 end as off,
                  case vec_id % 8 when 0 then 7 when 1 then 5 when 2 then 7 when 3 then 6 when 4 then 5 when 5 then 6 when 6 then 2 else 9 end as n from embeddings),
p as (select *, row_number() over (order by vec_id) - 1 as k, coalesce(sum(n) over (order by vec_id rows between unbounded preceding and 1 preceding), 0) as before from b)
select k as specimen_index, cast(before + off as bigint) as line_no, message from p where message is not null
union all select k + 1, cast(before + 2 as bigint), 'expected ''LM='', found: ''8 9''' from p where vec_id % 8 = 6""")
def landmark_file_errors(spark, d):
    found = LF.read_landmark_errors(spark, _damaged(spark, d))
    return found.select("specimen_index", F.col("line_no").cast("long").alias("line_no"), "message")


@query("""
select vec_id as tps_id, case when vec_id % 8 = 7 then 'a=b' when vec_id % 8 = 5 then '' else 'i' end as image_path,
       case when vec_id % 8 = 7 then concat('p', vec_id) end as photo_id, list_transform([1, 3, 5], lambda i: round(cast(embedding[i] as double) * 1000) + 0.0) as x,
       list_transform([2, 4, 6], lambda i: round(cast(embedding[i] as double) * 1000) + 0.0) as y from embeddings where vec_id % 8 in (0, 5, 7)""")
def damaged_file_survivors(spark, d):
    rows = LF.read_landmarks(spark, _damaged(spark, d), strict=False, rank=False)
    return rows.select(F.col("tps_id").cast("long").alias("tps_id"), "image_path", "photo_id", "x", "y")


@query("""
select row_number() over (order by vec_id) - 1 as tps_id, concat('img/', vec_id, '.jpg') as image_path, 31 as n_points from embeddings""")
def clean_file_rewrite(spark, d):
    path = scratch_path(spark, "clean")
    LF.write_clean_landmarks(LF.without_landmark(LF.read_landmarks(spark, _written(spark, d)), 3), path)
    rows = LF.read_landmarks(spark, path, rank=False)
    return rows.select(F.col("tps_id").cast("long").alias("tps_id"), "image_path", "n_points")


@query("""
select concat('ph', vec_id) as photo_id, row_number() over (order by concat('ph', vec_id)) as tps_id from embeddings""")
def merged_landmark_uploads(spark, d):
    rows, paths = _landmarks(spark, d), []
    for k in range(2):
        paths.append(scratch_path(spark, "upload"))
        LF.write_landmarks(rows.filter(F.col("ord") % 2 == k), paths[-1])
    merged = LF.read_uploads(spark, paths)
    return merged.select("photo_id", F.col("tps_id").cast("long").alias("tps_id"))


@query("""
select i, round(cast(embedding[2 * i + 1] as double), 4) + 0.0 as x, round(cast(embedding[2 * i + 2] as double), 4) + 0.0 as y
from embeddings, range(32) t(i) where vec_id = 0""")
def reference_file(spark, d):
    path = scratch_path(spark, "reference")
    LF.write_landmarks(_landmarks(spark, d).filter("ord = 0"), path)
    shape = LF.read_reference(spark, path)
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(shape)], "i long, x double, y double")


@query(V.with_sql(V.PHOTO_SQL) + """
select 'demo_set' as dataset_name, count(*) as n_photos, count(distinct inv_id) as n_specimens from photo""")
def dataset_config(spark, d):
    photos = V.photos(spark, d)
    return TB.write_dataset_config(spark, scratch_path(spark, "config"), "demo/set", photos, photos.select("inv_id").distinct())


@query(V.with_sql(V.LOG_SQL) + """
select photo_key, arg_max(status, ord) as status from log group by 1""")
def csv_log_round_trip(spark, d):
    path = scratch_path(spark, "log")
    V.log(spark, d).select("ord", "photo_key", "status").write.option("header", True).csv(path)
    rows = TB.read_text_table(spark, path).withColumn("ord", F.col("ord").cast("long"))
    return L.latest_status(rows, ["ord"], "photo_key").select(F.col("photo_key").cast("long").alias("photo_key"), "status")


@query(V.with_sql(V.LOG_SQL) + "select status, count(*) as n from log group by 1")
def appended_log(spark, d):
    path = scratch_path(spark, "appended")
    log = V.log(spark, d).select("ord", "status")
    TB.append_log(log.filter("ord % 2 = 0"), path, first=True)
    TB.append_log(log.filter("ord % 2 = 1"), path)
    TB.append_log(log.filter("ord < 0"), path)
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_sql(V.PHOTO_SQL) + """
, m as (select species, count(*) as n, count(*) filter (caste = 'worker') as w from photo group by 1)
select concat('lda_', species, '/train/set') as run, species as model_name, n, round(w / n, 6) as accuracy_top1 from m""")
def run_ledger(spark, d):
    root = scratch_path(spark, "runs")
    table = V.photos(spark, d).groupBy("species").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("caste") == "worker").cast("int")), 6).alias("accuracy_top1"))
    for r in table.collect():  # one record per class
        LG.write_record(spark, f"{root}/lda/lda_{r['species']}/train/set", "metrics",
                        {"model_name": r["species"], "n": r["n"], "accuracy_top1": r["accuracy_top1"]})
    return LG.comparison_table(LG.read_runs(spark, root))


@query("""
select 'species' as level, 32 as n_points, 60 as n_components, count(distinct label) as n_classes from embeddings""")
def stored_model(spark, d):
    path = scratch_path(spark, "model")
    LD.save_model(spark, _model(spark, d), path)
    model = LD.load_model(spark, path)
    row = [(model.level, model.n_points, len(model.pca.loadings), len(model.classes))]
    return spark.createDataFrame(row, "level string, n_points int, n_components int, n_classes long")


# --- jobs --------------------------------------------------------------------------------


@query(V.with_sql(V.PHOTO_SQL) + """
select 'exported' as part, count(*) as n from photo where caste = 'worker' and species not in ('sp1', 'sp2')
union all select 'failed:outlier_registration', count(*) from photo where caste = 'worker' and species = 'sp1'
union all select 'failed:biological_metadata', count(*) from photo where caste = 'worker' and species = 'sp2'""")
def export_package(spark, d):
    photos = V.photos(spark, d)
    landmarks = V.shapes(spark, d).selectExpr(
        "ord", "n_points", "x", "y", "'' as image_path", "ord as tps_id", "concat('ph', ord) as photo_id", "inv_id", "species as sp", "caste as ca").filter("ca = 'worker'").drop("ca")
    biology = photos.filter("species <> 'sp2'").groupBy("inv_id").agg(F.min("species").alias("species"), F.min("caste").alias("caste"))
    manifest = photos.selectExpr("concat('ph', ord) as photo_id", "inv_id", "device_type", "1 as photo_index", "'p' as path")
    statuses = landmarks.selectExpr("photo_id", "inv_id", "tps_id", "case when sp = 'sp1' then 'SUSPECT' else 'OK' end as status", "'' as error_reason")
    package = E.export_tables(landmarks.drop("sp"), biology, manifest, statuses)
    path = scratch_path(spark, "export")
    E.write_package(package, path, "demo")
    written = LF.read_landmarks(spark, f"{path}/32lm/demo-landmarks_crop.tps", rank=False)
    parts = written.select(F.lit("exported").alias("part")).unionByName(
        package["failed"].select(F.concat(F.lit("failed:"), F.col("stage")).alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")


PREPARED = """
docs as (select doc_id, source, lang, text, case when doc_id % 4 = 0 then 'P' else 'S' end as dev, concat('T', doc_id // 8) as raw_id from documents)
"""


@query(V.with_sql(PREPARED) + """

select raw_id as original_id, dev as device_type, count(*) as n from docs group by 1, 2""")
def prepared_source(spark, d):
    docs = V.table(spark, d, "documents")
    scan = docs.select(
        F.expr("concat('T', doc_id div 8)").alias("original_id"), F.lit("field").alias("source_type"),
        F.expr("case when doc_id % 4 = 0 then 'P' end").alias("device_type"), F.col("doc_id").alias("shot_index"),
        F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("raw_path"),
        F.lit(".jpg").alias("ext"), F.length("text").cast("long").alias("file_size_bytes"),
        S.content_hash(F.concat(F.col("doc_id").cast("string"), F.col("text"))).alias("content_hash"),
        F.lit("OK").alias("status"), F.lit("").alias("status_reason"),
    )
    ident = docs.selectExpr("concat('T', doc_id div 8) as raw_id", "doc_id div 8 as k").groupBy("raw_id", "k").agg(
        F.min("k").alias("ord")).selectExpr(
        "raw_id", "ord", "'G' as genus", "concat('s', k % 4) as species", "'worker' as caste", "cast(null as int) as dd",
        "cast(null as int) as mm", "cast(null as int) as yyyy", "concat('site ', k % 3) as collection_origin")
    codes = ident.selectExpr("collection_origin", "case when collection_origin = 'site 0' then '' else 'ST' || right(collection_origin, 1) end as inv_name").distinct()
    out = PR.prepare_source(scan, ident, PR.SourceConfig("field", "raw_id", origin_codes=codes), PR.empty_mapping(spark), "t0")
    bio = out.biology.select("inv_id", "original_id")
    photos = out.dataset.join(bio, "inv_id")
    return photos.groupBy("original_id", "device_type").agg(F.count(F.lit(1)).alias("n"))


@query("""
select 'all_ok' as gate, count(*) as n_manifest, 0 as n_conflicts from documents union all
select 'blocked', count(*), count(distinct lang) from (select *, count(*) over (partition by lang) as k from documents)""")
def manifest_gate(spark, d):
    docs = V.table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("I"), F.col("doc_id").cast("string")).alias("inv_id"), F.col("lang").alias("species"),
        F.lit("q").alias("caste"), F.concat(F.lit("f/"), F.col("doc_id").cast("string")).alias("path"))
    files = docs.select("path", F.lit("h").alias("content_hash"), F.lit(1).cast("long").alias("file_size_bytes"))
    good = PR.build_manifest(docs, files, "path", order=["doc_id"])
    bad = PR.build_manifest(docs.withColumn("inv_id", F.col("species")).withColumn(
        "caste", F.when(F.col("doc_id") % 2 == 0, "q").otherwise("w")), files, "path", order=["doc_id"])

    def summary(result) -> DataFrame:
        conflicts = result.conflicts.select("inv_id").distinct()
        gate = "all_ok" if result.complete else "blocked"
        return result.manifest.agg(F.count(F.lit(1)).alias("n_manifest")).join(
            conflicts.agg(F.count(F.lit(1)).alias("n_conflicts")), F.lit(True)).select(F.lit(gate).alias("gate"), "n_manifest", "n_conflicts")

    return summary(good).unionByName(summary(bad))


@query()
def train_and_evaluate(spark, d):
    """Whole train job on the embedded shapes, then the stored model applied to the same photos."""
    data = V.near_shapes(spark, d).selectExpr(
        "ord", "n_points", "x", "y", "ord as tps_id", "concat('ph', ord) as photo_id", "inv_id", "species", "caste",
        "'' as image_path", "device_type as device")
    models, runs = scratch_path(spark, "models"), scratch_path(spark, "runs")
    trained = T.train(spark, data, "species", "demo", models, runs)
    T.evaluate(spark, trained.model_path, data, "field", runs, trained.run_id)
    return LG.comparison_table(LG.read_runs(spark, runs)).select("run", "n", "accuracy_top1", "accuracy_top3")


# --- streams --------------------------------------------------------------------------------


def _log_folder(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "arrivals")
    V.log(spark, d).selectExpr("ord", "photo_key as photo_id", "status", "step", "processed_at").repartitionByRange(6, "ord").write.parquet(path)
    return path


@query(V.with_sql(V.LOG_SQL) + "select step, status, count(*) as n from log group by 1, 2")
def stream_status_counters(spark, d):
    return ST.run_status_counters(spark, _log_folder(spark, d), scratch_path(spark, "counters"))


@query(V.with_sql(V.LOG_SQL) + "select photo_key as photo_id, arg_max(status, ord) as status, max(ord) as ord from log group by 1")
def stream_latest_status(spark, d):
    return ST.run_latest_status(spark, _log_folder(spark, d), scratch_path(spark, "latest")).select("photo_id", "status", "ord")


@query("select count(*) as n_rows, count(distinct content_hash) as n_hashes from (select distinct substr(sha256(text), 1, 16) as content_hash from documents)")
def stream_content_dedup(spark, d):
    source = scratch_path(spark, "contents")
    V.file_scan(spark, d).select("ord", S.content_hash(F.col("content")).alias("content_hash")).repartitionByRange(6, "ord").write.parquet(source)
    kept = ST.run_content_dedup(spark, source, scratch_path(spark, "unique"))
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("content_hash").alias("n_hashes"))


@query("""
select 'usable' as kind, vec_id as tps_id, 32 as n_points, round(cast(embedding[1] as double), 4) as x1, round(cast(embedding[64] as double), 4) as y32, null as message
from embeddings where vec_id % 7 <> 3
union all
select 'fault', null, null, null, null, 'expected 33 landmarks, found 32' from embeddings where vec_id % 7 = 3""")
def stream_landmark_ingest(spark, d):
    """Every seventh block names a point too many: its fault goes to the second table, the others' coordinates to the first."""
    source, target = scratch_path(spark, "damaged"), scratch_path(spark, "ingested")
    lines = spark.read.option("lineSep", "\nLM=").text(_written(spark, d))
    wrong = F.regexp_extract("value", r"(?m)^ID=(\d+)", 1).cast("long") % 7 == 3
    body = F.regexp_replace("value", r"^(?:LM=)?32", "")
    lines.select(F.concat(F.when(wrong, "LM=33").otherwise("LM=32"), body).alias("value")).write.option("lineSep", "\n").text(source)
    table = ST.run_landmark_ingest(spark, source, target)
    faults = spark.read.parquet(f"{target}__errors")
    usable = table.select(F.lit("usable").alias("kind"), F.col("tps_id").cast("long").alias("tps_id"), "n_points", F.col("x")[0].alias("x1"), F.col("y")[31].alias("y32"),
                          F.lit(None).cast("string").alias("message"))
    return usable.unionByName(faults.select(F.lit("fault").alias("kind"), "message"), allowMissingColumns=True)


@query("select vec_id as tps_id, true as same from embeddings")
def stream_scoring(spark, d):
    """Scores from the stream equal the batch predictions."""
    model = _model(spark, d)
    arrivals = scratch_path(spark, "shapes")
    _landmarks(spark, d).repartitionByRange(4, "ord").write.parquet(arrivals)
    scored = ST.run_scoring(spark, arrivals, scratch_path(spark, "scored"), model)
    batch = LD.predict(model, _landmarks(spark, d)).select("tps_id", F.col("predicted_species").alias("b"), F.col("confidence").alias("bc"))
    joined = scored.join(batch, "tps_id")
    return joined.select("tps_id", ((F.col("predicted_species") == F.col("b")) & (F.abs(F.col("confidence") - F.col("bc")) < 1e-9)).alias("same"))


