import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from alula.operators.discriminant import load_model
from alula.plans import export as E
from alula.plans import prepare as PR
from alula.plans import review as RV
from alula.plans import train as T
from alula.plans.variance_report import variance_report
from alula.sources import images as IM
from alula.sources import ledger as LG
from alula.sources import tables as TB
from alula.streaming import jobs as ST
from tests.shapes import BASE, frame, population


@pytest.fixture(scope="module")
def photo_tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("photos")
    for name, content in (
        ("anna/A1_S1.JPG", b"one"), ("anna/A1_S2.jpg", b"two"), ("ben/A2_P1.png", b"three"), ("ben/copy_S1.jpg", b"one"),
        ("odd.jpeg", b"four"), ("notes.txt", b"no"),
    ):
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(content)
    return str(root)


def test_image_scan(spark, photo_tree):
    roots = [{"path": photo_tree, "source_type": "field", "photographer_subfolder": True}, {"path": photo_tree + "/missing", "source_type": "x"}]
    rows = {r["raw_path"].rsplit("/", 1)[-1]: r for r in IM.scan_roots(spark, roots).collect()}
    assert set(rows) == {"A1_S1.JPG", "A1_S2.jpg", "A2_P1.png", "copy_S1.jpg", "odd.jpeg"}
    a = rows["A1_S1.JPG"]
    assert (a["original_id"], a["device_type"], a["shot_index"], a["photographer"], a["ext"], a["file_size_bytes"]) == ("A1", "S", 1, "anna", ".jpg", 3)
    assert len(a["content_hash"]) == 16 and a["status"] == "OK" and rows["copy_S1.jpg"]["status"] == "SUSPECT"
    assert rows["odd.jpeg"]["status"] == "FAILED" and rows["odd.jpeg"]["photographer"] is None


def test_prepare_dataset(spark, photo_tree, tmp_path):
    scan = IM.scan_roots(spark, [{"path": photo_tree, "source_type": "field"}])
    ident = spark.createDataFrame(
        [(0, "A1", "B", "x", "w", "N side"), (1, "A1", "B", "y", "w", "N side"), (2, "A2", "B", "x", "q", "S side"), (3, "A9", "B", "x", "q", "S side")],
        "ord long, num string, genus string, species string, caste string, place string")
    codes = spark.createDataFrame([("N side", "NN"), ("S side", "")], "collection_origin string, inv_name string")
    config = PR.SourceConfig("field", "num", origin_codes=codes, origin_column="place", image_group_by=["species"])
    one = PR.prepare_source(scan, ident, config, PR.empty_mapping(spark), "t0")
    assert {r["original_id"]: r["inv_id"] for r in one.mapping.collect()} == {"A1": "NN_0001", "A2": "S side_0001", "A9": "S side_0002"}
    assert one.conflicts.count() == 2 and [r["inv_id"] for r in one.excluded.collect()] == ["S side_0002"]
    assert {r["original_id"] for r in one.orphans.collect()} == {"copy"}
    photos = {r["photo_id"]: r for r in one.photos.collect()}
    assert set(photos) == {"NN_0001_S_1", "NN_0001_S_2", "S side_0001_P_1"}
    assert photos["NN_0001_S_1"]["target_path"] == "x/NN_0001_S_1.jpg"
    assert set(one.dataset.columns) >= {"photo_id", "inv_id", "species", "caste", "path"}

    broken = ident.withColumn("num", F.concat(F.lit("Q"), F.col("num")))
    bad = PR.SourceConfig("other", "num", origin_codes=codes, origin_column="place")
    out = PR.prepare_dataset(spark, [(scan, ident, config)], "my/set", str(tmp_path / "d"), "t0")
    assert out.manifest.count() == 3 and out.biology.count() == 2 and out.failed_sources == []
    assert out.config.first().asDict() == {"dataset_name": "my_set", "n_photos": 3, "n_specimens": 2}
    assert broken.count() == 4 and bad.source_type == "other"
    with pytest.raises(ValueError, match="no source"):
        PR.prepare_dataset(spark, [], "x", str(tmp_path / "e"), "t0")


def test_manifest_gate(spark):
    df = spark.createDataFrame([(0, "i", "x", "w", "a.jpg"), (1, "i", "y", "w", "b.jpg")], "ord long, inv_id string, species string, caste string, path string")
    files = spark.createDataFrame([("a.jpg", "h", 1), ("b.jpg", "g", 2)], "path string, content_hash string, file_size_bytes long")
    blocked = PR.build_manifest(df, files)
    assert not blocked.complete and blocked.biology is None and blocked.conflicts.count() == 2 and blocked.counters["suspect"] == 2
    good = PR.build_manifest(df.withColumn("species", F.lit("x")), files)
    assert good.complete and good.biology.first()["n_photos_S"] == 2
    lost = PR.build_manifest(df.withColumn("species", F.lit("x")), files.filter("path = 'a.jpg'"))
    assert not lost.complete and lost.counters["failed"] == 1


@pytest.fixture(scope="module")
def shapes(spark):
    wide = BASE * np.array([1.3, 1.0])
    members = population(40, 1, 0.06) + population(40, 2, 0.06, wide)
    n = len(members)
    return frame(
        spark, members, species=["a"] * 40 + ["b"] * 40, caste=["w", "q"] * 40, inv_id=[f"i{i // 4}" for i in range(n)],
        photo_id=[f"p{i}" for i in range(n)], tps_id=list(range(n)), image_path=[""] * n, device=["P", "S"] * 40, device_tag=["P1", "S1"] * 40,
    ).cache()


def test_train_evaluate_report(spark, shapes, tmp_path):
    models, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    run = T.train(spark, shapes, "species", "set", models, runs, model_name="Demo name")
    assert run.run_id == "Demo-name_8LM_species" and run.metrics["n"] == 80 and run.metrics["accuracy_top1"] > 0.95
    assert run.metrics["n_pca_components"] == 12 and run.singletons.count() == 0
    again = T.train(spark, shapes, "species", "set", models, runs, model_name="Demo name")
    assert again.run_id == "Demo-name_8LM_species_v2" and again.metrics["model_name"] == "Demo name_8LM_species_v2"
    predictions = T.evaluate(spark, run.model_path, shapes, "field", runs, run.run_id)
    assert predictions.count() == 80
    table = LG.comparison_table(LG.read_runs(spark, runs))
    assert table.count() == 3 and table.columns[:4] == ["run", "model_name", "eval_tag", "n"]
    assert LG.read_record(spark, run.run_path, "params")["family"] == "lda"
    assert LG.find_model(spark, models, runs, "Demo name_8LM_species_v2").endswith("_v2")
    with pytest.raises(LG.LedgerError):
        LG.find_model(spark, models, runs, "nobody")
    report = T.classification_report(load_model(spark, run.model_path), predictions, shapes)
    assert report["confusion"].count() == 4 and report["devices"].count() == 2 and report["centroids"].count() == 16
    assert report["projection"].count() == 80 and report["aligned"].count() == 80


def test_variance_report(shapes):
    rows = {r["source"]: r for r in variance_report(shapes, ["species", "inv_id"], ["P1", "S1"], balanced_devices=True).collect()}
    assert rows["species"]["df"] == 1 and rows["inv_id"]["df"] == 18 and rows["Residual"]["df"] == 60
    assert rows["species"]["f"] > 10
    with pytest.raises(ValueError):
        variance_report(shapes, ["species"], balanced_devices=True)


def test_export_with_reprojection(spark, shapes, tmp_path):
    landmarks = shapes.select("ord", "n_points", "x", "y", "image_path", "tps_id", "photo_id", "inv_id")
    biology = shapes.groupBy("inv_id").agg(F.min("species").alias("species"), F.min("caste").alias("caste"))
    manifest = shapes.select("photo_id", "inv_id", F.lit("P").alias("device_type"), F.lit(1).alias("photo_index"), "device",
                             F.concat(F.lit("img/"), "photo_id").alias("path"), F.lit(1000).alias("width"), F.lit(800).alias("height"))
    statuses = shapes.select("photo_id", "inv_id", "tps_id", F.when(F.col("ord") == 5, "SUSPECT").otherwise("OK").alias("status"), F.lit("").alias("error_reason"))
    corners = dict(zip(("x1", "y1", "x2", "y2", "x3", "y3", "x4", "y4"), (0.3, 0.4, 0.6, 0.4, 0.6, 0.6, 0.3, 0.6)))
    detections = shapes.select("photo_id", F.when(F.col("ord") == 7, "FAILED").otherwise("OK").alias("status"),
                               *[F.lit(v).alias(k) for k, v in corners.items()])
    tables = E.export_tables(landmarks, biology, manifest, statuses, detections)
    folder = E.write_package(tables, str(tmp_path), "My set", single_file=True)
    assert folder.endswith("/8lm") and (tmp_path / "8lm" / "My-set-landmarks_raw.tps").exists()
    bio = TB.read_text_table(spark, f"{folder}/My-set-biological_data.csv").collect()
    assert sorted(int(r["tps_id"]) for r in bio) == list(range(1, 79)) and bio[0]["device_tag"] == "P1"
    assert {(r["photo_id"], r["stage"]) for r in tables["failed"].collect()} == {("p5", "outlier_registration"), ("p7", "reprojection")}
    raw = tables["raw"].filter("tps_id = 1").first()
    assert raw["image_path"] == "img/p0" and 200 < raw["x"][0] < 700


def test_review_round_trip(spark):
    log = spark.createDataFrame([(0, "a", "i", "OK", None, "f"), (1, "a", "i", "FAILED", "e", "f"), (2, "b", "j", "OK", None, "g")],
                                "ord long, photo_id string, inv_id string, status string, error_reason string, output_path string")
    sheet = RV.crop_sheet(log)
    assert {r["photo_id"]: r["auto_status"] for r in sheet.collect()} == {"a": "FAILED", "b": "OK"}
    edited = sheet.withColumn("reviewed_status", F.lit("OK"))
    out, audit = RV.reconcile_crops(log, edited)
    assert {r["photo_id"]: r["status"] for r in out.collect()} == {"a": "OK", "b": "OK"} and audit.count() == 2


def test_step_stats_and_tables(spark, tmp_path):
    path = str(tmp_path / "stats")
    one = spark.createDataFrame([(4, 3, 1, 0, 0)], "total long, ok long, suspect long, skipped long, failed long")
    TB.update_step_stats(spark, path, one, "renumbering", "m", 2.0, "t")
    TB.update_step_stats(spark, path, one.withColumn("total", F.lit(0).cast("long")), "detection", "light", 0.0, "t")
    out = TB.update_step_stats(spark, path, one.withColumn("ok", F.lit(4).cast("long")), "renumbering", "m", 3.0, "u")
    rows = {r["step"]: r for r in out.collect()}
    assert len(rows) == 2 and rows["renumbering"]["mean_time_s"] == 0.75 and rows["renumbering"]["ok"] == 4 and rows["detection"]["mean_time_s"] == 0
    assert TB.read_mapping(spark, str(tmp_path / "none")).count() == 0
    csv = tmp_path / "bom.csv"
    csv.write_bytes("﻿id,name\n1,\n2,x\n".encode())
    assert [tuple(r) for r in TB.read_text_table(spark, str(csv)).collect()] == [("1", None), ("2", "x")]


def test_only_quoted_line_breaks_need_whole_files(spark, tmp_path):
    folder = tmp_path / "log parts"
    folder.mkdir()
    plain = [(str(i), f'say ""{i}""') for i in range(4000)]
    broken = [("a", "two\nlines"), ("b", "x"), ("c", "it ends\r\nhere")]
    for name, rows in (("plain%1.csv", plain), ("broken.csv", broken)):
        body = "".join(f'{k},"{v}"\n' for k, v in rows)
        (folder / name).write_text("key,said\n" + body, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert [f.rsplit("/", 1)[1] for f in TB.broken_in_quotes(spark, str(folder))] == ["broken.csv"]
        alone = TB.read_text_table(spark, str(folder / "plain%1.csv"), order=True)
        assert alone.rdd.getNumPartitions() > 5
        assert [r["key"] for r in alone.orderBy("ord").collect()] == [k for k, _ in plain]
        both = TB.read_text_table(spark, str(folder), order=True)
        assert both.rdd.getNumPartitions() > 5
        rows = [(r["key"], r["said"].replace("\r\n", "\n")) for r in both.orderBy("ord").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r for r in rows if r[0].isdigit()] == [(k, v.replace('""', '"')) for k, v in plain]
    assert [r for r in rows if not r[0].isdigit()] == [(k, v.replace("\r\n", "\n")) for k, v in broken]


def test_streams_resume(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    make = lambda *rows: spark.createDataFrame(list(rows), "ord long, photo_id string, step string, status string")
    make((1, "a", "s", "OK"), (2, "a", "s", "FAILED"), (3, "b", "s", "OK")).write.parquet(folder)
    got = {r["photo_id"]: r["status"] for r in ST.run_latest_status(spark, folder, target).collect()}
    assert got == {"a": "FAILED", "b": "OK"}
    make((4, "a", "s", "SKIPPED"), (0, "b", "s", "SUSPECT"), (5, "c", "t", "OK")).write.mode("append").parquet(folder)
    got = {r["photo_id"]: r["status"] for r in ST.run_latest_status(spark, folder, target).collect()}
    assert got == {"a": "SKIPPED", "b": "OK", "c": "OK"}
    counters = ST.run_status_counters(spark, folder, str(tmp_path / "counts"))
    assert {(r["step"], r["status"]): r["n"] for r in counters.collect()}["s", "OK"] == 2


def test_windowed_counters_drop_late_rows(spark, tmp_path):
    folder = str(tmp_path / "timed")
    for t, n in (("2024-01-01 10:05:00", 2), ("2024-01-01 16:00:00", 1), ("2024-01-01 16:10:00", 1), ("2024-01-01 10:30:00", 5), ("2024-01-02 10:00:00", 1)):
        spark.createDataFrame([(t, "s", "OK")] * n, "t string, step string, status string").select(
            F.to_timestamp("t").alias("processed_at"), "step", "status").coalesce(1).write.mode("append").parquet(folder)
        import time

        time.sleep(1.1)  # file order decides arrival order
    counts = ST.windowed_counters(ST.arriving(spark, folder, files_per_batch=1))
    query = counts.writeStream.format("memory").queryName("late").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = {str(r["start"]): r["n"] for r in spark.sql("select window.start as start, n from late").collect()}
    assert rows["2024-01-01 10:00:00"] == 2


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def _crash_after(monkeypatch, writes):
    """Lets a stream die once, right after so many tables were written."""
    real, left = ST._store_batch, [writes]

    def store(*args):
        real(*args)
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("killed")

    monkeypatch.setattr(ST, "_store_batch", store)


def test_latest_status_writes_changed_keys_only(spark, tmp_path, monkeypatch):
    folder, target = str(tmp_path / "in"), tmp_path / "out"
    spark.range(2000).selectExpr("id as ord", "concat('p', id) as photo_id", "'OK' as status").coalesce(1).write.parquet(folder)
    assert ST.run_latest_status(spark, folder, str(target)).count() == 2000
    before = _files(target)
    late = [(5000, "p1", "FAILED"), (-1, "p2", "FAILED"), (5001, "new", "OK")]
    spark.createDataFrame(late, "ord long, photo_id string, status string").coalesce(1).write.mode("append").parquet(folder)
    with monkeypatch.context() as patch:
        _crash_after(patch, 1)
        with pytest.raises(Exception, match="killed"):
            ST.run_latest_status(spark, folder, str(target))
    got = {r["photo_id"]: (r["status"], r["ord"]) for r in ST.run_latest_status(spark, folder, str(target)).collect()}
    assert len(got) == 2001 and (got["p1"], got["p2"], got["new"]) == (("FAILED", 5000), ("OK", 2), ("OK", 5001))
    after = _files(target)
    assert before.items() <= after.items()
    assert spark.read.parquet(*(set(after) - set(before))).count() == 3


def test_content_dedup_keeps_its_memory_on_disk(spark, tmp_path, monkeypatch):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    make = lambda *hashes: spark.createDataFrame([(i, h) for i, h in enumerate(hashes)], "ord long, content_hash string").coalesce(1)
    make("a", "b", "a", None).write.parquet(folder)
    assert sorted(str(r["content_hash"]) for r in ST.run_content_dedup(spark, folder, target).collect()) == ["None", "a", "b"]
    make("b", "c", None, "c").write.mode("append").parquet(folder)
    with monkeypatch.context() as patch:
        _crash_after(patch, 1)
        with pytest.raises(Exception, match="killed"):
            ST.run_content_dedup(spark, folder, target)
    assert sorted(str(r["content_hash"]) for r in ST.run_content_dedup(spark, folder, target).collect()) == ["None", "a", "b", "c"]
    make("a", "b").write.mode("append").parquet(folder)
    assert ST.run_content_dedup(spark, folder, target).count() == 4


def test_ingest_tables_agree_after_a_crash(spark, tmp_path, monkeypatch):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    good = "LM=1\n1 2\nIMAGE=i\nID=7\n"
    (folder / "a.tps").write_text(good + good.replace("LM=1", "LM=2") + good.replace("ID=7", "ID=8"))
    with monkeypatch.context() as patch:
        _crash_after(patch, 1)
        with pytest.raises(Exception, match="killed"):
            ST.run_landmark_ingest(spark, str(folder), target)
    for _ in range(2):
        rows = ST.run_landmark_ingest(spark, str(folder), target).collect()
        assert sorted(int(r["tps_id"]) for r in rows) == [7, 8] and all(r["x"] == [1.0] for r in rows)
        assert [r["message"] for r in spark.read.parquet(f"{target}__errors").collect()] == ["expected 2 landmarks, found 1"]
    (folder / "b.tps").write_text(good.replace("ID=7", "ID=9"))
    assert ST.run_landmark_ingest(spark, str(folder), target).count() == 3
