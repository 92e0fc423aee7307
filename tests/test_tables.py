import pytest
from pyspark.sql import functions as F

from alula.operators import dataset as D
from alula.operators import logs as L
from alula.operators import manifest as M
from alula.operators import matching as J
from alula.operators import reports as P
from alula.operators import splits as X
from alula.operators.identity import consistency_report, flag_inconsistent
from alula.schema import SchemaError


def df_of(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


# --- manifest ---------------------------------------------------------------------


def test_duplicates_never_touch_failed_rows(spark):
    df = df_of(spark, "ord int, photo_id string, status string, status_reason string",
               (1, "a", "OK", ""), (2, "a", "OK", ""), (3, "a", "FAILED", "gone"), (4, "b", "FAILED", "x"))
    got = {r["ord"]: (r["status"], r["status_reason"]) for r in M.flag_duplicate_photo_ids(df, ["ord"]).collect()}
    assert got == {1: ("OK", ""), 2: ("FAILED", "duplicate photo_id in input"), 3: ("FAILED", "gone"), 4: ("FAILED", "x")}


def test_consistency_counts_failed_rows_but_keeps_them(spark):
    df = df_of(spark, "ord int, inv_id string, species string, status string, status_reason string",
               (1, "a", "x", "FAILED", "f"), (2, "a", "y", "OK", ""), (3, "b", None, "OK", ""), (4, "b", None, "OK", ""))
    got = {r["ord"]: r["status"] for r in flag_inconsistent(df, ["ord"], ["species"]).collect()}
    assert got == {1: "FAILED", 2: "SUSPECT", 3: "OK", 4: "OK"}
    assert [r["ord"] for r in consistency_report(df, ["ord"], ["species"]).orderBy("ord").collect()] == [1, 2]


def test_photo_ids_are_kept_or_filled(spark):
    df = df_of(spark, "inv_id string, path string, device_type string, photo_id string",
               ("i", "b", "P", None), ("i", "a", "P", ""), ("i", "c", None, "own"), ("j", "d", "", None))
    got = {r["path"]: (r["photo_id"], r["photo_index"]) for r in M.fill_photo_ids(df, "path", "S").collect()}
    assert got == {"a": ("i_P_1", 1), "b": ("i_P_2", 2), "c": ("own", 1), "d": ("j_S_1", 1)}


def test_paths_are_verified(spark):
    files = df_of(spark, "path string, content_hash string, file_size_bytes long", ("/r/a.JPG", "h", 5))
    df = df_of(spark, "path string, inv_id string", ("a.JPG", "i"), ("b\\c.png", "j"))
    got = {r["inv_id"]: r for r in M.verify_paths(df, files, "path", "/r").collect()}
    assert (got["i"]["status"], got["i"]["ext"], got["i"]["file_size_bytes"]) == ("OK", ".jpg", 5)
    assert (got["j"]["status"], got["j"]["path"], got["j"]["content_hash"]) == ("FAILED", "/r/b/c.png", None)


def test_duplicate_report_splits_large_groups(spark):
    df = df_of(spark, "content_hash string, raw_path string", *[("h", f"p{i}") for i in range(5)], ("g", "x"), ("", "y"), ("", "z"))
    rows = M.duplicate_groups(df).collect()
    assert [(r["content_hash"], r["n_copies"], r["part"], r["paths"]) for r in rows] == [("h", 5, 1, "p0 | p1 | p2 | p3 | p4")]
    parts = {r["part"]: r["paths"] for r in M.duplicate_groups(df, paths_per_row=2).collect()}
    assert parts == {1: "p0 | p1", 2: "p2 | p3", 3: "p4"}


def test_combining_rejects_shared_ids(spark):
    m = lambda *ids: df_of(spark, "photo_id string", *[(i,) for i in ids])
    b = lambda *ids: df_of(spark, "inv_id string", *[(i,) for i in ids])
    manifest, _ = M.combine_roots([(m("a"), b("x")), (m("b"), b("y"))])
    assert manifest.count() == 2
    with pytest.raises(M.CollisionError, match="photo_id"):
        M.combine_roots([(m("a"), b("x")), (m("a"), b("y"))])
    with pytest.raises(M.CollisionError, match="inv_id"):
        M.combine_roots([(m("a"), b("x")), (m("b"), b("x"))])


# --- dataset ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def parts(spark):
    lm = spark.createDataFrame(
        [(0, 3, "p0", "i0", 10), (1, 3, "p1", "i0", 11), (2, 2, "p2", "i1", 12), (3, 3, "p3", "i9", 13), (4, 3, None, "i1", 14)],
        "ord long, n_points int, photo_id string, inv_id string, tps_id int")
    bio = spark.createDataFrame([("i0", "x", "w", "s1"), ("i1", None, "q", "s2")], "inv_id string, species string, caste string, site string")
    man = spark.createDataFrame([("p0", "P", 1, "d1"), ("p1", None, 2, "d2")], "photo_id string, device_type string, photo_index int, device string")
    return lm, bio, man


def test_dataset_join(parts):
    rows = {r["ord"]: r for r in D.load_dataset(*parts, labeled_only=False).collect()}
    assert set(rows) == {0, 1, 4}
    assert (rows[0]["device_tag"], rows[1]["device_tag"], rows[4]["device_tag"]) == ("P1", "2", None)
    assert rows[4]["groupe"] == "nan_q" and rows[0]["site"] == "s1" and rows[0]["device"] == "d1"
    assert {r["ord"] for r in D.load_dataset(*parts).collect()} == {0, 1}
    assert {r["ord"] for r in D.load_dataset(*parts, devices=["P1"]).collect()} == {0}
    with pytest.raises(D.EmptyDatasetError):
        D.load_dataset(*parts, species=["none"])
    with pytest.raises(SchemaError):
        D.load_dataset(parts[0], parts[1].drop("caste"), parts[2])


def test_outliers_are_excluded_by_photo_then_file_id(spark, parts):
    by_photo = df_of(spark, "photo_id string, status string", ("p0", "SUSPECT"), ("p1", "OK"))
    by_id = df_of(spark, "tps_id int, status string", (10, "OK"), (11, "FAILED"))
    assert {r["ord"] for r in D.load_dataset(*parts, statuses=by_photo).collect()} == {1}
    assert {r["ord"] for r in D.load_dataset(*parts, statuses=by_id).collect()} == {0}


def test_majority_ties(spark):
    df = df_of(spark, "ord int, n_points int", (0, 9), (1, 5), (2, 5), (3, 9))
    assert D.majority_point_count(df) == 9 and D.majority_point_count(df, tie="smallest") == 5
    assert {r["ord"] for r in D.with_majority_count(df).collect()} == {0, 3}


def test_complete_and_singleton_groups(spark):
    df = df_of(spark, "inv_id string, device_tag string, species string", ("a", "P1", "x"), ("a", "S1", "x"), ("a", "S2", "x"), ("b", "P1", "x"), ("c", None, "y"))
    assert {r["inv_id"] for r in D.complete_individuals(df, ["P1", "S1"]).collect()} == {"a"}
    assert [r["species"] for r in D.singleton_classes(df, "species").collect()] == ["y"]
    assert D.with_large_groups(df, "species", 2).count() == 4
    assert D.target_column(df.withColumn("groupe", F.lit("g")), "caste") == "groupe"
    with pytest.raises(SchemaError):
        D.target_column(df, "genus")


def test_upload_joins(spark, parts):
    lm, _, _ = parts
    bio = df_of(spark, "inv_id string, species string, caste string, ord long", ("i0", "x", "w", 1), ("i0", "z", "w", 2))
    assert D.merged_biology([bio]).first()["species"] == "x"
    assert D.join_upload(lm, bio).count() == 5
    with pytest.raises(D.UploadError, match="in common"):
        D.join_upload(lm, bio.withColumn("inv_id", F.lit("other")))
    bare = lm.withColumn("inv_id", F.lit(None).cast("string"))
    with pytest.raises(D.UploadError, match="no 'tps_id' column"):
        D.join_upload(bare, bio)
    positions = lm.select("tps_id", F.concat(F.lit("q"), "tps_id").alias("inv_id"))
    assert {r["inv_id"] for r in D.join_upload(bare, positions).collect()} == {f"q{i}" for i in range(10, 15)}
    with pytest.raises(D.UploadError, match="matching 'tps_id'"):
        D.join_upload(bare, positions.filter("tps_id > 11"))
    with pytest.raises(D.UploadError, match="only integers"):
        D.join_upload(bare, positions.withColumn("tps_id", F.lit("1.5x")))
    with pytest.raises(D.UploadError, match="missing column"):
        D.merged_biology([bio.drop("caste")])
    root = D.upload_root(lm, bio)
    assert {r["photo_id"] for r in root["manifest"].collect()} == {"p0", "p1", "p2", "p3", "tps_14"}
    assert root["biological_data"].columns == ["inv_id", "species", "caste"] and root["biological_data"].count() == 1


# --- logs ---------------------------------------------------------------------------------


def test_latest_state_is_chosen_before_the_status_filter(spark):
    log = df_of(spark, "ord int, photo_id string, status string", (1, "a", "OK"), (2, "a", "FAILED"), (3, "b", "FAILED"), (4, "b", "SKIPPED"))
    assert [r["photo_id"] for r in L.usable_crops(log, ["ord"]).collect()] == ["b"]
    counts = L.status_counters(log.unionByName(df_of(spark, log.schema, (9, "c", "ODD")))).first()
    assert (counts["total"], counts["ok"], counts["skipped"], counts["failed"], counts["suspect"]) == (5, 1, 1, 2, 0)


def test_review_changes_reasons_only_where_the_status_changed(spark):
    original = df_of(spark, "photo_id string, status string, error_reason string", ("a", "SUSPECT", None), ("b", "OK", None), ("c", "FAILED", "e"))
    sheet = df_of(spark, "photo_id string, auto_status string, reviewed_status string", ("a", "SUSPECT", "OK"), ("b", "OK", "OK"), ("zz", "OK", "FAILED"))
    got = {r["photo_id"]: (r["status"], r["error_reason"]) for r in L.apply_review(original, L.validated_review(sheet), True).collect()}
    assert got == {"a": ("OK", "manual review override (was: )"), "b": ("OK", None), "c": ("FAILED", "e")}
    crops = L.apply_review(original, sheet, False).filter("photo_id = 'a'").first()
    assert crops["error_reason"] == "excluded_by_manual_review"
    with pytest.raises(SchemaError, match="invalid reviewed_status"):
        L.validated_review(sheet.withColumn("reviewed_status", F.lit("MAYBE")))
    with pytest.raises(SchemaError, match="missing column"):
        L.validated_review(sheet.drop("auto_status"))


def test_exclusions_are_silent_under_extra_filters(spark):
    statuses = df_of(spark, "photo_id string, inv_id string, tps_id int, status string, error_reason string", ("p", "", 1, "OK", ""), ("q", "j", 2, "FAILED", "bad"))
    manifest = df_of(spark, "photo_id string, inv_id string", ("p", "i"), ("q", "j"))
    biology = df_of(spark, "inv_id string, species string", ("j", "x"))
    kept = df_of(spark, "tps_id int", (77,))
    rows = {r["photo_id"]: tuple(r)[1:] for r in L.exclusion_report(statuses, manifest, biology, kept).collect()}
    assert rows == {"p": ("i", "biological_metadata", "inv_id not found in biological_data.csv"), "q": ("j", "landmark_placement", "bad")}
    assert [r["photo_id"] for r in L.exclusion_report(statuses, manifest, biology, kept, True).collect()] == ["q"]


# --- matching and reports ----------------------------------------------------------------------


def test_one_to_one_pairs(spark):
    left = df_of(spark, "k int, s string", (1, "a"), (2, "b"))
    right = df_of(spark, "k int, s string, p string", (1, "a", "x"), (2, "b", "y"))
    assert J.paired_one_to_one(left, right, "k", "s", "p").count() == 2
    for bad, text in ((right.unionByName(right), "duplicated"), (right.filter("k = 1"), "no matching"), (right.withColumn("s", F.lit("q")), "disagrees")):
        with pytest.raises(J.PairingError, match=text):
            J.paired_one_to_one(left, bad, "k", "s", "p")


def test_path_tiers(spark):
    manifest = df_of(spark, "raw_path string, id int", ("d/x/y/a.jpg", 1), ("e/x/y/a.jpg", 2), ("q/w/e/b.jpg", 3), ("1/2/c.jpg", 4), ("1/3/c.jpg", 5))
    images = df_of(spark, "p string", ("Z:\\Q\\w\\E\\B.JPG",), ("other/b.jpg",), ("d/x/y/a.jpg",), ("9/c.jpg",), ("1/2/c.jpg",), ("n.jpg",))
    got = {r["p"]: (r["match_method"], r["id"]) for r in J.match_paths(images, manifest, "p", "raw_path", ["id"]).collect()}
    assert got["Z:\\Q\\w\\E\\B.JPG"] == ("tail3", 3) and got["other/b.jpg"] == ("basename", 3)
    assert got["d/x/y/a.jpg"][0] == "ambiguous filename (2 candidates in manifest.csv)" and got["9/c.jpg"][1] is None
    assert got["1/2/c.jpg"] == ("tail3", 4) and got["n.jpg"] == ("no match in manifest.csv", None)


def test_reports(spark):
    df = df_of(spark, "true_species string, predicted_species string, device string", ("a", "a", "P"), ("a", "b", "P"), ("b", "b", "S"), ("c", "z", None))
    cells = {(r["true_species"], r["predicted_species"]): r["n"] for r in P.confusion_counts(df, "species").collect()}
    assert len(cells) == 9 and cells["a", "b"] == 1 and cells["c", "c"] == 0
    rows = {r["species"]: r for r in P.class_report(df, "species").collect()}
    assert (rows["b"]["precision"], rows["b"]["recall"], rows["c"]["precision"], rows["c"]["f1"]) == (0.5, 1.0, 0.0, 0.0)
    assert rows["a"]["f1"] == pytest.approx(2 / 3)
    assert [(r["device"], r["n"], r["accuracy"]) for r in P.device_report(df, "species").collect()] == [("P", 2, 0.5), ("S", 1, 1.0)]
    assert P.device_report(df.filter("device = 'P'"), "species").count() == 0
    with pytest.raises(SchemaError):
        P.accuracy(df)


def test_group_split(spark):
    df = spark.range(300).select("id", F.concat(F.lit("g"), F.col("id") % 20).alias("g"))
    a = X.split_groups(df, "g", 0.7, 0.15, 0.15, 1)
    assert {r["split"]: r["specimens"] for r in X.split_statistics(a, "g").collect()} == {"train": 14, "val": 3, "test": 3}
    assert a.select("g", "split").distinct().count() == 20
    assert a.exceptAll(X.split_groups(df.repartition(7), "g", 0.7, 0.15, 0.15, 1)).count() == 0
    assert a.exceptAll(X.split_groups(df, "g", 0.7, 0.15, 0.15, 2)).count() > 0
    for bad in ((0.5, 0.1, 0.1),):
        with pytest.raises(X.SplitError):
            X.split_groups(df, "g", *bad, 1)
    with pytest.raises(X.SplitError):
        X.split_groups(df.filter("g in ('g1', 'g2')"), "g", 0.7, 0.15, 0.15, 1)


def test_addresses_that_differ_by_a_slash_are_different_files(spark, tmp_path):
    import duckdb

    from workload import all_queries

    pages = [(3, "https://a/x", "three"), (1, "https://a/x/", "1"), (2, "https://a/x", "22"), (4, "http://a/x", ""), (5, "https://a//x", "fives")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found, sql = (q["verified_paths"] for q in all_queries())
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    rows = sorted(tuple(r) for r in found(spark, str(tmp_path)).collect())
    assert rows == sorted(con.execute(sql).fetchall())
    assert [r[-1] for r in rows] == [1, 2, 2, None, 5]
