import pytest
from pyspark.sql import functions as F

from alula.functions import shapes as G
from alula.functions import status as R
from alula.functions import strings as S


def values(spark, rows, schema, column):
    return [r["v"] for r in spark.createDataFrame(rows, schema).select(column.alias("v")).collect()]


@pytest.mark.parametrize("stem,expected", [
    ("AB_12_s3", ("AB_12", "S", 3, True)), ("AB-12-p-4", ("AB-12", "P", 4, True)), ("AB_12_7", ("AB_12", None, 7, True)),
    ("AB12", (None, None, None, False)), ("_S1", (None, None, None, False)), ("A_X1", (None, None, None, False)),
    ("A-S-x", (None, None, None, False)), ("a_b-S-2", ("a_b", "S", 2, True)),
])
def test_file_names(spark, stem, expected):
    (row,) = values(spark, [(stem,)], "s string", S.parsed_name(F.col("s")))
    assert tuple(row) == expected


def test_extra_name_shape(spark):
    shape = S.NameShape(r"^cam(\d+)\.(\w+)$", id_group=2, shot_group=1)
    (row,) = values(spark, [("cam5.X9",)], "s string", S.parsed_name(F.col("s"), [*S.NAME_SHAPES, shape]))
    assert tuple(row) == ("X9", None, 5, True)


@pytest.mark.parametrize("text,expected", [(" Ünï côdé!! x ", "n-c-d-x"), ("a--b__", "a-b"), ("***", "run"), ("ok_1", "ok_1")])
def test_slug(spark, text, expected):
    assert values(spark, [(text,)], "s string", S.slug(F.col("s"))) == [expected]


def test_names_and_tags(spark):
    assert values(spark, [("a\\b//c ",), ("  ",)], "s string", S.dataset_folder_name(F.col("s"))) == ["a_b_c", "dataset"]
    names = [("x-landmarks_crop.tps",), ("-failed.csv",), ("y.tps",)]
    assert values(spark, names, "s string", S.name_from_export(F.col("s"))) == ["x", None, None]
    assert values(spark, [("P", 2), (None, 1), ("S", None)], "d string, i int", S.device_tag(F.col("d"), F.col("i"))) == ["P2", "1", "S"]
    assert values(spark, [("a", None)], "s string, c string", S.group_label(F.col("s"), F.col("c"))) == ["a_nan"]
    assert values(spark, [("N1", 12345), ("N1", 7)], "a string, n long", S.numbered_id(F.col("a"), F.col("n"))) == ["N1_12345", "N1_0007"]
    label = S.upload_label(F.array(F.lit("wing a.tps")), F.array(F.lit("demo-biological_data.csv")))
    assert values(spark, [(1,)], "i int", label) == ["demo"]


def test_comments(spark):
    text = "x; photo_id = a ;junk;=n;inv_id=b=c;photo_id=z"
    assert values(spark, [(text,)], "s string", S.comment_field(F.col("s"), "photo_id")) == ["z"]
    assert values(spark, [(text,)], "s string", S.comment_field(F.col("s"), "inv_id")) == ["b=c"]
    assert values(spark, [(text,)], "s string", S.comment_map(F.col("s"))) == [{"photo_id": "z", "inv_id": "b=c"}]
    assert values(spark, [(None, None)], "a string, b string", S.comment_text(F.col("a"), F.col("b"))) == [None]


def test_paths_and_durations(spark):
    rows = [("C:\\Data\\x\\Y.JPG",)]
    assert values(spark, rows, "p string", S.path_tail(F.col("p"))) == ["data/x/y.jpg"]
    assert values(spark, rows, "p string", S.path_basename(F.col("p"))) == ["y.jpg"]
    assert values(spark, rows, "p string", S.path_extension(F.col("p"))) == [".jpg"]
    assert values(spark, [("a\\b",), ("/c",)], "p string", S.resolved_path(F.col("p"), "/r")) == ["/r/a/b", "/c"]
    got = values(spark, [(3930.0,), (312.3,), (3.2,)], "s double", S.duration_text(F.col("s")))
    assert got == ["1h05m30.0s", "5m12.3s", "3.2s"]
    frame = spark.createDataFrame([("a/b", "", "p1"), ("  ", None, "p2")], "g string, h string, p string")
    got = [r[0] for r in frame.select(S.grouped_relative_path(["g", "h"], F.col("p"), F.lit(".jpg"))).collect()]
    assert got == ["a_b/unknown_h/p1.jpg", "unknown/unknown_h/p2.jpg"]


@pytest.mark.parametrize("status,overwrite,retry,exists,skip", [
    (None, False, False, True, False), ("OK", False, False, True, True), ("OK", True, False, True, False),
    ("SUSPECT", False, False, True, True), ("OK", False, False, False, False), ("FAILED", False, False, True, True),
    ("FAILED", False, True, True, False), ("WEIRD", False, False, True, False),
])
def test_resume_rule(spark, status, overwrite, retry, exists, skip):
    rule = R.should_skip(F.col("s"), F.lit(overwrite), F.lit(retry), F.lit(exists))
    assert values(spark, [(status,)], "s string", rule) == [skip]


def test_quads(spark):
    good = ["0.1", "0.1", "0.9", "0.1", "0.9", "0.9", "0.1", "0.9"]
    rows = [tuple(good), tuple([None, *good[1:]]), tuple(["x", *good[1:]]), tuple(["Infinity", *good[1:]]), tuple(["1.2", *good[1:]]), tuple(["0.5"] * 8)]
    schema = ", ".join(f"{c} string" for c in ("x1", "y1", "x2", "y2", "x3", "y3", "x4", "y4"))
    assert values(spark, rows, schema, R.quad_problem()) == [
        None, "missing coordinate", "invalid coordinate", "non-finite coordinate", "coordinate outside [0,1]", "degenerate quadrilateral"]
    assert values(spark, [rows[4]], schema, R.quad_problem(clip=True)) == [None]


def test_shape_expressions(spark):
    df = spark.createDataFrame([([0.0, 3.0], [0.0, 4.0])], "x array<double>, y array<double>")
    r = df.select(
        G.centroid_size(F.col("x"), F.col("y")).alias("size"), G.interleaved(F.col("x"), F.col("y")).alias("v"),
        G.dropped_point(F.col("x"), 0).alias("d"), G.flipped_y(F.col("y"), F.lit(10.0)).alias("f"),
        G.count_outside(F.col("x"), F.col("y"), 3, 5).alias("n"),
        G.shape_distance(F.col("x"), F.col("y"), F.col("y"), F.col("x")).alias("dist"),
    ).first()
    assert r["size"] == pytest.approx(5 / 2**0.5) and r["v"] == [0, 0, 3, 4] and r["d"] == [3] and r["f"] == [10, 6]
    assert r["n"] == 1 and r["dist"] == pytest.approx(2**0.5)
