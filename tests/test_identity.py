import pytest
from pyspark.sql import functions as F

from alula.operators import identity as I
from alula.schema import MAPPING, SchemaError

COLUMNS = "ord long, raw_id string, device_type string, genus string, species string, caste string, dd int, mm int, yyyy int, n_photos int"


@pytest.fixture(scope="module")
def ident(spark):
    rows = [
        (0, "a", "P", "B", "x", "w", 1, 2, 2020, 3), (1, "a", "S", "B", "y", "w", 1, 2, 2020, 1), (2, "a", "S", "B", "x", "w", 1, 2, 2020, 9),
        (3, "b", "P", "B", "x", None, None, None, None, 2), (4, "b", "P", "B", "x", None, None, None, None, 5),
        (5, "c", "S", "B", "z", "q", 3, 1, 2019, 4),
    ]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def mapping(spark):
    rows = [("src", "a", 1, "N_0001", "N", True, "t"), ("src", "b", 2, "N_0002", "N", False, "t"), ("src", "c", 3, "N_0003", "N", False, "t"),
            ("other", "a", 1, "M_0001", "M", False, "t")]
    return spark.createDataFrame(rows, MAPPING)


def test_conflicts_take_the_first_identity(ident):
    rows = {(r["raw_id"], r["device_type"]): r for r in I.resolve_identification(ident, "raw_id", ["ord"], "device_type").collect()}
    assert len(rows) == 4
    assert rows["a", "S"]["species"] == "x" and rows["a", "S"]["ord"] == 1 and rows["a", "S"]["n_photos"] == 1
    assert rows["b", "P"]["n_photos"] == 2
    report = I.identity_conflicts(ident, "raw_id", ["ord"]).collect()
    assert sorted((r["species"], r["matches_first_occurrence"]) for r in report) == [("x", True), ("y", False)]


def test_frozen_numbering(spark, mapping):
    rows = [("src", "a", "N", 1, 1, 1), ("src", "n1", "N", 2021, 5, 1), ("src", "n2", "N", None, 1, 1), ("src", "n0", "N", 2020, 9, 9),
            ("src", "m", "Z", None, None, None)]
    new = spark.createDataFrame(rows, "source_type string, original_id string, inv_name string, yyyy int, mm int, dd int").withColumn(
        "resolved_conflict", F.lit(False))
    out = {(r["source_type"], r["original_id"]): r for r in I.extend_mapping(mapping, new, "now", False).collect()}
    assert len(out) == 8 and out["src", "a"]["inv_id"] == "N_0001" and out["src", "a"]["frozen_at"] == "t"
    assert [out["src", k]["inv_id"] for k in ("n0", "n1", "n2", "m")] == ["N_0004", "N_0005", "N_0006", "Z_0001"]
    again = I.extend_mapping(spark.createDataFrame(list(out.values()), MAPPING), new, "later", False)
    assert again.count() == 8 and again.filter("frozen_at = 'later'").count() == 0


def test_embedded_numbering_and_collisions(spark, mapping):
    make = lambda i, s="f": spark.createDataFrame([(s, i, False)], "source_type string, original_id string, resolved_conflict boolean")
    r = I.extend_mapping(mapping, make("WB1_23_0007"), "now", True).filter("source_type = 'f'").first()
    assert (r["inv_id"], r["inv_name"], r["inv_num"]) == ("WB1_23_0007", "WB1_23", 7)
    with pytest.raises(Exception, match="does not match"):
        I.extend_mapping(mapping, make("nodigits"), "now", True).collect()
    with pytest.raises(Exception, match="another source"):
        I.extend_mapping(mapping, make("N_0002", "g"), "now", True).collect()


def test_attach(ident, mapping):
    out = I.attach_inv_id(ident.withColumn("inv_num", F.lit(5)), mapping, "raw_id", "src")
    assert out.columns[:1] == ["inv_id"] and "original_id" in out.columns and "inv_num" not in out.columns and out.count() == 6
    assert "raw_id" not in I.attach_inv_id(ident, mapping, "raw_id", "src", keep_original_id=False).columns
    with pytest.raises(SchemaError):
        I.attach_inv_id(ident.withColumn("original_id", F.lit("x")), mapping, "raw_id", "src")


def test_specimen_tables(ident, mapping):
    rows = {r["inv_id"]: r for r in I.specimen_table(mapping, ident, "raw_id", "src", ["ord"], "device_type").collect()}
    assert len(rows) == 3 and (rows["N_0001"]["n_photos_P"], rows["N_0001"]["n_photos_S"]) == (3, 1)
    assert rows["N_0002"]["n_photos_S"] is None and rows["N_0003"]["n_photos_P"] is None
    names = I.specimen_devices(mapping, ident, "raw_id", "src", "device_type", "species", ["ord"]).collect()
    assert {(r["inv_id"], r["device_type"]): r["device"] for r in names}["N_0001", "S"] == "y"


def test_origins(spark):
    df = spark.createDataFrame([("1", "Paris"), ("2", "Lyon"), ("3", None)], "id string, place string")
    table = I.origin_table(df, "place").collect()
    assert [tuple(r) for r in table] == [("Lyon", ""), ("Paris", "")]
    assert I.origin_table(df, "nowhere").count() == 0
    codes = spark.createDataFrame([("Paris", " P "), ("Lyon", None)], "collection_origin string, inv_name string")
    resolved = I.resolved_origin_codes(codes)
    assert {r[0]: r[1] for r in resolved.collect()} == {"Paris": "P", "Lyon": "Lyon"}
    named = I.assign_inv_name(df.filter("place is not null"), "id", resolved, "place")
    assert {r["id"]: r["inv_name"] for r in named.collect()} == {"1": "P", "2": "Lyon"}
    with pytest.raises(I.IdentityError, match="missing from the origin codes"):
        I.assign_inv_name(df, "id", resolved, "place")


def test_photo_ids_follow_shot_order(spark, mapping):
    rows = [("a", "P", 9, "h1", "r1"), ("a", "P", 2, "h3", "r2"), ("a", "P", 2, "h2", "r3"), ("a", "S", None, "h", "r4"), ("zz", "S", 1, "h", "r5")]
    manifest = spark.createDataFrame(rows, "original_id string, device_type string, shot_index int, content_hash string, raw_path string")
    own = mapping.filter("source_type = 'src'")
    got = {r["raw_path"]: r["photo_id"] for r in I.assign_photo_ids(manifest, own).collect()}
    assert got == {"r3": "N_0001_P_1", "r2": "N_0001_P_2", "r1": "N_0001_P_3", "r4": "N_0001_S_1"}


def test_images_and_rows_without_partner(spark, ident):
    manifest = spark.createDataFrame([("a",), ("a",), ("q",)], "original_id string")
    assert {r["raw_id"] for r in I.with_image(ident, manifest, "raw_id").collect()} == {"a"}
    assert {r["raw_id"] for r in I.without_image(ident, manifest, "raw_id").collect()} == {"b", "c"}
    assert [r["original_id"] for r in I.orphan_images(manifest, ident, "raw_id").collect()] == ["q"]
