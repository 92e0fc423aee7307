import numpy as np
import pytest
from pyspark.sql import functions as F

from alula.operators import cropspace as C


def box(cx, cy, half_w, half_h, degrees, width, height):
    """Four turned corners in image fractions."""
    t = np.deg2rad(degrees)
    r = np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]])
    p = np.array([(-half_w, -half_h), (half_w, -half_h), (half_w, half_h), (-half_w, half_h)]) @ r.T + (cx, cy)
    return (p / (width, height)).reshape(-1)


def geometry(*boxes, width=1000.0, height=800.0):
    n = len(boxes)
    return C.window_geometry(np.array(boxes), np.full(n, width), np.full(n, height), 0.1, 2.0)


def place(g, k, x, y):
    r = g.iloc[k]
    u, v = r.m00 * x + r.m01 * y + r.m02, r.m10 * x + r.m11 * y + r.m12
    return (u - r.left) * 512 / (r.right - r.left), (v - r.top) * 256 / (r.bottom - r.top)


def test_upright_box():
    g = geometry(box(500, 400, 100, 40, 0, 1000, 800))
    r = g.iloc[0]
    assert (r.m00, r.m01, r.m02, r.m12) == pytest.approx((1, 0, 0, 0), abs=1e-4)
    assert (r.left, r.right, r.top, r.bottom) == (390, 610, 345, 455)
    assert r.aspect_ratio == pytest.approx(2.5, rel=1e-4) and r.valid
    assert place(g, 0, 500, 400) == pytest.approx((256, 128), abs=0.01)


@pytest.mark.parametrize("degrees", [10, 80, 91, 135, 179, -60])
def test_turned_box_is_centred_and_level(degrees):
    g = geometry(box(480, 410, 120, 45, degrees, 1000, 800))
    assert place(g, 0, 480, 410) == pytest.approx((256, 128), abs=1.5)
    t = np.deg2rad(degrees)
    a, b = place(g, 0, 480 + 90 * np.cos(t), 410 + 90 * np.sin(t)), place(g, 0, 480 - 90 * np.cos(t), 410 - 90 * np.sin(t))
    assert a[1] == pytest.approx(b[1], abs=0.05) and abs(a[0] - b[0]) == pytest.approx(180 * 512 / 264, rel=0.01)


def test_window_stays_inside_and_keeps_its_ratio():
    g = geometry(box(90, 400, 80, 30, 0, 1000, 800), box(500, 30, 300, 28, 0, 1000, 800), box(500, 400, 480, 380, 0, 1000, 800))
    for _, r in g.iterrows():
        assert 0 <= r.left < r.right <= 1000 and 0 <= r.top < r.bottom <= 800
        assert abs((r.right - r.left) / (r.bottom - r.top) - 2) < 0.03


def test_degenerate_and_missing_boxes():
    g = geometry(np.zeros(8), np.full(8, np.nan))
    assert not g.valid.any()


def tables(spark):
    lm = spark.createDataFrame([(f"p{i}", [100.0 + i, 300.0], [50.0, 200.0 - i]) for i in range(5)], "photo_id string, x array<double>, y array<double>")
    man = spark.createDataFrame([(f"p{i}", f"img{i}", 1000 if i != 3 else None, 800) for i in range(4)], "photo_id string, path string, width int, height int")
    corner = box(500, 400, 150, 60, 25, 1000, 800).tolist()
    det = spark.createDataFrame(
        [(f"p{i}", "OK" if i != 1 else "FAILED", *(corner if i != 2 else [0.5] * 8)) for i in range(4)],
        "photo_id string, status string, " + ", ".join(f"{c} double" for c in C.CORNER_COLUMNS))
    return lm, man, det


def test_reasons_and_round_trip(spark):
    lm, man, det = tables(spark)
    rows = {r["photo_id"]: r for r in C.reproject(lm, man, det).collect()}
    assert rows["p0"]["reproject_reason"] is None and rows["p0"]["raw_path"] == "img0"
    assert rows["p1"]["reproject_reason"].startswith("no OK detection")
    assert rows["p2"]["reproject_reason"] == "degenerate OBB geometry"
    assert rows["p3"]["reproject_reason"] == "unreadable_image"
    assert rows["p4"]["reproject_reason"] == "photo_id not found in manifest.csv" and rows["p4"]["rx"] is None
    back = C.reproject(
        spark.createDataFrame([("p0", rows["p0"]["rx"], rows["p0"]["ry"])], lm.schema), man, det, direction="to_crop").first()
    assert back["rx"] == pytest.approx([100.0, 300.0]) and back["ry"] == pytest.approx([50.0, 200.0])


def test_flip_and_bounds(spark):
    _, man, det = tables(spark)
    raw = spark.createDataFrame([("p0", [500.0, 2000.0], [390.0, 0.0])], "photo_id string, x array<double>, y array<double>")
    up = C.reproject(raw, man, det, direction="to_crop", flip_y=True).first()
    down = C.reproject(raw.withColumn("y", F.transform("y", lambda v: 800 - v)), man, det, direction="to_crop").first()
    assert up["ry"] == pytest.approx(down["ry"])
    judged = C.bounds_status(C.reproject(raw, man, det, direction="to_crop")).first()
    assert judged["n_out_of_bounds"] == 1 and judged["status"] == "SUSPECT"
