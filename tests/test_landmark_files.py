import numpy as np
import pytest

from alula.sources import landmark_files as LF
from tests.shapes import BASE, frame

GOOD = "LM=2\n1.5 2\n3,4\nIMAGE=a b.jpg\nID=7\nCOMMENT=photo_id=p7;inv_id=i1\nSCALE=0.1\n"


def write(tmp_path, text, name="f.tps", newline=""):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def errors(spark, path):
    rows = LF.read_landmark_errors(spark, path).collect()
    return sorted((r["specimen_index"], r["line_no"], r["message"]) for r in rows)


def test_block_fields(spark, tmp_path):
    path = write(tmp_path, GOOD + GOOD.replace("ID=7", "ID=12821918321641067740").replace("\n", "\r\n"))
    a, b = LF.read_landmarks(spark, path).orderBy("ord").collect()
    assert (a["n_points"], a["x"], a["y"], a["image_path"]) == (2, [1.5, 3.0], [2.0, 4.0], "a b.jpg")
    assert (a["photo_id"], a["inv_id"], a["ord"], int(a["tps_id"])) == ("p7", "i1", 0, 7)
    assert int(b["tps_id"]) == 12821918321641067740 and b["ord"] == 1 and b["y"] == [2.0, 4.0]


def test_any_case_indentation_and_order(spark, tmp_path):
    text = "  lm=1\n\n 5 6 extra\nid=3\nimage=x\n" + "LM=1\nimage=LM=odd\nID=4\n7 8\n" + "\tLM=1\n1 1\nID=5\n"
    rows = {int(r["tps_id"]): r for r in LF.read_landmarks(spark, write(tmp_path, text), strict=False).collect()}
    assert set(rows) == {3, 5}
    assert rows[3]["x"] == [5.0] and rows[3]["image_path"] == "x"


def test_truncated_block_spares_the_next(spark, tmp_path):
    path = write(tmp_path, "LM=3\n1 2\nIMAGE=i\nID=1\n" + GOOD)
    assert [int(r["tps_id"]) for r in LF.read_landmarks(spark, path, strict=False).collect()] == [7]
    assert errors(spark, path) == [(0, 1, "expected 3 landmarks, found 1")]
    with pytest.raises(Exception, match="expected 3 landmarks, found 1"):
        LF.read_landmarks(spark, path).collect()


def test_every_kind_of_problem(spark, tmp_path):
    text = (
        "LM=two\n1 2\n" "LM=2\n1 2\n9\n3 4\nID=1\n" "LM=2\n1 2\nx y\n3 4\nID=2\n" "LM=1\n1 2\nIMAGE=q\n"
        "LM=1\n1 2\nID=z\nID=8\n"
    )
    path = write(tmp_path, text)
    assert errors(spark, path) == [
        (0, 1, "unreadable point count in 'LM=two'"), (1, 2, "expected 'LM=', found: '1 2'"),
        (1, 5, "malformed landmark: '9'"), (2, 10, "non-numeric coordinate: 'x y'"),
        (3, 13, "no ID= found for this specimen"), (4, 18, "non-integer ID: 'ID=z'"),
    ]
    assert [int(r["tps_id"]) for r in LF.read_landmarks(spark, path, strict=False).collect()] == [8]


def test_tidy_blocks_report_the_same_lines(spark, tmp_path):
    path = write(tmp_path, "LM=2\n1 2\n3 4\nIMAGE=i\nID=q\n" + "LM=2\r\n1 2\r\n3, 4\r\nID=5\r\n\r\n" + "LM=1\n1 2\n3 4\nID=6\n" + "LM=2\n1 2\n3 z\nID=7\n")
    assert errors(spark, path) == [
        (0, 1, "no ID= found for this specimen"), (0, 5, "non-integer ID: 'ID=q'"),
        (3, 15, "expected 2 landmarks, found 1"), (3, 17, "non-numeric coordinate: '3 z'"),
    ]
    rows = {int(r["tps_id"]): r for r in LF.read_landmarks(spark, path, strict=False).collect()}
    assert rows[5]["y"] == [2.0, 4.0] and rows[6]["x"] == [1.0] and set(rows) == {5, 6}


def test_white_space_of_any_kind_and_numbers_as_written(spark, tmp_path):
    many = "\n".join(f"\t{i} {i}\t" for i in range(3000))
    path = write(tmp_path, f"LM=3000\n{many}\n\tIMAGE=q\n\tID=5\t\nLM=1\n1d 2f\nID=6\nLM=1\n\t1e2,+.5\n ID= 8\t\n")
    rows = {int(r["tps_id"]): r for r in LF.read_landmarks(spark, path, strict=False).collect()}
    assert set(rows) == {5, 8} and rows[5]["x"] == [float(i) for i in range(3000)] and (rows[8]["x"], rows[8]["y"]) == ([100.0], [0.5])
    assert (1, 3005, "non-numeric coordinate: '1d 2f'") in errors(spark, path)


def test_text_before_the_first_block_is_no_block(spark, tmp_path):
    path = write(tmp_path, "title\n\nmore\nLM=two\n5 5\nLM=1\n1 1\nID=z\n")
    assert errors(spark, path) == [
        (0, 1, "expected 'LM=', found: 'title'"), (0, 3, "expected 'LM=', found: 'more'"), (0, 4, "unreadable point count in 'LM=two'"),
        (1, 5, "expected 'LM=', found: '5 5'"), (1, 6, "no ID= found for this specimen"), (1, 8, "non-integer ID: 'ID=z'"),
    ]


def test_order_survives_many_splits(spark, tmp_path):
    path = write(tmp_path, "".join(f"LM=1\n{i} {i}\nID={i}\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = LF.read_landmarks(spark, path).orderBy("ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r["tps_id"]) for r in rows] == list(range(500)) and [r["ord"] for r in rows] == list(range(500))


def test_round_trip_and_single_file(spark, tmp_path):
    df = frame(spark, [BASE, BASE * 2], tps_id=[4, 9], image_path=["a", "b"], photo_id=["p", None], inv_id=["i", None])
    out = str(tmp_path / "out")
    LF.write_landmarks(df, out, single_file=True)
    part = next(tmp_path.glob("out/part-*"))
    text = part.read_bytes().decode()
    assert text.startswith("LM=8\r\n0.0000 0.0000\r\n") and "COMMENT=photo_id=p;inv_id=i\r\n" in text and text.count("COMMENT") == 1
    rows = LF.read_landmarks(spark, out).orderBy("ord").collect()
    assert np.allclose(rows[1]["x"], BASE[:, 0] * 2) and [int(r["tps_id"]) for r in rows] == [4, 9]
    clean = str(tmp_path / "clean")
    LF.write_clean_landmarks(LF.without_landmark(df, 0), clean, single_file=True)
    text = next(tmp_path.glob("clean/part-*")).read_text()
    assert text.startswith("LM=7\n1.00000 0.20000\n") and "ID=0" in text and "COMMENT" not in text


def test_reference_needs_exactly_one_block(spark, tmp_path):
    one = write(tmp_path, GOOD, "one.tps")
    assert LF.read_reference(spark, one).tolist() == [[1.5, 2.0], [3.0, 4.0]]
    with pytest.raises(LF.LandmarkFileError):
        LF.read_reference(spark, write(tmp_path, GOOD * 2, "two.tps"))


def test_uploads_are_renumbered_and_must_not_be_empty(spark, tmp_path):
    a = write(tmp_path, GOOD.replace("p7", "z"), "a.tps")
    b = write(tmp_path, GOOD.replace("p7", "y"), "b.tps")
    rows = LF.read_uploads(spark, [a, b]).collect()
    assert {r["photo_id"]: int(r["tps_id"]) for r in rows} == {"y": 1, "z": 2}
    LF.write_landmarks(LF.read_landmarks(spark, a), str(tmp_path / "folder"))
    assert LF.read_uploads(spark, [str(tmp_path / "folder"), b]).count() == 2
    (tmp_path / "other").mkdir()
    with pytest.raises(LF.LandmarkFileError, match="other/a.tps"):
        LF.read_uploads(spark, [a, write(tmp_path / "other", "nothing", "a.tps")])
    with pytest.raises(LF.LandmarkFileError, match="c.tps"):
        LF.read_uploads(spark, [a, write(tmp_path, "nothing here", "c.tps")])


def test_ranks_come_from_file_splits(spark, tmp_path, limits):
    """Ranks follow (file, place in the file) over many splits; rows with coordinates are not shuffled for it."""
    block = "LM=2\n1.5 2\n{v} 4\nIMAGE=i\nID={id}\n"
    n = 0
    for k, size in enumerate((40, 3, 120, 1, 77)):
        text = "".join(block.format(v="x" if (n + i) % 13 == 5 else n + i, id=n + i) for i in range(size))
        write(tmp_path, text, f"part-{k}.tps")
        n += size
    wanted = [(r, i) for r, i in enumerate(i for i in range(n) if i % 13 != 5)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = LF.read_landmarks(spark, str(tmp_path), strict=False)
        assert rows.rdd.getNumPartitions() > 5
        assert sorted((r["ord"], int(r["tps_id"])) for r in rows.collect()) == wanted
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line and "x#" in line]
        with limits(broadcastBytes=0, hotGroupRows=3):
            assert sorted((r["ord"], int(r["tps_id"])) for r in LF.read_landmarks(spark, str(tmp_path), strict=False).collect()) == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_changed_splits_are_noticed(spark, tmp_path):
    write(tmp_path, GOOD * 9)
    blocks = LF.scan_blocks(spark, str(tmp_path))
    with pytest.raises(Exception, match="file splits changed"):
        LF._ranked_by_split(blocks, blocks.limit(4)).collect()
