import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alula.operators import medians as MD
from alula.operators import ordering as O


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, "hot" if i % 3 else f"k{i % 11}", rng.randrange(40), rng.random()) for i in range(400)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "ord long, key string, v long, w double").repartition(4).cache()


def test_first_latest_and_repeats(rows):
    data, df = rows
    first, last = {}, {}
    for r in sorted(data):
        first.setdefault(r[1], r[0])
        last[r[1]] = r[0]
    assert {r["key"]: r["ord"] for r in O.first_rows(df, ["key"], ["ord"]).collect()} == first
    assert {r["key"]: r["ord"] for r in O.latest_rows(df, ["key"], ["ord"]).collect()} == last
    marked = O.with_repeats(df, ["key"], ["ord"], F.col("v") > 5).collect()
    seen = {}
    for r in sorted(data):
        if r[2] > 5:
            seen.setdefault(r[1], r[0])
    assert all(r["is_repeat"] == (r["v"] > 5 and r["ord"] > seen[r["key"]]) for r in marked)


@pytest.mark.parametrize("hot", [None, 20])
@pytest.mark.parametrize("keys", [["key"], []])
def test_numbering_is_the_same_with_split_groups(rows, limits, hot, keys):
    data, df = rows
    with limits(**({"hotGroupRows": hot} if hot else {})):
        got = {r["ord"]: r["n"] for r in O.numbered(df, keys, ["v", "ord"], "n").collect()}
    counters, expected = {}, {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        k = r[1] if keys else 0
        counters[k] = counters.get(k, 0) + 1
        expected[r[0]] = counters[k]
    assert got == expected


@pytest.mark.parametrize("hot", [None, 15])
def test_numbering_handles_null_keys(spark, limits, hot):
    df = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "a").alias("key"))
    with limits(**({"hotGroupRows": hot} if hot else {})):
        got = O.numbered(df, ["key"], ["id"], "n").collect()
    assert all(r["n"] == r["id"] // 2 + 1 for r in got)


@pytest.mark.parametrize("hot", [None, 25])
def test_failure_runs(spark, limits, hot):
    pattern = [1, 1, 0, 1, 0, 0, 1, 1, 1] * 12
    df = spark.createDataFrame([(i, b) for i, b in enumerate(pattern)], "ord long, bad int").repartition(3)
    runs, n = [], 0
    for b in [*pattern, 0]:
        if b:
            n += 1
        elif n:
            runs.append(n)
            n = 0
    with limits(**({"hotGroupRows": hot} if hot else {})):
        got = sorted(r["run_length"] for r in O.failure_runs(df, ["ord"], F.col("bad") == 1).collect())
        O.check_failure_runs(df, ["ord"], F.col("bad") == 1, 6)
        with pytest.raises(RuntimeError, match="consecutive"):
            O.check_failure_runs(df, ["ord"], F.col("bad") == 1, 5)
    assert got == sorted(runs)


@pytest.mark.parametrize("hot", [None, 7])
def test_medians_are_exact_in_both_plans(spark, rows, limits, hot):
    data, df = rows
    ties = df.withColumn("t", F.col("v") % 3)
    with limits(**({"hotGroupRows": hot} if hot else {})):
        got = {r["key"]: (r["mw"], r["mt"]) for r in MD.grouped_medians(
            ties, ["key"], {"mw": F.col("w"), "mt": F.col("t")}).collect()}
    import statistics

    for key in {r[1] for r in data}:
        w = statistics.median(r[3] for r in data if r[1] == key)
        t = statistics.median(r[2] % 3 for r in data if r[1] == key)
        assert got[key] == (pytest.approx(w, abs=1e-15), t)


def test_sequential_ids_put_missing_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "ord long, photo_id string")
    assert {r["ord"]: r["tps_id"] for r in O.sequential_ids(df).collect()} == {2: 1, 3: 2, 1: 3}


def test_medians_of_a_wide_range_take_seven_passes(spark, limits):
    """Values from 1e-300 to 1e300, of both signs, with ties, zeros of both signs and infinities."""
    rng = random.Random(9)
    data = [("a", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(301)]
    data += [("b", 10 ** rng.uniform(-300, 300)) for _ in range(200)] + [("c", rng.choice([0.0, -0.0, 1e-300])) for _ in range(90)]
    data += [("d", x) for x in (1.7e308, 1.6e308, float("inf"), -1.0)] + [(None, 3.5), (None, 4.5)]
    df = spark.createDataFrame(data, "key string, v double").repartition(3)
    with limits(hotGroupRows=3):
        got = {r["key"]: r["m"] for r in MD.grouped_medians(df, ["key"], {"m": F.col("v")}).collect()}
    import statistics

    for key in ("a", "b", "c"):
        assert got[key] == pytest.approx(statistics.median(v for k, v in data if k == key), rel=1e-15, abs=0)
    assert got["d"] == pytest.approx(1.65e308) and got[None] == 4.0
    assert sum(MD.PASSES) == 64 and len(MD.PASSES) == 7
    codes = MD.ordered_bits(np.array([-np.inf, -1e300, -1e-300, -0.0, 0.0, 1e-300, 1.0, np.inf]))
    assert (np.diff(codes) >= 0).all() and codes[3] == codes[4] and MD.from_ordered_bits(codes)[1] == -1e300
