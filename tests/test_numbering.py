import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from alula.operators import numbering as N
from tests.shapes import BASE, frame, population, turned, unit


def clouds(n=12, seed=3, noise=0.01):
    rng = np.random.default_rng(seed)
    out, orders = [], []
    for i in range(n):
        p = rng.permutation(len(BASE))
        shape = turned(BASE + rng.normal(0, noise, BASE.shape), rng.uniform(0, 360), rng.uniform(0.5, 40), rng.normal(0, 9, 2))
        out.append(shape[p])
        orders.append(shape)
    return out, orders


def test_assignment_is_optimal():
    rng = np.random.default_rng(0)
    cost = rng.random((40, 5, 5))
    cost[:5] = np.round(cost[:5], 1)  # ties
    cols = N.assign_batch(cost)
    for c, mine in zip(cost, cols):
        best = min(sum(c[i, p[i]] for i in range(5)) for p in itertools.permutations(range(5)))
        assert sorted(mine.tolist()) == list(range(5))
        assert c[np.arange(5), mine].sum() == pytest.approx(best)


def test_shuffled_turned_and_enlarged_clouds_are_recovered(spark):
    given, truth = clouds()
    rows = sorted(N.number_landmarks(frame(spark, given), unit(BASE)).collect(), key=lambda r: r["ord"])
    for r, t in zip(rows, truth):
        assert r["status"] == "OK" and r["registration_cost"] < 1e-3
        assert np.allclose(np.column_stack([r["nx"], r["ny"]]), t)


def test_wrong_counts_and_coincident_points_fail(spark):
    rows = {r["ord"]: r for r in N.number_landmarks(frame(spark, [BASE[:6], np.zeros((8, 2)), BASE]), unit(BASE)).collect()}
    assert rows[0]["status"] == "FAILED" and rows[0]["error_reason"] == "6 landmarks, 8 expected"
    assert rows[0]["registration_cost"] == float("inf") and rows[0]["nx"] == BASE[:6, 0].tolist()
    assert rows[1]["status"] == "FAILED" and rows[2]["status"] == "OK"


def test_mirrored_clouds_still_give_a_permutation(spark):
    mirrored = [s * np.array([-1.0, 1.0]) for s in clouds(4)[0]]
    for r in N.number_landmarks(frame(spark, mirrored), unit(BASE)).collect():
        assert sorted(r["nx"]) == sorted(mirrored[r["ord"]][:, 0].tolist())


def test_job_flags_atypical_labelled_shapes(spark):
    rng = np.random.default_rng(2)
    shapes = population(15, 7) + [BASE + rng.normal(0, 0.35, BASE.shape), BASE[:5]]
    df = frame(spark, shapes, inv_id=[f"i{k}" for k in range(17)], photo_id=[f"p{k}" for k in range(17)],
               tps_id=list(range(17)), image_path=[""] * 17)
    biology = spark.createDataFrame([(f"i{k}", "a" if k != 3 else None) for k in range(17)], "inv_id string, species string")
    result = N.renumber(df, unit(BASE), biology)
    rows = {r["ord"]: r for r in result.collect()}
    assert rows[16]["status"] == "FAILED" and not rows[16]["usable"]
    assert rows[15]["n_outlier_landmarks"] > 0 and rows[3]["n_outlier_landmarks"] is None
    assert N.numbering_log(result).count() == 17 and N.numbered_landmarks(result).count() == 16
    assert {r["status"] for r in N.renumber(df, unit(BASE)).collect()} == {"OK", "FAILED"}


def test_another_method_can_be_registered(spark):
    N.register_method("as_is", lambda z, ref: (np.tile(np.arange(z.shape[1]), (len(z), 1)), np.zeros(len(z))))
    r = N.number_landmarks(frame(spark, [BASE[::-1].copy()]), unit(BASE), "as_is").first()
    assert r["nx"] == BASE[::-1, 0].tolist() and r["registration_cost"] == 0


def test_localisation_error(spark):
    df = spark.createDataFrame(
        [
            (1, [3.0, 10.0], [0.0, 0.0], [10.0, 0.0], [0.0, 4.0]),
            (2, [0.0, 50.0, 7.0], [0.0, 0.0, 0.0], [1.0, 8.0], [0.0, 0.0]),
            (3, [], [], [1.0], [1.0]),
        ],
        "ord long, px array<double>, py array<double>, tx array<double>, ty array<double>",
    )
    rows = {r["ord"]: r for r in N.matched_distances(df, "px", "py", "tx", "ty").collect()}
    assert sorted(rows[1]["distances"]) == [0.0, 5.0]
    assert (sorted(rows[2]["distances"]), rows[2]["n_missed"], rows[2]["n_spurious"]) == ([1.0, 1.0], 0, 1)
    assert (rows[3]["distances"], rows[3]["n_missed"]) == ([], 1)
    total = N.localization_error(N.matched_distances(df, "px", "py", "tx", "ty"), F.lit("OK")).first()
    assert (total["n_specimens"], total["n_matched_points"], total["n_missed_points"], total["n_spurious_points"]) == (3, 4, 1, 1)
    assert total["mean_error_px"] == pytest.approx(1.75) and total["median_error_px"] == 1.0
    assert total["pct_within_5px"] == 1.0


def test_what_is_solved_together_does_not_grow_with_the_rows(spark):
    N.register_method("how_many", lambda z, ref: (np.tile(np.arange(z.shape[1]), (len(z), 1)), np.full(len(z), float(len(z)))))
    rng = np.random.default_rng(6)
    many = frame(spark, list(rng.normal(size=(700, 32, 2)))).coalesce(1)
    costs = [r["registration_cost"] for r in N.number_landmarks(many, rng.normal(size=(32, 2)), "how_many").collect()]
    assert len(costs) == 700 and max(costs) * 8 * 32 * 32 <= 1 << 21


def test_solver_holds_few_copies_of_its_cost_table():
    import tracemalloc

    rng = np.random.default_rng(7)
    z, ref = rng.normal(size=(2, 256, 32)), rng.normal(size=(2, 32))
    tracemalloc.start()
    N.rotate_and_match(z[0] + 1j * z[1], ref[0] + 1j * ref[1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3.5 * 8 * 256 * 8 * 32 * 32
