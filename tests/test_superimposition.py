import numpy as np
import pytest

from alula.operators import outliers as U
from alula.operators import superimposition as A
from tests.shapes import BASE, frame, plain_consensus, population, rotated, turned, unit


def matrix(rows, x="ax", y="ay"):
    rows = sorted(rows, key=lambda r: r["ord"])
    return np.stack([np.column_stack([r[x], r[y]]) for r in rows])


def test_copies_have_distance_zero(spark):
    shapes = [turned(BASE, d, s, (d, -s)) for d, s in ((0, 1), (37, 2.5), (190, 0.3), (300, 10))]
    rows = A.align_to_reference(frame(spark, shapes), unit(BASE)).collect()
    assert max(r["procrustes_distance"] for r in rows) < 1e-12


def test_mirror_image_is_not_aligned(spark):
    mirrored = BASE * np.array([-1.0, 1.0])
    assert A.align_to_reference(frame(spark, [mirrored]), unit(BASE)).first()["procrustes_distance"] > 0.1


def test_alignment_agrees_with_singular_vectors(spark):
    shapes = population(6, 3, 0.3)
    rows = A.align_to_reference(frame(spark, shapes), unit(BASE)).collect()
    expected = np.stack([rotated(unit(s), unit(BASE)) for s in shapes])
    assert np.allclose(matrix(rows), expected, atol=1e-12)


def test_wrong_landmark_count_and_degenerate_shape_fail(spark):
    with pytest.raises(Exception, match="shape mismatch"):
        A.align_to_reference(frame(spark, [BASE[:5]]), unit(BASE)).collect()
    with pytest.raises(Exception, match="centroid size = 0"):
        A.align_to_reference(frame(spark, [np.ones((8, 2))]), unit(BASE), "ord").collect()


def test_consensus_matches_plain_iteration(spark):
    shapes = [turned(s, 20 * i, 1 + i, (i, 2 * i)) for i, s in enumerate(population(12, 1, 0.05))]
    fitted = A.consensus(frame(spark, shapes))
    aligned, mean, steps = plain_consensus(shapes)
    assert fitted.n_iterations == steps and fitted.n_specimens == 12
    assert np.allclose(fitted.mean_shape, mean, atol=1e-10)
    assert np.allclose(matrix(fitted.aligned.collect()), aligned, atol=1e-10)
    assert abs((fitted.mean_shape**2).sum() - 1) < 1e-12


def test_consensus_rejects_mixed_counts(spark):
    with pytest.raises(Exception, match="landmark counts"):
        A.consensus(frame(spark, [BASE, BASE[:5], BASE]))


@pytest.mark.parametrize("bound", [None, 1])
def test_grouped_consensus_equals_one_per_group(spark, limits, bound):
    groups = {"a": population(9, 1, 0.05), "b": population(7, 2, 0.2)}
    shapes = groups["a"] + groups["b"]
    df = frame(spark, shapes, species=["a"] * 9 + ["b"] * 7)
    with limits(**({"broadcastBytes": bound} if bound else {})):
        fitted = A.consensus_by_group(df, "species", max_iter=6)
        rows = fitted.aligned.collect()
        means = {r["species"]: r for r in fitted.means.collect()}
    for name, members in groups.items():
        aligned, mean, steps = plain_consensus(members, max_iter=6)
        assert means[name]["n_iterations"] == steps
        assert np.allclose(np.column_stack([means[name]["mean_x"], means[name]["mean_y"]]), mean, atol=1e-9)
        assert np.allclose(matrix([r for r in rows if r["species"] == name]), aligned, atol=1e-9)


def test_reference_shape_uses_majority_count_and_drops_a_point(spark):
    shapes = population(5, 4) + [BASE[:6]]
    shape = A.reference_shape(frame(spark, shapes), drop_point=2)
    assert shape.shape == (7, 2)
    assert np.allclose(shape, np.delete(plain_consensus(shapes[:5])[1], 2, axis=0), atol=1e-9)


def plain_flags(shapes, factor, heavy):
    al, _, _ = plain_consensus(shapes)
    med = np.median(al, axis=0)
    dist = np.linalg.norm(al - med, axis=2)
    mid = np.median(dist, axis=0)
    out = dist > mid + factor * np.median(np.abs(dist - mid), axis=0)
    return out.sum(axis=1), out.sum(axis=1) >= heavy * al.shape[1]


@pytest.mark.parametrize("hot", [None, 6])
def test_outlier_flags(spark, limits, hot):
    rng = np.random.default_rng(9)
    good = population(14, 5)
    bad = BASE + rng.normal(0, 0.5, BASE.shape)
    shapes = [*good, bad, *population(4, 6)]
    df = frame(spark, shapes, species=["a"] * 15 + ["small"] * 4)
    with limits(**({"hotGroupRows": hot} if hot else {})):
        rows = {r["ord"]: r for r in U.flag_by_group(df).collect()}
    n_out, heavy = plain_flags(shapes[:15], U.MAD_FACTOR, U.HEAVY_FRACTION)
    assert [rows[i]["n_outlier_landmarks"] for i in range(15)] == n_out.tolist()
    assert [rows[i]["heavy"] for i in range(15)] == heavy.tolist()
    assert heavy[14] and not any(rows[i]["heavy"] for i in range(15, 19))
