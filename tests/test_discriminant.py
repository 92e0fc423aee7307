import numpy as np
import pytest
from pyspark.sql import functions as F

from alula.operators import discriminant as LD
from alula.operators import reports as P
from alula.operators.dataset import EmptyDatasetError
from alula.operators.superimposition import consensus
from tests.shapes import BASE, frame, population, turned, unit


def gaussians(seed=0, per_group=4, groups=5, d=3):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c, centre in enumerate(([0, 0, 0], [2, 1, 0], [0, 2, 2])):
        for g in range(groups):
            shift = rng.normal(0, 0.3, d)
            for _ in range(per_group):
                rows.append((i, f"c{c}", f"c{c}g{g}", (np.array(centre) + shift + rng.normal(0, 0.7, d)).tolist()))
                i += 1
    return rows


def plain_fit(x, labels, target):
    """Textbook pooled-covariance rule."""
    classes = sorted(set(labels))
    n, k = len(x), len(classes)
    means = np.array([x[labels == c].mean(axis=0) for c in classes])
    pooled = sum((x[labels == c] - m).T @ (x[labels == c] - m) for c, m in zip(classes, means)) / (n - k)
    inv = np.linalg.inv(pooled)
    priors = np.array([(labels == c).mean() for c in classes])
    logits = target @ inv @ means.T - 0.5 * np.einsum("kd,de,ke->k", means, inv, means) + np.log(priors)
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return classes, e / e.sum(axis=1, keepdims=True)


SCHEMA = "ord long, label string, inv_id string, scores array<double>"


def test_fit_agrees_with_textbook_rule(spark):
    rows = gaussians()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    x, labels = np.array([r[3] for r in rows]), np.array([r[1] for r in rows])
    lda = LD.fit_discriminant(df, "label")
    classes, expected = plain_fit(x, labels, x)
    assert lda.classes == classes
    assert np.allclose(LD.posteriors(x, lda.coef, lda.intercept), expected, atol=1e-9)
    assert lda.axes.shape == (3, 2)


@pytest.mark.parametrize("large", [None, 2])
def test_leave_group_out_equals_refitting(spark, limits, large):
    rows = gaussians(4) + [(900 + i, "lonely", "only", [5.0, 5.0, 5.0 + i]) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    with limits(**({"foldGroupRows": large} if large else {}), foldRows=20):
        out, classes = LD.leave_group_out(df, "label")
        got = {r["ord"]: np.array(r["proba"]) for r in out.collect()}
    x, labels, groups = (np.array([r[k] for r in rows]) for k in (3, 1, 2))
    assert len(got) == len(rows)
    for g in set(groups.tolist()):
        held = groups == g
        present, expected = plain_fit(x[~held], labels[~held], x[held])
        columns = [classes.index(c) for c in present]
        for row, e in zip(np.flatnonzero(held), expected):
            p = got[rows[row][0]]
            assert np.allclose(p[columns], e, atol=1e-8)
            assert sum(p) == pytest.approx(1)
            if g == "only":
                assert p[classes.index("lonely")] == 0


def test_few_rows_leave_the_inverse(spark, monkeypatch):
    """Small specimens take the low-rank way, a null score and a class that one specimen holds included."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(150):
        c = i % 3
        rows.append((i, f"c{c}", f"g{i // 9}{c}" if i else None, [*(rng.normal(c, 1, 9) * np.logspace(0, -3, 9)).tolist(), 0.0], "kept"))
    rows += [(900 + i, "lonely", "only", [*(rng.normal(4, 1, 9) * np.logspace(0, -3, 9)).tolist(), 0.0], "kept") for i in range(4)]
    rows.append((999, None, "g0", [0.0] * 10, "kept"))
    df = spark.createDataFrame(rows, "ord long, label string, inv_id string, scores array<double>, grp string").repartition(3)
    out, classes = LD.leave_group_out(df, "label")
    assert out.columns == [*df.columns, "proba"]
    got = {r["ord"]: np.array(r["proba"]) for r in out.collect()}
    rows.pop()
    assert len(got) == len(rows)
    x, labels, groups = np.array([r[3] for r in rows])[:, :9], np.array([r[1] for r in rows]), np.array([str(r[2]) for r in rows])
    for g in set(groups.tolist()):
        held = groups == g
        present, expected = plain_fit(x[~held], labels[~held], x[held])
        for row, e in zip(np.flatnonzero(held), expected):
            assert np.allclose(got[rows[row][0]][[classes.index(c) for c in present]], e, atol=1e-8)
    model = LD.Downdate(LD.class_sums(df, "label"))
    monkeypatch.setattr(LD, "_fold_model", lambda *a: pytest.fail("solved in full"))
    codes, full = np.searchsorted(classes, labels), np.array([r[3] for r in rows])
    for g in set(groups.tolist()):
        model.posteriors(codes[groups == g], full[groups == g])


def test_folds_that_change_the_rank_are_solved_in_full(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (40, 6))
    x[:, 5] = 0
    x[:2, 5] = [1.0, -1.0]  # only one specimen varies in the last score
    rows = [(i, f"c{i // 2 % 2}", f"g{i // 2}", v.tolist()) for i, v in enumerate(x)]
    out, _ = LD.leave_group_out(spark.createDataFrame(rows, SCHEMA), "label")
    got = {r["ord"]: r["proba"] for r in out.collect()}
    labels = np.array([r[1] for r in rows])
    _, expected = plain_fit(x[2:, :5], labels[2:], x[:2, :5])
    assert np.allclose([got[0], got[1]], expected, atol=1e-8)


def test_one_class_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", "g", [1.0, 2.0]), (2, "a", "h", [2.0, 1.0])], SCHEMA)
    with pytest.raises(LD.ModelError):
        LD.fit_discriminant(df, "label")
    with pytest.raises(LD.ModelError):
        LD.projection_axes(1)


@pytest.fixture(scope="module")
def fitted(spark):
    shapes = [turned(s, 10 * i, 1 + i) for i, s in enumerate(population(40, 1, 0.08))]
    wide = BASE * np.array([1.25, 1.0])
    shapes += [turned(s, 7 * i, 2 + i) for i, s in enumerate(population(40, 2, 0.08, wide))]
    species = ["a"] * 40 + ["b"] * 40
    df = frame(spark, shapes, species=species, inv_id=[f"{s}{i % 8}" for i, s in enumerate(species)]).cache()
    c = consensus(df)
    pca = LD.fit_components(c.aligned, 8, c.mean_shape.reshape(-1))
    scored = LD.with_scores(c.aligned, pca)
    lda = LD.fit_discriminant(scored, "species")
    return df, c, pca, scored, LD.TrainedModel(c.mean_shape, pca, lda, "species", 1, {"model_name": "demo"})


def test_components_match_covariance(fitted):
    _, c, pca, scored, _ = fitted
    rows = c.aligned.orderBy("ord").collect()
    v = np.array([np.column_stack([r["ax"], r["ay"]]).reshape(-1) for r in rows])
    values = np.sort(np.linalg.eigvalsh(np.cov(v.T)))[::-1]
    assert np.allclose(pca.explained_ratio, values[:12] / values.sum(), atol=1e-10)
    assert np.allclose(pca.mean, v.mean(axis=0), atol=1e-12)
    s = np.array([r["scores"] for r in scored.orderBy("ord").collect()])
    assert np.allclose(s, (v - v.mean(axis=0)) @ pca.loadings.T, atol=1e-10)
    strongest = np.abs(pca.loadings).argmax(axis=1)
    assert (pca.loadings[np.arange(12), strongest] > 0).all()


def test_small_deviations_keep_their_components(spark):
    """Deviations of 1 to 1e-10: products of coordinates would lose all below 1e-8."""
    rng = np.random.default_rng(3)
    turn, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    v = (rng.normal(size=(300, 12)) * np.logspace(0, -10, 12)) @ turn
    df = spark.createDataFrame([(r[::2].tolist(), r[1::2].tolist()) for r in v], "ax array<double>, ay array<double>").repartition(5)
    pca = LD.fit_components(df, 6, np.zeros(12))
    s = np.linalg.svd(v - v.mean(axis=0), compute_uv=False)
    assert np.allclose(pca.explained_ratio, s[:8] ** 2 / (s**2).sum(), rtol=1e-6, atol=0)
    assert np.allclose(pca.loadings @ pca.loadings.T, np.eye(8), atol=1e-12)


def test_too_few_rows_for_components(spark):
    df = frame(spark, population(5)).withColumnRenamed("x", "ax").withColumnRenamed("y", "ay")
    with pytest.raises(LD.ModelError, match="components"):
        LD.fit_components(df, 8, BASE.reshape(-1))


def test_predictions_and_stored_model(spark, fitted, tmp_path):
    df, _, _, _, model = fitted
    LD.save_model(spark, model, str(tmp_path / "m"))
    loaded = LD.load_model(spark, str(tmp_path / "m"))
    assert loaded.classes == ["a", "b"] and loaded.label() == "demo"
    a = {r["ord"]: r for r in LD.predict(model, df).collect()}
    b = {r["ord"]: r for r in LD.predict(loaded, df).collect()}
    assert all(a[k]["confidence"] == pytest.approx(b[k]["confidence"], abs=1e-12) for k in a)
    assert all(r["third_choice"] is None and r["second_choice"] is not None for r in a.values())
    judged = P.accuracy(P.with_correctness(LD.predict(model, df), "species", F.col("species"))).first()
    assert judged["n"] == 80 and judged["accuracy_top1"] > 0.9 and judged["accuracy_top3"] == 1.0
    with pytest.raises(LD.ModelError):
        LD.load_model(spark, str(tmp_path / "absent"))


def test_other_landmark_counts_are_skipped(spark, fitted):
    df, _, _, _, model = fitted
    mixed = frame(spark, [BASE, BASE[:5], turned(BASE, 30)])
    assert LD.predict(model, mixed).count() == 2
    with pytest.raises(EmptyDatasetError):
        LD.predict(model, frame(spark, [BASE[:5]]))


def test_projection_and_distance(spark, fitted):
    df, _, _, _, model = fitted
    rows = LD.score_shapes(model, frame(spark, [turned(unit(model.mean_shape), 50, 3)]), projection=True).collect()
    assert rows[0]["procrustes_distance"] < 1e-7 and len(rows[0]["lda"]) == 1


def test_choice_ties_follow_class_order(spark):
    df = spark.createDataFrame([(1, [0.4, 0.4, 0.2])], "ord long, proba array<double>")
    r = P.prediction_columns(df, "species", ["b", "c", "a"]).first()
    assert (r["predicted_species"], r["second_choice"], r["third_choice"]) == ("b", "c", "a")
