import numpy as np
import pytest

from alula.operators import variance as VA


def table(spark, n=60, seed=2, effect=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        species, caste = f"s{i % 3}", f"c{(i // 3) % 2}"
        v = rng.normal(0, 1, 6) + effect * (i % 3)
        rows.append((i, species, caste, v.tolist()))
    return rows, spark.createDataFrame(rows, "ord long, species string, caste string, v array<double>").repartition(3)


def between(x, labels):
    grand = x.mean(axis=0)
    return sum(len(x[labels == g]) * ((x[labels == g].mean(axis=0) - grand) ** 2).sum() for g in np.unique(labels))


def test_nested_sums_of_squares(spark):
    rows, df = table(spark, effect=0.7)
    x = np.array([r[3] for r in rows])
    species = np.array([r[1] for r in rows])
    cells = np.array([r[1] + r[2] for r in rows])
    total = ((x - x.mean(axis=0)) ** 2).sum()
    b1, b2 = between(x, species), between(x, cells)
    got = {r["source"]: r for r in VA.nested_anova(df, ["species", "caste"]).collect()}
    assert got["species"]["ss"] == pytest.approx(b1) and got["species"]["df"] == 2
    assert got["caste"]["ss"] == pytest.approx(b2 - b1) and got["caste"]["df"] == 3
    assert got["Residual"]["ss"] == pytest.approx(total - b2) and got["Residual"]["df"] == 54
    assert got["species"]["f"] == pytest.approx((b1 / 2) / ((total - b2) / 54)) and got["Residual"]["f"] is None


def test_null_level_is_rejected(spark):
    df = spark.createDataFrame([(1, None, [1.0]), (2, "a", [2.0])], "ord long, species string, v array<double>")
    with pytest.raises(Exception, match="missing values"):
        VA.nested_anova(df, ["species"]).collect()


def test_within_group_variance(spark):
    rows, df = table(spark, 31)
    extra = df.sparkSession.createDataFrame([(99, "alone", "c0", [0.0] * 6)], df.schema)
    got = {r["species"]: r["shape_variance"] for r in VA.within_group_variance(df.unionByName(extra), "species").collect()}
    x, s = np.array([r[3] for r in rows]), np.array([r[1] for r in rows])
    for name in ("s0", "s1", "s2"):
        assert got[name] == pytest.approx(x[s == name].var(axis=0, ddof=1).sum())
    assert got["alone"] is None


@pytest.mark.parametrize("piece", [None, 9])
def test_permutation_p(spark, limits, piece):
    with limits(**({"permutationRows": piece} if piece else {})):
        _, strong = table(spark, effect=2.0)
        p = VA.permutation_p_values(strong, ["species", "caste"], "v", 49, seed=5)
        assert p["species"] == pytest.approx(1 / 50)
        assert p["caste"] > 0.05
        again = VA.permutation_p_values(strong.repartition(5), ["species", "caste"], "v", 49, seed=5)
        assert again == p


@pytest.mark.parametrize("piece", [None, 7])
def test_permuted_sums_have_the_right_expectation(spark, limits, piece):
    """Mean between-cells sum over permutations approaches (K-1)/(N-1) of the total."""
    rows, df = table(spark, 45, 8)
    x = np.array([r[3] for r in rows])
    total = ((x - x.mean(axis=0)) ** 2).sum()
    with limits(**({"permutationRows": piece} if piece else {})):
        q = VA._permuted_sums(df, [], "species", "v", 200, 3, "ord")
    between_sums = q - len(x) * (x.mean(axis=0) ** 2).sum()
    assert between_sums.std() > 0
    assert between_sums.mean() == pytest.approx(total * 2 / 44, rel=0.12)


def test_no_setting_changes_the_draws(spark, limits):
    _, df = table(spark, 45, 8)
    whole = VA._permuted_sums(df, ["species"], "caste", "v", 20, 3, "ord")
    for piece in (1, 9, 20):
        with limits(permutationRows=piece):
            assert VA._permuted_sums(df, ["species"], "caste", "v", 20, 3, "ord") == pytest.approx(whole)


def test_strata_are_shuffled_independently(spark, limits):
    """The same rows in three strata, with ids that differ: equal orders would give three equal sums."""
    rows = [(f"sp{k}", "ab"[i % 2], [float(i)], 100 * k + i) for k in range(3) for i in range(10)]
    sums = []
    for k in range(3):
        df = spark.createDataFrame([r for r in rows if r[0] == f"sp{k}"], "species string, caste string, v array<double>, ord long")
        for piece in (100, 4):
            with limits(permutationRows=piece):
                sums.append(VA._permuted_sums(df, ["species"], "caste", "v", 12, 3, "ord").tolist())
    assert sums[0] == pytest.approx(sums[1]) and sums[0] != sums[2] and sums[2] != sums[4]


def test_between_within_identity(spark):
    _, df = table(spark)
    r = VA.between_within(df, "species").first()
    assert r["ss_between"] + r["ss_within"] == pytest.approx(r["ss_total"])
