"""Formula matrices by hand, bootstrapped bands against numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.operators import linalg, models


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, 2.0, 10.0, "b", 3, True), (2, 4.0, 20.0, "a", 11, False), (3, 6.0, 30.0, "c", 3, True), (4, None, 1.0, "a", 3, True),
         (5, 8.0, 40.0, None, 11, True), (6, 10.0, 50.0, "b", 2, False)],
        "id int, x double, z double, s string, k int, t boolean")


def matrix(df):
    return df.columns, [list(r) for r in df.orderBy("id").collect()]


def test_categories_and_interactions(rows):
    cols, got = matrix(models.formula_matrix(rows, "x + C(s) + x:C(s)", keep=["id"]))
    assert cols == ["id", "Intercept", "x", "s[T.b]", "s[T.c]", "x:s[T.b]", "x:s[T.c]"]
    assert got == [[1, 1, 2, 1, 0, 2, 0], [2, 1, 4, 0, 0, 0, 0], [3, 1, 6, 0, 1, 0, 6], [6, 1, 10, 1, 0, 10, 0]]
    star = models.formula_matrix(rows, "x * s", keep=["id"])
    assert matrix(star) == (cols, got)


def test_numbers_as_categories_and_no_intercept(rows):
    cols, got = matrix(models.formula_matrix(rows, "0 + C(k) + t", keep=["id"]))
    assert cols == ["id", "k[2]", "k[3]", "k[11]", "t[T.true]"]
    assert got[0] == [1, 0, 1, 0, 1] and got[1] == [2, 0, 0, 1, 0] and len(got) == 6
    cols, got = matrix(models.formula_matrix(rows, "x:C(s)", keep=["id"]))        # a slope per level
    assert cols == ["id", "Intercept", "x:s[a]", "x:s[b]", "x:s[c]"] and got[1] == [2, 1, 4, 0, 0]
    cols, got = matrix(models.formula_matrix(rows, "x:z - 1", keep=["id"]))
    assert cols == ["id", "x:z"] and got[0] == [1, 20]


def test_full_rank(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, float(rng.normal()), "abc"[i % 3], "uv"[i // 3 % 2]) for i in range(60)],
                               "id int, x double, s string, t string")
    for formula, rank in (("s * t", 6), ("0 + s + t", 4), ("s + t + x", 5), ("x * s", 6), ("0 + x:s + s", 6)):
        m = np.array([list(r) for r in models.formula_matrix(df, formula).collect()])
        assert m.shape[1] == rank == np.linalg.matrix_rank(m), formula


def test_errors(rows):
    with pytest.raises(ValueError, match="more than 2 levels"):
        models.formula_matrix(rows, "s", max_levels=2)
    with pytest.raises(ValueError, match="no column"):
        models.formula_matrix(rows, "x + nothing")
    with pytest.raises(ValueError, match="left out"):
        models.formula_matrix(rows, "x - z")


def test_draws_are_poisson():
    w = linalg.poisson_draws(np.arange(2000, dtype=np.uint64) * 7919, 300)
    assert abs(w.mean() - 1) < .01 and abs(w.var() - 1) < .02
    assert abs((w == 0).mean() - np.exp(-1)) < .005
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < .1


def test_band_agrees_with_resampling(spark):
    rng = np.random.default_rng(6)
    x = rng.gamma(2, 3, 800) + 1e3
    y = 2 + .5 * x + rng.normal(size=800) * (x - 995)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y double")
    got = models.bootstrap_line(df.repartition(5), "x", "y", ["id"], replicates=2000, grid=20).collect()
    again = models.bootstrap_line(df.repartition(2), "x", "y", ["id"], replicates=2000, grid=20).collect()
    assert np.allclose(np.array(got), np.array(again), rtol=1e-9)
    grid = np.linspace(x.min(), x.max(), 20)
    lines = []
    for _ in range(2000):
        k = rng.integers(0, 800, 800)
        b, a = np.polyfit(x[k] - 1e3, y[k], 1)
        lines.append(a + b * (grid - 1e3))
    low, high = np.quantile(lines, [.025, .975], axis=0)
    width = high - low
    assert np.allclose([r.x for r in got], grid)
    assert np.all(np.abs(np.array([r.ci_low for r in got]) - low) < .15 * width)
    assert np.all(np.abs(np.array([r.ci_high for r in got]) - high) < .15 * width)
    b, a = np.polyfit(x - 1e3, y, 1)
    assert np.allclose([r.fit for r in got], a + b * (grid - 1e3))


def test_no_band(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 3.0), (3, 1.0, 4.0), (4, None, 1.0)], "id int, x double, y double")
    assert models.bootstrap_line(df, "x", "y", ["id"]).collect() == []
    assert models.bootstrap_line(df.limit(0), "x", "y", ["id"]).collect() == []
    two = df.withColumn("x", F.col("id").cast("double"))
    assert len(models.bootstrap_line(two, "x", "y", ["id"], replicates=50, grid=5).collect()) == 5
