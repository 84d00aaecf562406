import numpy as np
import pytest

from bazaar.operators import models as MD
from bazaar.operators.quantiles import exact_quantiles


def _frame(spark, n=500, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 2 + 3 * x1 - x2 + rng.normal(scale=0.5, size=n)
    return spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(y, x1, x2)],
                                 "y double, x1 double, x2 double"), y, x1, x2


def test_ols_matches_numpy(spark):
    df, y, x1, x2 = _frame(spark)
    X = np.column_stack([np.ones_like(x1), x1, x2])
    beta, rss, *_ = np.linalg.lstsq(X, y, rcond=None)
    s2 = rss[0] / (len(y) - 3)
    se = np.sqrt(np.diag(s2 * np.linalg.inv(X.T @ X)))
    coefs, stats = MD.ols(df, "y", ["x1", "x2"])
    got = {r.variable: r for r in coefs.collect()}
    for i, v in enumerate(["Intercept", "x1", "x2"]):
        assert got[v].coef == pytest.approx(beta[i], rel=1e-9)
        assert got[v].std_err == pytest.approx(se[i], rel=1e-7)
    assert stats.first().r2 == pytest.approx(1 - rss[0] / ((y - y.mean()) ** 2).sum(), rel=1e-9)
    assert got["x1"].p_value < 1e-10


def test_fwl_slope_equals_coefficient(spark):
    df, *_ = _frame(spark)
    coefs, _ = MD.ols(df, "y", ["x1", "x2"])
    b2 = [r.coef for r in coefs.collect() if r.variable == "x2"][0]
    pts = MD.partial_regression(df, "y", ["x1", "x2"], "x2")
    slope, _ = MD.ols(pts, "res_y", ["res_x"])
    assert [r.coef for r in slope.collect() if r.variable == "res_x"][0] == pytest.approx(b2, rel=1e-8)


def test_vif_matches_inverse_correlation(spark):
    df, y, x1, x2 = _frame(spark)
    corr = np.corrcoef(np.vstack([y, x1, x2]))
    expect = np.diag(np.linalg.inv(corr))
    got = {r.variable: r.vif for r in MD.vif(df, ["y", "x1", "x2"]).collect()}
    assert [got[k] for k in ("y", "x1", "x2")] == pytest.approx(list(expect), rel=1e-8)


def test_collinear_raises(spark):
    df = spark.createDataFrame([(float(i), float(i), 2.0 * i + 1) for i in range(20)], "y double, a double, b double")
    with pytest.raises(ValueError):
        MD.ols(df, "y", ["a", "b"])


def test_logit_matches_numpy_irls(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=800)
    p = 1 / (1 + np.exp(-(0.3 + 1.2 * x)))
    yv = (rng.uniform(size=800) < p).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(yv, x)], "y double, x double")
    X = np.column_stack([np.ones_like(x), x])
    beta = np.zeros(2)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-X @ beta))
        W = mu * (1 - mu)
        beta = beta + np.linalg.solve(X.T @ (W[:, None] * X), X.T @ (yv - mu))
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ (W[:, None] * X))))
    coefs, _ = MD.logit(df, "y", ["x"])
    got = {r.variable: r for r in coefs.collect()}
    assert got["x"].coef == pytest.approx(beta[1], rel=1e-5)
    assert got["x"].std_err == pytest.approx(se[1], rel=1e-4)


def test_exact_quantiles_with_heavy_ties(spark, monkeypatch):
    from bazaar.operators import quantiles as Q
    monkeypatch.setattr(Q, "BAND_ROWS", 40)
    monkeypatch.setattr(Q, "BUCKETS", 8)
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=900), np.full(600, 0.25)])
    df = spark.createDataFrame([(float(a),) for a in v], "v double")
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    got = sorted((r.p, r.quantile) for r in exact_quantiles(df, "v", probs).collect())
    assert [q for _, q in got] == pytest.approx(list(np.quantile(v, probs)), abs=0)


def test_logit_reports_separation(spark):
    rng = np.random.default_rng(8)
    rows = [(float(i % 3 == 0 and i > 300), float(i > 300), float(rng.normal())) for i in range(600)]  # quasi: y = 0 where a = 0
    full = [(float(x > 0), float(x)) for x in rng.normal(size=200)]                                    # complete
    for parts in (1, 5):
        for df, xs in ((spark.createDataFrame(rows, "y double, a double, b double"), ["a", "b"]),
                       (spark.createDataFrame(full, "y double, x double"), ["x"])):
            coefs, fit = MD.logit(df.repartition(parts), "y", xs)
            assert all(r.converged is False and r.coef is None and r.std_err is None for r in coefs.collect())
            assert fit.first().converged is False and fit.first().pseudo_r2 is None


def test_logit_is_equal_for_any_partitioning(spark):
    rng = np.random.default_rng(9)
    rows = [(float(rng.random() < 1 / (1 + np.exp(-x))), float(x)) for x in rng.normal(size=500)]
    df = spark.createDataFrame(rows, "y double, x double")
    seen = {tuple(round(v, 9) for r in MD.logit(df.repartition(p), "y", ["x"])[0].orderBy("variable").collect()
                  for v in (r.coef, r.std_err, r.p_value)) for p in (1, 4, 13)}
    assert len(seen) == 1


def test_logit_p_value_keeps_digits(spark):
    rows = [(float(i % 10 < (9 if i % 2 else 1)), float(i % 2)) for i in range(4000)]
    p = {r.variable: r.p_value for r in MD.logit(spark.createDataFrame(rows, "y double, x double"), "y", ["x"])[0].collect()}
    assert 0 < p["x"] < 1e-100


def test_perfect_fit_and_constant_column(spark):
    from bazaar.operators.stats import zscore
    df = spark.createDataFrame([(2.0 * i + 1, float(i), 3.0) for i in range(30)], "y double, x double, c double")
    coefs, stats = MD.ols(df, "y", ["x"])
    assert {r.variable: round(r.coef, 9) for r in coefs.collect()} == {"Intercept": 1.0, "x": 2.0}
    assert stats.first().r2 == pytest.approx(1.0)
    assert all(r.c is None and r.x is not None for r in zscore(df, ["x", "c"]).collect())


def test_quantiles_never_rank_a_large_band(spark):
    v = np.concatenate([10.0 ** np.linspace(-30, 30, 300), [-1.7e308, 1.7e308, 5e-324, 0.0]])
    df = spark.createDataFrame([(float(a),) for a in v] + [(None,), (float("nan"),)], "v double")
    from bazaar.operators import quantiles as Q
    probs = [0.05, 0.5, 0.95]
    got = sorted((r.p, r.quantile) for r in Q.exact_quantiles(df, "v", probs, band_rows=10).collect())
    assert [q for _, q in got] == pytest.approx(list(np.quantile(v, probs)), rel=1e-12)


def test_samples_do_not_depend_on_partitioning(spark):
    from bazaar.operators.stats import sample_rows
    df = spark.range(5000).selectExpr("id", "id * 0.1 AS x")
    seen = {tuple(r.id for r in sample_rows(df.repartition(p), 50, ["id"], seed=3).collect()) for p in (1, 3, 8)}
    assert len(seen) == 1 and len(next(iter(seen))) == 50


def test_density_keeps_its_resolution_beside_an_outlier(spark):
    from bazaar.operators.stats import density
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=3000), [400.0]])
    rows = density(spark.createDataFrame([(float(a),) for a in v], "v double"), "v", grid_size=2000).collect()
    bw = v.std(ddof=1) * len(v) ** -0.2
    for r in rows[::97]:
        exact = np.exp(-0.5 * ((r.x - v) / bw) ** 2).sum() / (len(v) * bw * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(exact, abs=2e-4)
