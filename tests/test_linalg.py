"""Matrix sums and QR against numpy; fits of badly scaled and nearly collinear designs."""
import math

import numpy as np
import pytest

from bazaar.operators import linalg, models, stats


def frame(spark, x, parts=5):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [[None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v) for v in r] for r in x.tolist()]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts), names


def pairwise(x):
    k = x.shape[1]
    out = {}
    for i in range(k):
        for j in range(i + 1, k):
            ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[ok, i], x[ok, j]
            out[i, j] = None if len(a) < 2 else np.nan if np.ptp(a) == 0 or np.ptp(b) == 0 else np.corrcoef(a, b)[0, 1]
    return out


@pytest.mark.parametrize("columns", [3, 150])
def test_correlations(spark, columns, monkeypatch):
    monkeypatch.setattr(linalg, "FAN_IN", 2)
    rng = np.random.default_rng(columns)
    x = rng.normal(size=(400, columns)) @ rng.normal(size=(columns, columns)) + rng.normal(size=columns) * 1e4
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 0] = np.where(np.isnan(x[:, 0]), np.nan, 0.1)         # constant
    x[:-1, 1] = np.nan                                          # one row only
    df, names = frame(spark, x)
    got = stats.corr_matrix(df, names).collect()
    want = pairwise(x)
    assert len(got) == columns * (columns - 1) // 2
    for r in got:
        w = want[int(r.variable_a[1:]), int(r.variable_b[1:])]
        if w is None or math.isnan(w):
            assert r.corr is None if w is None else math.isnan(r.corr)
        else:
            assert abs(r.corr - w) < 1e-9


def test_no_rows(spark):
    df, names = frame(spark, np.ones((4, 3)))
    assert [r.corr for r in stats.corr_matrix(df.limit(0), names).collect()] == [None] * 3


def lstsq(x, y):
    a = np.column_stack([np.ones(len(x)), x])
    mean, sd = x.mean(0), x.std(0)
    b, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(x)), (x - mean) / sd]), y, rcond=None)
    beta = b[1:] / sd
    return np.concatenate([[b[0] - mean @ beta], beta]), a


@pytest.mark.parametrize("scales", [(1e9, 1e-3, 1.0), (1e-8, 1e12, 1e3)])
def test_units_do_not_matter(spark, scales):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * scales + np.array(scales) * 3
    y = x @ (np.array([1.0, -2.0, .5]) / scales) + 4 + rng.normal(size=500)
    df, names = frame(spark, np.column_stack([x, y]))
    fit = models.ols_fit(df, names[3], names[:3])
    want, a = lstsq(x, y)
    assert np.allclose(fit.coef, want, rtol=1e-8)
    s2 = ((y - a @ want) ** 2).sum() / (500 - 4)
    z = (x - x.mean(0)) / x.std(0)
    se = np.sqrt(s2 * np.diag(np.linalg.inv(z.T @ z))) / x.std(0)
    assert np.allclose(np.sqrt(np.diag(fit.cov))[1:], se, rtol=1e-7)


def test_nearly_collinear_by_qr(spark):
    """A condition number near 1e12: the products alone keep no digit of the small one."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=2000)
    x = np.column_stack([base, base + 1e-6 * rng.normal(size=2000), rng.normal(size=2000)])
    y = x @ [1.0, 2.0, 3.0] + 1e-7 * rng.normal(size=2000)
    df, names = frame(spark, np.column_stack([x, y]), 7)
    fit = models.ols_fit(df, names[3], names[:3])
    want, _ = lstsq(x, y)
    assert np.allclose(fit.coef, want, rtol=1e-5, atol=1e-8)
    assert abs(fit.coef[1] - 1) < .1 and abs(fit.coef[2] - 2) < .1


def test_collinear_raises(spark):
    x = np.random.default_rng(3).normal(size=(50, 2))
    df, names = frame(spark, np.column_stack([x, x.sum(1), x[:, 0]]))
    with pytest.raises(ValueError, match="collinear"):
        models.ols_fit(df, names[3], names[:3])
    with pytest.raises(ValueError, match="collinear"):
        models.ols_fit(frame(spark, np.column_stack([np.ones(20), np.arange(20.)]))[0], "x1", ["x0"])


def test_regplot_without_a_line(spark):
    for rows in ([(1.0, 2.0)] * 2, [(1.0, 2.0), (1.0, 3.0), (1.0, 5.0), (None, 1.0)], []):
        df = spark.createDataFrame(rows, "x double, y double")
        assert models.regplot_line(df, "x", "y").collect() == []
