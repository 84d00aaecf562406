"""Linear and logistic regression with significance tables.

OLS is fitted from one distributed aggregation of means and (co)variances
(Spark's numerically stable online covariance), so only a (k+1) x (k+1)
matrix reaches the driver; coefficients, standard errors, t, p, confidence
intervals and fit statistics follow from it.  Logistic regression takes Newton
steps, each from one aggregation of the score and the information matrix.
Predictions and residuals are plain column expressions (codegen).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distributions import f_sf, norm_ppf, t_ppf, t_sf2
from ..session import cut_lineage
from .linalg import poisson_sums, triangular_factor

INTERCEPT = "Intercept"
COEF_SCHEMA = ("variable string, coef double, std_err double, t double, p_value double, "
               "ci_low double, ci_high double")


@dataclass
class OLSFit:
    variables: list[str]          # Intercept first
    coef: np.ndarray
    cov: np.ndarray
    n: int
    k: int                        # regressors without intercept
    rss: float
    tss: float

    @property
    def df_resid(self) -> float:
        return self.n - self.k - 1

    def predict(self, features: Sequence[str]) -> Column:
        e = F.lit(float(self.coef[0]))
        for name, b in zip(features, self.coef[1:]):
            e = e + F.col(name) * F.lit(float(b))
        return e


def _moments(df: DataFrame, y: str, xs: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    cols = [y, *xs]
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(F.covar_samp(a, cols[j]).alias(f"c{i}_{j}"))
    row = d.agg(*aggs).first()
    n = int(row["n"])
    p = len(cols)
    means = np.array([row[f"m{i}"] for i in range(p)], dtype=float)
    cov = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            v = row[f"c{i}_{j}"]
            cov[i, j] = cov[j, i] = float("nan") if v is None else v
    return n, means, cov


#: Condition number of the correlation matrix from which on products lose too many
#: digits and the fit is taken from a QR decomposition of the rows.
ILL_CONDITIONED = 1e6
#: Share of a standardized regressor that the others must leave unexplained.
COLLINEAR = 1e-10


def ols_fit(df: DataFrame, y: str, xs: Sequence[str]) -> OLSFit:
    """y ~ 1 + xs on the rows where all used columns are non-NULL.

    Moments are scaled to correlations before they are judged and inverted, so the
    units of the regressors don't matter.  Where regressors nearly explain each other,
    a second pass factors the standardized rows (TSQR)."""
    xs = list(xs)
    n, means, cov = _moments(df, y, xs)
    k = len(xs)
    if n <= k + 1:
        raise ValueError("not enough rows for the number of regressors")
    collinear = ValueError("regressors are exactly collinear; standard errors are undefined")
    sd = np.sqrt(np.diag(cov))
    if not np.all(sd[1:] > 0):
        raise collinear
    scale = np.where(sd > 0, sd, 1.0)
    corr = cov / np.outer(scale, scale)
    if k and np.linalg.cond(corr[1:, 1:]) > ILL_CONDITIONED:
        r = triangular_factor(df.select(*xs, y).na.drop(), [*xs, y], np.append(means[1:], means[0]),
                              np.append(scale[1:], scale[0]))
        if np.min(np.abs(np.diag(r)[:k])) < COLLINEAR * math.sqrt(n):
            raise collinear
        back = np.linalg.inv(r[:k, :k])
        b, unexplained = back @ r[:k, k], float(r[k, k] ** 2) if len(r) > k else 0.0
        inv = back @ back.T
    else:
        inv = np.linalg.inv(corr[1:, 1:]) / (n - 1) if k else np.zeros((0, 0))
        b = inv @ corr[1:, 0] * (n - 1)
        unexplained = max((corr[0, 0] - b @ corr[1:, 0]) * (n - 1), 0.0)
    inv = inv / np.outer(sd[1:], sd[1:])
    beta, rss, tss = b * scale[0] / sd[1:], unexplained * scale[0] ** 2, cov[0, 0] * (n - 1)
    s2 = rss / (n - k - 1)
    xbar = means[1:]
    cov_b = np.zeros((k + 1, k + 1))
    cov_b[1:, 1:] = s2 * inv
    cov_b[0, 1:] = cov_b[1:, 0] = -s2 * (inv @ xbar)
    cov_b[0, 0] = s2 * (1.0 / n + xbar @ inv @ xbar)
    return OLSFit([INTERCEPT, *xs], np.concatenate([[means[0] - xbar @ beta], beta]), cov_b, n, k, rss, tss)


def coef_table(spark, names, coef, se, stat, p, crit) -> DataFrame:
    rows = [(str(nm), float(b), float(s), float(t), float(pp), float(b - crit * s), float(b + crit * s))
            for nm, b, s, t, pp in zip(names, coef, se, stat, p)]
    return spark.createDataFrame(rows, COEF_SCHEMA)


def ols(df: DataFrame, y: str, xs: Sequence[str], alpha: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """-> (coefficients, fit statistics) DataFrames, statsmodels-style."""
    f = ols_fit(df, y, xs)
    se = np.sqrt(np.diag(f.cov))
    # a perfect fit has no error: its t values are infinite
    t = [float(b / s) if s > 0 else math.copysign(math.inf, b) if b else math.nan for b, s in zip(f.coef, se)]
    dfr = f.df_resid
    p = [t_sf2(v, dfr) for v in t]
    crit = t_ppf(1 - alpha / 2, dfr)
    coefs = coef_table(df.sparkSession, f.variables, f.coef, se, t, p, crit)
    r2 = 1 - f.rss / f.tss if f.tss > 0 else float("nan")
    adj = 1 - (1 - r2) * (f.n - 1) / dfr
    fstat = (r2 / f.k) / ((1 - r2) / dfr) if r2 < 1 else float("inf")
    ll = -f.n / 2 * (math.log(2 * math.pi) + math.log(f.rss / f.n) + 1) if f.rss > 0 else math.inf
    stats = df.sparkSession.createDataFrame(
        [tuple(float(v) if i > 1 else int(v) for i, v in enumerate(
            (f.n, f.k, r2, adj, fstat, f_sf(fstat, f.k, dfr), ll, -2 * ll + 2 * (f.k + 1),
             -2 * ll + (f.k + 1) * math.log(f.n), math.sqrt(f.rss / f.n))))],
        "n long, k long, r2 double, adj_r2 double, f_stat double, f_pvalue double, "
        "log_likelihood double, aic double, bic double, rmse double")
    return coefs, stats


def significant_coefs(coefs: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Regressors with p < alpha, largest coefficient first (no intercept)."""
    return coefs.filter((F.col("p_value") < alpha) & (F.col("variable") != INTERCEPT)).select("variable", "p_value", "coef").orderBy(F.desc("coef"))


def with_prediction(df: DataFrame, y: str, xs: Sequence[str], fit: OLSFit | None = None) -> DataFrame:
    """Adds ``fitted`` and ``residual`` (= fitted - actual, the sign the source uses)."""
    fit = fit or ols_fit(df, y, xs)
    pred = fit.predict(xs)
    return df.withColumn("fitted", pred).withColumn("residual", F.col("fitted") - F.col(y))


def rmse(df: DataFrame, residual: str = "residual") -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.col(residual) * F.col(residual))).alias("rmse"))


def design_matrix(df: DataFrame, xs: Sequence[str]) -> DataFrame:
    """Model matrix with an explicit constant column (statsmodels ``add_constant``)."""
    return df.select(F.lit(1.0).alias("constant"), *[F.col(c).cast("double").alias(c) for c in xs])


#: Levels that one category of a formula may have.
MAX_LEVELS = 200


def _terms(formula: str) -> tuple[bool, list[list[str]]]:
    """(intercept, terms as lists of factors) of ``1 + a + C(b) + a:C(b) + a*c``; ``0`` or
    ``-1`` leaves the intercept out, ``a*b`` stands for ``a + b + a:b``."""
    intercept, terms = True, []
    for part in formula.replace("-", "+-").split("+"):
        part = part.strip().replace(" ", "")
        if part in ("", "1"):
            continue
        if part in ("0", "-1"):
            intercept = False
            continue
        if part.startswith("-"):
            raise ValueError(f"only the intercept can be left out, not {part[1:]!r}")
        stars = part.split("*")
        for size in range(1, len(stars) + 1):
            for some in combinations(stars, size):
                term = [f for s in some for f in s.split(":")]
                if term not in terms:
                    terms.append(term)
    return intercept, sorted(terms, key=len)


def formula_matrix(df: DataFrame, formula: str, keep: Sequence[str] = (), max_levels: int = MAX_LEVELS) -> DataFrame:
    """Model matrix of a right-hand side such as ``wait_time + C(state) + price:C(state)``.

    Numeric columns are taken as they are, ``C(column)`` (and any string or boolean
    column) as a category: one 0/1 column ``column[T.level]`` per level but the least.
    Without an intercept the first category keeps all its levels.  A category that
    interacts with a numeric column without that column being a term of its own keeps
    all its levels there.  Levels come from one distinct job for all categories; more
    than ``max_levels`` raise an error.  Rows with a null in a used column are left out.
    ``keep`` names columns to carry along in front."""
    intercept, terms = _terms(formula)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def column(factor: str) -> tuple[str, bool]:
        name = factor[2:-1] if factor.startswith("C(") and factor.endswith(")") else factor
        if name not in kinds:
            raise ValueError(f"no column {name!r}")
        return name, name != factor or not isinstance(kinds[name], T.NumericType)

    factors = dict.fromkeys(f for t in terms for f in t)
    used = list(dict.fromkeys(column(f)[0] for f in factors))
    rows = df.select(*keep, *[c for c in used if c not in keep]).na.drop(subset=used) if used else df.select(*keep)
    categories = list(dict.fromkeys(column(f)[0] for f in factors if column(f)[1]))
    levels: dict[str, list] = {c: [] for c in categories}
    if categories:
        pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                                for c in categories])).alias("x")).select("x.*").distinct()
        # at most one level more than allowed of each category reaches the driver
        few = pairs.withColumn("k", F.row_number().over(Window.partitionBy("c").orderBy("v"))).filter(F.col("k") <= max_levels + 1)
        for r in few.orderBy("c", "k").collect():
            levels[r.c].append(r.v)
        for c, found in levels.items():
            if len(found) > max_levels:
                raise ValueError(f"category {c!r} has more than {max_levels} levels")
            if isinstance(kinds[c], T.NumericType):
                found.sort(key=float)

    def coded(factor: str, full: bool) -> list[tuple[str, Column]]:
        name, category = column(factor)
        if not category:
            return [(name, F.col(name).cast("double"))]
        return [(f"{name}[{'' if full else 'T.'}{v}]", (F.col(name).cast("string") == F.lit(v)).cast("double"))
                for v in levels[name][0 if full else 1:]]

    out: list[tuple[str, Column]] = [("Intercept", F.lit(1.0))] if intercept else []
    spanned = intercept
    for term in terms:
        products: list[tuple[str, Column]] = [("", F.lit(1.0))]
        for f in term:
            others = [g for g in term if g != f]
            # all levels are wanted where the term without the category isn't in the model
            margin = others in terms if others else spanned
            full = column(f)[1] and not margin
            products = [(f"{a}:{b}" if a else b, x * y) for a, x in products for b, y in coded(f, full)]
        if len(term) == 1 and column(term[0])[1]:
            spanned = True
        out += products
    return rows.select(*keep, *[x.alias(name) for name, x in out])


def vif(df: DataFrame, xs: Sequence[str]) -> DataFrame:
    """Variance inflation factors of standardized regressors = diagonal of the
    inverse correlation matrix (one aggregation, k x k on the driver)."""
    xs = list(xs)
    n, means, cov = _moments(df, xs[0], xs[1:]) if len(xs) > 1 else (0, None, None)
    if cov is None:
        return df.sparkSession.createDataFrame([(xs[0], 1.0)], "variable string, vif double")
    sd = np.sqrt(np.diag(cov))
    corr = cov / np.outer(sd, sd)
    v = np.diag(np.linalg.inv(corr))
    return df.sparkSession.createDataFrame([(x, float(val)) for x, val in zip(xs, v)],
                                           "variable string, vif double")


LOGIT_SCHEMA = COEF_SCHEMA + ", converged boolean"
LOGIT_FIT_SCHEMA = ("n long, k long, pseudo_r2 double, deviance double, null_deviance double, aic double, "
                    "iterations int, converged boolean")


@dataclass
class LogitFit:
    variables: list[str]
    n: int
    positives: int
    coef: np.ndarray | None       # None: no maximum exists, or it wasn't reached
    cov: np.ndarray | None
    deviance: float
    iterations: int

    @property
    def converged(self) -> bool:
        return self.coef is not None


def _score_and_information(d: DataFrame, y: str, xs: Sequence[str], beta: np.ndarray):
    """Deviance, score vector and information matrix at ``beta``, one aggregation."""
    eta = F.lit(float(beta[0]))
    for x, b in zip(xs, beta[1:]):
        eta = eta + F.col(x) * F.lit(float(b))
    d = d.select(F.col(y).alias("y"), F.lit(1.0).alias("x0"), *[F.col(x).alias(f"x{i}") for i, x in enumerate(xs, 1)],
                 eta.alias("eta"))
    d = d.withColumn("p", 1 / (1 + F.exp(-F.col("eta")))).withColumn("w", F.col("p") * (1 - F.col("p")))
    m = len(xs) + 1
    # log(1 + exp(eta)), without overflow
    softplus = F.greatest(F.col("eta"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("eta")))
    aggs = [(2 * F.sum(softplus - F.col("y") * F.col("eta"))).alias("deviance")]
    aggs += [F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")).alias(f"s{i}") for i in range(m)]
    aggs += [F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"i{i}_{j}") for i in range(m) for j in range(i, m)]
    row = d.agg(*aggs).first()
    info = np.array([[row[f"i{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)], float)
    return float(row["deviance"]), np.array([row[f"s{i}"] for i in range(m)], float), info


def logit_fit(df: DataFrame, y: str, xs: Sequence[str], max_iter: int = 25, tol: float = 1e-9) -> LogitFit:
    """Binary logit y ~ 1 + xs on complete rows, by Newton steps.

    Under (quasi-)separation the likelihood has no maximum: steps don't shrink or
    the information matrix loses rank.  Both are reported as not converged."""
    xs = list(xs)
    d = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in (y, *xs)]).na.drop())
    head = d.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos")).first()
    n, pos = int(head["n"]), int(head["pos"] or 0)
    names = [INTERCEPT, *xs]
    if pos in (0, n):
        return LogitFit(names, n, pos, None, None, math.nan, 0)
    beta = np.zeros(len(names))
    beta[0] = math.log(pos / (n - pos))
    for step in range(1, max_iter + 1):
        deviance, score, info = _score_and_information(d, y, xs, beta)
        scale = np.sqrt(np.maximum(np.diag(info), 0.0))
        if not np.all(scale > 0) or np.linalg.cond(info / np.outer(scale, scale)) > 1e12:
            break
        move = np.linalg.solve(info, score)
        if np.max(np.abs(move) / (1 + np.abs(beta))) < tol:
            return LogitFit(names, n, pos, beta + move, np.linalg.inv(info), deviance, step)
        beta = beta + move
    return LogitFit(names, n, pos, None, None, math.nan, step)


def logit(df: DataFrame, y: str, xs: Sequence[str], alpha: float = 0.05,
          max_iter: int = 25) -> tuple[DataFrame, DataFrame]:
    """-> (coefficients with z and p, fit statistics).  Where no estimate exists
    ``converged`` is false and every estimate is NULL."""
    f = logit_fit(df, y, xs, max_iter)
    spark, k = df.sparkSession, len(list(xs))
    if not f.converged:
        rows = [(v, *[None] * 6, False) for v in f.variables]
        return (spark.createDataFrame(rows, LOGIT_SCHEMA),
                spark.createDataFrame([(f.n, k, None, None, None, None, f.iterations, False)], LOGIT_FIT_SCHEMA))
    se = np.sqrt(np.diag(f.cov))
    crit = norm_ppf(1 - alpha / 2)
    rows = [(v, float(b), float(s), float(b / s), math.erfc(abs(b / s) / math.sqrt(2)), float(b - crit * s),
             float(b + crit * s), True) for v, b, s in zip(f.variables, f.coef, se)]
    share = f.positives / f.n
    null_deviance = -2 * (f.positives * math.log(share) + (f.n - f.positives) * math.log1p(-share))
    fit = (f.n, k, 1 - f.deviance / null_deviance, f.deviance, null_deviance, f.deviance + 2 * (k + 1), f.iterations, True)
    return spark.createDataFrame(rows, LOGIT_SCHEMA), spark.createDataFrame([fit], LOGIT_FIT_SCHEMA)


def coef_compare(linear: DataFrame, logistic: DataFrame) -> DataFrame:
    """Side-by-side linear vs logit coefficients (without the intercept), by linear coefficient."""
    a = linear.filter(F.col("variable") != INTERCEPT).select("variable", F.col("coef").alias("linear_coef"))
    b = logistic.filter(F.col("variable") != INTERCEPT).select("variable", F.col("coef").alias("logit_coef"))
    return a.join(b, "variable", "full").orderBy(F.desc("linear_coef"))


def partial_regression(df: DataFrame, y: str, xs: Sequence[str], focus: str) -> DataFrame:
    """Added-variable data for ``focus``: residual of y on the other regressors
    vs residual of ``focus`` on them (Frisch-Waugh-Lovell: the slope through
    these points equals the full-model coefficient)."""
    others = [x for x in xs if x != focus]
    d = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in (y, *xs)]).na.drop())
    fy, fx = ols_fit(d, y, others), ols_fit(d, focus, others)
    return d.select((F.col(focus) - fx.predict(others)).alias("res_x"),
                    (F.col(y) - fy.predict(others)).alias("res_y"))


def partial_regressions(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Added-variable data of every regressor: (variable, res_x, res_y)."""
    d = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in (y, *xs)]).na.drop())
    out = []
    for focus in xs:
        others = [x for x in xs if x != focus]
        fy, fx = ols_fit(d, y, others), ols_fit(d, focus, others)
        out += [F.struct(F.lit(focus).alias("variable"), (F.col(focus) - fx.predict(others)).alias("res_x"),
                         (F.col(y) - fy.predict(others)).alias("res_y"))]
    return d.select(F.inline(F.array(*out)))


def residual_vs_fitted(df: DataFrame, y: str, xs: Sequence[str], bins: int = 50) -> DataFrame:
    """2-D binned (fitted, residual) counts: the scatter data at any scale."""
    p = with_prediction(cut_lineage(df.select(y, *xs).na.drop()), y, xs)
    b = p.agg(F.min("fitted").alias("f0"), F.max("fitted").alias("f1"),
              F.min("residual").alias("r0"), F.max("residual").alias("r1")).first()

    def binc(c, lo, hi):
        w = (hi - lo) / bins if hi > lo else 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    return (p.groupBy(binc("fitted", b.f0, b.f1).alias("fitted_bin"), binc("residual", b.r0, b.r1).alias("residual_bin"))
            .agg(F.count(F.lit(1)).alias("count"), F.avg("fitted").alias("fitted_mean"),
                 F.avg("residual").alias("residual_mean")))


def bootstrap_line(df: DataFrame, x: str, y: str, key: Sequence[str], replicates: int = 1000, grid: int = 100,
                   level: float = 0.95, seed: int = 42) -> DataFrame:
    """Fitted line with its bootstrapped confidence band on a grid over [min x, max x]:
    (x, fit, ci_low, ci_high), the percentiles of the replicates' lines.

    Poisson bootstrap: in each replicate a row counts as often as a draw from Poisson(1)
    says, so replicates need no resampling and all of them are sums of one pass.  The
    draws follow from a hash of the row's ``key`` and the seed, not from its place, so
    the band is the same for any partitioning; equal keys draw alike.  A task keeps
    five sums per replicate; replicates that draw fewer than two different x have no
    line and are left out.  Without three rows or two different x there are no rows."""
    names = dict.fromkeys(key)
    d = df.select(F.xxhash64(*[F.col(c) for c in names], F.lit(seed)).alias("h"),
                  F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    d = cut_lineage(d)
    head = d.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("x").alias("mx"),
                 F.avg("y").alias("my"), F.regr_slope("y", "x").alias("b")).first()
    schema = "x double, fit double, ci_low double, ci_high double"
    if head.n < 3 or head.lo == head.hi:
        return df.sparkSession.createDataFrame([], schema)
    sums = poisson_sums(d, replicates, head.mx, head.my)
    w, wx, wy, wxx, wxy = sums
    with np.errstate(all="ignore"):
        slope = (wxy - wx * wy / w) / (wxx - wx * wx / w)
        offset = wy / w - slope * wx / w
    good = np.isfinite(slope) & (wxx - wx * wx / w > 1e-12 * np.maximum(wxx, 1e-300))
    points = np.linspace(head.lo, head.hi, grid)
    lines = head.my + offset[good, None] + slope[good, None] * (points - head.mx)
    low, high = np.quantile(lines, [0.5 - level / 2, 0.5 + level / 2], axis=0)
    fit = head.my + head.b * (points - head.mx)
    rows = list(zip(points.tolist(), fit.tolist(), low.tolist(), high.tolist()))
    return df.sparkSession.createDataFrame(rows, schema)


def regplot_line(df: DataFrame, x: str, y: str, grid: int = 100, level: float = 0.95) -> DataFrame:
    """Fitted line y = a + b x with its confidence band on a grid over [min x, max x]."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    r = d.agg(F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a"),
              F.regr_count("y", "x").alias("n"), F.regr_sxx("y", "x").alias("sxx"),
              F.regr_syy("y", "x").alias("syy"), F.regr_sxy("y", "x").alias("sxy"),
              F.regr_avgx("y", "x").alias("mx"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    n = int(r.n)
    if n < 3 or not r.sxx:                 # no line, or no error to base a band on
        return df.sparkSession.createDataFrame([], "x double, fit double, ci_low double, ci_high double")
    s = math.sqrt(max(r.syy - r.b * r.sxy, 0.0) / (n - 2))
    tcrit = t_ppf(0.5 + level / 2, n - 2)
    step = (r.hi - r.lo) / (grid - 1)
    g = df.sparkSession.range(grid).select((F.lit(r.lo) + F.col("id") * F.lit(step)).alias("x"))
    fit = F.lit(r.a) + F.lit(r.b) * F.col("x")
    half = F.lit(tcrit * s) * F.sqrt(F.lit(1.0 / n) + F.pow(F.col("x") - F.lit(r.mx), 2) / F.lit(r.sxx))
    return g.select("x", fit.alias("fit"), (fit - half).alias("ci_low"), (fit + half).alias("ci_high"))
