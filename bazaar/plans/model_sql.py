"""Oracle SQL of the regression models, written out for DuckDB.

A linear system is solved by sweeping a symmetric matrix: sweeping pivot k turns
entry (k,k) into -1/d, (i,k) into a_ik/d and (i,j) into a_ij - a_ik a_jk / d, with
d = a_kk.  After all regressors are swept, row 0 (the target) holds the
coefficients, (0,0) the residual sum of squares, and the regressors' block minus
the inverse.  Tail probabilities are Simpson sums of the densities.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

Z975 = NormalDist().inv_cdf(0.975)
Z995 = NormalDist().inv_cdf(0.995)
STEPS = 2000    # Simpson intervals
SIMPSON = f"CASE WHEN i IN (0, {STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def entry(i: int, j: int) -> str:
    return f"a{min(i, j)}_{max(i, j)}"


def sweep(name: str, start: str, size: int, pivots: Sequence[int], carry: Sequence[str]) -> list[str]:
    """CTEs ``name_1 .. name_n`` that sweep the entries of the one-row CTE ``start``."""
    out, prev = [], start
    for step, k in enumerate(pivots, 1):
        d = entry(k, k)
        cols = []
        for i in range(size):
            for j in range(i, size):
                if i == k and j == k:
                    e = f"-1.0::DOUBLE / {d}"
                elif k in (i, j):
                    e = f"{entry(i, j)} / {d}"
                else:
                    e = f"{entry(i, j)} - {entry(i, k)} * {entry(j, k)} / {d}"
                cols.append(f"{e} AS {entry(i, j)}")
        out.append(f"{name}_{step} AS MATERIALIZED (SELECT {', '.join([*carry, *cols])} FROM {prev})")
        prev = f"{name}_{step}"
    return out


def ols_ctes(name: str, source: str, y: str, xs: Sequence[str], keep: Sequence[str] = ()) -> list[str]:
    """``name_d`` (y, x1.., kept columns; complete rows), and the one-row ``name``:
    n, b0.., v0.. (unscaled variances), rss, tss, s2."""
    k = len(xs)
    cols = ["y"] + [f"x{i}" for i in range(1, k + 1)]
    take = [f"({y})::DOUBLE AS y"] + [f"({x})::DOUBLE AS x{i}" for i, x in enumerate(xs, 1)] + list(keep)
    means = [f"avg({c}) AS m{i}" for i, c in enumerate(cols)]
    moments = [f"covar_pop({cols[i]}, {cols[j]}) * count(*) AS {entry(i, j)}" for i in range(k + 1) for j in range(i, k + 1)]
    carry = ["n", "tss"] + [f"m{i}" for i in range(k + 1)]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    ctes = [f"{name}_d AS MATERIALIZED (SELECT * FROM (SELECT {', '.join(take)} FROM ({source}) src) src2 WHERE {complete})",
            f"{name}_m AS MATERIALIZED (SELECT count(*)::DOUBLE AS n, var_pop(y) * count(*) AS tss, "
            f"{', '.join(means + moments)} FROM {name}_d)"]
    ctes += sweep(f"{name}_s", f"{name}_m", k + 1, range(1, k + 1), carry)
    betas = [f"{entry(0, i)} AS b{i}" for i in range(1, k + 1)]
    b0 = " - ".join(["m0"] + [f"{entry(0, i)} * m{i}" for i in range(1, k + 1)])
    quad = " + ".join(f"m{i} * m{j} * (-{entry(i, j)})" for i in range(1, k + 1) for j in range(1, k + 1))
    v = [f"-{entry(i, i)} AS v{i}" for i in range(1, k + 1)]
    ctes.append(f"{name} AS MATERIALIZED (SELECT n, tss, a0_0 AS rss, a0_0 / (n - {k + 1}) AS s2, n - {k + 1} AS df, "
                f"{b0} AS b0, 1.0 / n + {quad} AS v0, {', '.join(betas + v)} FROM {name}_s_{k})")
    return ctes


def ols_rows(name: str, xs: Sequence[str]) -> str:
    """(variable, coef, std_err, t, df) of a fitted ``name``."""
    return " UNION ALL ".join(
        f"SELECT '{v}' AS variable, b{i} AS coef, sqrt(s2 * v{i}) AS std_err, b{i} / sqrt(s2 * v{i}) AS t, df FROM {name}"
        for i, v in enumerate(["Intercept", *xs]))


def t_tail(rows: str) -> str:
    """Adds the two-sided ``p_value`` of Student's t to (..., t, df)."""
    # with t = sqrt(df) tan(u) the density is a power of cos(u); it is nil 40 deviations on
    lo = "atan(abs(t) / sqrt(df))"
    h = f"((least(1.5707963267948966, {lo} + 40 / sqrt(df)) - {lo}) / {STEPS})"
    return f"""SELECT r.* EXCLUDE (rid), 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) * q.s * {h} / 3 AS p_value
FROM (SELECT *, row_number() OVER () AS rid FROM ({rows}) r0) r
JOIN (SELECT rid, sum({SIMPSON} * pow(cos({lo} + i * {h}), df - 1)) AS s
      FROM (SELECT *, row_number() OVER () AS rid FROM ({rows}) r1), range({STEPS + 1}) g(i) GROUP BY rid) q USING (rid)"""


def normal_tail(z: str) -> str:
    """Two-sided normal tail of a column expression, as a correlated sum."""
    h = f"(12.0::DOUBLE / {STEPS})"
    return (f"(SELECT 2 / sqrt(2 * pi()) * sum({SIMPSON} * exp(-0.5 * pow(abs({z}) + i * {h}, 2))) * {h} / 3 "
            f"FROM range({STEPS + 1}) g(i))")


def t_quantile(z: float, df: str) -> str:
    """Student's quantile from the normal one, by its expansion in 1/df."""
    a, b, c = (z ** 3 + z) / 4, (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96, (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384
    return f"({z!r}::DOUBLE + {a!r} / {df} + {b!r} / pow({df}, 2) + {c!r} / pow({df}, 3))"


def f_tail(f: str, d1: str, d2: str) -> str:
    """Upper tail of the F distribution, as an integral of the beta density."""
    a, b = f"({d2} / 2.0)", f"({d1} / 2.0)"
    x = f"({d2} / ({d2} + {d1} * {f}))"
    lo = f"({x} * exp(-80 / {a}))"
    h = f"(({x} - {lo}) / {STEPS})"
    u = f"({lo} + i * {h})"
    return (f"(SELECT sum({SIMPSON} * exp(({a} - 1) * ln({u}) + ({b} - 1) * ln(1 - {u}) "
            f"+ lgamma({a} + {b}) - lgamma({a}) - lgamma({b}))) * {h} / 3 FROM range({STEPS + 1}) g(i))")


def zscored(source: str, columns: Sequence[str], keep: Sequence[str] = (), ddof: int = 1) -> str:
    sd = "stddev_samp" if ddof else "stddev_pop"
    cols = [f"({c} - avg({c}) OVER ()) / {sd}({c}) OVER () AS {c}" for c in columns]
    return f"SELECT {', '.join([*keep, *cols])} FROM ({source}) zsrc"


def logit_ctes(name: str, source: str, y: str, xs: Sequence[str], steps: int = 9) -> list[str]:
    """Newton steps for a logit: ``name_d`` and the one-row ``name`` with n, pos,
    b0.., v0.., deviance at the last but one coefficients (equal by then)."""
    k = len(xs)
    m = k + 1                                   # index m is the score
    take = [f"({y})::DOUBLE AS y", "1.0::DOUBLE AS x0"] + [f"({x})::DOUBLE AS x{i}" for i, x in enumerate(xs, 1)]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ["y"] + [f"x{i}" for i in range(1, k + 1)])
    ctes = [f"{name}_d AS MATERIALIZED (SELECT * FROM (SELECT {', '.join(take)} FROM ({source}) src) src2 WHERE {complete})",
            f"{name}_b0 AS MATERIALIZED (SELECT ln(avg(y) / (1 - avg(y))) AS b0, "
            + ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(1, k + 1)) + f" FROM {name}_d)"]
    eta = " + ".join(f"b{i} * x{i}" for i in range(m))
    for s in range(1, steps + 1):
        sums = [f"sum(p * (1 - p) * x{i} * x{j}) AS {entry(i, j)}" for i in range(m) for j in range(i, m)]
        sums += [f"sum((y - p) * x{i}) AS {entry(i, m)}" for i in range(m)] + [f"0.0::DOUBLE AS {entry(m, m)}"]
        bs = [f"any_value(b{i}) AS b{i}" for i in range(m)]
        dev = "2 * sum(greatest(eta, 0) + ln(1 + exp(-abs(eta))) - y * eta) AS deviance"
        ctes.append(f"{name}_e{s} AS MATERIALIZED (SELECT {', '.join(bs + [dev, 'count(*)::DOUBLE AS n', 'sum(y) AS pos'] + sums)} "
                    f"FROM (SELECT *, 1 / (1 + exp(-eta)) AS p FROM (SELECT *, {eta} AS eta FROM {name}_d, {name}_b{s - 1}) q0) q1)")
        ctes += sweep(f"{name}_w{s}", f"{name}_e{s}", m + 1, range(m), [f"b{i}" for i in range(m)] + ["deviance", "n", "pos"])
        ctes.append(f"{name}_b{s} AS MATERIALIZED (SELECT " + ", ".join(f"b{i} + {entry(i, m)} AS b{i}" for i in range(m))
                    + f" FROM {name}_w{s}_{m})")
    ctes.append(f"{name} AS MATERIALIZED (SELECT w.n, w.pos, w.deviance, " + ", ".join(f"b.b{i}" for i in range(m)) + ", "
                + ", ".join(f"-w.{entry(i, i)} AS v{i}" for i in range(m)) + f" FROM {name}_w{steps}_{m} w, {name}_b{steps} b)")
    return ctes


def with_ctes(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
