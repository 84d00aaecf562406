"""Descriptive statistics, profiling, correlation, histograms, densities,
Q-Q data and sampling.

Every statistic is a distributed aggregation; only fixed-size results
(k x k correlations, B bucket counts, a probability grid) reach the driver.
Multi-column statistics run on the long (variable, value) form so one
``groupBy(variable)`` serves all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distributions import norm_ppf
from ..functions.exprs import round_half_even
from ..session import cut_lineage, store_columns
from .linalg import correlations
from .quantiles import exact_quantiles, quantile_columns
from .sketches import column_sketches, sketch_describe, sketch_profile

QUARTILES = (0.25, 0.5, 0.75)


def select_numeric(df: DataFrame) -> list[str]:
    """Names of numeric (non-boolean) columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "variable", "value")


def describe_table(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """``DataFrame.describe()``: (variable, count, mean, std, min, q25, q50,
    q75, max); std with ddof=1, quartiles exact with linear interpolation.

    ``exact=False`` reads the source once and takes quartiles from KLL sketches: values
    of the data whose rank is within the stated error."""
    columns = list(columns or select_numeric(df))
    if not exact:
        return sketch_describe(column_sketches(df, columns))
    # several passes read the columns: the job that makes them runs once
    long = _long(cut_lineage(df.select(*columns)), columns)
    base = long.groupBy("variable").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", QUARTILES, by=["variable"], stored=True)
    qw = q.groupBy("variable").pivot("p", list(QUARTILES)).agg(F.first("quantile"))
    qw = qw.select("variable", *[F.col(f"`{p}`").alias(f"q{int(p * 100)}") for p in QUARTILES])
    return base.join(qw, "variable", "left").select(
        "variable", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def medians(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """(variable, median) for the numeric columns; ``exact=False`` as in ``describe_table``."""
    columns = list(columns or select_numeric(df))
    if not exact:
        return sketch_describe(column_sketches(df, columns), probs=[0.5]).select("variable", F.col("q50").alias("median"))
    return quantile_columns(df, columns, [0.5]).select("variable", F.col("quantile").alias("median"))


def schema_info(df: DataFrame) -> DataFrame:
    """``DataFrame.info()``: (column, dtype, non_null)."""
    wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[x for f in df.schema.fields
                           for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return (wide.unpivot([], df.columns, "column", "non_null")
            .select("column", types[F.col("column")].alias("dtype"), "non_null"))


def profile_table(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Column profile: dtype, rows, nulls, distinct values, zeros, min, max,
    mean, std, quartiles (numeric only) and the most frequent value.

    ``exact=False`` reads the source once and estimates distinct values, quartiles and
    top values by sketches, with the errors stated in ``sketches``."""
    columns = list(columns or df.columns)
    if not exact:
        return sketch_profile(column_sketches(df, columns))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [isinstance(kinds[c], T.NumericType) for c in columns]
    # several passes read the columns, each only those it needs: the job that makes them runs once
    stored = store_columns(df.select(*[_value_key(c, kinds[c]).alias(f"c{i}") for i, c in enumerate(columns)]))
    none = F.lit(None).cast("double")
    aggs, rows, tops = [F.count(F.lit(1)).alias("n_rows")], [], None
    for i, c in enumerate(columns):
        d = F.col(f"c{i}").cast("double")
        stats = {"n_null": F.count_if(F.col(f"c{i}").isNull())}
        if numeric[i]:
            stats |= {"n_zeros": F.count_if(d == 0), "min": F.min(d), "max": F.max(d), "mean": F.avg(d), "std": F.stddev_samp(d)}
        aggs += [x.alias(f"{name}_{i}") for name, x in stats.items()]
        rows.append(F.struct(
            F.lit(i).alias("i"), F.col("n_rows"), F.col(f"n_null_{i}").alias("n_null"),
            (F.col(f"n_zeros_{i}") if numeric[i] else F.lit(0).cast("long")).alias("n_zeros"),
            *[(F.col(f"{x}_{i}") if numeric[i] else none).alias(x) for x in ("min", "max", "mean", "std")]))
        top = _top_value(stored.select(F.col(f"c{i}").alias("v")), numeric[i]).select(F.lit(i).alias("i"), "*")
        tops = top if tops is None else tops.unionByName(top)
    base = stored.agg(*aggs).filter("n_rows > 0").select(F.inline(F.array(*rows)))
    out = base.join(tops, "i", "left")
    if any(numeric):
        # numbered columns: integer keys make the joins of each pass cheap
        at = [i for i in range(len(columns)) if numeric[i]]
        long = stored.select(F.posexplode(F.array(*[F.col(f"c{i}").cast("double") for i in at])).alias("k", "value"))
        q = exact_quantiles(long, "value", QUARTILES, by=["k"], stored=True)
        qw = q.groupBy("k").pivot("p", list(QUARTILES)).agg(F.first("quantile"))
        qw = qw.select(F.array(*map(F.lit, at))[F.col("k")].alias("i"),
                       *[F.col(f"`{p}`").alias(f"q{int(p * 100)}") for p in QUARTILES])
        out = out.join(qw, "i", "left")
    else:
        out = out.select("*", *[none.alias(f"q{int(p * 100)}") for p in QUARTILES])
    names = F.array(*[F.struct(F.lit(c).alias("variable"), F.lit(kinds[c].simpleString()).alias("dtype")) for c in columns])
    return out.select(names[F.col("i")]["variable"].alias("variable"), names[F.col("i")]["dtype"].alias("dtype"), "n_rows",
                      "n_null", "n_distinct", "n_zeros", "min", "max", "mean", "std", "q25", "q50", "q75",
                      "top_value", "top_count")


#: Types whose values are told apart, and stored, as they are; others as strings.
_PLAIN = (T.IntegralType, T.FractionalType, T.DateType, T.TimestampNTZType, T.BooleanType)


def _value_key(c: str, kind: T.DataType) -> Column:
    return F.col(c) if isinstance(kind, _PLAIN) else F.col(c).cast("string")


def _top_value(values: DataFrame, number: bool) -> DataFrame:
    """(n_distinct, top_value, top_count) of column ``v``: each distinct value is sent
    once per task, with its count.  Of equally frequent values the largest is the top
    one, as a number where it is one."""
    s, d = F.col("v").cast("string"), (F.col("v").cast("double") if number else F.lit(None).cast("double"))
    keys = [F.col("v")]
    if isinstance(values.schema["v"].dataType, (T.FloatType, T.DoubleType)):
        keys.append(F.when((F.col("v") == 0) & (s == "-0.0"), True).alias("minus"))      # 0.0 and -0.0 are two values
        s = F.when(F.col("minus"), F.lit("-0.0")).otherwise(s)
    counts = values.filter("v IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).select(s.alias("s"), d.alias("d"), "c")
    return (counts.agg(F.count(F.lit(1)).alias("n_distinct"), F.max_by(F.struct("s", "c"), F.struct("c", "d", "s")).alias("t"))
            .select("n_distinct", F.col("t.s").alias("top_value"), F.col("t.c").alias("top_count")))


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair a < b (pairwise complete rows), by one pass of
    matrix sums over all columns -> long form (variable_a, variable_b, corr).  NULL
    without two common rows, NaN where a column doesn't vary over them."""
    columns = list(columns or select_numeric(df))
    r = correlations(df, columns)
    rows = [(a, columns[j], None if np.isinf(r[i, j]) else float(r[i, j]))
            for i, a in enumerate(columns) for j in range(i + 1, len(columns))]
    return df.sparkSession.createDataFrame(rows, "variable_a string, variable_b string, corr double")


def corr_with_target(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                     digits: int = 2) -> DataFrame:
    """corr(target, x) for each column, with |corr| rounded for display,
    strongest first."""
    columns = [c for c in (columns or select_numeric(df)) if c != target]
    wide = df.agg(*[F.corr(F.col(target).cast("double"), F.col(c).cast("double")).alias(c) for c in columns])
    long = wide.unpivot([], columns, "variable", "corr")
    return (long.select("variable", "corr", round_half_even(F.abs("corr"), digits).alias("abs_corr"))
            .orderBy(F.desc("abs_corr"), F.asc("variable")))


def scalars(agg: DataFrame) -> dict[str, "F.Column"]:
    """Columns of a 1-row aggregate as ONE struct-valued scalar subquery
    (identical subqueries are reused, so the aggregate runs once)."""
    sub = agg.select(F.struct(*agg.columns).alias("s")).scalar()
    return {c: sub.getField(c) for c in agg.columns}


def zscore(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """Standardize columns: (x - mean) / std with ``ddof`` 0 (scipy) or 1
    (pandas); a constant column gives NULL.  Means and stds are one aggregation used as a scalar subquery."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    st = scalars(df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[sd(c).alias(f"s_{c}") for c in columns]))
    return df.withColumns({c: F.try_divide(F.col(c) - st[f"m_{c}"], st[f"s_{c}"]) for c in columns})


def _bins(x, lo, hi, bins: int):
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(F.floor((x - lo) / width))
    return F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 10, by: str | None = None) -> DataFrame:
    """Equal-width histogram from min to max (last bin closed), every bin
    emitted: ([by], bin, bin_lo, bin_hi, count).  Per group when ``by``."""
    keys = [by] if by else []
    x = F.col(column).cast("double")
    d = cut_lineage(df.select(*keys, x.alias("x")).filter(F.col("x").isNotNull()))
    b = scalars(d.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    lo, hi = b["lo"], b["hi"]
    counts = cut_lineage(d.groupBy(*keys, _bins(F.col("x"), lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = (counts.select(*keys).distinct() if keys else counts.limit(1).select()).select(
        *keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (hi - lo) / bins
    return (grid.join(counts, keys + ["bin"], "left")
            .select(*keys, "bin", (lo + F.col("bin") * width).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def histograms(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """Equal-width histograms of several columns (all numeric ones by default) in
    one long-form job, every bin emitted: (variable, bin, bin_lo, bin_hi, count)."""
    columns = list(columns or select_numeric(df))
    d = _long(cut_lineage(df.select(*columns)), columns).filter(F.col("value").isNotNull())
    ends = d.groupBy("variable").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    counts = (d.join(ends, "variable").groupBy("variable", _bins(F.col("value"), lo, hi, bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    grid = ends.select("variable", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (hi - lo) / bins
    return grid.join(counts, ["variable", "bin"], "left").select(
        "variable", "bin", (lo + F.col("bin") * width).alias("bin_lo"), (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def density(df: DataFrame, column: str, by: str | None = None, grid_size: int = 200,
            bins_per_bandwidth: int = 8, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth, seaborn grid) -> ([by], x, density).

    Data are pre-binned (one groupBy) into bins of an eighth of the group's own
    bandwidth, so the error stays below 1/512 of the kernel's curvature however
    many rows or outliers there are, and the kernel sum runs over occupied bins x
    grid points, never over rows x grid.  A group without spread has no density."""
    keys = [by] if by else []
    x = F.col(column).cast("double")
    d = df.select(*keys, x.alias("x")).filter(F.col("x").isNotNull())
    st = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                              F.min("x").alias("lo"), F.max("x").alias("hi"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    st = st.filter(F.col("bw") > 0)
    width = F.col("bw") / F.lit(float(bins_per_bandwidth))
    # The per-group statistics are one row per group; without groups they
    # are a single row attached as scalar subqueries.
    joined = d.join(st, keys, "inner") if keys else _with_scalars(d, st)
    b = F.floor((F.col("x") - F.col("lo")) / width)
    bins_df = (joined.groupBy(*keys, b.alias("b"), "lo", "hi", "bw", "n")
               .agg(F.count(F.lit(1)).alias("c"))
               .withColumn("center", F.col("lo") + (F.col("b") + 0.5) * width))
    g0 = F.col("lo") - cut * F.col("bw")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / (grid_size - 1)
    pts = bins_df.select(*keys, "c", "center", "bw", "n", g0.alias("g0"), step.alias("step"),
                         F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("i"))
    gx = F.col("g0") + F.col("i") * F.col("step")
    z = (gx - F.col("center")) / F.col("bw")
    k = F.col("c") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5))
    return (pts.groupBy(*keys, "i", gx.alias("x")).agg(F.sum(k).alias("density"))
            .drop("i"))


def _with_scalars(d: DataFrame, st: DataFrame) -> DataFrame:
    """Attach the columns of a 1-row aggregate as scalar subqueries."""
    return d.withColumns(scalars(st))


def qq_points(df: DataFrame, column: str, n_points: int = 100) -> DataFrame:
    """Normal Q-Q data on a fixed probability grid p_k = (k - 0.5) / K:
    (p, theoretical, sample, line) with the standardized reference line
    (``line='s'``: mean + std x theoretical).  Sample quantiles are exact."""
    probs = [(k - 0.5) / n_points for k in range(1, n_points + 1)]
    df = cut_lineage(df.select(column))
    q = exact_quantiles(df, column, probs, stored=True)
    spark = df.sparkSession
    theo = spark.createDataFrame([(p, norm_ppf(p)) for p in probs], "p double, theoretical double")
    st = scalars(df.agg(F.avg(column).alias("m"), F.stddev_samp(column).alias("s")))
    m, s = st["m"], st["s"]
    return (theo.join(q, "p").select("p", "theoretical", F.col("quantile").alias("sample"),
                                     (m + s * F.col("theoretical")).alias("line")))


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows without replacement: those with the smallest md5 of their key and
    the seed (a distributed top-n).  ``key`` names columns that identify a row
    and don't depend on summation order, so the sample is the same for any
    partitioning, and on any engine that has md5."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    h = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")
