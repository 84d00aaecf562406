"""Column statistics by mergeable sketches: one scan, one shuffle of sketches.

``column_sketches`` gives one row per (group, column) with counts, moments, a HyperLogLog
sketch of the distinct values, a KLL sketch of the quantiles and a frequent-items
sketch, all Spark's own.  Such rows can be stored per day or partition and merged later
(``merge_sketches``) without reading the data again; ``sketch_profile`` and
``sketch_describe`` read figures off them.

Errors (n: rows with a value): a quantile's rank is off by at most ``rank_error(k)`` * n
at 99 % confidence; distinct counts have a relative standard deviation of
``distinct_error(lg)``; a top value's count is off by at most ``top_error(items)`` * n,
and every value above that count is found.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KLL_K = 2000
HLL_LG = 14
TOP_ITEMS = 1024


def rank_error(k: int = KLL_K) -> float:
    """Normalized rank error of a KLL sketch of size ``k`` at 99 % confidence."""
    return 2.296 / k ** 0.9723


def distinct_error(lg: int = HLL_LG) -> float:
    """Relative standard deviation of a HyperLogLog estimate with 2 ** ``lg`` registers."""
    return 1.04 / math.sqrt(2 ** lg)


def top_error(items: int = TOP_ITEMS) -> float:
    """Share of the rows by which a frequent item's count may be off: 3.5 over the size
    of the map, a power of two that is at most three quarters full."""
    return 3.5 / 2 ** math.ceil(math.log2(items / 0.75))


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), k: int = KLL_K,
                    lg: int = HLL_LG, items: int = TOP_ITEMS) -> DataFrame:
    """(*by, variable, dtype, n_rows, n_null, n_zeros, min, max, mean, m2, quantiles,
    distinct, top) of each column, numbers as doubles, values as strings."""
    by = list(by)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in (columns or df.columns) if c not in by]
    rows, aggs = [], []

    def agg(expr: Column) -> Column:
        aggs.append(expr.alias(f"a{len(aggs)}"))
        return F.col(f"a{len(aggs) - 1}")

    wide = df.select(*by, *[F.col(c).cast("string").alias(f"s{i}") for i, c in enumerate(columns)],
                     *[F.col(c).cast("double").alias(f"d{i}") for i, c in enumerate(columns)
                       if isinstance(kinds[c], T.NumericType)])
    n_rows = agg(F.count(F.lit(1)))
    for i, c in enumerate(columns):
        number, s, d = isinstance(kinds[c], T.NumericType), F.col(f"s{i}"), F.col(f"d{i}")
        none = F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(c).alias("variable"), F.lit(kinds[c].simpleString()).alias("dtype"), n_rows.alias("n_rows"),
            agg(F.count_if(s.isNull())).alias("n_null"),
            (agg(F.count_if(d == 0)) if number else F.lit(0).cast("long")).alias("n_zeros"),
            *[(agg(fn(d)) if number else none).alias(name)
              for name, fn in (("min", F.min), ("max", F.max), ("mean", F.avg))],
            (agg(F.var_pop(d) * F.count(d)) if number else none).alias("m2"),
            (agg(F.expr(f"kll_sketch_agg_double(d{i}, {k})")) if number else F.lit(None).cast("binary")).alias("quantiles"),
            agg(F.expr(f"hll_sketch_agg(s{i}, {lg})")).alias("distinct"),
            agg(F.expr(f"approx_top_k_accumulate(s{i}, {items})")).alias("top")))
    grouped = wide.groupBy(*by) if by else wide
    return grouped.agg(*aggs).select(*by, F.inline(F.array(*rows)))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), items: int = TOP_ITEMS) -> DataFrame:
    """The sketches of the union of the rows behind ``sketches``, per ``by`` and column."""
    keys = [*by, "variable", "dtype"]
    n = F.col("n_rows") - F.col("n_null")
    mean = (F.sum(F.when(n > 0, n * F.col("mean"))) / F.sum(n)).alias("mean")
    whole = sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.sum("n_zeros").alias("n_zeros"),
        F.min("min").alias("min"), F.max("max").alias("max"), mean, F.expr("kll_merge_agg_double(quantiles)").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"), F.expr(f"approx_top_k_combine(top, {items})").alias("top"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    spread = (sketches.alias("p").join(whole.select(*keys, F.col("mean").alias("centre")).alias("w"), on)
              .groupBy(*[F.col(f"p.{c}") for c in keys])
              .agg(F.sum(F.col("m2") + n * F.pow(F.col("mean") - F.col("centre"), 2)).alias("m2")))
    on = F.lit(True)
    for c in keys:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return whole.alias("a").join(spread.alias("b"), on).select(
        *[F.col(f"a.{c}") for c in [*keys, "n_rows", "n_null", "n_zeros", "min", "max", "mean"]], "m2",
        "quantiles", "distinct", "top")


def _quantile(p: float) -> Column:
    """NULL where the sketch has seen no value."""
    seen = F.col("quantiles").isNotNull() & (F.expr("kll_sketch_get_n_double(quantiles)") > 0)
    return F.when(seen, F.expr(f"kll_sketch_get_quantile_double(quantiles, {p}D)"))


def sketch_describe(sketches: DataFrame, by: Sequence[str] = (), probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(*by, variable, count, mean, std, min, q..., max) of numeric columns; a quantile
    is a value of the data within the rank error, not interpolated."""
    n = F.col("n_rows") - F.col("n_null")
    return sketches.filter("quantiles IS NOT NULL").select(
        *by, "variable", n.alias("count"), "mean", F.sqrt(F.try_divide("m2", n - 1)).alias("std"), "min",
        *[_quantile(p).alias(f"q{round(p * 100):d}") for p in probs], "max")


def sketch_profile(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns of an exact profile, as far as sketches tell them."""
    n = F.col("n_rows") - F.col("n_null")
    first = F.expr("approx_top_k_estimate(top, 1)")
    return sketches.withColumn("first", F.try_element_at(first, F.lit(1))).select(
        *by, "variable", "dtype", "n_rows", "n_null", F.hll_sketch_estimate("distinct").alias("n_distinct"), "n_zeros",
        "min", "max", "mean", F.sqrt(F.try_divide("m2", n - 1)).alias("std"),
        *[_quantile(p).alias(f"q{round(p * 100):d}") for p in (0.25, 0.5, 0.75)],
        F.col("first.item").alias("top_value"), F.col("first.count").alias("top_count"))
