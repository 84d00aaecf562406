"""Exact, interpolated quantiles that scale: distributed selection.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a hot group at scale, and
``percentile_approx`` is not exact.  Here each target rank is found by
repeated narrowing:

1. per group: n, min, max; target ranks floor/ceil((n-1)p).  Every row gets
   its bucket ``_b1`` on a ``BUCKETS``-wide grid over [min, max]; one
   ``groupBy(group, _b1)`` (partial aggregation, output <= groups x BUCKETS)
   locates the bucket holding each rank.
2. While a band holds more than ``band_rows`` rows and more than one value,
   only the rows of that band are histogrammed again; its largest value always
   has a bucket of its own, so every pass narrows it.  Bands are
   de-duplicated, hence disjoint, and always lie inside one ``_b1`` bucket,
   so rows meet them through an equi-join on (group, ``_b1``): a row matches
   at most one band, there is no expansion and no nested-loop join.
3. A single-valued band is its value; any other band (<= band_rows rows) is
   ranked with a window over that band alone.

The narrow (group, value) projection is materialized once, unless the caller has
stored it, and each pass rescans it; pass state is checkpointed into the shared
checkpoint folder.  NaN counts as missing.
Result: ``v0 + (v1 - v0) * frac`` at position (n-1)p (pandas / numpy linear).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BUCKETS = 1024
BAND_ROWS = 100_000    # default of band_rows: what a single window task may rank
SENT_ROWS = 100_000    # groups or bands that are broadcast
BAND = ["_lo", "_hi", "_below"]


def _bucket(x, lo, hi, by_magnitude: bool = False):
    """Bucket of x in [lo, hi], by distance from lo or by the magnitude of this
    distance.  Passes take turns, so neither outliers nor values spread over
    hundreds of decades make the search long."""
    # halves keep the difference of the largest doubles finite
    share = F.coalesce(F.try_divide(x * 0.5 - lo * 0.5, hi * 0.5 - lo * 0.5), F.lit(0.0))
    if by_magnitude:
        share = F.log1p(share * F.lit(1e290)) / F.log1p(F.lit(1e290))
    return (F.when(hi == lo, F.lit(0)).when(x >= hi, F.lit(BUCKETS - 1))
            .otherwise(F.least(F.floor(share * (BUCKETS - 1)), F.lit(BUCKETS - 2))).cast("int"))


def _locate(hist: DataFrame, keys: list[str], targets: DataFrame, tkeys: list[str]) -> DataFrame:
    """Bucket counts -> for each target rank the bucket containing it."""
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    h = hist.withColumn("_start", F.col("_base") + F.coalesce(F.sum("_c").over(w), F.lit(0)))
    j = targets.join(h, tkeys)
    return j.filter((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_c")))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    by: Sequence[str] = (), band_rows: int | None = None, stored: bool = False) -> DataFrame:
    """-> (*by, p, quantile) for each group of ``by`` and each p in ``probs``.
    ``stored``: ``df`` is cheap to read repeatedly and isn't materialized again."""
    band_rows = band_rows or BAND_ROWS
    user_by = list(by)
    # Without groups, one constant group keeps every join an equi-join.
    by = user_by or ["_g"]
    keys = [F.col(c) for c in user_by] or [F.lit(0).alias("_g")]
    x = F.col("_x")
    base = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(x.isNotNull() & ~F.isnan(x))
    base = base if stored else cut_lineage(base)
    # one row per group, made once: every pass below joins it
    stats = cut_lineage(base.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo0"),
                                              F.max("_x").alias("_hi0")))
    few = stats.count() * 2 * len(probs) <= SENT_ROWS

    def sent(df: DataFrame) -> DataFrame:
        """Few groups or bands go to every task, so that the rows stay where they are."""
        return F.broadcast(df) if few else df

    data = base.join(sent(stats.select(*by, "_lo0", "_hi0")), by)
    data = data.select(*by, "_x", _bucket(x, F.col("_lo0"), F.col("_hi0")).alias("_b1"))
    targets = (
        stats.select(*by, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
        .withColumn("_pos", (F.col("_n") - 1) * F.col("p"))
        .withColumn("_r0", F.floor("_pos").cast("long")).withColumn("_r1", F.ceil("_pos").cast("long"))
        .withColumn("_frac", F.col("_pos") - F.col("_r0")))
    ranks = targets.select(*by, F.explode(F.array("_r0", "_r1")).alias("_rank")).dropDuplicates()

    # pass 1: the global grid
    h1 = (data.groupBy(*by, F.col("_b1").alias("_b"))
          .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_blo"), F.max("_x").alias("_bhi"))
          .withColumn("_base", F.lit(0).cast("long")))
    state = cut_lineage(_locate(h1, by, ranks, by).select(
        *by, "_rank", F.col("_b").alias("_b1"), F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"),
        F.col("_start").alias("_below"), F.col("_c").alias("_cnt")))

    is_open = (F.col("_cnt") > band_rows) & (F.col("_lo") < F.col("_hi"))
    bkeys = by + ["_b1"] + BAND
    by_magnitude = False
    while state.filter(is_open).limit(1).count():
        by_magnitude = not by_magnitude
        bands = state.filter(is_open).select(*bkeys).dropDuplicates()
        hist = (data.join(sent(bands), by + ["_b1"]).filter(x.between(F.col("_lo"), F.col("_hi")))
                .groupBy(*bkeys, _bucket(x, F.col("_lo"), F.col("_hi"), by_magnitude).alias("_b"))
                .agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_blo"), F.max("_x").alias("_bhi"))
                .withColumn("_base", F.col("_below")))
        moved = _locate(hist, bkeys, state.filter(is_open).select(*bkeys, "_rank"), bkeys).select(
            *by, "_rank", "_b1", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"),
            F.col("_start").alias("_below"), F.col("_c").alias("_cnt"))
        state = cut_lineage(moved.unionByName(state.filter(~is_open)))

    const = state.filter(F.col("_lo") == F.col("_hi")).select(*by, "_rank", F.col("_lo").alias("_v"))
    open_bands = state.filter(F.col("_lo") < F.col("_hi"))
    bands = open_bands.select(*bkeys).dropDuplicates()
    wb = Window.partitionBy(*bkeys).orderBy("_x")
    ranked = (data.join(sent(bands), by + ["_b1"]).filter(x.between(F.col("_lo"), F.col("_hi")))
              .select(*bkeys, "_x", (F.row_number().over(wb) - 1 + F.col("_below")).alias("_k")))
    picked = open_bands.join(ranked, bkeys).filter(F.col("_k") == F.col("_rank")).select(
        *by, "_rank", F.col("_x").alias("_v"))
    values = cut_lineage(const.unionByName(picked))     # used twice, and the bands are ranked once
    v0 = values.select(*by, F.col("_rank").alias("_r0"), F.col("_v").alias("_v0"))
    v1 = values.select(*by, F.col("_rank").alias("_r1"), F.col("_v").alias("_v1"))
    out = targets.join(v0, by + ["_r0"]).join(v1, by + ["_r1"])
    q = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")
    return out.select(*user_by, "p", q.alias("quantile"))


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns in one run -> (variable, p, quantile)."""
    narrow = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    long = narrow.unpivot([], list(columns), "variable", "value")
    return exact_quantiles(long, "value", probs, by=["variable"], stored=True)
