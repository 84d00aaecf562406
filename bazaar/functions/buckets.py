"""Time-bucketed aggregation with pandas ``resample`` semantics: every bucket
between the first and the last populated one is emitted (count/sum 0, mean NULL).

The aggregate itself is a normal ``groupBy(label)`` (partial aggregation on the
map side, one small shuffle).  The calendar spine is generated from the 1-row
min/max of the *aggregated* frame, so its size is bounded by the number of
buckets in the time range, never by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exprs import BUCKETS


def dense_spine(agg: DataFrame, label: str, step: str) -> DataFrame:
    """All labels from min to max of ``agg[label]`` every ``step``."""
    if step == "1 month":
        # last_day of each month: walk month starts, then take last_day.
        bounds = agg.agg(F.trunc(F.min(label), "month").alias("lo"), F.max(label).alias("hi"))
        return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m")) \
            .select(F.last_day("m").alias(label))
    bounds = agg.agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias(label))


def resample(df: DataFrame, ts: str, rule: str, aggs: dict[str, Column],
             fill_zero: tuple[str, ...] = ()) -> DataFrame:
    """``df.set_index(ts).resample(rule).agg(...)`` -> (label, *aggs).

    ``fill_zero`` lists the count/sum outputs that pandas reports as 0 for an
    empty bucket; other outputs stay NULL there."""
    label_fn, step = BUCKETS[rule]
    label = "period"
    agg = (df.filter(F.col(ts).isNotNull())
           .groupBy(label_fn(ts).alias(label))
           .agg(*[e.alias(n) for n, e in aggs.items()]))
    spine = dense_spine(agg, label, step)
    # Both sides are one row per bucket: the spine is tiny and bounded by the
    # calendar; AQE broadcasts it.
    out = spine.join(agg, label, "left")
    if fill_zero:
        out = out.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in fill_zero})
    return out.select(label, *aggs.keys())
