"""Business metrics: counts, shares, NPS and time-bucketed KPIs.

Every KPI is one ``groupBy`` (partial aggregation, small shuffle) and, for
time series, a left join with a calendar spine whose size is bounded by the
number of buckets in the time range.  Totals used as denominators are scalar
subqueries (``DataFrame.scalar()``): evaluated once, no join, no window over
the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import resample
from ..functions.exprs import (MICROS_PER_DAY, micros_between, money_sum, promoter_score,
                               round_half_even)
from .orders import filter_delivered, filter_not_delivered, training_data

Tables = dict[str, DataFrame]

# Fixed bracket labels of the lateness report, most late first.
LATENESS_BRACKETS = [(" ≥ 20%", 0.20, None), ("15% - 20%", 0.15, 0.20), ("10% - 15%", 0.10, 0.15),
                     ("5% - 10%", 0.05, 0.10), (" ≤ 5%", 0.00, 0.05)]


# -- counts --------------------------------------------------------------------

def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``value_counts()``: rows per non-NULL value, most frequent first."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)))


def value_share(df: DataFrame, col: str, digits: int | None = 2) -> DataFrame:
    """``value_counts(normalize=True)`` (rounded): share of rows per value."""
    base = df.filter(F.col(col).isNotNull())
    total = base.select(F.count(F.lit(1))).scalar()
    share = F.col("n") / total
    return (base.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .select(col, (round_half_even(share, digits) if digits is not None else share).alias("share")))


def status_counts(t: Tables) -> DataFrame:
    return value_counts(t["orders"], "order_status")


def score_counts(t: Tables) -> DataFrame:
    return value_counts(t["order_reviews"], "review_score")


def missing_reviews_by_status(t: Tables) -> DataFrame:
    """Orders without a review score per status (statuses with 0 kept), desc."""
    j = t["orders"].select("order_id", "order_status").join(
        t["order_reviews"].select("order_id", "review_score"), "order_id", "left")
    return (j.groupBy("order_status").agg(F.count_if(F.col("review_score").isNull()).alias("n_missing"))
            .orderBy(F.desc("n_missing")))


def non_null_counts_by(df: DataFrame, key: str) -> DataFrame:
    """``groupby(key).count()``: non-NULL values of every other column per key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.count(c).alias(c) for c in df.columns if c != key])


def null_counts(df: DataFrame) -> DataFrame:
    """``isnull().sum()`` as (column, n_null), one pass over the data."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "n_null")


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """``nunique()`` as (column, n_distinct).  Exact by default; ``approx``
    uses HyperLogLog++ (one pass, no per-column expansion) for very large data."""
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    wide = df.agg(*[fn(c).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "n_distinct")


def orders_reviews_customers(t: Tables) -> DataFrame:
    return (t["orders"].join(t["order_reviews"], "order_id")
            .join(t["customers"], "customer_id"))


def state_review_stats(t: Tables) -> DataFrame:
    """Per customer_state: mean and max review score, distinct zip prefixes."""
    m = orders_reviews_customers(t)
    return m.groupBy("customer_state").agg(
        F.avg("review_score").alias("mean_review_score"),
        F.max("review_score").alias("max_review_score"),
        F.count_distinct("customer_zip_code_prefix").alias("n_zip_codes"))


def nps_overall(t: Tables) -> DataFrame:
    """1 row: NPS over the order training population,
    (#5 stars - #below 4) / #scored."""
    d = training_data(t)
    s = F.col("review_score")
    return d.agg(F.try_divide(F.sum(F.when(s.isNotNull(), promoter_score(s))), F.count(s)).alias("nps"))


def nps_by_state(t: Tables) -> DataFrame:
    """NPS per customer_state over all orders with a review."""
    m = orders_reviews_customers(t)
    s = F.col("review_score")
    return m.groupBy("customer_state").agg(
        F.try_divide(F.sum(promoter_score(s)), F.count(s)).alias("nps"))


# -- time-bucketed KPIs --------------------------------------------------------

def weekly_orders(t: Tables) -> DataFrame:
    """Orders per Tuesday..Monday week (``resample('W-MON')``)."""
    return resample(t["orders"], "order_purchase_timestamp", "W-MON",
                    {"n_orders": F.count("order_id")}, fill_zero=("n_orders",))


def weekly_non_delivered(t: Tables, since: str = "2017-02-01") -> DataFrame:
    """Non-delivered orders per Monday..Sunday week from ``since`` (inclusive)."""
    o = filter_not_delivered(t["orders"]).filter(
        F.col("order_purchase_timestamp") >= F.lit(since).cast("timestamp_ntz"))
    return resample(o, "order_purchase_timestamp", "W", {"n_orders": F.count("order_id")},
                    fill_zero=("n_orders",))


def payments_per_order(t: Tables) -> DataFrame:
    """order_id, order_payment_value = Σ payment_value."""
    p = t["order_payments"].filter(F.col("order_id").isNotNull())
    return p.groupBy("order_id").agg(F.coalesce(money_sum("payment_value"), F.lit(0.0)).alias("order_payment_value"))


def weekly_payments(t: Tables) -> DataFrame:
    """Per week: orders with payments, Σ payments, Σ / 1000, mean payment."""
    j = t["orders"].select("order_id", "order_purchase_timestamp").join(payments_per_order(t), "order_id")
    out = resample(j, "order_purchase_timestamp", "W",
                   {"n_orders": F.count("order_id"),
                    "payment_sum": money_sum("order_payment_value"),
                    "payment_mean": F.try_divide(money_sum("order_payment_value"), F.count("order_payment_value"))},
                   fill_zero=("n_orders", "payment_sum"))
    return out.select("period", "n_orders", "payment_sum", (F.col("payment_sum") / 1000).alias("payment_sum_k"),
                      "payment_mean")


def monthly_satisfaction(t: Tables, since: str = "2017-02-01") -> DataFrame:
    """Mean review score per calendar month of review creation, from ``since``."""
    r = t["order_reviews"].filter(F.col("review_creation_date") >= F.lit(since).cast("timestamp_ntz"))
    return resample(r, "review_creation_date", "M", {"mean_review_score": F.avg("review_score")})


def delivered_lateness(t: Tables) -> DataFrame:
    """Delivered orders with signed delay, wait, was_late and its label."""
    o = filter_delivered(t["orders"])
    delay_us = micros_between("order_estimated_delivery_date", "order_delivered_customer_date")
    was_late = F.coalesce(delay_us > 0, F.lit(False))
    return o.select("order_id", "order_purchase_timestamp",
                    delay_us.alias("delay_us"),
                    micros_between("order_purchase_timestamp", "order_delivered_customer_date").alias("wait_us"),
                    (delay_us / F.lit(MICROS_PER_DAY)).alias("delay_vs_expected"),
                    was_late.alias("was_late"),
                    F.when(was_late, F.lit("late")).otherwise(F.lit("in_time")).alias("early_or_on_time"))


def lateness_share(t: Tables, digits: int | None = 2) -> DataFrame:
    """Share of delivered orders that were late / in time."""
    return value_share(delivered_lateness(t), "early_or_on_time", digits)


def weekly_delay_analysis(t: Tables) -> DataFrame:
    """Per Monday..Sunday week of purchase (delivered orders): mean signed
    delay, mean wait, number late, number of orders, share late (NULL for an
    empty week)."""
    d = delivered_lateness(t)
    out = resample(d, "order_purchase_timestamp", "W", {
        "avg_delay_vs_exp": F.avg("delay_us") / F.lit(MICROS_PER_DAY),
        "avg_wait_time": F.avg("wait_us") / F.lit(MICROS_PER_DAY),
        "nb_of_delays": F.count_if(F.col("was_late")),
        "nb_of_orders": F.count("order_id"),
    }, fill_zero=("nb_of_delays", "nb_of_orders"))
    return out.withColumn("pct_of_lateness", F.try_divide(F.col("nb_of_delays"), F.col("nb_of_orders")))


def worst_weeks(t: Tables, n: int = 10) -> DataFrame:
    """Top-n weeks by share of late orders (a top-k report; ties by date)."""
    w = weekly_delay_analysis(t)
    return (w.select("period", "nb_of_delays", "nb_of_orders", "pct_of_lateness")
            .orderBy(F.desc_nulls_last("pct_of_lateness"), F.asc("period")).limit(n))


def lateness_brackets(t: Tables, drop_first: bool = True) -> DataFrame:
    """Number of weeks per late-share bracket.  Ranges are closed at both ends
    (a week exactly on a boundary counts in both brackets) and the top bracket
    drops its earliest week when ``drop_first`` (as the source report does)."""
    w = weekly_delay_analysis(t)
    p = F.col("pct_of_lateness")
    aggs = []
    for i, (label, lo, hi) in enumerate(LATENESS_BRACKETS):
        cond = p >= F.lit(lo) if hi is None else p.between(F.lit(lo), F.lit(hi))
        cnt = F.count_if(cond)
        if i == 0 and drop_first:
            cnt = cnt - 1
        aggs.append(cnt.alias(f"b{i}"))
    wide = w.agg(*aggs)
    stack = ", ".join(f"'{label}', b{i}" for i, (label, _, _) in enumerate(LATENESS_BRACKETS))
    return wide.selectExpr(f"stack({len(LATENESS_BRACKETS)}, {stack}) AS (brackets, nb_weeks)")


def lateness_bracket_total(t: Tables, drop_first: bool = True) -> DataFrame:
    return lateness_brackets(t, drop_first).agg(F.sum("nb_weeks").alias("total_weeks"))
