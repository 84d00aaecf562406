"""Registered metric / KPI queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources.driver_tables import driver_catalog
from .registry import mdays, msum, npround, r6, register, stable_doubles

D = "::DOUBLE"
# The fixture's calendar runs 1995-2001; the reports' "since" cut-off is a
# parameter, set inside that range.
SINCE = "1997-02-01"


def _cat(spark, sf_dir):
    return driver_catalog(spark, sf_dir)


def week_sun(ts: str) -> str:
    return f"(CAST(date_trunc('week', {ts}) AS DATE) + 6)"


def week_mon(ts: str) -> str:
    return f"(CAST(date_trunc('week', {ts} - INTERVAL 1 DAY) AS DATE) + 7)"


def spine(agg: str, step: str = "7 DAY") -> str:
    if step == "1 MONTH":
        return f"""SELECT last_day(CAST(unnest(generate_series(date_trunc('month', lo)::TIMESTAMP, hi::TIMESTAMP,
                   INTERVAL 1 MONTH)) AS DATE)) AS period FROM (SELECT min(period) lo, max(period) hi FROM {agg})"""
    return f"""SELECT CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL {step})) AS DATE) AS period
               FROM (SELECT min(period) lo, max(period) hi FROM {agg})"""


@register("status_counts", """
SELECT order_status, count(*) AS n FROM ol_orders WHERE order_status IS NOT NULL GROUP BY order_status""")
def q_status_counts(spark, sf_dir):
    return M.status_counts(_cat(spark, sf_dir))


@register("score_counts", """
SELECT review_score, count(*) AS n FROM ol_order_reviews WHERE review_score IS NOT NULL GROUP BY review_score""")
def q_score_counts(spark, sf_dir):
    return M.score_counts(_cat(spark, sf_dir))


@register("missing_reviews_by_status", """
SELECT o.order_status, count(*) FILTER (WHERE r.review_score IS NULL) AS n_missing
FROM ol_orders o LEFT JOIN ol_order_reviews r ON o.order_id = r.order_id GROUP BY o.order_status""")
def q_missing_by_status(spark, sf_dir):
    return M.missing_reviews_by_status(_cat(spark, sf_dir))


@register("reviews_per_order", """
SELECT order_id, count(review_id) AS review_id, count(review_score) AS review_score,
       count(review_comment_title) AS review_comment_title, count(review_comment_message) AS review_comment_message,
       count(review_creation_date) AS review_creation_date, count(review_answer_timestamp) AS review_answer_timestamp
FROM ol_order_reviews WHERE order_id IS NOT NULL GROUP BY order_id""")
def q_reviews_per_order(spark, sf_dir):
    return M.non_null_counts_by(_cat(spark, sf_dir)["order_reviews"], "order_id")


_ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


@register("null_counts_orders", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ol_orders" for c in _ORDER_COLS))
def q_null_counts(spark, sf_dir):
    return M.null_counts(_cat(spark, sf_dir)["orders"])


@register("distinct_counts_orders", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM ol_orders" for c in _ORDER_COLS))
def q_distinct_counts(spark, sf_dir):
    return M.distinct_counts(_cat(spark, sf_dir)["orders"])


_REVIEW_COLS = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                "review_creation_date", "review_answer_timestamp"]


@register("null_counts_reviews", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM ol_order_reviews" for c in _REVIEW_COLS))
def q_null_counts_reviews(spark, sf_dir):
    return M.null_counts(_cat(spark, sf_dir)["order_reviews"])


@register("distinct_counts_reviews", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM ol_order_reviews" for c in _REVIEW_COLS))
def q_distinct_counts_reviews(spark, sf_dir):
    return M.distinct_counts(_cat(spark, sf_dir)["order_reviews"])


ORC = """ol_orders o JOIN ol_order_reviews r ON o.order_id = r.order_id
JOIN ol_customers c ON c.customer_id = o.customer_id"""


@register("state_review_stats", f"""
SELECT customer_state, {r6('avg(review_score)')} AS mean_review_score, max(review_score) AS max_review_score,
       count(DISTINCT customer_zip_code_prefix) AS n_zip_codes
FROM {ORC} GROUP BY customer_state""")
def q_state_review_stats(spark, sf_dir):
    return stable_doubles(M.state_review_stats(_cat(spark, sf_dir)))


PROMOTER = "CASE WHEN review_score = 5 THEN 1 WHEN review_score < 4 THEN -1 ELSE 0 END"


@register("nps_by_state", f"""
SELECT customer_state, {r6(f'sum({PROMOTER}){D} / count(review_score)')} AS nps
FROM {ORC} GROUP BY customer_state""")
def q_nps_by_state(spark, sf_dir):
    return stable_doubles(M.nps_by_state(_cat(spark, sf_dir)))


def _nps_overall_sql() -> str:
    from .order_queries import _train_sql
    return f"SELECT {r6(f'sum({PROMOTER}){D} / count(review_score)')} AS nps FROM ({_train_sql(False)}) t"


@register("nps_overall", _nps_overall_sql())
def q_nps_overall(spark, sf_dir):
    return stable_doubles(M.nps_overall(_cat(spark, sf_dir)))


@register("lateness_share", f"""
SELECT early_or_on_time, {npround(f'count(*){D} / (SELECT count(*) FROM ol_orders WHERE order_status = \'delivered\')', 2)} AS share
FROM (SELECT CASE WHEN coalesce(order_delivered_customer_date > order_estimated_delivery_date, false)
                  THEN 'late' ELSE 'in_time' END AS early_or_on_time
      FROM ol_orders WHERE order_status = 'delivered') x GROUP BY early_or_on_time""")
def q_lateness_share(spark, sf_dir):
    return M.lateness_share(_cat(spark, sf_dir))


@register("payments_per_order", f"""
SELECT order_id, {r6(f'coalesce({msum("payment_value")}, 0.0{D})')} AS order_payment_value
FROM ol_order_payments WHERE order_id IS NOT NULL GROUP BY order_id""")
def q_payments_per_order(spark, sf_dir):
    return stable_doubles(M.payments_per_order(_cat(spark, sf_dir)))


@register("weekly_orders", f"""
WITH a AS (SELECT {week_mon('order_purchase_timestamp')} AS period, count(order_id) AS n_orders
           FROM ol_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1)
SELECT s.period, coalesce(a.n_orders, 0) AS n_orders FROM ({spine('a')}) s LEFT JOIN a ON s.period = a.period""")
def q_weekly_orders(spark, sf_dir):
    return M.weekly_orders(_cat(spark, sf_dir))


@register("weekly_non_delivered", f"""
WITH a AS (SELECT {week_sun('order_purchase_timestamp')} AS period, count(order_id) AS n_orders
           FROM ol_orders WHERE order_status IS DISTINCT FROM 'delivered'
             AND order_purchase_timestamp >= TIMESTAMP '{SINCE}' GROUP BY 1)
SELECT s.period, coalesce(a.n_orders, 0) AS n_orders FROM ({spine('a')}) s LEFT JOIN a ON s.period = a.period""")
def q_weekly_non_delivered(spark, sf_dir):
    return M.weekly_non_delivered(_cat(spark, sf_dir), since=SINCE)


@register("weekly_payments", f"""
WITH p AS (SELECT order_id, coalesce({msum('payment_value')}, 0.0{D}) AS v FROM ol_order_payments
           WHERE order_id IS NOT NULL GROUP BY order_id),
a AS (SELECT {week_sun('o.order_purchase_timestamp')} AS period, count(o.order_id) AS n_orders,
             {msum('p.v')} AS payment_sum, {msum('p.v')} / count(p.v) AS payment_mean
      FROM ol_orders o JOIN p ON o.order_id = p.order_id WHERE o.order_purchase_timestamp IS NOT NULL GROUP BY 1)
SELECT s.period, coalesce(a.n_orders, 0) AS n_orders, {r6(f'coalesce(a.payment_sum, 0.0{D})')} AS payment_sum,
       {r6(f'coalesce(a.payment_sum, 0.0{D}) / 1000')} AS payment_sum_k, {r6('a.payment_mean')} AS payment_mean
FROM ({spine('a')}) s LEFT JOIN a ON s.period = a.period""")
def q_weekly_payments(spark, sf_dir):
    return stable_doubles(M.weekly_payments(_cat(spark, sf_dir)))


@register("monthly_satisfaction", f"""
WITH a AS (SELECT last_day(review_creation_date) AS period, avg(review_score) AS mean_review_score
           FROM ol_order_reviews WHERE review_creation_date >= TIMESTAMP '{SINCE}' GROUP BY 1)
SELECT s.period, {r6('a.mean_review_score')} AS mean_review_score
FROM ({spine('a', '1 MONTH')}) s LEFT JOIN a ON s.period = a.period""")
def q_monthly_satisfaction(spark, sf_dir):
    return stable_doubles(M.monthly_satisfaction(_cat(spark, sf_dir), since=SINCE))


WEEKLY_DELAY_SQL = f"""
WITH d AS (SELECT order_id, order_purchase_timestamp,
                  epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date) AS delay_us,
                  epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp) AS wait_us
           FROM ol_orders WHERE order_status = 'delivered'),
a AS (SELECT {week_sun('order_purchase_timestamp')} AS period,
             sum(delay_us){D} / count(delay_us) / 86400000000.0{D} AS avg_delay_vs_exp,
             sum(wait_us){D} / count(wait_us) / 86400000000.0{D} AS avg_wait_time,
             count(*) FILTER (WHERE coalesce(delay_us > 0, false)) AS nb_of_delays,
             count(order_id) AS nb_of_orders
      FROM d WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1)
SELECT s.period, a.avg_delay_vs_exp, a.avg_wait_time, coalesce(a.nb_of_delays, 0) AS nb_of_delays,
       coalesce(a.nb_of_orders, 0) AS nb_of_orders,
       CASE WHEN coalesce(a.nb_of_orders, 0) > 0 THEN a.nb_of_delays{D} / a.nb_of_orders END AS pct_of_lateness
FROM ({spine('a')}) s LEFT JOIN a ON s.period = a.period"""


@register("weekly_delay_analysis", f"""
SELECT period, {r6('avg_delay_vs_exp')} AS avg_delay_vs_exp, {r6('avg_wait_time')} AS avg_wait_time,
       nb_of_delays, nb_of_orders, {r6('pct_of_lateness')} AS pct_of_lateness FROM ({WEEKLY_DELAY_SQL})""")
def q_weekly_delay_analysis(spark, sf_dir):
    return stable_doubles(M.weekly_delay_analysis(_cat(spark, sf_dir)))


@register("worst_weeks", f"""
SELECT period, nb_of_delays, nb_of_orders, {r6('pct_of_lateness')} AS pct_of_lateness FROM ({WEEKLY_DELAY_SQL})
ORDER BY pct_of_lateness DESC NULLS LAST, period LIMIT 10""")
def q_worst_weeks(spark, sf_dir):
    return stable_doubles(M.worst_weeks(_cat(spark, sf_dir)))


def _brackets_sql() -> str:
    rows = []
    for i, (label, lo, hi) in enumerate(M.LATENESS_BRACKETS):
        cond = (f"pct_of_lateness >= {lo}{D}" if hi is None
                else f"pct_of_lateness BETWEEN {lo}{D} AND {hi}{D}")
        minus = " - 1" if i == 0 else ""
        rows.append(f"SELECT '{label}' AS brackets, count(*) FILTER (WHERE {cond}){minus} AS nb_weeks FROM w")
    return f"WITH w AS ({WEEKLY_DELAY_SQL}) " + " UNION ALL ".join(rows)


@register("lateness_brackets", _brackets_sql())
def q_lateness_brackets(spark, sf_dir):
    return M.lateness_brackets(_cat(spark, sf_dir))


@register("lateness_bracket_total", f"SELECT CAST(sum(nb_weeks) AS BIGINT) AS total_weeks FROM ({_brackets_sql()}) b")
def q_lateness_bracket_total(spark, sf_dir):
    return M.lateness_bracket_total(_cat(spark, sf_dir))


@register("weekly_delay_tail", f"""
SELECT period, {r6('avg_delay_vs_exp')} AS avg_delay_vs_exp, {r6('avg_wait_time')} AS avg_wait_time,
       nb_of_delays, nb_of_orders, {r6('pct_of_lateness')} AS pct_of_lateness FROM ({WEEKLY_DELAY_SQL})
ORDER BY period DESC LIMIT 10""")
def q_weekly_delay_tail(spark, sf_dir):
    """``tail(10)`` of the weekly report: the 10 latest weeks."""
    return stable_doubles(M.weekly_delay_analysis(_cat(spark, sf_dir)).orderBy(F.desc("period")).limit(10))
