"""Seller-level feature tables, review economics and P&L.

Scale notes: all aggregates are ``groupBy(seller_id)`` with partial
aggregation, so a seller holding a third of all items costs one partial row
per task.  Review statistics are pre-aggregated per order (one row per order)
and joined to (order, seller, n_items) pairs, never expanded to the
item x review fan-out; the weighted sums give the same numbers exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (MICROS_PER_DAY, MONTHLY_FEE_BRL, SALES_CUT, micros_between,
                               money_sum, months_between_avg, review_cost, round_half_even)
from .orders import filter_delivered

Tables = dict[str, DataFrame]


def seller_features(t: Tables) -> DataFrame:
    """seller_id, seller_city, seller_state (deduplicated)."""
    return t["sellers"].drop("seller_zip_code_prefix").dropDuplicates()


def seller_delay_wait(t: Tables) -> DataFrame:
    """seller_id, delay_to_carrier, wait_time over the items of delivered
    orders.  The carrier delay is averaged first and clipped at 0 afterwards
    (an all-NULL mean becomes 0)."""
    items = t["order_items"].filter(F.col("seller_id").isNotNull())
    ship = items.select("order_id", "seller_id", "shipping_limit_date").join(
        filter_delivered(t["orders"]).select("order_id", "order_delivered_carrier_date",
                                             "order_delivered_customer_date", "order_purchase_timestamp"),
        "order_id")
    g = ship.groupBy("seller_id").agg(
        (F.avg(micros_between("shipping_limit_date", "order_delivered_carrier_date")) / F.lit(MICROS_PER_DAY)).alias("d"),
        (F.avg(micros_between("order_purchase_timestamp", "order_delivered_customer_date")) / F.lit(MICROS_PER_DAY)).alias("wait_time"))
    return g.select("seller_id", F.when(F.col("d") > 0, F.col("d")).otherwise(F.lit(0.0)).alias("delay_to_carrier"),
                    "wait_time")


def seller_active_dates(t: Tables) -> DataFrame:
    """seller_id, date_first_sale, date_last_sale, months_on_olist from the
    approval dates of the seller's orders (any status).  De-duplicating
    (order, seller) first would not change min/max, so it is skipped."""
    appr = t["orders"].select("order_id", "order_approved_at").na.drop()
    g = (appr.join(t["order_items"].select("order_id", "seller_id").na.drop(), "order_id")
         .groupBy("seller_id").agg(F.min("order_approved_at").alias("date_first_sale"),
                                   F.max("order_approved_at").alias("date_last_sale")))
    return g.withColumn("months_on_olist", months_between_avg("date_first_sale", "date_last_sale"))


def seller_quantity(t: Tables) -> DataFrame:
    """seller_id, n_orders (distinct orders), quantity (items), quantity_per_order."""
    g = t["order_items"].filter(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("n_orders"), F.count("order_id").alias("quantity"))
    return g.withColumn("quantity_per_order", F.try_divide(F.col("quantity"), F.col("n_orders")))


def seller_sales(t: Tables) -> DataFrame:
    """seller_id, sales = Σ item price."""
    return (t["order_items"].filter(F.col("seller_id").isNotNull()).groupBy("seller_id")
            .agg(F.coalesce(money_sum("price"), F.lit(0.0)).alias("sales")))


def reviews_per_order(t: Tables) -> DataFrame:
    """One row per order with review counts by score (and Σscore, Σcost)."""
    r = t["order_reviews"]
    s = F.col("review_score")
    return r.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(s).alias("n_scored"),
        F.sum(s).alias("sum_score"),
        *[F.count(F.when(s == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4, 5)],
        F.sum(review_cost(s)).alias("cost"))


def _order_seller_items(t: Tables, dedupe: bool) -> DataFrame:
    """(order_id, seller_id, w): w = number of items, or 1 when de-duplicated."""
    items = t["order_items"].select("order_id", "seller_id").na.drop()
    if dedupe:
        return items.dropDuplicates().withColumn("w", F.lit(1).cast("long"))
    return items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("w"))


def _weighted_reviews(t: Tables, dedupe: bool) -> DataFrame:
    pairs = _order_seller_items(t, dedupe).join(reviews_per_order(t), "order_id")
    w = F.col("w")
    return pairs.groupBy("seller_id").agg(
        F.sum(w * F.col("n_rows")).alias("n_rows"),
        F.sum(w * F.col("n_scored")).alias("n_scored"),
        F.sum(w * F.col("sum_score")).alias("sum_score"),
        *[F.sum(w * F.col(f"n{k}")).alias(f"n{k}") for k in (1, 2, 3, 4, 5)],
        F.sum(w * F.col("cost")).alias("cost"))


def seller_review_score(t: Tables) -> DataFrame:
    """seller_id, share_of_five_stars, share_of_one_stars, review_score,
    item-weighted (every item of an order counts each review of that order)."""
    g = _weighted_reviews(t, dedupe=False)
    n = F.col("n_scored")
    return g.select("seller_id",
                    F.try_divide(F.col("n5"), n).alias("share_of_five_stars"),
                    F.try_divide(F.col("n1"), n).alias("share_of_one_stars"),
                    F.try_divide(F.col("sum_score"), n).alias("review_score"))


def seller_review_counts(t: Tables) -> DataFrame:
    """De-duplicated (order, seller) variant with per-score counts."""
    g = _weighted_reviews(t, dedupe=True)
    n = F.col("n_rows")
    return g.select("seller_id",
                    F.try_divide(F.col("n5"), n).alias("share_of_five_stars"),
                    F.try_divide(F.col("n1"), n).alias("share_of_one_stars"),
                    F.try_divide(F.col("sum_score"), F.col("n_scored")).alias("review_score"),
                    F.col("n1").alias("count_of_one_star"), F.col("n2").alias("count_of_two_star"),
                    F.col("n3").alias("count_of_three_star"), F.col("n4").alias("count_of_four_star"),
                    F.col("n5").alias("count_of_five_star"))


def seller_review_cost(t: Tables, dedupe: bool = False) -> DataFrame:
    """seller_id, review_cost = Σ cost of the reviews of the seller's orders
    (item-weighted by default; ``dedupe`` counts an order once per seller)."""
    orders = t["orders"].select("order_id").na.drop()
    g = (_order_seller_items(t, dedupe).join(orders, "order_id")
         .join(reviews_per_order(t).select("order_id", "cost"), "order_id")
         .groupBy("seller_id").agg(F.sum(F.col("w") * F.col("cost")).alias("review_cost")))
    return g


def seller_revenue(months, sales, digits: int | None = 2):
    rev = F.col(months) * F.lit(MONTHLY_FEE_BRL) + F.col(sales) * F.lit(SALES_CUT) \
        if isinstance(months, str) else months * F.lit(MONTHLY_FEE_BRL) + sales * F.lit(SALES_CUT)
    return round_half_even(rev, digits) if digits is not None else rev


def seller_pnl(t: Tables, dedupe: bool = False, digits: int | None = 2) -> DataFrame:
    """seller_id, revenue, review_cost, profits for every seller with reviewed
    orders.  revenue = 80 x months + 10% of sales (rounded to ``digits``);
    a seller without approval dates gets NULL revenue and profits."""
    cost = seller_review_cost(t, dedupe)
    j = (cost.join(seller_active_dates(t).select("seller_id", "months_on_olist"), "seller_id", "left")
         .join(seller_sales(t), "seller_id", "left"))
    rev = seller_revenue(F.col("months_on_olist"), F.col("sales"), digits)
    return j.select("seller_id", rev.alias("revenue"), "review_cost",
                    (rev - F.col("review_cost")).alias("profits"))


def seller_summary(t: Tables) -> DataFrame:
    """Every numeric seller feature from ONE pass over the items.

    Items are first reduced to one row per (order, seller) carrying exact
    microsecond sums; that row meets its order (one row per order) and its
    review counts (one row per order) and a single ``groupBy(seller_id)``
    produces all features.  Each feature keeps its own population through
    conditional aggregates (``has_*`` flags), so joining on the flags gives
    exactly the inner-join populations of the separate jobs."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    us = lambda c: micros_between(epoch, c)  # noqa: E731  (wall-clock, zone-free)
    pairs = (t["order_items"].filter(F.col("seller_id").isNotNull())
             .groupBy("order_id", "seller_id")
             .agg(F.count(F.lit(1)).alias("w"), F.count("order_id").alias("w_oid"),
                  F.count("shipping_limit_date").alias("w_lim"), F.sum(us("shipping_limit_date")).alias("lim_us"),
                  F.sum(F.col("price").cast("decimal(28,10)")).alias("sales")))
    o = t["orders"].filter(F.col("order_id").isNotNull()).select(
        "order_id", F.lit(True).alias("in_orders"), (F.col("order_status") == "delivered").alias("delivered"),
        "order_approved_at", us("order_delivered_carrier_date").alias("car_us"),
        micros_between("order_purchase_timestamp", "order_delivered_customer_date").alias("wait_us"))
    r = reviews_per_order(t)
    j = pairs.join(o, "order_id", "left").join(r, "order_id", "left")
    dlv = F.coalesce(F.col("delivered"), F.lit(False))
    car_ok = dlv & F.col("car_us").isNotNull()
    wait_ok = dlv & F.col("wait_us").isNotNull()
    has_rev = F.col("n_rows").isNotNull()
    w = F.col("w")
    g = j.groupBy("seller_id").agg(
        F.max(dlv).alias("has_delivered"),
        F.sum(F.when(car_ok, F.col("w_lim") * F.col("car_us") - F.col("lim_us"))).alias("delay_us"),
        F.sum(F.when(car_ok, F.col("w_lim"))).alias("delay_n"),
        F.sum(F.when(wait_ok, w * F.col("wait_us"))).alias("wait_sum"),
        F.sum(F.when(wait_ok, w)).alias("wait_n"),
        F.min("order_approved_at").alias("date_first_sale"), F.max("order_approved_at").alias("date_last_sale"),
        F.count(F.when(F.col("w_oid") > 0, 1)).alias("n_orders"), F.sum("w_oid").alias("quantity"),
        F.coalesce(F.sum("sales").cast("double"), F.lit(0.0)).alias("sales"),
        F.max(has_rev).alias("has_review"),
        F.max(has_rev & F.coalesce(F.col("in_orders"), F.lit(False))).alias("has_cost"),
        F.sum(w * F.col("n_scored")).alias("rv_n"), F.sum(w * F.col("sum_score")).alias("rv_sum"),
        F.sum(w * F.col("n5")).alias("rv_n5"), F.sum(w * F.col("n1")).alias("rv_n1"),
        F.sum(F.when(F.col("in_orders"), w * F.col("cost"))).alias("review_cost"),
        # de-duplicated (order, seller) review counts: every pair weighs 1
        F.sum("n_rows").alias("dd_rows"), F.sum("n_scored").alias("dd_scored"), F.sum("sum_score").alias("dd_sum"),
        *[F.sum(f"n{k}").alias(f"dd_{k}") for k in (1, 2, 3, 4, 5)])
    d = F.col("delay_us") / F.col("delay_n") / F.lit(MICROS_PER_DAY)
    return g.select(
        "seller_id", "has_delivered", "has_review", "has_cost",
        F.when(d > 0, d).otherwise(F.lit(0.0)).alias("delay_to_carrier"),
        (F.col("wait_sum") / F.col("wait_n") / F.lit(MICROS_PER_DAY)).alias("wait_time"),
        "date_first_sale", "date_last_sale",
        months_between_avg("date_first_sale", "date_last_sale").alias("months_on_olist"),
        "n_orders", "quantity", F.try_divide(F.col("quantity"), F.col("n_orders")).alias("quantity_per_order"),
        "sales",
        F.try_divide(F.col("rv_n5"), F.col("rv_n")).alias("share_of_five_stars"),
        F.try_divide(F.col("rv_n1"), F.col("rv_n")).alias("share_of_one_stars"),
        F.try_divide(F.col("rv_sum"), F.col("rv_n")).alias("review_score"),
        "review_cost", "dd_rows", "dd_scored", "dd_sum", *[f"dd_{k}" for k in (1, 2, 3, 4, 5)])


def training_data(t: Tables) -> DataFrame:
    """The 18-column seller table: features ⨝ the one-pass summary, restricted
    to the sellers every per-feature inner join would keep."""
    s = seller_summary(t).filter(F.col("has_delivered") & F.col("date_first_sale").isNotNull()
                                 & F.col("has_review") & F.col("has_cost"))
    rev = seller_revenue(F.col("months_on_olist"), F.col("sales"), 2)
    return seller_features(t).join(s, "seller_id").select(
        "seller_id", "seller_city", "seller_state", "delay_to_carrier", "wait_time", "date_first_sale",
        "date_last_sale", "months_on_olist", "n_orders", "quantity", "quantity_per_order", "sales",
        "share_of_five_stars", "share_of_one_stars", "review_score", rev.alias("revenue"), "review_cost",
        (rev - F.col("review_cost")).alias("profits"))


def seller_economics(t: Tables, variant: str = "star_counts") -> DataFrame:
    """Per-seller revenues / costs / profits for the CEO what-if.

    ``star_counts``: revenues = round(0.1 sales + 80 months, 1), costs =
    round(100 n1 + 50 n2 + 40 n3, 1) over de-duplicated (order, seller) reviews.
    ``dedup``: unrounded revenues, cost_of_reviews de-duplicated.
    Output: seller_id, n_orders, revenues, costs, profits, revenues_per_n_orders."""
    summ = seller_summary(t).filter(F.col("has_delivered") & F.col("date_first_sale").isNotNull()
                                    & F.col("has_review"))
    base = seller_features(t).join(summ, "seller_id").select(
        "seller_id", "n_orders", "months_on_olist", "sales",
        F.col("dd_1").alias("count_of_one_star"), F.col("dd_2").alias("count_of_two_star"),
        F.col("dd_3").alias("count_of_three_star"))
    digits = 1 if variant == "star_counts" else None
    revenues = seller_revenue(F.col("months_on_olist"), F.col("sales"), digits)
    raw_cost = (F.lit(100) * F.col("count_of_one_star") + F.lit(50) * F.col("count_of_two_star")
                + F.lit(40) * F.col("count_of_three_star")).cast("double")
    costs = round_half_even(raw_cost, 1) if digits is not None else raw_cost
    return base.select("seller_id", "n_orders", revenues.alias("revenues"), costs.alias("costs"),
                       (revenues - costs).alias("profits"),
                       F.try_divide(revenues, F.col("n_orders")).alias("revenues_per_n_orders"))
