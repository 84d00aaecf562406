"""Order-level feature tables (one row per order, or per review where noted).

Scale notes: every job here is keyed on ``order_id``.  The three item
aggregates share one ``groupBy(order_id)`` (partial aggregation on the map
side, so a hot order costs one partial row per task), and the training join
chain keeps that hash partitioning, so each input is shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (MONEY_DECIMAL, STAR_NAMES, clip_lower_zero, days_between, haversine_km,
                               money_sum, positive_or_zero, star_flag, whole_days_between)

Tables = dict[str, DataFrame]

WAIT_MODES = ("purchase_to_customer", "approved_to_carrier", "whole_days")


def filter_delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "delivered")


def filter_not_delivered(orders: DataFrame) -> DataFrame:
    """``order_status != 'delivered'``; a NULL status is kept (pandas ``!=``)."""
    return orders.filter(~F.col("order_status").eqNullSafe(F.lit("delivered")))


def wait_time(t: Tables, is_delivered: bool = True, mode: str = "purchase_to_customer") -> DataFrame:
    """order_id, wait_time, expected_wait_time, delay_vs_expected, order_status.

    ``purchase_to_customer`` (default): fractional days; the delay is clipped at
    0 and a missing delivery gives delay 0 while wait_time stays NULL.
    ``approved_to_carrier``: wait = carrier - approved, expected = estimate -
    approved, delay = clip(wait - expected) (NULL -> 0).
    ``whole_days``: floored day counts, delay = clip(wait - expected, lower=0)
    keeping NULL."""
    o = t["orders"]
    if is_delivered:
        o = filter_delivered(o)
    pur, appr = "order_purchase_timestamp", "order_approved_at"
    car, dlv, est = ("order_delivered_carrier_date", "order_delivered_customer_date",
                     "order_estimated_delivery_date")
    if mode == "purchase_to_customer":
        wait, expected = days_between(pur, dlv), days_between(pur, est)
        delay = positive_or_zero(days_between(est, dlv))
    elif mode == "approved_to_carrier":
        wait, expected = days_between(appr, car), days_between(appr, est)
        delay = positive_or_zero(wait - expected)
    elif mode == "whole_days":
        wait, expected = whole_days_between(pur, dlv), whole_days_between(pur, est)
        delay = clip_lower_zero(wait - expected)
    else:
        raise ValueError(f"mode must be one of {WAIT_MODES}")
    return o.select("order_id", wait.alias("wait_time"), expected.alias("expected_wait_time"),
                    delay.alias("delay_vs_expected"), "order_status")


def star_flag_columns(flags: str = "all") -> list[int]:
    if flags == "all":
        return [5, 4, 3, 2, 1]
    if flags == "one_five":
        return [5, 1]
    raise ValueError("flags must be 'all' or 'one_five'")


def review_score(t: Tables, flags: str = "all") -> DataFrame:
    """One row per review: order_id, dim_is_{five..one}_star, review_score."""
    r = t["order_reviews"]
    return r.select("order_id",
                    *[star_flag("review_score", k).alias(f"dim_is_{STAR_NAMES[k]}_star")
                      for k in star_flag_columns(flags)],
                    "review_score")


def item_stats(t: Tables) -> DataFrame:
    """order_id, number_of_products, number_of_sellers, price, freight_value in
    a single aggregation (pandas: three groupbys).  Sums over all-NULL groups
    are 0 like pandas."""
    items = t["order_items"].filter(F.col("order_id").isNotNull())
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("number_of_products"),
        F.count_distinct("seller_id").alias("number_of_sellers"),
        F.coalesce(money_sum("price"), F.lit(0.0)).alias("price"),
        F.coalesce(money_sum("freight_value"), F.lit(0.0)).alias("freight_value"),
    )


def number_of_products(t: Tables) -> DataFrame:
    items = t["order_items"].filter(F.col("order_id").isNotNull())
    return items.groupBy("order_id").agg(F.count("order_item_id").alias("number_of_products"))


def number_of_sellers(t: Tables) -> DataFrame:
    items = t["order_items"].filter(F.col("order_id").isNotNull())
    return items.groupBy("order_id").agg(F.count_distinct("seller_id").alias("number_of_sellers"))


def price_and_freight(t: Tables) -> DataFrame:
    items = t["order_items"].filter(F.col("order_id").isNotNull())
    return items.groupBy("order_id").agg(
        F.coalesce(money_sum("price"), F.lit(0.0)).alias("price"),
        F.coalesce(money_sum("freight_value"), F.lit(0.0)).alias("freight_value"))


GEO_VALUE_COLUMNS = ("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")


def geo_first(t: Tables, order_col: str = "geo_seq") -> DataFrame:
    """Per zip prefix, the first non-NULL value of every column in file order
    (``groupby(zip).first()``).  ``min_by`` skips rows whose ordering is NULL,
    so masking the ordinal where the value is NULL gives "first non-null"."""
    g = t["geolocation"].filter(F.col("geolocation_zip_code_prefix").isNotNull())
    seq = F.col(order_col)
    return g.groupBy("geolocation_zip_code_prefix").agg(
        *[F.min_by(F.col(cn), F.when(F.col(cn).isNotNull(), seq)).alias(cn) for cn in GEO_VALUE_COLUMNS])


def order_facts(t: Tables, orders: DataFrame) -> DataFrame:
    """order_id, number_of_products, number_of_sellers, price, freight_value and
    distance_seller_customer of ``orders`` from one pass over the items.

    Items are first reduced to one row per (order, seller), which collapses hot
    orders.  The position of the customer joins the orders (one row per order),
    so the pairs are shuffled once by order; orders that the caller left out drop
    before any position is looked up.  Distances are weighted by items; a pair
    without a known position on either side doesn't count."""
    geo = geo_first(t).select(F.col("geolocation_zip_code_prefix").alias("zip"),
                              F.col("geolocation_lat").alias("lat"), F.col("geolocation_lng").alias("lng"))
    sellers = (t["sellers"].select("seller_id", F.col("seller_zip_code_prefix").alias("zip")).join(geo, "zip", "left")
               .select("seller_id", F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng")))
    customers = (t["customers"].select("customer_id", F.col("customer_zip_code_prefix").alias("zip")).join(geo, "zip", "left")
                 .select("customer_id", F.col("lat").alias("c_lat"), F.col("lng").alias("c_lng")))
    placed = (orders.select("order_id", "customer_id").join(customers, "customer_id", "left")
              .select("order_id", "c_lat", "c_lng"))
    pairs = t["order_items"].filter(F.col("order_id").isNotNull()).groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("order_item_id").alias("items"),
        F.sum(F.col("price").cast(MONEY_DECIMAL)).alias("p"), F.sum(F.col("freight_value").cast(MONEY_DECIMAL)).alias("f"))
    d = haversine_km("s_lng", "s_lat", "c_lng", "c_lat")       # NULL without both positions
    j = pairs.join(placed, "order_id").join(sellers, "seller_id", "left").withColumn("d", d)
    return j.groupBy("order_id").agg(
        F.sum("items").alias("number_of_products"), F.count("seller_id").alias("number_of_sellers"),
        F.coalesce(F.sum("p").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce(F.sum("f").cast("double"), F.lit(0.0)).alias("freight_value"),
        F.try_divide(F.sum(F.col("d") * F.col("n")), F.sum(F.when(F.col("d").isNotNull(), F.col("n"))))
        .alias("distance_seller_customer"))


def order_distance(t: Tables) -> DataFrame:
    """order_id, distance_seller_customer: item-weighted mean great-circle
    distance between the seller's and the customer's zip positions; orders
    without any known distance are left out."""
    return (order_facts(t, t["orders"]).filter(F.col("distance_seller_customer").isNotNull())
            .select("order_id", "distance_seller_customer"))


def training_data(t: Tables, is_delivered: bool = True, with_distance: bool = False,
                  flags: str = "all", mode: str = "purchase_to_customer") -> DataFrame:
    """The order training table: wait times ⨝ reviews ⨝ item stats [⨝ distance]
    on order_id (inner), then rows with any NULL are dropped.  One row per
    review, so an order with two reviews appears twice."""
    parts = [wait_time(t, is_delivered, mode), review_score(t, flags)]
    if with_distance:
        parts.append(order_facts(t, filter_delivered(t["orders"]) if is_delivered else t["orders"]))
    else:
        parts.append(item_stats(t))
    return reduce(lambda a, b: a.join(b, "order_id"), parts).na.drop("any")


def product_details(t: Tables) -> DataFrame:
    """Per order: Σ(weight × count) over its products, max length/height/width.
    Sums skip NULL weights (0 for all-NULL, like pandas); max of all-NULL stays NULL."""
    counts = (t["order_items"].filter(F.col("order_id").isNotNull()).groupBy("order_id", "product_id")
              .agg(F.count("order_item_id").alias("order_item_count")))
    prods = t["products"].select("product_id", "product_weight_g", "product_length_cm",
                                 "product_height_cm", "product_width_cm")
    j = counts.join(prods, "product_id")
    return j.groupBy("order_id").agg(
        F.coalesce(F.sum(F.col("product_weight_g") * F.col("order_item_count")), F.lit(0.0)).alias("product_weight_g_sum"),
        F.max("product_length_cm").alias("product_length_cm_max"),
        F.max("product_height_cm").alias("product_height_cm_max"),
        F.max("product_width_cm").alias("product_width_cm_max"))


def details_training(t: Tables, with_distance: bool = True) -> DataFrame:
    """Training rows left-joined with the per-order product details, complete rows only."""
    return (training_data(t, with_distance=with_distance)
            .join(product_details(t), "order_id", "left").na.drop("any"))


def orders_with_reviews(t: Tables) -> DataFrame:
    """orders LEFT JOIN reviews (orders without review keep NULL review columns)."""
    return t["orders"].join(t["order_reviews"], "order_id", "left")


def missing_reviews(t: Tables) -> DataFrame:
    """1 row: number of orders without any review (anti join)."""
    return (t["orders"].select("order_id")
            .join(t["order_reviews"].select("order_id"), "order_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("orders_without_review")))
