"""Registered order-level queries and their DuckDB oracles."""

from __future__ import annotations

import uuid

from ..operators import orders as O
from ..session import ensure_checkpoint_dir
from ..sources.driver_tables import driver_catalog
from ..sources.layout import with_order_layout
from .registry import days, pos0, r6, register, stable_doubles

PUR, APPR, CAR, DLV, EST = ("order_purchase_timestamp", "order_approved_at",
                            "order_delivered_carrier_date", "order_delivered_customer_date",
                            "order_estimated_delivery_date")

WAIT_SQL = f"""
SELECT order_id, {days(PUR, DLV)} AS wait_time, {days(PUR, EST)} AS expected_wait_time,
       {pos0(days(EST, DLV))} AS delay_vs_expected, order_status
FROM ol_orders WHERE order_status = 'delivered'"""

FLAGS_SQL = """
SELECT order_id,
       CASE WHEN review_score = 5 THEN 1 ELSE 0 END AS dim_is_five_star,
       CASE WHEN review_score = 4 THEN 1 ELSE 0 END AS dim_is_four_star,
       CASE WHEN review_score = 3 THEN 1 ELSE 0 END AS dim_is_three_star,
       CASE WHEN review_score = 2 THEN 1 ELSE 0 END AS dim_is_two_star,
       CASE WHEN review_score = 1 THEN 1 ELSE 0 END AS dim_is_one_star,
       review_score
FROM ol_order_reviews"""

STATS_SQL = """
SELECT order_id, count(order_item_id) AS number_of_products,
       count(DISTINCT seller_id) AS number_of_sellers,
       coalesce(CAST(sum(CAST(price AS DECIMAL(28,10))) AS DOUBLE), 0.0) AS price, coalesce(CAST(sum(CAST(freight_value AS DECIMAL(28,10))) AS DOUBLE), 0.0) AS freight_value
FROM ol_order_items WHERE order_id IS NOT NULL GROUP BY order_id"""

GEO_FIRST_SQL = """
SELECT geolocation_zip_code_prefix,
       arg_min(geolocation_lat, geo_seq) FILTER (WHERE geolocation_lat IS NOT NULL) AS geolocation_lat,
       arg_min(geolocation_lng, geo_seq) FILTER (WHERE geolocation_lng IS NOT NULL) AS geolocation_lng,
       arg_min(geolocation_city, geo_seq) FILTER (WHERE geolocation_city IS NOT NULL) AS geolocation_city,
       arg_min(geolocation_state, geo_seq) FILTER (WHERE geolocation_state IS NOT NULL) AS geolocation_state
FROM ol_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL
GROUP BY geolocation_zip_code_prefix"""

HAV = ("2 * 6371.0::DOUBLE * asin(sqrt(pow(sin((radians(c_lat) - radians(s_lat)) / 2), 2)"
       " + cos(radians(s_lat)) * cos(radians(c_lat)) * pow(sin((radians(c_lng) - radians(s_lng)) / 2), 2)))")

DISTANCE_SQL = f"""
SELECT order_id, avg({HAV}) AS distance_seller_customer
FROM (
  SELECT i.order_id, sg.lat AS s_lat, sg.lng AS s_lng, cg.lat AS c_lat, cg.lng AS c_lng,
         c.customer_zip_code_prefix AS c_zip, s.seller_zip_code_prefix AS s_zip
  FROM ol_customers c
  JOIN ol_orders o ON o.customer_id = c.customer_id
  JOIN ol_order_items i ON i.order_id = o.order_id
  JOIN ol_sellers s ON s.seller_id = i.seller_id
  JOIN (SELECT s2.seller_id, g.geolocation_lat AS lat, g.geolocation_lng AS lng
        FROM ol_sellers s2 LEFT JOIN ({GEO_FIRST_SQL}) g
          ON s2.seller_zip_code_prefix = g.geolocation_zip_code_prefix) sg ON sg.seller_id = i.seller_id
  JOIN (SELECT c2.customer_id, g.geolocation_lat AS lat, g.geolocation_lng AS lng
        FROM ol_customers c2 LEFT JOIN ({GEO_FIRST_SQL}) g
          ON c2.customer_zip_code_prefix = g.geolocation_zip_code_prefix) cg ON cg.customer_id = c.customer_id
) x
WHERE s_lat IS NOT NULL AND s_lng IS NOT NULL AND c_lat IS NOT NULL AND c_lng IS NOT NULL
  AND c_zip IS NOT NULL AND s_zip IS NOT NULL
GROUP BY order_id"""

TRAIN_COLS = ["order_id", "wait_time", "expected_wait_time", "delay_vs_expected", "order_status",
              "dim_is_five_star", "dim_is_four_star", "dim_is_three_star", "dim_is_two_star",
              "dim_is_one_star", "review_score", "number_of_products", "number_of_sellers",
              "price", "freight_value"]
TRAIN_DOUBLES = {"wait_time", "expected_wait_time", "delay_vs_expected", "price", "freight_value",
                 "distance_seller_customer"}


def train_raw_sql(with_distance: bool) -> str:
    """Unrounded training rows (for oracles that compute on top of them)."""
    cols = TRAIN_COLS + (["distance_seller_customer"] if with_distance else [])
    dist = f" JOIN ({DISTANCE_SQL}) d USING (order_id)" if with_distance else ""
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"""SELECT {', '.join(cols)} FROM (
  SELECT * FROM ({WAIT_SQL}) w JOIN ({FLAGS_SQL}) r USING (order_id)
  JOIN ({STATS_SQL}) s USING (order_id){dist}) t WHERE {notnull}"""


def _train_sql(with_distance: bool) -> str:
    cols = TRAIN_COLS + (["distance_seller_customer"] if with_distance else [])
    dist = f" JOIN ({DISTANCE_SQL}) d USING (order_id)" if with_distance else ""
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    sel = ", ".join(f"{r6(c)} AS {c}" if c in TRAIN_DOUBLES else c for c in cols)
    return f"""SELECT {sel} FROM (
  SELECT * FROM ({WAIT_SQL}) w JOIN ({FLAGS_SQL}) r USING (order_id)
  JOIN ({STATS_SQL}) s USING (order_id){dist}) t WHERE {notnull}"""


DETAILS_SQL = """
SELECT order_id,
       coalesce(sum(product_weight_g * order_item_count), 0.0) AS product_weight_g_sum,
       max(product_length_cm) AS product_length_cm_max,
       max(product_height_cm) AS product_height_cm_max,
       max(product_width_cm) AS product_width_cm_max
FROM (SELECT order_id, product_id, count(order_item_id) AS order_item_count
      FROM ol_order_items WHERE order_id IS NOT NULL GROUP BY order_id, product_id) c
JOIN ol_products p USING (product_id)
GROUP BY order_id"""


def _cat(spark, sf_dir):
    return driver_catalog(spark, sf_dir)


@register("order_wait_time", f"""
SELECT order_id, {r6('wait_time')} AS wait_time, {r6('expected_wait_time')} AS expected_wait_time,
       {r6('delay_vs_expected')} AS delay_vs_expected, order_status FROM ({WAIT_SQL})""")
def q_order_wait_time(spark, sf_dir):
    return stable_doubles(O.wait_time(_cat(spark, sf_dir)))


@register("order_wait_time_all", f"""
SELECT order_id, {r6(days(PUR, DLV))} AS wait_time, {r6(days(PUR, EST))} AS expected_wait_time,
       {r6(pos0(days(EST, DLV)))} AS delay_vs_expected, order_status FROM ol_orders""")
def q_order_wait_time_all(spark, sf_dir):
    return stable_doubles(O.wait_time(_cat(spark, sf_dir), is_delivered=False))


@register("order_wait_time_approved_to_carrier", f"""
SELECT order_id, {r6(days(APPR, CAR))} AS wait_time, {r6(days(APPR, EST))} AS expected_wait_time,
       {r6(pos0(days(APPR, CAR) + ' - ' + days(APPR, EST)))} AS delay_vs_expected, order_status
FROM ol_orders WHERE order_status = 'delivered'""")
def q_wait_approved_to_carrier(spark, sf_dir):
    return stable_doubles(O.wait_time(_cat(spark, sf_dir), mode="approved_to_carrier"))


_WD = lambda a, b: f"floor({days(a, b)})"


@register("order_wait_time_whole_days", f"""
SELECT order_id, {_WD(PUR, DLV)} AS wait_time, {_WD(PUR, EST)} AS expected_wait_time,
       CASE WHEN {_WD(PUR, DLV)} - {_WD(PUR, EST)} IS NOT NULL
            THEN greatest({_WD(PUR, DLV)} - {_WD(PUR, EST)}, 0.0::DOUBLE) END AS delay_vs_expected,
       order_status
FROM ol_orders WHERE order_status = 'delivered'""")
def q_wait_whole_days(spark, sf_dir):
    return stable_doubles(O.wait_time(_cat(spark, sf_dir), mode="whole_days"))


@register("order_review_score", FLAGS_SQL)
def q_order_review_score(spark, sf_dir):
    return O.review_score(_cat(spark, sf_dir))


@register("number_of_products", """
SELECT order_id, count(order_item_id) AS number_of_products
FROM ol_order_items WHERE order_id IS NOT NULL GROUP BY order_id""")
def q_number_of_products(spark, sf_dir):
    return O.number_of_products(_cat(spark, sf_dir))


@register("number_of_sellers", """
SELECT order_id, count(DISTINCT seller_id) AS number_of_sellers
FROM ol_order_items WHERE order_id IS NOT NULL GROUP BY order_id""")
def q_number_of_sellers(spark, sf_dir):
    return O.number_of_sellers(_cat(spark, sf_dir))


@register("price_and_freight", f"""
SELECT order_id, {r6('coalesce(CAST(sum(CAST(price AS DECIMAL(28,10))) AS DOUBLE), 0.0)')} AS price,
       {r6('coalesce(CAST(sum(CAST(freight_value AS DECIMAL(28,10))) AS DOUBLE), 0.0)')} AS freight_value
FROM ol_order_items WHERE order_id IS NOT NULL GROUP BY order_id""")
def q_price_and_freight(spark, sf_dir):
    return stable_doubles(O.price_and_freight(_cat(spark, sf_dir)))


@register("geo_first", f"""
SELECT geolocation_zip_code_prefix, {r6('geolocation_lat')} AS geolocation_lat,
       {r6('geolocation_lng')} AS geolocation_lng, geolocation_city, geolocation_state
FROM ({GEO_FIRST_SQL})""")
def q_geo_first(spark, sf_dir):
    return stable_doubles(O.geo_first(_cat(spark, sf_dir)))


@register("order_distance", f"""
SELECT order_id, {r6('distance_seller_customer')} AS distance_seller_customer FROM ({DISTANCE_SQL})""")
def q_order_distance(spark, sf_dir):
    return stable_doubles(O.order_distance(_cat(spark, sf_dir)))


@register("order_training_data", _train_sql(False))
def q_order_training_data(spark, sf_dir):
    return stable_doubles(O.training_data(_cat(spark, sf_dir)))


@register("order_training_data_bucketed", _train_sql(False))
def q_order_training_bucketed(spark, sf_dir):
    """The same rows from the layout bucketed by order_id."""
    path = f"{ensure_checkpoint_dir(spark)}/layout-{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stable_doubles(O.training_data(with_order_layout(_cat(spark, sf_dir), buckets, path)))


@register("order_training_data_with_distance", _train_sql(True))
def q_order_training_with_distance(spark, sf_dir):
    return stable_doubles(O.training_data(_cat(spark, sf_dir), with_distance=True))


ONE_FIVE_COLS = [c for c in TRAIN_COLS if c not in ("dim_is_four_star", "dim_is_three_star", "dim_is_two_star")]


@register("order_training_data_one_five", "SELECT " + ", ".join(
    f"{r6(c)} AS {c}" if c in TRAIN_DOUBLES else c for c in ONE_FIVE_COLS) + f" FROM ({_train_sql(False)}) t")
def q_order_training_one_five(spark, sf_dir):
    return stable_doubles(O.training_data(_cat(spark, sf_dir), flags="one_five"))


@register("order_product_details", f"""
SELECT order_id, {r6('product_weight_g_sum')} AS product_weight_g_sum,
       {r6('product_length_cm_max')} AS product_length_cm_max,
       {r6('product_height_cm_max')} AS product_height_cm_max,
       {r6('product_width_cm_max')} AS product_width_cm_max
FROM ({DETAILS_SQL})""")
def q_order_product_details(spark, sf_dir):
    return stable_doubles(O.product_details(_cat(spark, sf_dir)))


DETAIL_COLS = TRAIN_COLS + ["distance_seller_customer", "product_weight_g_sum", "product_length_cm_max",
                            "product_height_cm_max", "product_width_cm_max"]


def details_raw_sql() -> str:
    """Unrounded training rows left-joined with product details, complete rows only."""
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in DETAIL_COLS)
    return f"""SELECT {', '.join(DETAIL_COLS)} FROM (
  SELECT * FROM ({train_raw_sql(True)}) t LEFT JOIN ({DETAILS_SQL}) p USING (order_id)) x WHERE {notnull}"""


def _details_training_sql() -> str:
    dbl = TRAIN_DOUBLES | set(DETAIL_COLS[-4:])
    sel = ", ".join(f"{r6(c)} AS {c}" if c in dbl else c for c in DETAIL_COLS)
    return f"SELECT {sel} FROM ({details_raw_sql()}) x"


@register("order_details_training", _details_training_sql())
def q_order_details_training(spark, sf_dir):
    return stable_doubles(O.details_training(_cat(spark, sf_dir)))


@register("missing_reviews", """
SELECT count(*) AS orders_without_review FROM ol_orders o
WHERE NOT EXISTS (SELECT 1 FROM ol_order_reviews r WHERE r.order_id = o.order_id)""")
def q_missing_reviews(spark, sf_dir):
    return O.missing_reviews(_cat(spark, sf_dir))


@register("join_orders_reviews_left", """
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
       o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
       r.review_id, r.review_score, r.review_comment_title, r.review_comment_message,
       r.review_creation_date, r.review_answer_timestamp
FROM ol_orders o LEFT JOIN ol_order_reviews r ON o.order_id = r.order_id""")
def q_orders_reviews_left(spark, sf_dir):
    return O.orders_with_reviews(_cat(spark, sf_dir))


@register("filter_not_delivered", """
SELECT * FROM ol_orders WHERE order_status IS DISTINCT FROM 'delivered'""")
def q_filter_not_delivered(spark, sf_dir):
    return O.filter_not_delivered(_cat(spark, sf_dir)["orders"])
