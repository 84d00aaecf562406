"""Registered seller / product queries and their DuckDB oracles."""

from __future__ import annotations

from ..operators import products as P
from ..operators import sellers as S
from ..sources.driver_tables import driver_catalog
from .registry import mdays, mean, msum, npround, r6, register, stable_doubles

D = "::DOUBLE"


def _cat(spark, sf_dir):
    return driver_catalog(spark, sf_dir)


def _r(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"{r6(c)} AS {c}" if c in doubles else c for c in cols)


FEATURES_SQL = "SELECT DISTINCT seller_id, seller_city, seller_state FROM ol_sellers"

DELAY_SQL = f"""
SELECT seller_id, CASE WHEN d > 0 THEN d ELSE 0.0{D} END AS delay_to_carrier, wait_time FROM (
  SELECT i.seller_id, {mdays('i.shipping_limit_date', 'o.order_delivered_carrier_date')} AS d,
         {mdays('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS wait_time
  FROM ol_order_items i JOIN ol_orders o ON i.order_id = o.order_id
  WHERE o.order_status = 'delivered' AND i.seller_id IS NOT NULL GROUP BY i.seller_id) x"""

DATES_SQL = f"""
SELECT seller_id, date_first_sale, date_last_sale,
       round_even(((epoch_us(date_last_sale) - epoch_us(date_first_sale)) / 86400000000.0{D}) / 30.436875{D}, 0)
         AS months_on_olist
FROM (SELECT i.seller_id, min(o.order_approved_at) AS date_first_sale, max(o.order_approved_at) AS date_last_sale
      FROM ol_orders o JOIN ol_order_items i ON o.order_id = i.order_id
      WHERE o.order_approved_at IS NOT NULL AND o.order_id IS NOT NULL AND i.seller_id IS NOT NULL GROUP BY i.seller_id) x"""

QUANTITY_SQL = f"""
SELECT seller_id, count(DISTINCT order_id) AS n_orders, count(order_id) AS quantity,
       count(order_id){D} / count(DISTINCT order_id) AS quantity_per_order
FROM ol_order_items WHERE seller_id IS NOT NULL GROUP BY seller_id"""

SALES_SQL = f"""
SELECT seller_id, coalesce({msum('price')}, 0.0{D}) AS sales
FROM ol_order_items WHERE seller_id IS NOT NULL GROUP BY seller_id"""

REVIEW_SQL = f"""
SELECT i.seller_id,
       sum(CASE WHEN r.review_score = 5 THEN 1 ELSE 0 END){D} / count(r.review_score) AS share_of_five_stars,
       sum(CASE WHEN r.review_score = 1 THEN 1 ELSE 0 END){D} / count(r.review_score) AS share_of_one_stars,
       {mean('r.review_score')} AS review_score
FROM ol_order_items i JOIN ol_order_reviews r ON i.order_id = r.order_id WHERE i.seller_id IS NOT NULL GROUP BY i.seller_id"""

COST_CASE = "CASE r.review_score WHEN 1 THEN 100 WHEN 2 THEN 50 WHEN 3 THEN 40 ELSE 0 END"

PNL_SQL = f"""
SELECT c.seller_id, {npround(f'd.months_on_olist * 80.0{D} + s.sales * 0.1{D}', 2)} AS revenue,
       c.review_cost,
       {npround(f'd.months_on_olist * 80.0{D} + s.sales * 0.1{D}', 2)} - c.review_cost AS profits
FROM (SELECT i.seller_id, CAST(sum({COST_CASE}) AS BIGINT) AS review_cost
      FROM (SELECT order_id FROM ol_orders WHERE order_id IS NOT NULL) o
      JOIN ol_order_reviews r ON o.order_id = r.order_id
      JOIN ol_order_items i ON i.order_id = o.order_id WHERE i.seller_id IS NOT NULL GROUP BY i.seller_id) c
LEFT JOIN ({DATES_SQL}) d ON c.seller_id = d.seller_id
LEFT JOIN ({SALES_SQL}) s ON c.seller_id = s.seller_id"""

COUNTS_SQL = f"""
SELECT seller_id,
       sum(CASE WHEN review_score = 5 THEN 1 ELSE 0 END){D} / count(*) AS share_of_five_stars,
       sum(CASE WHEN review_score = 1 THEN 1 ELSE 0 END){D} / count(*) AS share_of_one_stars,
       {mean('review_score')} AS review_score,
       CAST(sum(CASE WHEN review_score = 1 THEN 1 ELSE 0 END) AS BIGINT) AS count_of_one_star,
       CAST(sum(CASE WHEN review_score = 2 THEN 1 ELSE 0 END) AS BIGINT) AS count_of_two_star,
       CAST(sum(CASE WHEN review_score = 3 THEN 1 ELSE 0 END) AS BIGINT) AS count_of_three_star,
       CAST(sum(CASE WHEN review_score = 4 THEN 1 ELSE 0 END) AS BIGINT) AS count_of_four_star,
       CAST(sum(CASE WHEN review_score = 5 THEN 1 ELSE 0 END) AS BIGINT) AS count_of_five_star
FROM (SELECT DISTINCT order_id, seller_id FROM ol_order_items) os
JOIN ol_order_reviews r USING (order_id) WHERE seller_id IS NOT NULL GROUP BY seller_id"""

SELLER_TRAIN_COLS = ["seller_id", "seller_city", "seller_state", "delay_to_carrier", "wait_time",
                     "date_first_sale", "date_last_sale", "months_on_olist", "n_orders", "quantity",
                     "quantity_per_order", "sales", "share_of_five_stars", "share_of_one_stars",
                     "review_score", "revenue", "review_cost", "profits"]
SELLER_DOUBLES = {"delay_to_carrier", "wait_time", "months_on_olist", "quantity_per_order", "sales",
                  "share_of_five_stars", "share_of_one_stars", "review_score", "revenue", "profits",
                  "revenues", "costs", "revenues_per_n_orders"}


@register("seller_features", FEATURES_SQL)
def q_seller_features(spark, sf_dir):
    return S.seller_features(_cat(spark, sf_dir))


@register("seller_delay_wait", f"SELECT {_r(['seller_id', 'delay_to_carrier', 'wait_time'], SELLER_DOUBLES)} FROM ({DELAY_SQL})")
def q_seller_delay_wait(spark, sf_dir):
    return stable_doubles(S.seller_delay_wait(_cat(spark, sf_dir)))


@register("seller_active_dates", DATES_SQL)
def q_seller_active_dates(spark, sf_dir):
    return S.seller_active_dates(_cat(spark, sf_dir))


@register("seller_quantity", f"SELECT {_r(['seller_id', 'n_orders', 'quantity', 'quantity_per_order'], SELLER_DOUBLES)} FROM ({QUANTITY_SQL})")
def q_seller_quantity(spark, sf_dir):
    return stable_doubles(S.seller_quantity(_cat(spark, sf_dir)))


@register("seller_sales", f"SELECT seller_id, {r6('sales')} AS sales FROM ({SALES_SQL})")
def q_seller_sales(spark, sf_dir):
    return stable_doubles(S.seller_sales(_cat(spark, sf_dir)))


@register("seller_review_score", f"SELECT {_r(['seller_id', 'share_of_five_stars', 'share_of_one_stars', 'review_score'], SELLER_DOUBLES)} FROM ({REVIEW_SQL})")
def q_seller_review_score(spark, sf_dir):
    return stable_doubles(S.seller_review_score(_cat(spark, sf_dir)))


@register("seller_review_counts", f"""SELECT {_r(['seller_id', 'share_of_five_stars', 'share_of_one_stars', 'review_score',
    'count_of_one_star', 'count_of_two_star', 'count_of_three_star', 'count_of_four_star', 'count_of_five_star'],
    SELLER_DOUBLES)} FROM ({COUNTS_SQL})""")
def q_seller_review_counts(spark, sf_dir):
    return stable_doubles(S.seller_review_counts(_cat(spark, sf_dir)))


@register("seller_review_cost", f"""
SELECT i.seller_id, CAST(sum({COST_CASE}) AS BIGINT) AS review_cost
FROM ol_orders o JOIN ol_order_reviews r ON o.order_id = r.order_id
JOIN ol_order_items i ON i.order_id = o.order_id WHERE o.order_id IS NOT NULL AND i.seller_id IS NOT NULL GROUP BY i.seller_id""")
def q_seller_review_cost(spark, sf_dir):
    return S.seller_review_cost(_cat(spark, sf_dir))


@register("seller_review_cost_dedup", f"""
SELECT os.seller_id, CAST(sum({COST_CASE}) AS BIGINT) AS review_cost
FROM (SELECT DISTINCT order_id, seller_id FROM ol_order_items) os
JOIN ol_orders o ON o.order_id = os.order_id JOIN ol_order_reviews r ON r.order_id = os.order_id
WHERE os.seller_id IS NOT NULL GROUP BY os.seller_id""")
def q_seller_review_cost_dedup(spark, sf_dir):
    return S.seller_review_cost(_cat(spark, sf_dir), dedupe=True)


@register("seller_pnl", f"SELECT {_r(['seller_id', 'revenue', 'review_cost', 'profits'], SELLER_DOUBLES)} FROM ({PNL_SQL})")
def q_seller_pnl(spark, sf_dir):
    return stable_doubles(S.seller_pnl(_cat(spark, sf_dir)))


SELLER_TRAIN_SQL = f"""
SELECT {_r(SELLER_TRAIN_COLS, SELLER_DOUBLES)} FROM ({FEATURES_SQL}) f
JOIN ({DELAY_SQL}) dw USING (seller_id) JOIN ({DATES_SQL}) dt USING (seller_id)
JOIN ({QUANTITY_SQL}) q USING (seller_id) JOIN ({SALES_SQL}) s USING (seller_id)
JOIN ({REVIEW_SQL}) rv USING (seller_id) JOIN ({PNL_SQL}) p USING (seller_id)"""


@register("seller_training_data", SELLER_TRAIN_SQL)
def q_seller_training_data(spark, sf_dir):
    return stable_doubles(S.training_data(_cat(spark, sf_dir)))


ECON_INNER = f"""
SELECT f.seller_id, q.n_orders,
       {npround(f'dt.months_on_olist * 80.0{D} + s.sales * 0.1{D}', 1)} AS revenues,
       {npround(f'(100 * c.count_of_one_star + 50 * c.count_of_two_star + 40 * c.count_of_three_star){D}', 1)} AS costs
FROM ({FEATURES_SQL}) f JOIN ({DELAY_SQL}) dw USING (seller_id) JOIN ({DATES_SQL}) dt USING (seller_id)
JOIN ({COUNTS_SQL}) c USING (seller_id) JOIN ({QUANTITY_SQL}) q USING (seller_id) JOIN ({SALES_SQL}) s USING (seller_id)"""

ECON_SQL = f"""
SELECT seller_id, n_orders, revenues, costs, revenues - costs AS profits,
       revenues / n_orders AS revenues_per_n_orders FROM ({ECON_INNER}) e"""


@register("seller_economics", f"""SELECT {_r(['seller_id', 'n_orders', 'revenues', 'costs', 'profits',
    'revenues_per_n_orders'], SELLER_DOUBLES)} FROM ({ECON_SQL})""")
def q_seller_economics(spark, sf_dir):
    return stable_doubles(S.seller_economics(_cat(spark, sf_dir)))


# -- products ----------------------------------------------------------------

PFEAT_SQL = """
SELECT p.product_id, p.product_name_lenght AS product_name_length,
       p.product_description_lenght AS product_description_length, p.product_photos_qty,
       p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
       t.product_category_name_english AS category
FROM ol_products p JOIN ol_translation t ON p.product_category_name = t.product_category_name"""

PPRICE_SQL = f"""SELECT product_id, {msum('price')} / count(price) AS price
FROM ol_order_items WHERE product_id IS NOT NULL GROUP BY product_id"""

PWAIT_SQL = f"""
SELECT op.product_id, {mdays('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS wait_time
FROM (SELECT DISTINCT order_id, product_id FROM ol_order_items) op
JOIN ol_orders o ON o.order_id = op.order_id WHERE o.order_status = 'delivered' AND op.product_id IS NOT NULL GROUP BY op.product_id"""

PREVIEW_SQL = f"""
SELECT op.product_id,
       sum(CASE WHEN r.review_score = 1 THEN 1 ELSE 0 END){D} / count(*) AS share_of_one_stars,
       sum(CASE WHEN r.review_score = 5 THEN 1 ELSE 0 END){D} / count(*) AS share_of_five_stars,
       {mean('r.review_score')} AS review_score
FROM (SELECT DISTINCT order_id, product_id FROM ol_order_items) op
JOIN ol_order_reviews r ON r.order_id = op.order_id WHERE op.product_id IS NOT NULL GROUP BY op.product_id"""

PQTY_SQL = """SELECT product_id, count(DISTINCT order_id) AS n_orders, count(order_id) AS quantity
FROM ol_order_items WHERE product_id IS NOT NULL GROUP BY product_id"""

PSALES_SQL = f"""SELECT product_id, coalesce({msum('price')}, 0.0{D}) AS sales
FROM ol_order_items WHERE product_id IS NOT NULL GROUP BY product_id"""

PRODUCT_DOUBLES = {"product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                   "wait_time", "price", "share_of_one_stars", "share_of_five_stars", "review_score",
                   "sales", "revenue", "profits", "review_cost_d", "product_name_length",
                   "product_description_length", "product_photos_qty", "n_orders", "quantity"}
PTRAIN_COLS = P.FEATURE_COLUMNS + ["wait_time", "price", "share_of_one_stars", "share_of_five_stars",
                                   "review_score", "n_orders", "quantity", "sales"]
PTRAIN_RAW = f"""
SELECT * FROM ({PFEAT_SQL}) f JOIN ({PWAIT_SQL}) w USING (product_id) JOIN ({PPRICE_SQL}) p USING (product_id)
JOIN ({PREVIEW_SQL}) r USING (product_id) JOIN ({PQTY_SQL}) q USING (product_id) JOIN ({PSALES_SQL}) s USING (product_id)"""

_PT_DOUBLES = {"product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
               "wait_time", "price", "share_of_one_stars", "share_of_five_stars", "review_score", "sales"}


@register("product_features", f"SELECT {_r(P.FEATURE_COLUMNS, _PT_DOUBLES)} FROM ({PFEAT_SQL})")
def q_product_features(spark, sf_dir):
    return stable_doubles(P.product_features(_cat(spark, sf_dir)))


@register("product_price", f"SELECT product_id, {r6('price')} AS price FROM ({PPRICE_SQL})")
def q_product_price(spark, sf_dir):
    return stable_doubles(P.product_price(_cat(spark, sf_dir)))


@register("product_wait_time", f"SELECT product_id, {r6('wait_time')} AS wait_time FROM ({PWAIT_SQL})")
def q_product_wait_time(spark, sf_dir):
    return stable_doubles(P.product_wait_time(_cat(spark, sf_dir)))


@register("product_review_score", f"""SELECT {_r(['product_id', 'share_of_one_stars', 'share_of_five_stars',
    'review_score'], _PT_DOUBLES)} FROM ({PREVIEW_SQL})""")
def q_product_review_score(spark, sf_dir):
    return stable_doubles(P.product_review_score(_cat(spark, sf_dir)))


@register("product_quantity", PQTY_SQL)
def q_product_quantity(spark, sf_dir):
    return P.product_quantity(_cat(spark, sf_dir))


@register("product_sales", f"SELECT product_id, {r6('sales')} AS sales FROM ({PSALES_SQL})")
def q_product_sales(spark, sf_dir):
    return stable_doubles(P.product_sales(_cat(spark, sf_dir)))


@register("product_training_data", f"SELECT {_r(PTRAIN_COLS, _PT_DOUBLES)} FROM ({PTRAIN_RAW})")
def q_product_training_data(spark, sf_dir):
    return stable_doubles(P.training_data(_cat(spark, sf_dir)))


def _rollup_sql(agg: str) -> str:
    parts = []
    for c in P.ROLLUP_COLUMNS:
        if c == "quantity":
            parts.append(f"CAST(sum(quantity) AS BIGINT) AS quantity")
        elif agg == "median":
            parts.append(f"{r6(f'quantile_cont({c}, 0.5)')} AS {c}")
        elif c == "sales":
            parts.append(f"{r6(msum('sales') + ' / count(sales)')} AS sales")
        else:
            parts.append(f"{r6(f'avg({c})')} AS {c}")
    return f"SELECT category, {', '.join(parts)} FROM ({PTRAIN_RAW}) t GROUP BY category"


@register("category_rollup_mean", _rollup_sql("mean"))
def q_category_rollup_mean(spark, sf_dir):
    return stable_doubles(P.category_rollup(_cat(spark, sf_dir), "mean"))


@register("category_rollup_median", _rollup_sql("median"))
def q_category_rollup_median(spark, sf_dir):
    return stable_doubles(P.category_rollup(_cat(spark, sf_dir), "median"))


@register("product_pnl", f"""
SELECT s.product_id, {r6('s.sales * 0.1::DOUBLE')} AS revenue,
       {r6('coalesce(c.review_cost, 0)::DOUBLE')} AS review_cost,
       {r6('s.sales * 0.1::DOUBLE - coalesce(c.review_cost, 0)::DOUBLE')} AS profits
FROM ({PSALES_SQL}) s LEFT JOIN (
  SELECT op.product_id, sum({COST_CASE}) AS review_cost
  FROM (SELECT DISTINCT order_id, product_id FROM ol_order_items) op
  JOIN ol_order_reviews r ON r.order_id = op.order_id WHERE op.product_id IS NOT NULL GROUP BY op.product_id) c ON s.product_id = c.product_id""")
def q_product_pnl(spark, sf_dir):
    return stable_doubles(P.product_pnl(_cat(spark, sf_dir)))
