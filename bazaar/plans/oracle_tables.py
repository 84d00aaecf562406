"""DuckDB side of the fixture mapping: the nine marketplace tables as CTEs over
the pre-registered driver views.  Written independently of the Spark adapter
(same contract, other engine) so the oracle really checks it."""

MAPPING_CTES = """
ol_orders_base AS (
  SELECT o.*, o.o_orderkey AS k,
         o.o_orderdate + to_seconds(CAST(o.o_orderkey * 7919 % 86400 AS BIGINT)) AS pur
  FROM orders o
),
ol_orders_x AS (
  SELECT k, o_orderpriority, o_totalprice, o_orderdate,
         k AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                            WHEN 'P' THEN 'canceled' END AS order_status,
         pur AS order_purchase_timestamp,
         CASE WHEN k % 97 <> 0 THEN pur + to_hours(CAST(k * 31 % 48 AS BIGINT)) END AS order_approved_at,
         CASE WHEN o_orderstatus <> 'P' THEN pur + to_hours(CAST(24 + k * 37 % 168 AS BIGINT)) END
           AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' AND k % 101 <> 0
              THEN pur + to_hours(CAST(72 + k * 53 % 720 AS BIGINT)) END AS order_delivered_customer_date,
         o_orderdate + to_days(CAST(12 + k * 17 % 25 AS INTEGER)) AS order_estimated_delivery_date
  FROM ol_orders_base
),
ol_orders AS (
  SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
         order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
  FROM ol_orders_x
),
ol_order_items AS (
  SELECT CASE WHEN l_orderkey % 229 <> 9 THEN l_orderkey END AS order_id, l_linenumber AS order_item_id,
         CASE WHEN l_orderkey % 211 <> 5 THEN l_partkey END AS product_id,
         CASE WHEN l_orderkey % 223 <> 7 THEN l_suppkey END AS seller_id, l_shipdate AS shipping_limit_date,
         l_extendedprice / 160 AS price, l_extendedprice * l_tax / 160 AS freight_value
  FROM lineitem
),
ol_order_reviews AS (
  SELECT 2 * k AS review_id, CASE WHEN k % 233 <> 11 THEN k END AS order_id,
         CAST(CASE WHEN coalesce(order_delivered_customer_date > order_estimated_delivery_date, false) AND k % 7 <> 0
                   THEN greatest(1, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 2)
                   ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS INTEGER) AS review_score,
         CASE WHEN k % 3 <> 0 THEN o_orderpriority END AS review_comment_title,
         CASE WHEN k % 4 <> 0 THEN 'review ' || CAST(k AS VARCHAR) END AS review_comment_message,
         o_orderdate + INTERVAL 40 DAY AS review_creation_date,
         o_orderdate + INTERVAL 40 DAY + to_hours(CAST(k % 72 AS BIGINT)) AS review_answer_timestamp
  FROM ol_orders_x WHERE k % 50 <> 0
  UNION ALL
  SELECT 2 * k + 1, CASE WHEN k % 233 <> 11 THEN k END, CAST(1 + k % 5 AS INTEGER),
         CASE WHEN k % 3 <> 0 THEN o_orderpriority END,
         CASE WHEN k % 4 <> 0 THEN 'review ' || CAST(k AS VARCHAR) END,
         o_orderdate + INTERVAL 40 DAY,
         o_orderdate + INTERVAL 40 DAY + to_hours(CAST(k % 72 AS BIGINT))
  FROM ol_orders_x WHERE k % 200 = 1
),
ol_order_payments AS (
  SELECT o_orderkey AS order_id, CAST(s.seq AS INTEGER) AS payment_sequential,
         (['credit_card', 'boleto', 'voucher', 'debit_card'])[CAST(o_orderkey % 4 AS INTEGER) + 1] AS payment_type,
         CAST(1 + o_orderkey % 6 AS INTEGER) AS payment_installments,
         CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice / 2 ELSE o_totalprice END AS payment_value
  FROM orders, (VALUES (1), (2)) s(seq)
  WHERE o_orderkey % 303 <> 0 AND (s.seq = 1 OR o_orderkey % 10 = 0)
),
ol_customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
         CAST(c_nationkey * 100 + c_custkey % 20 AS INTEGER) AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
ol_sellers AS (
  SELECT s_suppkey AS seller_id,
         CAST(s_nationkey * 100 + s_suppkey % 20 AS INTEGER) AS seller_zip_code_prefix,
         s_name AS seller_city, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
ol_geolocation AS (
  SELECT CAST(n_nationkey * 100 + z AS INTEGER) AS geolocation_zip_code_prefix,
         CASE WHEN NOT (z = 7 AND dup = 0)
              THEN -30.0::DOUBLE + n_nationkey + z * 0.05::DOUBLE + dup * 0.01::DOUBLE END AS geolocation_lat,
         -70.0::DOUBLE + n_nationkey * 1.5::DOUBLE + z * 0.03::DOUBLE + dup * 0.02::DOUBLE AS geolocation_lng,
         n_name AS geolocation_city, n_name AS geolocation_state, CAST(dup AS BIGINT) AS geo_seq
  FROM nation, range(20) zz(z), range(3) dd(dup)
  WHERE NOT (z = 19 AND n_nationkey % 2 = 0)
),
ol_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 70 <> 0 THEN lower(p_brand) END AS product_category_name,
         CAST(length(p_name) AS INTEGER) AS product_name_lenght,
         CAST(p_size * 20 + p_partkey % 13 AS INTEGER) AS product_description_lenght,
         CAST(1 + p_partkey % 6 AS INTEGER) AS product_photos_qty,
         CASE WHEN p_partkey % 89 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
         CAST(10 + p_size % 30 AS DOUBLE) AS product_length_cm,
         CAST(5 + p_partkey % 20 AS DOUBLE) AS product_height_cm,
         CAST(8 + p_partkey % 25 AS DOUBLE) AS product_width_cm
  FROM part
),
ol_translation AS (
  SELECT DISTINCT lower(p_brand) AS product_category_name,
         'cat_' || lower(p_brand) AS product_category_name_english
  FROM part WHERE lower(p_brand) <> 'brand#7'
)
"""


def with_tables(body: str) -> str:
    """Prefix an oracle query with the mapping CTEs."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH" + MAPPING_CTES + "," + body[4:]
    return "WITH" + MAPPING_CTES + body
