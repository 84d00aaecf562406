"""Product-level feature tables, category roll-up and product P&L.

Scale notes: the distinct (order, product) pairs are computed once per job
and joined to per-order aggregates (one row per order), so no join fans out
beyond the item count.  Per-product aggregates are ``groupBy(product_id)``
with partial aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import MICROS_PER_DAY, SALES_CUT, micros_between, money_sum
from ..session import cut_lineage
from .orders import filter_delivered
from .quantiles import exact_quantiles
from .sellers import reviews_per_order

Tables = dict[str, DataFrame]

FEATURE_COLUMNS = ["product_id", "product_name_length", "product_description_length",
                   "product_photos_qty", "product_weight_g", "product_length_cm",
                   "product_height_cm", "product_width_cm", "category"]


def product_features(t: Tables) -> DataFrame:
    """Products with the English category (inner join: NULL or untranslated
    categories drop) and the column-name spelling fixed."""
    p = t["products"].join(t["product_category_name_translation"], "product_category_name")
    return p.select(
        "product_id",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm", F.col("product_category_name_english").alias("category"))


def _order_products(t: Tables) -> DataFrame:
    return t["order_items"].select("order_id", "product_id").na.drop().dropDuplicates()


def product_price(t: Tables) -> DataFrame:
    """product_id, price = mean item price."""
    i = t["order_items"].filter(F.col("product_id").isNotNull())
    return i.groupBy("product_id").agg(F.try_divide(money_sum("price"), F.count("price")).alias("price"))


def product_wait_time(t: Tables) -> DataFrame:
    """product_id, wait_time = mean wait of the delivered orders containing it
    (each order counted once per product)."""
    o = filter_delivered(t["orders"]).select(
        "order_id", micros_between("order_purchase_timestamp", "order_delivered_customer_date").alias("us"))
    return (_order_products(t).join(o, "order_id").groupBy("product_id")
            .agg((F.avg("us") / F.lit(MICROS_PER_DAY)).alias("wait_time")))


def product_review_score(t: Tables) -> DataFrame:
    """product_id, share_of_one_stars, share_of_five_stars, review_score over
    the reviews of the (distinct) orders containing the product."""
    g = (_order_products(t).join(reviews_per_order(t), "order_id").groupBy("product_id")
         .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_scored").alias("n_scored"),
              F.sum("sum_score").alias("sum_score"), F.sum("n1").alias("n1"), F.sum("n5").alias("n5")))
    return g.select("product_id",
                    (F.col("n1") / F.col("n_rows")).alias("share_of_one_stars"),
                    (F.col("n5") / F.col("n_rows")).alias("share_of_five_stars"),
                    F.try_divide(F.col("sum_score"), F.col("n_scored")).alias("review_score"))


def product_quantity(t: Tables) -> DataFrame:
    """product_id, n_orders (distinct orders), quantity (items)."""
    i = t["order_items"].filter(F.col("product_id").isNotNull())
    return i.groupBy("product_id").agg(F.count_distinct("order_id").alias("n_orders"),
                                       F.count("order_id").alias("quantity"))


def product_sales(t: Tables) -> DataFrame:
    i = t["order_items"].filter(F.col("product_id").isNotNull())
    return i.groupBy("product_id").agg(F.coalesce(money_sum("price"), F.lit(0.0)).alias("sales"))


def product_item_stats(t: Tables) -> DataFrame:
    """price (mean), n_orders, quantity and sales in one aggregation of the items."""
    i = t["order_items"].filter(F.col("product_id").isNotNull())
    return i.groupBy("product_id").agg(
        F.try_divide(money_sum("price"), F.count("price")).alias("price"),
        F.count_distinct("order_id").alias("n_orders"), F.count("order_id").alias("quantity"),
        F.coalesce(money_sum("price"), F.lit(0.0)).alias("sales"))


def training_data(t: Tables) -> DataFrame:
    """The 17-column product table (inner joins on product_id)."""
    parts = [product_features(t), product_wait_time(t), product_review_score(t), product_item_stats(t)]
    j = reduce(lambda a, b: a.join(b, "product_id"), parts)
    return j.select(*FEATURE_COLUMNS, "wait_time", "price", "share_of_one_stars", "share_of_five_stars",
                    "review_score", "n_orders", "quantity", "sales")


ROLLUP_COLUMNS = ["product_name_length", "product_description_length", "product_photos_qty",
                  "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                  "wait_time", "price", "share_of_one_stars", "share_of_five_stars", "review_score",
                  "n_orders", "quantity", "sales"]


def _category_medians(d: DataFrame) -> DataFrame:
    """Medians by distributed selection, so a category that holds most products
    isn't gathered in one buffer."""
    d = cut_lineage(d.select("category", *ROLLUP_COLUMNS).filter(F.col("category").isNotNull()))
    cols = [c for c in ROLLUP_COLUMNS if c != "quantity"]
    long = d.select("category", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ["category"], cols, "variable", "value")
    mid = exact_quantiles(long, "value", [0.5], by=["category", "variable"], stored=True)
    wide = mid.groupBy("category").pivot("variable", cols).agg(F.first("quantile"))
    total = d.groupBy("category").agg(F.sum("quantity").alias("quantity"))
    return total.join(wide, "category", "left").select("category", *ROLLUP_COLUMNS)


def category_rollup(t: Tables, agg: str = "mean") -> DataFrame:
    """One row per category: ``quantity`` summed, every other column averaged
    (``agg='mean'``) or its median (``agg='median'``, exact, interpolated)."""
    if agg not in ("mean", "median"):
        raise ValueError("agg must be 'mean' or 'median'")
    if agg == "median":
        return _category_medians(training_data(t))

    def one(c: str):
        if c == "quantity":
            return F.sum(c).alias(c)
        if c == "sales":  # money: exact mean
            return F.try_divide(money_sum(c), F.count(c)).alias(c)
        return F.avg(c).alias(c)
    exprs = [one(c) for c in ROLLUP_COLUMNS]
    return training_data(t).groupBy("category").agg(*exprs)


def product_pnl(t: Tables) -> DataFrame:
    """product_id, revenue (10% of sales), review_cost (reviews of the distinct
    orders containing the product), profits.  Products without reviews cost 0."""
    cost = (_order_products(t).join(reviews_per_order(t).select("order_id", "cost"), "order_id")
            .groupBy("product_id").agg(F.sum("cost").alias("review_cost")))
    j = product_sales(t).join(cost, "product_id", "left")
    rc = F.coalesce(F.col("review_cost"), F.lit(0)).cast("double")
    return j.select("product_id", (F.col("sales") * F.lit(SALES_CUT)).alias("revenue"),
                    rc.alias("review_cost"), (F.col("sales") * F.lit(SALES_CUT) - rc).alias("profits"))
