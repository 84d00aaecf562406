"""Adapter: the benchmark's TPC-H style tables -> the nine marketplace tables.

The rules are fixed by the fixture contract (they must equal the DuckDB oracle's
mapping).  Everything is a lazy projection/filter/union over the parquet scans,
so column pruning and filter push-down reach the files.  ``k`` = ``o_orderkey``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture contract.
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "canceled"}
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]  # by k % 4
UNTRANSLATED_CATEGORY = "brand#7"
GEO_ZIPS_PER_NATION = 20
GEO_DUPLICATES = 3


def _plus(ts: Column, days=0, hours=0, seconds=0) -> Column:
    """Wall-clock TIMESTAMP_NTZ + day-time interval (time-zone free)."""
    return ts + F.make_dt_interval(F.lit(days) if isinstance(days, int) else days,
                                   F.lit(hours) if isinstance(hours, int) else hours,
                                   F.lit(0),
                                   F.lit(seconds) if isinstance(seconds, int) else seconds)


def _case(col: Column, mapping: dict) -> Column:
    """A plain CASE WHEN chain: Catalyst folds ``CASE ... END = 'x'`` back to a
    predicate on the source column, which then reaches the parquet scan."""
    e = None
    for k, v in mapping.items():
        e = F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v))
    return e


def _unless(key: Column, modulus: int, remainder: int) -> Column:
    """The key, NULL for some orders: null keys must be dropped by every job."""
    return F.when(key % modulus != remainder, key)


class DriverTables:
    """Lazy catalog over ``/root/testdata/sf*/`` (or any folder of the same tables)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- orders -------------------------------------------------------------
    def _orders_base(self) -> DataFrame:
        o = self._raw("orders")
        k = F.col("o_orderkey")
        day0 = F.col("o_orderdate").cast("timestamp_ntz")
        pur = _plus(day0, seconds=((k * 7919) % 86400).cast("decimal(18,6)"))
        status = F.col("o_orderstatus")
        delivered_at = _plus(pur, hours=(72 + (k * 53) % 720).cast("int"))
        return o.select(
            k.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            _case(status, STATUS_BY_CODE).alias("order_status"),
            pur.alias("order_purchase_timestamp"),
            F.when(k % 97 != 0, _plus(pur, hours=((k * 31) % 48).cast("int"))).alias("order_approved_at"),
            F.when(status != "P", _plus(pur, hours=(24 + (k * 37) % 168).cast("int"))).alias("order_delivered_carrier_date"),
            F.when((status == "F") & (k % 101 != 0), delivered_at).alias("order_delivered_customer_date"),
            _plus(day0, days=(12 + (k * 17) % 25).cast("int")).alias("order_estimated_delivery_date"),
            F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_orderdate"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders_base().drop("o_orderpriority", "o_totalprice", "o_orderdate")

    @cached_property
    def order_items(self) -> DataFrame:
        li = self._raw("lineitem")
        return li.select(
            _unless(F.col("l_orderkey"), 229, 9).alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.when(F.col("l_orderkey") % 211 != 5, F.col("l_partkey")).alias("product_id"),
            F.when(F.col("l_orderkey") % 223 != 7, F.col("l_suppkey")).alias("seller_id"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_limit_date"),
            (F.col("l_extendedprice") / 160).alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax") / 160).alias("freight_value"),
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        o = self._orders_base()
        k = F.col("order_id")
        d = F.substring("o_orderpriority", 1, 1).cast("int")
        late = F.coalesce(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"), F.lit(False))
        creation = _plus(F.col("o_orderdate").cast("timestamp_ntz"), days=40)

        def rows(review_id: Column, score: Column) -> list[Column]:
            return [review_id.alias("review_id"), _unless(k, 233, 11).alias("order_id"),
                    score.cast("int").alias("review_score"),
                    F.when(k % 3 != 0, F.col("o_orderpriority")).alias("review_comment_title"),
                    F.when(k % 4 != 0, F.concat(F.lit("review "), k.cast("string"))).alias("review_comment_message"),
                    creation.alias("review_creation_date"),
                    _plus(creation, hours=(k % 72).cast("int")).alias("review_answer_timestamp")]

        base = o.filter(k % 50 != 0).select(*rows(2 * k, F.when(late & (k % 7 != 0), F.greatest(F.lit(1), d - 2)).otherwise(d)))
        second = o.filter(k % 200 == 1).select(*rows(2 * k + 1, 1 + k % 5))
        return base.unionByName(second)

    @cached_property
    def order_payments(self) -> DataFrame:
        o = self._raw("orders").filter(F.col("o_orderkey") % 303 != 0)
        k = F.col("o_orderkey")
        split = k % 10 == 0
        ptype = F.element_at(F.array(*[F.lit(t) for t in PAYMENT_TYPES]), (k % 4 + 1).cast("int"))
        # seq 1 always, seq 2 only for split orders: explode a 1- or 2-element array.
        seqs = F.when(split, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return (o.select(k.alias("order_id"), F.explode(seqs).alias("payment_sequential"),
                         ptype.alias("payment_type"),
                         (1 + k % 6).cast("int").alias("payment_installments"),
                         F.when(split, F.col("o_totalprice") / 2).otherwise(F.col("o_totalprice")).alias("payment_value")))

    @cached_property
    def customers(self) -> DataFrame:
        c = self._raw("customer")
        n = self._raw("nation").select("n_nationkey", "n_name")
        return (c.join(n, c.c_nationkey == n.n_nationkey)
                .select(F.col("c_custkey").alias("customer_id"),
                        F.col("c_custkey").alias("customer_unique_id"),
                        (F.col("c_nationkey") * 100 + F.col("c_custkey") % 20).cast("int").alias("customer_zip_code_prefix"),
                        F.col("c_mktsegment").alias("customer_city"),
                        F.col("n_name").alias("customer_state")))

    @cached_property
    def sellers(self) -> DataFrame:
        s = self._raw("supplier")
        n = self._raw("nation").select("n_nationkey", "n_name")
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .select(F.col("s_suppkey").alias("seller_id"),
                        (F.col("s_nationkey") * 100 + F.col("s_suppkey") % 20).cast("int").alias("seller_zip_code_prefix"),
                        F.col("s_name").alias("seller_city"),
                        F.col("n_name").alias("seller_state")))

    @cached_property
    def geolocation(self) -> DataFrame:
        n = self._raw("nation")
        g = (n.select("n_nationkey", "n_name",
                      F.explode(F.sequence(F.lit(0), F.lit(GEO_ZIPS_PER_NATION - 1))).alias("z"))
             .filter(~((F.col("z") == GEO_ZIPS_PER_NATION - 1) & (F.col("n_nationkey") % 2 == 0)))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(GEO_DUPLICATES - 1))).alias("dup")))
        nk, z, dup = F.col("n_nationkey"), F.col("z"), F.col("dup")
        lat = F.lit(-30.0) + nk + z * F.lit(0.05) + dup * F.lit(0.01)
        lng = F.lit(-70.0) + nk * F.lit(1.5) + z * F.lit(0.03) + dup * F.lit(0.02)
        return g.select((nk * 100 + z).cast("int").alias("geolocation_zip_code_prefix"),
                        F.when(~((z == 7) & (dup == 0)), lat).alias("geolocation_lat"),
                        lng.alias("geolocation_lng"),
                        F.col("n_name").alias("geolocation_city"),
                        F.col("n_name").alias("geolocation_state"),
                        dup.cast("long").alias("geo_seq"))

    @cached_property
    def products(self) -> DataFrame:
        p = self._raw("part")
        pk, size = F.col("p_partkey"), F.col("p_size")
        return p.select(
            pk.alias("product_id"),
            F.when(pk % 70 != 0, F.lower("p_brand")).alias("product_category_name"),
            F.length("p_name").cast("int").alias("product_name_lenght"),
            (size * 20 + pk % 13).cast("int").alias("product_description_lenght"),
            (1 + pk % 6).cast("int").alias("product_photos_qty"),
            F.when(pk % 89 != 0, (size * 100).cast("double")).alias("product_weight_g"),
            (10 + size % 30).cast("double").alias("product_length_cm"),
            (5 + pk % 20).cast("double").alias("product_height_cm"),
            (8 + pk % 25).cast("double").alias("product_width_cm"),
        )

    @cached_property
    def product_category_name_translation(self) -> DataFrame:
        cat = F.lower("p_brand")
        return (self._raw("part").select(cat.alias("product_category_name")).distinct()
                .filter(F.col("product_category_name") != UNTRANSLATED_CATEGORY)
                .select("product_category_name",
                        F.concat(F.lit("cat_"), F.col("product_category_name")).alias("product_category_name_english")))

    def catalog(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in (
            "customers", "geolocation", "order_items", "order_payments", "order_reviews",
            "orders", "products", "sellers", "product_category_name_translation")}


def driver_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return DriverTables(spark, sf_dir).catalog()
