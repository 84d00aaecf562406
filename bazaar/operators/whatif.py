"""Seller-removal what-if: remove the k least profitable sellers, for every k.

The ranking (profits ascending, seller_id as tie-break) needs a global prefix
sum.  A bare ``Window.orderBy`` would pull every seller into one task, so it
runs in two phases:

1. ``repartitionByRange(profits, seller_id)``: Spark samples the composite key,
   so even a third of the sellers sharing one profit value are split across
   partitions by seller_id; each range partition is numbered
   (``spark_partition_id``) and gets local running sums through a window
   partitioned by that number.  The result is checkpointed, pinning the
   partition numbers.
2. Per-partition totals (one row per partition, bounded by the partition
   count) become exclusive offsets and are joined back.

Grand totals are scalar subqueries.  Output for k = 0..N sellers removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import IT_COST_TOTAL_BRL
from ..session import cut_lineage

SUMMED = ("revenues", "costs", "n_orders")


def prefix_sums(df: DataFrame, order: list[str], cols: tuple[str, ...],
                num_partitions: int | None = None) -> DataFrame:
    """Adds ``k`` (1-based rank by ``order``) and ``cum_<col>`` inclusive prefix sums."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", F.count(F.lit(1)).over(w).alias("_lk"),
                          *[F.sum(c).over(w).alias(f"_l_{c}") for c in cols])
    local = cut_lineage(local)
    totals = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_tk"), *[F.sum(c).alias(f"_t_{c}") for c in cols])
    wo = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)   # <= #partitions rows
    offsets = totals.select("_pid", F.coalesce(F.sum("_tk").over(wo), F.lit(0)).alias("_ok"),
                            *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}") for c in cols])
    out = local.join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, (F.col("_ok") + F.col("_lk")).alias("k"),
                      *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"cum_{c}") for c in cols])


def seller_removal_whatif(sellers: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``sellers``: seller_id, revenues, costs, profits, n_orders.  Sellers
    without a profit figure are left out of the ranking.  For each k: the k-th
    removed seller, kept revenues / costs / gross profit / orders, IT cost =
    500000 / sqrt(N_all) x sqrt(N_kept) and net profit."""
    # One row per seller: small next to the item data it was aggregated from.
    # Materialized once so ranking, totals and offsets all read the same rows.
    s = cut_lineage(sellers.filter(F.col("profits").isNotNull()).select("seller_id", "profits", *SUMMED))
    tot = s.agg(*[F.sum(c).alias(c) for c in SUMMED])
    totals = tot.select(F.struct(*SUMMED)).scalar()   # one scalar subquery, reused
    t_rev, t_cost, t_n = (totals.getField(c) for c in SUMMED)
    ranked = prefix_sums(s, ["profits", "seller_id"], SUMMED, num_partitions)
    steps = ranked.select("k", F.col("seller_id").alias("removed_seller_id"),
                          (t_rev - F.col("cum_revenues")).alias("revenues"),
                          (t_cost - F.col("cum_costs")).alias("costs"),
                          (t_n - F.col("cum_n_orders")).alias("n_orders"))
    zero = tot.select(F.lit(0).cast("long").alias("k"), F.lit(None).cast(s.schema["seller_id"].dataType).alias("removed_seller_id"),
                      *[F.col(c) for c in SUMMED])
    allk = zero.unionByName(steps)
    it = F.lit(IT_COST_TOTAL_BRL) / F.sqrt(t_n) * F.sqrt(F.col("n_orders"))
    return allk.select("k", "removed_seller_id", "revenues", "costs",
                       (F.col("revenues") - F.col("costs")).alias("gross_profit"), "n_orders",
                       it.alias("it_cost"), (F.col("revenues") - F.col("costs") - it).alias("net_profit"))


def whatif_best(whatif: DataFrame) -> DataFrame:
    """The k with the highest net profit (smallest k on ties)."""
    best = whatif.agg(F.max_by(F.struct("k", "net_profit", "revenues", "costs", "n_orders", "it_cost"),
                               F.struct("net_profit", -F.col("k"))).alias("b"))
    return best.select("b.*")


def whatif_rule(sellers: DataFrame, min_profit: float = 0.0, loss_floor: float = -700.0,
                revenue_floor: float = 5000.0) -> DataFrame:
    """One scenario: keep sellers with profit > min_profit, or profit >
    loss_floor and revenues > revenue_floor.  1 row of kept totals and IT cost."""
    p, r = F.col("profits"), F.col("revenues")
    keep = (p > min_profit) | ((p > loss_floor) & (r > revenue_floor))
    t_n = sellers.agg(F.sum("n_orders")).scalar()
    k = sellers.filter(keep).agg(F.count(F.lit(1)).alias("n_sellers"), F.sum("revenues").alias("revenues"),
                                 F.sum("costs").alias("costs"), F.sum("profits").alias("profits"),
                                 F.sum("n_orders").alias("n_orders"))
    it = F.lit(IT_COST_TOTAL_BRL) / F.sqrt(t_n) * F.sqrt(F.col("n_orders"))
    return k.select("*", it.alias("it_cost"), (F.col("profits") - it).alias("net_profit"))


def sort_by_profit(sellers: DataFrame, ascending: bool = True) -> DataFrame:
    o = F.asc("profits") if ascending else F.desc("profits")
    return sellers.orderBy(o, "seller_id")


def remove_worst_sellers(sellers: DataFrame, n: int) -> DataFrame:
    """All sellers but the n least profitable (a distributed top-n, anti-joined)."""
    worst = sellers.filter(F.col("profits").isNotNull()).orderBy("profits", "seller_id").limit(n).select("seller_id")
    return sellers.join(worst, "seller_id", "left_anti")


def filter_profit_band(sellers: DataFrame, lo: float, hi: float) -> DataFrame:
    """lo < profits < hi (open interval)."""
    return sellers.filter((F.col("profits") > lo) & (F.col("profits") < hi))
