"""The bucketed layout: same rows, no exchange on order_id."""
import re

import pytest

from bazaar.operators import orders
from bazaar.plans.registry import stable_doubles
from bazaar.sources.driver_tables import driver_catalog
from bazaar.sources.layout import ORDER_TABLES, read_order_layout, with_order_layout, write_order_layout

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain(spark):
    return driver_catalog(spark, SF)


@pytest.fixture(scope="module")
def bucketed(spark, plain, tmp_path_factory):
    return with_order_layout(plain, 6, str(tmp_path_factory.mktemp("layout")))


def rows(df):
    return sorted(map(str, stable_doubles(df).collect()))


def exchanges(spark, df):
    """Keys of the shuffles of the plan, when no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_training_data_joins_in_place(spark, plain, bucketed):
    assert any("order_id" in x for x in exchanges(spark, orders.training_data(plain)))
    assert exchanges(spark, orders.training_data(bucketed)) == []
    assert rows(orders.training_data(bucketed)) == rows(orders.training_data(plain))


def test_other_order_jobs(spark, plain, bucketed):
    for job in (orders.missing_reviews, orders.orders_with_reviews, orders.item_stats):
        assert exchanges(spark, job(bucketed)) == []
        assert rows(job(bucketed)) == rows(job(plain))
    assert rows(orders.training_data(bucketed, with_distance=True)) == rows(orders.training_data(plain, with_distance=True))


def test_layout_is_replaced(spark, plain, tmp_path):
    some = {k: plain[k] for k in (*ORDER_TABLES, "sellers")}
    write_order_layout(some, "again", 3, str(tmp_path))
    write_order_layout({k: v.limit(5) for k, v in some.items()}, "again", 4, str(tmp_path))
    got = read_order_layout(spark, some, "again")
    assert all(got[k].count() == 5 for k in ORDER_TABLES) and got["sellers"] is some["sellers"]
    for k in ORDER_TABLES:
        spark.sql(f"DROP TABLE again_{k}")
