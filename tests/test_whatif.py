import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaar.operators import whatif as W


def _sellers(spark, n=300):
    rows = [(f"s{i:04d}", float((i * 37) % 101 - 50), float((i * 13) % 7), float((i * 37) % 101 - 50) - float((i * 13) % 7) + 0.0,
             int(1 + i % 5)) for i in range(n)]
    # many equal profits (ties broken by seller_id)
    return spark.createDataFrame(rows, "seller_id string, revenues double, costs double, profits double, n_orders long")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_prefix_sums_equal_plain_window(spark, parts):
    s = _sellers(spark)
    got = W.prefix_sums(s, ["profits", "seller_id"], ("revenues", "n_orders"), parts) \
        .select("seller_id", "k", "cum_revenues", "cum_n_orders").collect()
    w = Window.orderBy("profits", "seller_id").rowsBetween(Window.unboundedPreceding, 0)
    exp = s.select("seller_id", F.row_number().over(w).alias("k"), F.sum("revenues").over(w).alias("cum_revenues"),
                   F.sum("n_orders").over(w).alias("cum_n_orders")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp))  # integral values: exact


def test_whatif_has_k0_and_best(spark):
    s = _sellers(spark, 50)
    w = W.seller_removal_whatif(s, 4)
    assert w.count() == 51
    r0 = w.filter("k = 0").first()
    assert r0.n_orders == s.agg(F.sum("n_orders")).first()[0]
    assert r0.it_cost == pytest.approx(500000.0)
    best = W.whatif_best(w).first()
    assert best.net_profit == w.agg(F.max("net_profit")).first()[0]
