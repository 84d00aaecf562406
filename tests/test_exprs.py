from pyspark.sql import functions as F

from bazaar.functions import exprs as X


def test_round_half_even_numpy_semantics(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (0.125,), (2.675,)], "x double")
    got = [r[0] for r in df.select(X.round_half_even("x", 0).alias("r0")).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0, 3.0]
    got2 = [r[0] for r in df.select(X.round_half_even("x", 2)).collect()]
    import numpy as np
    assert got2 == [float(np.round(v, 2)) for v in (0.5, 1.5, 2.5, 0.125, 2.675)]  # pandas rounding


def test_haversine_known_distance(spark):
    # Paris -> London ~ 343.5 km
    df = spark.createDataFrame([(2.3522, 48.8566, -0.1276, 51.5072)], "a double, b double, c double, d double")
    d = df.select(X.haversine_km("a", "b", "c", "d")).first()[0]
    assert abs(d - 343.5) < 1.0


def test_week_labels(spark):
    df = spark.createDataFrame([("2017-01-01 23:59:00",), ("2017-01-02 00:00:00",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("ts"))
    r = df.select(X.week_label_sun("ts").cast("string"), X.week_label_mon("ts").cast("string")).collect()
    # Sunday 2017-01-01 closes the 'W' week; Monday 2017-01-02 closes a 'W-MON' week
    assert [tuple(x) for x in r] == [("2017-01-01", "2017-01-02"), ("2017-01-08", "2017-01-02")]


def test_promoter_and_review_cost(spark):
    df = spark.createDataFrame([(s,) for s in (1, 2, 3, 4, 5, None)], "s int")
    r = df.select(X.promoter_score("s"), X.promoter_score("s", null_as_zero=False), X.review_cost("s")).collect()
    assert [tuple(x) for x in r] == [(-1, -1, 100), (-1, -1, 50), (-1, -1, 40), (0, 0, 0), (1, 1, 0), (0, None, 0)]


def test_months_half_even(spark):
    df = spark.createDataFrame([("2017-01-01 00:00:00", "2017-02-15 05:15:00")], "a string, b string") \
        .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    # 45.21875 days / 30.436875 = 1.4857 -> 1
    assert df.select(X.months_between_avg("a", "b")).first()[0] == 1.0
