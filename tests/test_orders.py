from bazaar.operators import orders as O
from frames import catalog, item, order, review


def test_null_delivery_gives_zero_delay_and_is_dropped(spark):
    t = catalog(spark, orders=[order("o1", dlv=None), order("o2", dlv="2017-01-12 00:00:00")],
                order_items=[item("o1", 1), item("o2", 1)],
                order_reviews=[review("r1", "o1", 5), review("r2", "o2", 1)])
    w = {r.order_id: r for r in O.wait_time(t).collect()}
    assert w["o1"].delay_vs_expected == 0.0 and w["o1"].wait_time is None
    assert w["o2"].delay_vs_expected == 2.0 and w["o2"].wait_time == 11.0
    ids = [r.order_id for r in O.training_data(t).collect()]
    assert ids == ["o2"]


def test_two_reviews_fan_out_and_missing_review_count(spark):
    t = catalog(spark, orders=[order("o1", dlv="2017-01-05 00:00:00"), order("o2", dlv="2017-01-05 00:00:00")],
                order_items=[item("o1", 1), item("o2", 1)],
                order_reviews=[review("r1", "o1", 5), review("r2", "o1", 3)])
    assert O.training_data(t).count() == 2
    assert O.missing_reviews(t).first()[0] == 1


def test_item_stats_counts(spark):
    t = catalog(spark, order_items=[item("o1", 1, "p1", "s1", 10.0), item("o1", 2, "p1", "s1", 10.0),
                                    item("o1", 3, "p2", "s2", 5.5)])
    r = O.item_stats(t).first()
    assert (r.number_of_products, r.number_of_sellers, r.price, r.freight_value) == (3, 2, 25.5, 3.0)


def test_whole_days_floor_and_clip(spark):
    t = catalog(spark, orders=[order("o1", pur="2017-01-01 00:00:00", dlv="2017-01-09 23:00:00",
                                     est="2017-01-10 00:00:00")])
    r = O.wait_time(t, mode="whole_days").first()
    assert (r.wait_time, r.expected_wait_time, r.delay_vs_expected) == (8.0, 9.0, 0.0)
    t2 = catalog(spark, orders=[order("o1", pur="2017-01-02 00:00:00", dlv="2017-01-01 23:00:00")])
    assert O.wait_time(t2, mode="whole_days").first().wait_time == -1.0


def test_geo_first_non_null_per_column(spark):
    geo = [(10, None, -46.0, "a", "SP", 0), (10, -23.5, -47.0, "b", "SP", 1), (10, -23.6, -48.0, "c", "SP", 2)]
    t = catalog(spark)
    t["geolocation"] = spark.createDataFrame(
        geo, "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
             "geolocation_city string, geolocation_state string, geo_seq long")
    r = O.geo_first(t).first()
    assert (r.geolocation_lat, r.geolocation_lng, r.geolocation_city) == (-23.5, -46.0, "a")
