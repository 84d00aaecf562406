import os
import tempfile

import pytest

from bazaar.sources.catalog import load_tables, parse_timestamps, table_key


def test_table_key():
    assert table_key("olist_order_items_dataset.csv") == "order_items"
    assert table_key("/x/product_category_name_translation.csv") == "product_category_name_translation"


def test_csv_multiline_quotes_and_timestamps(spark):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    with open(os.path.join(d, "olist_order_reviews_dataset.csv"), "w") as f:
        f.write("review_id,order_id,review_score,review_comment_title,review_comment_message,"
                "review_creation_date,review_answer_timestamp\n")
        f.write('r1,o1,4,,"line one\nline ""two""",2018-01-18 00:00:00,2018-01-18 21:46:59\n')
        f.write("r2,o2,5,t,ok,2018-03-10 00:00:00,not-a-date\n")
    t = load_tables(spark, d)
    assert list(t) == ["order_reviews"]
    rows = {r.review_id: r for r in t["order_reviews"].collect()}
    assert rows["r1"].review_comment_message == 'line one\nline "two"'
    assert rows["r1"].review_score == 4 and str(rows["r1"].review_answer_timestamp) == "2018-01-18 21:46:59"
    assert rows["r2"].review_answer_timestamp is None


def test_parse_timestamps_lenient(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("garbage",)], "ts string")
    got = [r.ts for r in parse_timestamps(df, ["ts"]).collect()]
    assert str(got[0]) == "2017-10-02 10:56:33" and got[1] is None


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_csv_is_read_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    _write(d, "olist_sellers_dataset.csv", "seller_state,extra,seller_id,seller_city,seller_zip_code_prefix\nSP,x,s1,campinas,13023\n")
    row = load_tables(spark, d)["sellers"].first()
    assert (row.seller_id, row.seller_zip_code_prefix, row.seller_city, row.seller_state) == ("s1", 13023, "campinas", "SP")
    assert "extra" not in row


def test_csv_missing_column_fails(spark):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    _write(d, "olist_sellers_dataset.csv", "seller_id,seller_city,seller_state\ns1,campinas,SP\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        load_tables(spark, d)


def test_strict_csv_fails_on_bad_values(spark):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    _write(d, "olist_sellers_dataset.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,abc,campinas,SP\n")
    assert load_tables(spark, d)["sellers"].first().seller_zip_code_prefix is None
    with pytest.raises(Exception, match="(?i)malformed"):
        load_tables(spark, d, strict=True)["sellers"].collect()


def test_csv_files_are_split(spark):
    d = tempfile.mkdtemp(prefix="bazaar-csv-")
    head = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    _write(d, "olist_order_items_dataset.csv", head + "o1,1,p1,s1,2018-01-18 00:00:00,1.5,0.5\n" * 40_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        t = load_tables(spark, d)["order_items"]
        assert t.rdd.getNumPartitions() > 1 and t.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parquet_geolocation_has_file_order(spark):
    from bazaar.operators.orders import geo_first
    d = tempfile.mkdtemp(prefix="bazaar-pq-")
    spark.createDataFrame([(1, None, 2.0, "a", "x"), (1, 5.0, 3.0, "b", "x")],
                          "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
                          "geolocation_city string, geolocation_state string").coalesce(1).write.parquet(f"{d}/geolocation.parquet")
    row = geo_first(load_tables(spark, d, fmt="parquet")).first()
    assert (row.geolocation_lat, row.geolocation_lng, row.geolocation_city) == (5.0, 2.0, "a")
