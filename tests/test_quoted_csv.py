"""Records cut from splits equal those of the one-task ``multiLine`` reader."""
import random

import pytest
from pyspark.sql import types as T

from bazaar.sources.catalog import load_tables, read_csv
from bazaar.sources.quoted_csv import quoted_records, read_quoted_csv

OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}
SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])


def csv_text(seed, rows, end="\n"):
    rng = random.Random(seed)
    out = ["a,b,c"]
    for k in range(rows):
        text = "".join(rng.choice(["x", "é", " ", ",", '""', "\n", end, "word"]) for _ in range(rng.choice([0, 3, 12, 12, 400])))
        kind = rng.randrange(6)
        field = f'"{text}"' if kind < 4 else "" if kind == 4 else '""'
        out.append(rng.choice([f"{k},{field},z{k}", f"{k},{field},", f"{k},plain,{field}", f"{k},{field}", f"x{k},{field},1,extra", ""]))
    return end.join(out) + (end if seed % 2 else "")


@pytest.fixture(params=[40, 300, 10_000_000])
def split_bytes(spark, request):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], request.param)
    spark.conf.set(keys[1], 1)
    yield request.param
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def as_set(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_multi_line(spark, tmp_path, split_bytes, end):
    for k in range(3):
        (tmp_path / f"part{k}.csv").write_bytes(csv_text(k, 60, end).encode())
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA, OPTIONS)
    want = spark.read.schema(SCHEMA).options(header=True, multiLine=True, **OPTIONS).csv(str(tmp_path))
    assert as_set(got) == as_set(want)
    assert got.count() > 100
    if split_bytes < 1000:
        assert quoted_records(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_records_over_many_splits(spark, tmp_path, split_bytes):
    long = "line of it\n" * 300
    (tmp_path / "t.csv").write_text(f'a,b,c\n1,"{long}",x\n2,"{long}{long}",y\n3,b,"{long}"')
    got = {r.a: (r.b, r.c) for r in read_quoted_csv(spark, str(tmp_path), SCHEMA, OPTIONS).collect()}
    assert got == {1: (long, "x"), 2: (long * 2, "y"), 3: ("b", long)}


def test_odd_quotes_fail(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c\n1,"open,x\n2,y,z\n')
    with pytest.raises(Exception, match="odd number of quotes"):
        read_quoted_csv(spark, str(tmp_path), SCHEMA, OPTIONS).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n")
    (tmp_path / "u.csv").write_text("")
    assert read_quoted_csv(spark, str(tmp_path), SCHEMA, OPTIONS).collect() == []


def test_catalog_reads_reviews_in_splits(spark, tmp_path, split_bytes):
    rows = "".join(f'r{k},o{k},{k % 5 + 1},t,"so ""good""\n{"very " * k}",2018-01-01 00:00:00,bad\n' for k in range(50))
    path = tmp_path / "olist_order_reviews_dataset.csv"
    path.write_text("review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
                    "review_answer_timestamp\n" + rows)
    got = {r.review_id: r for r in load_tables(spark, str(tmp_path))["order_reviews"].collect()}
    assert len(got) == 50 and got["r3"].review_comment_message == 'so "good"\nvery very very '
    assert got["r3"].review_score == 4 and got["r3"].review_answer_timestamp is None
    with pytest.raises(Exception):
        read_csv(spark, str(path), strict=True).collect()
