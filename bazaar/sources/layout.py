"""A stored layout of the order tables in which joins on order_id need no shuffle.

Each table that has an order_id is written once as Parquet in the same number of
buckets by a hash of order_id, sorted within the bucket.  Spark reads a bucket as a
partition, so the chain of joins and aggregations by order_id that every order feature
table is made of runs where the rows are: bucket i of all tables meets in one task.  The
shuffle is paid at writing, once, instead of per job and table.

Choose ``buckets`` such that a bucket of the largest table is some 100 to 200 MB; it is
also the number of tasks of such a job.  Rows without an order_id share a bucket (they
join nothing).  A single order never holds more than its own items, so buckets are even.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_KEY = "order_id"
ORDER_TABLES = ("orders", "order_items", "order_reviews", "order_payments")


def _name(prefix: str, key: str) -> str:
    return f"{prefix}_{key}"


def write_order_layout(tables: dict[str, DataFrame], prefix: str, buckets: int, path: str | None = None) -> None:
    """Write the order tables of ``tables`` as tables ``<prefix>_<key>`` of the session's
    catalog, below ``path`` or in the warehouse.  Existing tables are replaced."""
    for key in ORDER_TABLES:
        if key not in tables:
            continue
        # one task per bucket, so that a bucket is one file
        dealt = tables[key].repartition(buckets, F.col(ORDER_KEY))
        writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, ORDER_KEY).sortBy(ORDER_KEY)
        if path:
            writer = writer.option("path", f"{path}/{key}")
        writer.saveAsTable(_name(prefix, key))


def read_order_layout(spark: SparkSession, tables: dict[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    """``tables`` with the order tables read from the layout ``prefix``."""
    out = dict(tables)
    for key in ORDER_TABLES:
        if key in tables:
            out[key] = spark.table(_name(prefix, key)).select(*tables[key].columns)
    return out


def with_order_layout(tables: dict[str, DataFrame], buckets: int, path: str | None = None) -> dict[str, DataFrame]:
    """``tables`` with the order tables written to a new layout and read from it."""
    spark = next(iter(tables.values())).sparkSession
    prefix = f"layout_{uuid.uuid4().hex}"
    write_order_layout(tables, prefix, buckets, path)
    return read_order_layout(spark, tables, prefix)
