"""Catalog of marketplace tables: CSV/parquet folders -> ``dict[str, DataFrame]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quoted_csv import read_quoted_csv
from .schemas import SCHEMAS

#: Tables whose fields may hold line breaks.
MULTI_LINE_KEYS = {"order_reviews"}


def table_key(file_name: str) -> str:
    """File name -> catalog key: drop the ``olist_`` prefix, the ``_dataset``
    infix and the extension (``olist_order_items_dataset.csv`` -> ``order_items``)."""
    base = file_name.rsplit("/", 1)[-1]
    for ext in (".csv", ".parquet"):
        if base.endswith(ext):
            base = base[: -len(ext)]
    return base.replace("olist_", "").replace("_dataset", "")


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """List ``folder`` through the Hadoop FileSystem (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().toString() for st in fs.listStatus(path)
                  if st.getPath().getName().endswith(suffix))


def read_csv(spark: SparkSession, path: str, key: str | None = None, strict: bool = False) -> DataFrame:
    """Read one marketplace CSV by the names in its header, typed by the explicit
    schema.  A missing column fails, further columns are left out.  A value that
    doesn't parse becomes NULL, or fails when ``strict``.

    All tables are read in parallel splits, also review texts that hold line breaks
    (see ``quoted_csv``)."""
    key = key or table_key(path)
    options = {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    reader = spark.read.option("header", True).options(**options)
    if key not in SCHEMAS:
        return reader.csv(path)
    wanted = SCHEMAS[key]
    header = reader.csv(path).columns                       # reads the first line only
    missing = [f.name for f in wanted.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    in_file = T.StructType([wanted[c] if c in wanted.names else T.StructField(c, T.StringType()) for c in header])
    options["mode"] = "FAILFAST" if strict else "PERMISSIVE"
    if key in MULTI_LINE_KEYS:
        return read_quoted_csv(spark, path, in_file, options).select(*wanted.names)
    df = reader.schema(in_file).option("mode", options["mode"]).csv(path)
    if key == "geolocation":
        df = with_file_order(df, "geo_seq")
        return df.select(*wanted.names, "geo_seq")
    return df.select(*wanted.names)


def with_file_order(df: DataFrame, name: str) -> DataFrame:
    """Attach a deterministic file-order key: (file, split start, row id within
    the task).  Rows of one split are read sequentially by one task, so the
    triple orders rows as they appear in the file without any shuffle."""
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("f"),
                                        F.col("_metadata.file_block_start").alias("b"),
                                        F.monotonically_increasing_id().alias("r")))


def load_tables(spark: SparkSession, folder: str, fmt: str = "csv", strict: bool = False) -> dict[str, DataFrame]:
    """Every ``*.csv`` (or ``*.parquet``) file of ``folder`` as a lazy DataFrame,
    keyed by :func:`table_key`.  Nothing is scanned until a job needs it."""
    suffix = "." + fmt
    out: dict[str, DataFrame] = {}
    for path in list_files(spark, folder, suffix):
        key = table_key(path)
        if fmt == "csv":
            out[key] = read_csv(spark, path, key, strict)
        else:
            df = spark.read.parquet(path)
            out[key] = with_file_order(df, "geo_seq") if key == "geolocation" and "geo_seq" not in df.columns else df
    return out


def parse_timestamps(df: DataFrame, columns: list[str], fmt: str | None = None,
                     strict: bool = False) -> DataFrame:
    """String -> TIMESTAMP_NTZ for ``columns``.  Bad input becomes NULL, or
    raises when ``strict`` (the behaviour of ``pd.to_datetime``)."""
    def conv(c: Column) -> Column:
        if fmt is None:
            return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")
        parsed = F.to_timestamp_ntz(c, F.lit(fmt)) if strict else F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
        return parsed
    return df.withColumns({c: conv(F.col(c)) for c in columns})
