"""Shared-folder tables and Arrow-to-numpy helpers used by the operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.session import ensure_checkpoint_dir

#: Bytes of text handled by one vectorised numpy step (not a cap: longer texts
#: form a step of their own).
STEP_BYTES = 1 << 19


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Paths made within each open block of ``temporary_tables``.
_blocks: list[list[str]] = []


_last: list[str] = [""]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _last[0] = path
    if _blocks:
        _blocks[-1].append(path)
    return path


def last_path() -> str:
    """The path that was made last."""
    return _last[0]


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver forget frames that nothing refers to any more: Spark's cleaner
    then removes their shuffle files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that are stored within the block are removed at its end.  What is read
    after the block must have been stored at a path made before it."""
    free_shuffles(spark)
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            remove(spark, path)
        free_shuffles(spark)


def settled(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make()`` returns, stored at ``path``; tables that it stored on its way go."""
    with temporary_tables(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
        del df
    return spark.read.schema(schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: later
    steps neither recompute it nor depend on any single executor."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory of Arrow and numpy to the system (as far as the C library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function for mapInArrow, that gives freed memory back after each batch
    and at its end.  Spark keeps its Python workers for the next tasks and stages; what
    their allocators keep would count against the executor all the time."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from run(fed())
        give_back()
    return whole


#: Bytes of an Arrow batch within ``modest_batches`` (a larger row is a batch of its own).
BATCH_BYTES = 4 << 20


@contextmanager
def modest_batches(spark: SparkSession):
    """Jobs that run within the block send Python workers at most ``BATCH_BYTES`` at a
    time: a worker, and the JVM beside it, hold a few copies of a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    if not 0 < spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) <= BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_steps(column: pa.Array, max_bytes: int = STEP_BYTES
               ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``max_bytes``.

    Yields (first row, end row, UTF-8 bytes as uint8, row offsets into them).
    Null texts count as empty.  A text longer than ``max_bytes`` is a run of
    one row, so every text is whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


#: Name of the row number that ties an operator's verdict to an input row.
ROW = "__bazaar_row_number"


def with_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row in column ``ROW``: its own, if ``numbered`` stored
    it with one.  Else the numbers are those of one reading; another may split files
    differently.  A column of ``docs`` that happens to have this name isn't a number."""
    own = getattr(docs, "row_name", None)
    return docs.withColumn(ROW, F.col(own) if own else F.monotonically_increasing_id())


#: Paths of files that may be sent to every task, in characters of all their names.
PATHS_SENT = 32 << 20


def _is_parquet_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` is nothing but a read of Parquet files."""
    plan = docs._jdf.queryExecution().analyzed()
    return (plan.getClass().getSimpleName() == "LogicalRelation"
            and "parquet" in plan.relation().toString().lower())


def numbered(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or some of its columns) with a number per row that every job reads
    alike, on any executor and in any splits, also where ids are null or repeated.

    Rows of Parquet files are numbered by file and place in the file, without a copy;
    the files, as many as Spark's own list of them, are joined by path, broadcast up
    to ``PATHS_SENT``.  Any other frame is stored with its numbers."""
    columns = columns or docs.columns
    name = ROW
    while name in docs.columns:
        name += "_"
    if _is_parquet_scan(docs) and not {"_metadata"} & set(docs.columns):
        paths = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
        files = docs.sparkSession.createDataFrame(list(enumerate(paths)), "__file long, __path string")
        if sum(map(len, paths)) <= PATHS_SENT:
            files = F.broadcast(files)
        placed = docs.select(*columns, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__at"))
        stored = placed.join(files, "__path").select(
            *columns, (F.shiftleft("__file", 36) + F.col("__at")).alias(name))
    else:
        stored = materialize(docs.select(*columns, F.monotonically_increasing_id().alias(name)), "numbered")
    stored.row_name = name
    return stored


#: Row numbers that may be sent to every task; more are joined by shuffling.
LOST_SENT = 2_000_000


def without_rows(stored: DataFrame, lost: DataFrame) -> DataFrame:
    """A ``numbered`` frame without the rows in column ``row`` of ``lost``.  Up to
    ``LOST_SENT`` numbers, which are counted first, are broadcast, so that texts stay
    where they are; beyond that both sides are shuffled."""
    name = stored.row_name
    gone = lost.select(F.col("row").alias(name))
    if gone.count() <= LOST_SENT:
        gone = F.broadcast(gone)
    return stored.join(gone, name, "left_anti").drop(name)
