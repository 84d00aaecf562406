"""Exact de-duplication by a Grace hash partitioning of whole contents.

1. Every map task lower-cases A-Z, puts contents into an open-addressing table
   and writes one row per document, the content only at the first row of each
   group of its table (``leader``).  Copies are thus combined before any
   shuffle: a text that fills a third of the corpus leaves one leader per task
   and table.  These rows are the first spill files, a table in the shared
   folder.
2. Leaders are partitioned by a prefix of their SHA-256 digest.  The prefix is
   chosen so that buckets fit ``BUCKET_BYTES``; buckets that don't are written
   to new spill files and partitioned by a longer prefix, until each fits or has
   one digest only.
3. Each bucket is read into a fresh open-addressing table, which compares
   complete contents; a bucket is in memory only while it is read.

Defined cases: null text is empty text; of equal texts the row with the largest
id stays (null ids lose; among rows with the same id one stays); further columns
are ignored here and kept by ``drop_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

TABLE_BYTES = 24 << 20    # contents in a map task's table before it is written out
BUCKET_BYTES = 16 << 20   # contents that a bucket's table may hold
PREFIX_STEP = 1           # hex digits that a recursion adds: 16 children per bucket


class ContentTable:
    """Open addressing with linear probing; equal means equal complete contents."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.n_bytes = 0

    def _grow(self):
        size = 4 * len(self.slots)
        slots = [-1] * size
        for i, h in enumerate(self.hashes):
            at = h & (size - 1)
            while slots[at] >= 0:
                at = (at + 1) & (size - 1)
            slots[at] = i
        self.slots = slots

    def place(self, h: int, content: bytes) -> tuple[int, bool]:
        """(index of this content, whether it is new)."""
        mask = len(self.slots) - 1
        at = h & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return i, False
            at = (at + 1) & mask
        i = len(self.contents)
        self.slots[at] = i
        self.hashes.append(h)
        self.contents.append(content)
        self.n_bytes += len(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return i, True


ROWS = "key long, id long, leader long, sha string, content binary, n long, top_id long, top_key long"
VERDICT = "leader long, keep_id long, keep_key long, group_size long"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (key, id, text) to ROWS, combined within the task."""
    def rows():
        at_leader = {leader: g for g, leader in enumerate(leaders)}
        g_of = [at_leader.get(k) for k in keys]
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array([leaders[g] for g in groups], pa.int64()),
            pa.array([shas[g] for g in groups], pa.string()),
            pa.array([None if g is None else table.contents[g] for g in g_of], pa.binary()),
            pa.array([None if g is None else counts[g] for g in g_of], pa.int64()),
            pa.array([None if g is None else tops[g][1] for g in g_of], pa.int64()),
            pa.array([None if g is None else tops[g][2] for g in g_of], pa.int64())],
            names=["key", "id", "leader", "sha", "content", "n", "top_id", "top_key"])

    def fresh():
        return ContentTable(), [], [], [], [], [], [], []

    table, keys, ids, groups, leaders, shas, counts, tops = fresh()
    for batch in batches:
        text = pc.fill_null(batch.column(2).cast(pa.large_string()), "").cast(pa.large_binary())
        for key, doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text):
            content = content.as_py().lower()      # bytes.lower() changes A-Z only
            digest = hashlib.sha256(content).digest()
            g, new = table.place(int.from_bytes(digest[-8:], "big"), content)
            rank = (doc is not None, doc, key)
            if new:
                leaders.append(key)
                shas.append(digest.hex())
                counts.append(1)
                tops.append(rank)
            else:
                counts[g] += 1
                tops[g] = max(tops[g], rank, key=lambda r: (r[0], r[1] or 0, r[2]))
            keys.append(key)
            ids.append(doc)
            groups.append(g)
            if table.n_bytes >= TABLE_BYTES or len(keys) >= 100_000:
                yield rows()
                table, keys, ids, groups, leaders, shas, counts, tops = fresh()
    if keys:
        yield rows()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaders sorted by bucket to VERDICT; one table lives at a time."""
    bucket, table, groups, leaders, sizes, tops = None, ContentTable(), [], [], [], []

    def rows():
        return pa.RecordBatch.from_arrays([
            pa.array(leaders, pa.int64()), pa.array([tops[g][1] for g in groups], pa.int64()),
            pa.array([tops[g][2] for g in groups], pa.int64()), pa.array([sizes[g] for g in groups], pa.int64())],
            names=["leader", "keep_id", "keep_key", "group_size"])

    for batch in batches:
        contents = batch.column(3)
        for i, (b, sha, leader, n, doc, key) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4, 5, 6)))):
            if b != bucket:
                if leaders:
                    yield rows()
                bucket, table, groups, leaders, sizes, tops = b, ContentTable(), [], [], [], []
            g, new = table.place(int(sha[-16:], 16), contents[i].as_py())
            rank = (doc is not None, doc, key)
            if new:
                sizes.append(n)
                tops.append(rank)
            else:
                sizes[g] += n
                tops[g] = max(tops[g], rank, key=lambda r: (r[0], r[1] or 0, r[2]))
            groups.append(g)
            leaders.append(leader)
    if leaders:
        yield rows()


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: (row, id, keep_id, group_size, kept, text_sha256);
    ``row`` is the row's number (see ``common.numbered``)."""
    base = common.with_row(docs).select(F.col(common.ROW).alias("key"), F.col(id_col).cast("long").alias("id"),
                               F.col(text_col).alias("text"))
    spill = common.materialize(base.mapInArrow(common.lean(_combine), ROWS), "grace-0")
    todo = spill.filter("content IS NOT NULL").select("sha", "leader", "content", "n", "top_id", "top_key")
    size = F.octet_length("content")
    total = todo.agg(F.sum(size)).first()[0] or 0
    digits = 1
    while total > bucket_bytes // 4 * 16 ** digits:
        digits += 1
    verdicts = None
    while True:
        level = todo.withColumn("bucket", F.substring("sha", 1, digits))
        large = (level.groupBy("bucket").agg(F.sum(size).alias("bytes"), F.min("sha").alias("x"), F.max("sha").alias("y"))
                 .filter((F.col("bytes") > bucket_bytes) & (F.col("x") != F.col("y"))).select("bucket"))
        large = common.materialize(large, "grace-large")
        again = large.count() > 0
        fits = level.join(large, "bucket", "left_anti") if again else level
        done = (fits.select("bucket", "sha", "leader", "content", "n", "top_id", "top_key")
                .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(common.lean(_settle), VERDICT))
        verdicts = done if verdicts is None else verdicts.union(done)
        if not again:
            break
        todo = common.materialize(level.join(large, "bucket", "left_semi").drop("bucket"), f"grace-{digits}")
        digits += PREFIX_STEP
    return (spill.select("key", "id", "leader", "sha").join(verdicts, "leader")
            .select(F.col("key").alias("row"), F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("key") == F.col("keep_key")).alias("kept"), F.col("sha").alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that lose; all columns stay.  The verdict is stored
    first, so that the spill files are gone when the rows are filtered."""
    spark, stored = docs.sparkSession, common.numbered(docs)
    lost = common.settled(spark, common.shared_path(spark, "exact-copies"), lambda: duplicate_groups(
        stored, id_col, text_col).filter("NOT kept").select("row"))
    return common.without_rows(stored, lost)
