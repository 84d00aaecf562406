"""CSV whose quoted fields may hold line breaks, read in parallel splits.

Spark's ``multiLine`` reads a file in one task, as a line end may lie inside quotes.
Whether it does follows from the quotes before it, and those are counted in parallel:

1. lines are read as text, which splits files; per split the quotes are counted, and
   the parity of all splits before it says whether a split begins inside quotes;
2. splits that begin or end inside quotes hand on the pieces of the records they cut,
   which are put together per record;
3. every split gives the records that begin in it: whole lines as they are, lines of
   one record joined, and the last one with its rest from step 2.

A record is then parsed like a line of any CSV.  Quotes within a quoted field are
doubled (RFC 4180).  A file with an odd number of quotes can't be cut into records
and fails.  Steps 1 and 2 give one row per split (a terabyte has some 8,000), with at
most the rest of one record; they are broadcast, and the data are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT = ["file", "start"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _entries(lines: DataFrame) -> DataFrame:
    """(file, start, inside, open): whether a split begins and ends inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy(*SPLIT).agg((F.sum(quotes) % 2).cast("int").alias("odd"))
    before = Window.partitionBy("file").orderBy("start")       # a row per split
    last = F.lead("start").over(before).isNull()
    after = F.sum("odd").over(before.rowsBetween(Window.unboundedPreceding, 0)) % 2
    at_end = F.when(last & (after == 1), F.raise_error(F.concat(F.lit("odd number of quotes in "), "file"))).otherwise(after)
    return odd.select(*SPLIT, ((after + F.col("odd")) % 2).cast("int").alias("inside"), at_end.cast("int").alias("open"))


class _Split:
    """The lines of one split, in order: whole records, and pieces of cut ones."""

    def __init__(self, inside: bool, at_start: bool):
        self.parity, self.header = int(inside), at_start
        self.head = inside          # the lines held belong to a record of an earlier split
        self.held: list[str] = []
        self.first: str | None = None       # end of such a record

    def records(self, lines: pa.Array) -> pa.Array:
        """Records that begin and end here (not in order)."""
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1
        after = (self.parity + np.cumsum(odd)) & 1
        before = after ^ odd
        if len(after):
            self.parity = int(after[-1])
        whole = (before == 0) & (after == 0)
        if self.header and len(whole):
            self.header = whole[0] = False
            pieces = np.flatnonzero(~whole)[1:]
        else:
            pieces = np.flatnonzero(~whole)
        joined = []
        for i in pieces.tolist():
            self.held.append(lines[i].as_py())
            if not after[i]:
                text = "\n".join(self.held)
                self.held = []
                if self.head:
                    self.first, self.head = text, False
                else:
                    joined.append(text)
        return pa.concat_arrays([lines.filter(pa.array(whole)), pa.array(joined, lines.type)])


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, _Split, pa.Array | None, pa.Array | None]]:
    """(key, split, rest, lines) for each stretch of lines of one split, and (key,
    split, rest, None) at its end.  Columns: value, file, start, inside, rest."""
    key, split, rest = None, None, None
    for batch in batches:
        files, starts = batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
        cuts = [*np.flatnonzero(new).tolist(), len(starts)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            here = files[a].as_py(), int(starts[a])
            if here != key:
                if split:
                    yield key, split, rest, None
                key, split = here, _Split(bool(batch.column(3)[a].as_py()), int(starts[a]) == 0)
                rest = batch.column(4)[a].as_py()
            yield key, split, rest, batch.column(0).slice(a, b - a)
    if split:
        yield key, split, rest, None


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, text, closed) of the end of a record that began in an earlier split."""
    for key, split, _, lines in _splits(batches):
        if lines is not None:
            split.records(lines)
        elif split.first is not None or split.head:
            text = "\n".join(split.held) if split.head else split.first
            yield pa.RecordBatch.from_pydict({"file": [key[0]], "start": [key[1]], "text": [text], "closed": [not split.head]})


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, split, rest, lines in _splits(batches):
        if lines is not None:
            yield pa.RecordBatch.from_arrays([split.records(lines).cast(pa.string())], names=["record"])
        elif split.held and not split.head:
            yield pa.RecordBatch.from_pydict({"record": ["\n".join([*split.held, rest])]})


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(record) of every record behind the header of the CSV file(s) at ``path``."""
    lines = _lines(spark, path)
    entries = _entries(lines)
    cut = entries.filter("inside = 1 OR open = 1")
    crossing = lines.join(F.broadcast(cut), SPLIT).select("value", *SPLIT, "inside", F.lit(None).cast("string").alias("rest"))
    pieces = crossing.mapInArrow(_pieces, "file string, start long, text string, closed boolean")
    # a record's pieces follow one another: the split in which it begins is the last
    # one before them that isn't inside quotes all along
    marks = cut.join(pieces, SPLIT, "left")
    begins = F.last(F.when((F.col("open") == 1) & F.coalesce("closed", F.lit(True)), F.col("start")), True).over(
        Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    rests = (marks.withColumn("begin", begins).filter("text IS NOT NULL").groupBy("file", F.col("begin").alias("start"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("start").alias("s"), "text"))),
                                           lambda x: x["text"]), "\n").alias("rest")))
    known = entries.join(rests, SPLIT, "left").select(*SPLIT, "inside", "rest")
    # every split must be known: another reading may have split the files differently
    joined = lines.join(F.broadcast(known), SPLIT, "left").select("value", *SPLIT, F.coalesce("inside", F.raise_error(
        F.concat(F.lit("unknown split of "), "file"))).alias("inside"), "rest")
    return joined.mapInArrow(_records, "record string")


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """``schema`` names the columns in the file's order; ``options`` are those of
    Spark's CSV reader.  Blank lines are no records; a line break within a field is
    read as ``\\n``, also in files with ``\\r\\n``."""
    record = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    rows = quoted_records(spark, path).select(record.alias("record")).filter("record <> ''")
    parsed = F.from_csv("record", schema.toDDL(), {**options, "multiLine": "true"})
    return rows.select(parsed.alias("r")).select("r.*")
