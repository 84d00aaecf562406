"""Corpus pipeline: quality rules, exact de-duplication, near duplicates, source
mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of their input.  Rows with a null or repeated id pass through
the filtering stages by row; see the operators for each defined case.  What a stage
stored on its way, and its input, are removed once its output is committed.  Stages
follow one another in the same executors, so the jobs of each bound their Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import bounded_packing, common, grace_dedup, partenum_join, quality_forest, raking


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    with common.modest_batches(spark):
        return quality_forest.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    with common.modest_batches(spark):
        return grace_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    with common.modest_batches(spark):
        return partenum_join.drop_linked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by their calibrated probabilities."""
    with common.modest_batches(spark):
        return raking.sample_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training window."""
    with common.modest_batches(spark):
        return bounded_packing.pack(docs, step_bytes=1 << 20, memo_pieces=100_000)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

#: None: trained rules, hashed draws and tokenizer ids are beyond SQL; the tests
#: compare every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.read_documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = common.shared_path(spark, f"stage-{name}")
        docs = common.settled(spark, path, lambda: stage(spark, docs, sf_dir))  # noqa: B023
        if before:
            common.remove(spark, before)
        before = path
    return docs
