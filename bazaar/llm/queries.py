"""Registered queries of this subpackage: thin, over the driver's tables.

``QUERIES`` maps a name to ``fn(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL``
holds DuckDB SQL where SQL can express the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bitpack, common
from .bounded_packing import pack
from .grace_dedup import duplicate_groups
from .license_scan import license_scan
from .partenum_join import jaccard_components
from .periodic_runs import planted_tail, run_digests
from .piece_encoding import piece_digests
from .quality_forest import quality_rules
from .raking import mix
from .secret_forest import secret_scan
from .sentence_spans import remove_repeated_spans
from .spelling_groups import planted_slip, spelling_variants
from .suffix_dedup import removed_spans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return keep


@query("op5_partenum_jaccard_join")
def op5(spark, sf_dir):
    return jaccard_components(common.read_documents(spark, sf_dir))


@query("op2_quality_rules_forest")
def op2(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(common.read_documents(spark, sf_dir), labels).drop("row")


LOWER_AZ = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz')")


@query("op4_grace_exact_dedup", f"""
WITH d AS (SELECT doc_id, {LOWER_AZ} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)""")
def op4(spark, sf_dir):
    return duplicate_groups(common.read_documents(spark, sf_dir)).drop("row")


@query("op7_raking_mix")
def op7(spark, sf_dir):
    return mix(common.read_documents(spark, sf_dir)).drop("row")


@query("op8_bounded_packing")
def op8(spark, sf_dir):
    return pack(common.read_documents(spark, sf_dir))


@query("op9_bit_packed_tokens")
def op9(spark, sf_dir):
    folder = bitpack.new_folder(spark)
    return bitpack.read_tokens(bitpack.write_tokens(common.read_documents(spark, sf_dir), folder), folder)


@query("op10_license_scan")
def op10(spark, sf_dir):
    return license_scan(common.read_documents(spark, sf_dir))


@query("op1_sentence_span_dedup")
def op1(spark, sf_dir):
    return remove_repeated_spans(common.read_documents(spark, sf_dir))


@query("op3_run_length_suffix_dedup")
def op3(spark, sf_dir):
    return removed_spans(common.read_documents(spark, sf_dir))


@query("op6_secret_forest")
def op6(spark, sf_dir):
    return secret_scan(common.read_documents(spark, sf_dir))


@query("op11_spelling_variants")
def op11(spark, sf_dir):
    return spelling_variants(common.read_documents(spark, sf_dir), rewrite=planted_slip)


@query("op12_agenda_pieces")
def op12(spark, sf_dir):
    return piece_digests(common.read_documents(spark, sf_dir))


@query("op13_recompression_runs")
def op13(spark, sf_dir):
    return run_digests(common.read_documents(spark, sf_dir), rewrite=planted_tail)
