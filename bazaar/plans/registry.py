"""Registry of named queries: each is ``fn(spark, sf_dir) -> DataFrame`` over
the driver tables, optionally paired with an equivalent DuckDB SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .oracle_tables import with_tables

QueryFn = Callable[[SparkSession, str], DataFrame]

ROUND_SCALE = 1e6  # output doubles are compared at 1e-6


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, with_tables(sql) if sql else None)
        return fn
    return deco


def stable_doubles(df: DataFrame) -> DataFrame:
    """Round every DOUBLE output column to 1e-6 as ``round(x*1e6)/1e6 + 0``,
    the same arithmetic the oracle SQL uses, so float-summation order cannot
    change the compared value (``+ 0.0`` folds -0.0 into 0.0)."""
    s = F.lit(ROUND_SCALE)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append((F.round(F.col(f.name) * s) / s + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- SQL snippet helpers for the oracle side ---------------------------------

def r6(expr: str) -> str:
    return f"(round(({expr}) * 1000000.0::DOUBLE) / 1000000.0::DOUBLE + 0.0::DOUBLE)"


def days(a: str, b: str) -> str:
    """(b - a) in fractional days."""
    return f"((epoch_us({b}) - epoch_us({a})) / 86400000000.0::DOUBLE)"


def msum(expr: str) -> str:
    """Exact money sum (DECIMAL accumulation), as the library does."""
    return f"CAST(sum(CAST(({expr}) AS DECIMAL(28,10))) AS DOUBLE)"


def mdays(a: str, b: str) -> str:
    """Mean day difference over exact microseconds."""
    d = f"(epoch_us({b}) - epoch_us({a}))"
    return f"(sum({d})::DOUBLE / count({d}) / 86400000000.0::DOUBLE)"


def mean(expr: str) -> str:
    """Σ/n as one division (matches Spark's avg on exact sums)."""
    return f"(sum({expr})::DOUBLE / count({expr}))"


def npround(expr: str, digits: int) -> str:
    """numpy round: scale, half-to-even on the binary value, unscale."""
    k = f"{10 ** digits}.0::DOUBLE"
    return f"(round_even(({expr}) * {k}, 0) / {k})"


def pos0(expr: str) -> str:
    return f"(CASE WHEN ({expr}) > 0 THEN ({expr}) ELSE 0.0::DOUBLE END)"
