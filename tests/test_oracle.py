"""Every registered query of ``bazaar.plans`` against its DuckDB oracle at
sf0.001, plus the driver entry point."""

import hashlib

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from bazaar.plans.all_queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(df: pd.DataFrame) -> str:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v)
                          else str(pd.Timestamp(v)) if hasattr(v, "year") else str(v))
    df = df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)
    return hashlib.md5(df.to_csv(index=False).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "review_score" in df.columns


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    sql = REGISTRY[name].sql
    assert sql, f"{name} has no oracle"
    sp = REGISTRY[name].fn(spark, SF).toPandas()
    dk = con.sql(sql).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert _norm(sp) == _norm(dk)
