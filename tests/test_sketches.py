"""Sketches against exact figures, within the stated errors; one scan; merging."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.operators import quantiles, sketches, stats
from bazaar.sinks import datasets


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    n = 60_000
    skewed = np.floor(rng.pareto(1.1, n) * 3)
    return [(int(k % 3), float(x) if k % 11 else None, int(z), f"v{int(z)}" if k % 7 else None, None)
            for k, (x, z) in enumerate(zip(rng.normal(5, 2, n), skewed))]


@pytest.fixture(scope="module")
def table(spark, values):
    return spark.createDataFrame(values, "g long, x double, z long, s string, empty double").repartition(7)


def rank_of(sample, v):
    below, upto = np.searchsorted(sample, v, "left"), np.searchsorted(sample, v, "right")
    return below / len(sample), upto / len(sample)


def test_describe_within_rank_error(table, values):
    got = {r.variable: r for r in stats.describe_table(table, ["x", "z", "empty"], exact=False).collect()}
    exact = {r.variable: r for r in stats.describe_table(table, ["x", "z", "empty"]).collect()}
    error = sketches.rank_error()
    assert error < 0.002
    for c, k in (("x", 1), ("z", 2)):
        data = np.sort([v[k] for v in values if v[k] is not None])
        for p, q in ((.25, got[c].q25), (.5, got[c].q50), (.75, got[c].q75)):
            low, high = rank_of(data, q)
            assert low - error <= p <= high + error
        for f in ("count", "min", "max"):
            assert got[c][f] == exact[c][f]
        assert got[c]["mean"] == pytest.approx(exact[c]["mean"]) and got[c]["std"] == pytest.approx(exact[c]["std"])
    assert got["empty"]["count"] == 0 and got["empty"].q50 is None
    assert stats.medians(table, ["x"], exact=False).first()["median"] == pytest.approx(got["x"].q50, abs=0.02)


def test_profile_within_errors(table, values):
    got = {r.variable: r for r in stats.profile_table(table, exact=False).collect()}
    exact = {r.variable: r for r in stats.profile_table(table).collect()}
    assert list(stats.profile_table(table, exact=False).columns) == list(stats.profile_table(table).columns)
    for c, e in exact.items():
        g = got[c]
        for f in ("dtype", "n_rows", "n_null", "n_zeros", "min", "max"):
            assert g[f] == e[f], (c, f)
        assert abs(g.n_distinct - e.n_distinct) <= 4 * sketches.distinct_error() * e.n_distinct + 1
    for c in ("z", "s", "g"):
        assert got[c].top_value == exact[c].top_value or c == "g"
        assert abs(got[c].top_count - exact[c].top_count) <= sketches.top_error() * len(values)


def test_one_scan(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    plan = sketches.sketch_profile(sketches.column_sketches(spark.read.parquet(str(tmp_path / "t"))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


@pytest.mark.parametrize("by", [[], ["g"]])
def test_merged_sketches_equal_whole(spark, table, values, by, tmp_path):
    parts = None
    for k in range(4):
        some = table.filter(F.pmod(F.xxhash64("x", "z", "s"), F.lit(4)) == k)
        one = sketches.column_sketches(some, ["x", "z", "s", "empty"], by=by)
        parts = one if parts is None else parts.unionByName(one)
    parts.write.parquet(str(tmp_path / "parts"))
    merged = sketches.merge_sketches(spark.read.parquet(str(tmp_path / "parts")), by)
    got = {tuple(r[c] for c in [*by, "variable"]): r for r in sketches.sketch_profile(merged, by).collect()}
    want = {tuple(r[c] for c in [*by, "variable"]): r
            for r in sketches.sketch_profile(sketches.column_sketches(table, ["x", "z", "s", "empty"], by=by), by).collect()}
    assert got.keys() == want.keys()
    for key, w in want.items():
        g = got[key]
        assert (g.n_rows, g.n_null, g.n_zeros, g["min"], g["max"]) == (w.n_rows, w.n_null, w.n_zeros, w["min"], w["max"])
        if w["mean"] is not None:
            assert g["mean"] == pytest.approx(w["mean"]) and g["std"] == pytest.approx(w["std"])
            column = {"x": 1, "z": 2}[key[-1]]
            data = np.sort([v[column] for v in values if v[column] is not None and (not by or v[0] == key[0])])
            low, high = rank_of(data, g.q50)
            assert low - 2 * sketches.rank_error() <= .5 <= high + 2 * sketches.rank_error()
        assert abs(g.n_distinct - w.n_distinct) <= 6 * sketches.distinct_error() * w.n_distinct + 1


def test_datasets_are_replaced_as_one(spark, tmp_path):
    path = str(tmp_path / "out")
    a, b = spark.range(5), spark.range(7).withColumn("t", F.lit("x"))
    assert datasets.write_datasets({"a": a, "b": b}, path) == {"a": 5, "b": 7}
    first = datasets.read_datasets(spark, path)
    assert {k: v.count() for k, v in first.items()} == {"a": 5, "b": 7} and first["b"].columns == ["id", "t"]

    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        datasets.write_datasets({"a": spark.range(1), "b": broken}, path)
    again = datasets.read_datasets(spark, path)                    # the version before is still whole
    assert {k: v.count() for k, v in again.items()} == {"a": 5, "b": 7}

    for n in (1, 2, 3):
        datasets.write_datasets({"a": spark.range(n)}, path, keep=2)
    now = datasets.read_datasets(spark, path)
    assert list(now) == ["a"] and now["a"].count() == 3
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2


def test_exact_profile_sends_values_once(spark, monkeypatch):
    """The profile stores columns and counts values as they are: no checkpoint of the rows,
    zeros of both signs and NaN told apart, of equally frequent values the largest on top."""
    rows = [(1, 0.0, "a", True), (9, -0.0, "b", None), (9, float("nan"), "b", False), (1, None, None, False), (None, 2.5, "a", None)]
    df = spark.createDataFrame(rows, "n long, x double, `odd name` string, b boolean").withColumn(
        "t", F.expr("date_add(DATE'2020-01-01', int(n))")).withColumn("m", F.col("n").cast("decimal(12,2)")).repartition(3)

    def no_rows(df):
        raise AssertionError("rows are checkpointed")

    monkeypatch.setattr(stats, "cut_lineage", no_rows)
    got = {r.variable: r for r in stats.profile_table(df).collect()}
    assert set(got) == set(df.columns)
    assert [(got[c].n_rows, got[c].n_null, got[c].n_distinct, got[c].n_zeros, got[c].top_value, got[c].top_count)
            for c in df.columns] == [(5, 1, 2, 0, "9", 2), (5, 1, 4, 2, "NaN", 1), (5, 1, 2, 0, "b", 2), (5, 2, 2, 0, "false", 2),
                                     (5, 1, 2, 0, "2020-01-10", 2), (5, 1, 2, 0, "9.00", 2)]
    assert (got["n"].min, got["n"].max, got["n"].mean, got["n"].q25, got["n"].q50, got["n"].q75) == (1, 9, 5, 1, 5, 9)
    assert got["odd name"].mean is None and got["odd name"].q50 is None and got["m"].dtype == "decimal(12,2)"
    assert stats.profile_table(df.filter("n > 99")).count() == 0


def test_quantile_passes_leave_rows_in_place(spark, monkeypatch):
    """Rows meet the few groups and bands by broadcast, whatever Spark guesses of their size."""
    plans, cut = [], quantiles.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(quantiles, "cut_lineage", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).select(F.expr("id % 3").alias("g"), (F.col("id") * 7919 % 5003).cast("double").alias("v"))
        got = {(r.g, r.p): r["quantile"] for r in quantiles.exact_quantiles(df, "v", [.25, .5], by=["g"], band_rows=50).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    data = np.array([i * 7919 % 5003 for i in range(5000)], float)
    assert got == {(g, p): np.quantile(data[np.arange(5000) % 3 == g], p) for g in range(3) for p in (.25, .5)}
    passes = [p for p in plans if "_b1" in p and "Scan ExistingRDD" in p and "Join" in p]
    assert passes and "BroadcastHashJoin" in passes[0]
