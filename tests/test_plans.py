"""Physical-plan checks on the headline queries: no Python UDF evaluation and
no exchange that funnels unaggregated rows into one partition."""

import pytest

from bazaar.plans.all_queries import REGISTRY

SF = "/root/testdata/sf0.001"
HEADLINE = ["order_training_data_with_distance", "order_distance", "order_details_training", "seller_training_data", "product_training_data",
            "weekly_delay_analysis", "nps_by_state", "category_rollup_mean", "seller_economics"]


@pytest.mark.parametrize("name", HEADLINE)
def test_plan_is_jvm_side_and_distributed(spark, name):
    df = REGISTRY[name].fn(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    # A single-partition exchange may only carry partial aggregates (one row
    # per task, e.g. the calendar bounds), never raw rows for a window/sort.
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1], plan


def test_parquet_scans_are_pruned(spark):
    df = REGISTRY["order_training_data"].fn(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # lineitem is read with only the columns the item aggregates need
    assert "l_partkey" not in plan and "l_shipdate" not in plan


def test_items_are_scanned_once(spark):
    df = REGISTRY["order_training_data_with_distance"].fn(spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("l_extendedprice" in line for line in plan.split("\n") if "Relation [" in line) == 1


def test_category_medians_use_no_group_buffers(spark):
    plan = REGISTRY["category_rollup_median"].fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "median" not in plan.split("Scan")[0]
