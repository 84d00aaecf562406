"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through Spark's ``noop`` sink (full execution,
nothing collected); one warm-up run, then the median of 3 timed runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaar.plans.all_queries import REGISTRY  # noqa: E402
from bazaar.session import get_session  # noqa: E402

HEADLINE = [
    "order_training_data",
    "order_training_data_with_distance",
    "order_details_training",
    "seller_training_data",
    "seller_economics",
    "product_training_data",
    "category_rollup_mean",
    "weekly_delay_analysis",
    "lateness_brackets",
    "weekly_payments",
    "nps_by_state",
    "state_review_stats",
    "seller_removal_whatif",
    "describe_training",
    "corr_matrix_training",
    "ols_review_multivariate",
    "logit_one_star",
    "coef_compare_linear_logit",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = REGISTRY[name].fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8))
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
