"""Time the headline queries; prints one JSON line.

Each query runs twice to warm up and three times for the clock; the median
counts.  Results go to Spark's ``noop`` sink, so every row is computed and none
is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from candlemill.plans.indicators import indicators_resumed
from candlemill.registry import QUERIES
from candlemill.registry.series import resumed_inputs
from candlemill.session import local_session

HEADLINE = [
    "repo_stats",
    "user_stats",
    "daily_stats",
    "top1_per_group",
    "latest_per_key",
    "word_count",
    "text_lines_count",
    "plan_windows",
    "detect_rebased",
    "insert_ignore",
    "delete_range",
    "agg_collect_list",
    "set_subtract",
    "master_fixed_width",
    "udf_grouped_map",
    "indicators",
    "indicators_incremental",
    "indicators_resumed",
]
WARM_UPS = 2
ROUNDS = 3


# What a run finds on disk is written outside the clock.
PREPARED = {"indicators_resumed": (resumed_inputs, indicators_resumed)}


def runner(spark, name: str, sf_dir: str):
    if name in PREPARED:
        prepare, plan = PREPARED[name]
        inputs = prepare(spark, sf_dir)
        return lambda: plan(*inputs)
    return lambda: QUERIES[name](spark, sf_dir)


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_ONLY")
    spark = local_session("bench", cpus)
    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        run = runner(spark, name, sf_dir)
        for _ in range(WARM_UPS):
            timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(ROUNDS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median of 3, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf_dir.rpartition("sf")[2] or 0),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
