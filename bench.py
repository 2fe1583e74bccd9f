"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from anemos.plans import catalog  # noqa: E402
from anemos.session import local_session  # noqa: E402

HEADLINE = (
    "score_and_rank", "engineer_features", "impute_per_spot", "validate_slices", "hindcast", "drift_dataset",
    "drift_ks", "event_retention", "asof_nearest_tolerance", "point_in_time_join", "grid_sample_nearest",
    "holdout_split", "counter_increase", "night_intervals", "quality_grid",
)
RUNS = 3


def run_once(spark, key: str, sf_dir: str) -> float:
    start = time.perf_counter()
    # The noop sink runs the whole plan without sending rows to the driver.
    catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in HEADLINE:
        run_once(spark, key, sf_dir)  # warm-up: code generation and file listing
        times[key] = round(statistics.median(run_once(spark, key, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, sum of medians", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
