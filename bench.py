"""Benchmark of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default /root/testdata/sf0.1), ``BENCH_CPUS`` the
threads.  Each query runs once to warm up and then ``BENCH_RUNS`` times into a no-op
sink; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from firnspark.plans.catalogue import QUERIES
from firnspark.session import local_session

HEADLINE = [
    "combined_view",
    "caic_bulletins",
    "nwac_bulletins",
    "latest_publication",
    "target_table",
    "feature_table",
    "training_frame",
    "majority_models",
    "problem_forecasts",
    "aspect_models",
    "prediction_records",
    "class_metrics",
    "aspect_metrics",
    "regression_metrics",
    "missing_partitions",
    "backfilled_features",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, "firnspark-bench")
    seconds = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries (median run, warm session)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
