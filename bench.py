"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tidemark.registry.queries import QUERIES
from tidemark.session import local_session

HEADLINE = (
    "customer_features",
    "training_dataset",
    "scoring_dataset",
    "feature_drift",
    "delayed_evaluation",
    "threshold_sweep",
    "calibration_deciles",
    "purchase_interval_summary",
    "monthly_baseline",
    "clean_transactions",
    "promotion_decision",
    "split_dataset",
    "alert_rollup",
    "curated_store",
    "logistic_scores",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    times = {}
    for n in names:
        # An unmeasured run of each query lets the JVM load and compile what it uses; then the best of three.
        run(spark, n, sf_dir)
        times[n] = round(min(run(spark, n, sf_dir) for _ in range(3)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
