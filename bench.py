"""Headline queries timed on one machine; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts. Results go to the
`noop` sink, so every row is computed and none is sent to Python.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sorrel.plans.queries import QUERIES  # noqa: E402
from sorrel.session import local_session  # noqa: E402

HEADLINE = [
    "user_stats",
    "item_stats",
    "top_rated",
    "feature_matrix",
    "point_in_time",
    "historical_features",
    "materialize",
    "quality_checks",
    "roc_auc",
    "exact_split",
    "top_k",
    "rolling_latency",
    "nb_params",
    "nb_scores",
    "metrics",
    "cv",
    "grid",
    "recommend",
    "recommend_unseen",
    "feature_drift",
    "score_batches",
    "request_metrics",
    "stream_windows",
    "stream_materialize",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("OFF")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
