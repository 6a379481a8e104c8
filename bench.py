"""Headline queries at one scale factor; prints one JSON line.

Each query starts without cached data, and its whole result is produced (written to the no-op sink).
The warm-up query only loads classes and compiles the reader; it is not one of the measured ones.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideframe.plans.catalog import QUERIES  # noqa: E402
from tideframe.session import build_session  # noqa: E402

HEADLINE = [
    "features_full",
    "features_compact",
    "rolling_features",
    "ewma_features",
    "clean_series",
    "quality_report",
    "profile_summary",
    "training_stats",
    "drift_ratio",
    "evaluate_forecast",
    "request_counts",
    "latency_histogram",
    "counter_series",
    "counter_rate",
    "latency_quantiles",
    "alert_for_duration",
    "alerts",
    "correlation_matrix",
    "active_requests",
    "train_ridge",
    "train_random_forest",
    "forecast_recursive",
    "stream_counter_rate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("tideframe-bench", cores)
    QUERIES["time_range_filter"](spark, folder).write.format("noop").mode("overwrite").save()
    spent = {}
    for name in sys.argv[1:] or HEADLINE:
        spark.catalog.clearCache()
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.perf_counter() - start, 3)
    total = round(sum(spent.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": spent, "sf": os.path.basename(folder)}))


if __name__ == "__main__":
    main()
