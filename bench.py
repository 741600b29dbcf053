"""Headline timings: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Tables are landed first (timed as ``land_clean`` and ``land_features``); every query is then run
once on the smallest tables to load the JVM and once on the given ones, writing to a null sink.
"""

from __future__ import annotations

import json
import os
import time

from kerbline.plans import landed
from kerbline.plans.queries import QUERIES
from kerbline.session import local_session

HEADLINE = [
    "yoy_change", "holiday_comparison", "duplicate_count", "clean_traffic", "feature_table",
    "date_hourly_summary", "top_k_measure", "daytype_summary", "quiet_hours", "hourly_peaks", "weather_summary",
    "histogram_mode_above_median", "pattern_weather_hour", "recommend_scenarios", "frequent_itemsets",
    "association_rules", "chronological_split", "fixed_size_sample", "drift_report", "roc_auc",
    "logistic_classifier", "linear_regressor", "boosted_regressor", "network_regressor", "kmeans_sweep", "silhouette",
    "stratified_split", "csv_records", "quarantine_table",
]
WARM_DIR = "/root/testdata/sf0.001"


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="kerbline-bench")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    landed.features(spark, WARM_DIR)
    times = {}
    start = time.perf_counter()
    landed.traffic(spark, sf_dir)
    times["land_clean"] = time.perf_counter() - start
    start = time.perf_counter()
    landed.features(spark, sf_dir)
    times["land_features"] = time.perf_counter() - start
    for name in names:
        run(spark, name, WARM_DIR)
        times[name] = run(spark, name, sf_dir)
    times = {k: round(v, 3) for k, v in times.items()}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
