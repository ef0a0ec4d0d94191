"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of test tables), BENCH_CPUS (local cores).
All queries run once to warm up, then BENCH_RUNS times; the best run counts. Results go to the
no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ventis.plans.catalog import QUERIES
from ventis.session import build_session

HEADLINE = [
    "mp25_by_comuna", "critical_comunas", "daily_evolution", "ica_by_comuna", "sensor_ranking",
    "modeling_dataset", "measurement_page", "weather_join", "resolve_stations",
    "validate_errors", "clean_dataset", "ingest_accepted", "ingest_rejected", "missing_slots",
    "rolling_features", "target_24h", "latest_per_station", "temporal_split", "describe_stats",
    "correlation_matrix", "prediction_errors", "citizen_status", "windowed_ica", "risk_labels",
    "prepare_measurements", "bulk_quantiles", "error_histogram", "dedupe_first", "executive_kpis",
    "load_report", "ingest_summary",
]


def run(query, spark, root: str) -> float:
    start = time.perf_counter()
    query(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        run(QUERIES[name], spark, root)
    timings = {}
    for name in names:
        timings[name] = round(min(run(QUERIES[name], spark, root) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": root.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
