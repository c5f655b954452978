"""Timings of the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Each
query runs to the end (all rows are produced) once to warm up and then BENCH_RUNS times;
the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from checks.catalog import all_queries  # noqa: E402
from tachoflow.session import build_session  # noqa: E402

HEADLINE = (
    "src_read_jsonl", "src_load_bronze", "src_consume_once", "stg_parse", "stg_dedup",
    "silver_enrich", "fct_vehicle_telemetry", "agg_from_messages", "agg_vehicle_health",
    "agg_subsystem_health", "agg_driving_behavior", "agg_efficiency", "agg_trip_summary",
    "dim_driving_states", "unpivot_subsystems", "snk_materialize_table", "dq_quality_report",
    "dq_tick_order", "dq_sensor_statistics", "dq_duplicate_report", "str_telemetry_live",
    "str_stream_alerts", "str_stream_dedup", "rul_classify_fault",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = all_queries()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            found[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
