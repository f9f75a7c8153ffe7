"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the number of task threads.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardwatch.catalog import QUERIES
from wardwatch.session import build_session

HEADLINE = [
    "destination_summary",
    "score_vitals",
    "score_request",
    "vitals_delta",
    "vitals_delta_busy_patient",
    "enrich_latest",
    "recent_history",
    "lateness_tiers",
    "tumbling_vitals",
    "mean_shift_drift",
    "column_drift",
    "count_window_drift",
    "latency_summary_by_source",
    "counter_rate",
    "rolling_percentiles",
    "latency_panel",
    "reconcile",
    "scoring_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    QUERIES["destination_summary"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "events_per_sec": {name: round(events / s) for name, s in seconds.items()},
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
