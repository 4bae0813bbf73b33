"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (input tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma separated).
Each query runs once to warm up and is then timed; the whole result is computed, none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetmeter.plans.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "active_senses",
    "active_pills",
    "wifi_info",
    "hourly_active_sense",
    "device_firmware",
    "middle_firmware_devices",
    "data_quality_counts",
    "bad_sensor_events",
    "low_uptime_devices",
    "uptime_days",
    "meter_rates",
    "metrics_report",
    "sense_checkpoint_track",
    "state_export",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    records = QUERIES["sense_messages_processed"](spark, sf_dir).first()["messages"]
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "sense_records": records,
                "sense_records_per_sec": {n: round(records / s) for n, s in seconds.items() if s},
            }
        )
    )


if __name__ == "__main__":
    main()
