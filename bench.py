"""Time the headline queries on one machine and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the cores, and ``BENCH_QUERIES``
(comma-separated) other queries than the headline ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlake.plans.catalog import QUERIES
from fleetlake.session import build_session

HEADLINE = [
    "p05_valid_rows",
    "a04_server_summary",
    "a05_daily_metrics",
    "a06_reject_breakdown",
    "a08_cpu_profile",
    "a10_error_profile",
    "a13_trend_report",
    "a14_network_profile",
    "a15_fleet_robust_z",
    "a17_correlation_by_server",
    "a19_rule_vs_truth",
    "a22_hourly_profile",
    "a26_server_hour_matrix",
    "a29_gap_histogram",
    "a36_fleet_kpis",
    "w02_sessions",
    "w03_rolling_slopes",
    "m02_scalers",
    "m07_incidents",
    "m05_isolation_scores",
    "m12_detection",
    "j08_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "fleetlake-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        # The tables are a few MB here: let small inputs still use all cores.
        spark__sql__files__openCostInBytes="65536",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="65536",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="fleetlake-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        # The no-op sink computes every row and column without moving them to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # One untimed query, so that JVM start-up and compilation are not charged to the first.
    run("m12_detection")
    seconds = {name: run(name) for name in (names.split(",") if names else HEADLINE)}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
