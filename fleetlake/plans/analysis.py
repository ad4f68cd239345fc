"""The operational questions over one Silver table, each answer a table of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlake.operators import profile
from fleetlake.sources.tables import read_table, write_table

# Columns that the questions read; the rest of a reading stays in the file.
COLUMNS = [
    "server_id",
    "timestamp",
    "cpu_usage_percent",
    "memory_usage_percent",
    "disk_usage_percent",
    "network_rx_bytes",
    "network_tx_bytes",
    "application_error_count",
    "response_time_ms",
    "status",
]

QUESTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "cpu_by_server": profile.cpu_profile,
    "cpu_spread": profile.cpu_spread,
    "errors_by_server": profile.error_profile,
    "error_outlier": profile.error_outlier,
    "memory_and_disk_trends": profile.trend_report,
    "network_by_server": profile.network_profile,
    "unusual_traffic": lambda rows: profile.fleet_robust_z(profile.with_fleet_z(rows)),
    "traffic_surges": lambda rows: profile.surge_interval(profile.with_fleet_z(rows)),
    "cpu_latency_correlation": profile.correlate,
    "cpu_latency_by_server": lambda rows: profile.correlate(rows, by="server_id"),
    "latency_when_cpu_is_high": lambda rows: profile.natural_experiment(rows, profile.CPU, 90, profile.LATENCY),
    "cpu_when_latency_is_high": lambda rows: profile.natural_experiment(rows, profile.LATENCY, 500, profile.CPU),
    "status_counts": profile.status_counts,
    "load_by_hour": profile.hourly_profile,
    "hour_extremes": profile.hour_extremes,
    "business_hours": profile.business_hours,
    "load_by_weekday": profile.weekday_profile,
    "weekday_spread": profile.weekday_spread,
    "server_hour_matrix": profile.server_hour_matrix,
}
NEEDS_TRUTH = {"rules_against_truth": profile.rule_vs_truth, "truth_counts": profile.truth_counts}


def run_analysis(silver: DataFrame, out: str) -> list[str]:
    """Write the answer of every question below ``out``; those about injected incidents where readings tell them.

    ``silver`` is read once per question and should be a written table; each question reads the columns it needs.
    """
    told = "is_injected_anomaly" in silver.columns
    rows = silver.select(*COLUMNS, *(["is_injected_anomaly"] if told else []))
    questions = {**QUESTIONS, **(NEEDS_TRUTH if told else {})}
    for name, question in questions.items():
        write_table(question(rows), f"{out}/{name}")
    return list(questions)


def answer(spark: SparkSession, out: str, name: str) -> DataFrame:
    """One answer as it was written."""
    return read_table(spark, f"{out}/{name}")
