"""Per-server summary and per-day metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import (
    HealthConfig,
    count_if,
    health_score,
    is_rule_anomaly,
    per_hour,
    round_cols,
    rounded,
)

# Names of the output columns come from these.
UTILISATION = {"cpu": "cpu_usage_percent", "memory": "memory_usage_percent", "disk": "disk_usage_percent"}


def _common_metrics() -> list[Column]:
    """Averages and peaks that the summary and the daily table share."""
    utilisation = [
        expr
        for short, col in UTILISATION.items()
        for expr in (
            F.avg(col).alias(f"avg_{short}_percent"),
            F.max(col).alias(f"peak_{short}_percent"),
        )
    ]
    return [
        *utilisation,
        F.avg("network_rx_bytes").alias("avg_network_rx_bytes"),
        F.avg("network_tx_bytes").alias("avg_network_tx_bytes"),
        F.avg("application_error_count").alias("avg_errors_per_interval"),
        F.avg("response_time_ms").alias("avg_response_time_ms"),
    ]


def _summary_metrics() -> list[Column]:
    return [
        *_common_metrics(),
        F.max("response_time_ms").alias("peak_response_time_ms"),
        count_if(is_rule_anomaly()).alias("anomaly_count"),
        F.count(F.lit(1)).alias("total_readings"),
    ]


def midpoint(df: DataFrame) -> Column:
    """The middle instant of the whole table, as a scalar subquery over one column.

    An odd span is halved to the even microsecond, as a time span division would do.
    """
    first, last = F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp"))
    half = F.bround((last - first) / F.lit(2)).cast("long")
    return df.agg(F.timestamp_micros(first + half).alias("midpoint")).scalar()


def _half_averages(mid: Column) -> list[Column]:
    ts, disk = F.col("timestamp"), F.col("disk_usage_percent")
    return [
        F.avg(F.when(ts < mid, disk)).alias("disk_first_half_avg"),
        F.avg(F.when(ts >= mid, disk)).alias("disk_second_half_avg"),
    ]


def server_base(df: DataFrame) -> DataFrame:
    """Unrounded averages, peaks and counts by (server, hostname)."""
    return df.groupBy("server_id", "hostname").agg(*_summary_metrics())


def disk_halves(df: DataFrame, mid: Column | None = None) -> DataFrame:
    """Per server, mean disk use before and after the fleet-wide midpoint."""
    return df.groupBy("server_id").agg(*_half_averages(midpoint(df) if mid is None else mid))


def disk_trend(df: DataFrame, mid: Column | None = None) -> DataFrame:
    """Second-half mean minus first-half mean; null if a server lacks one half."""
    change = F.col("disk_second_half_avg") - F.col("disk_first_half_avg")
    return disk_halves(df, mid).select(
        "server_id", rounded(change, 2).alias("disk_trend_percent_change")
    )


def with_health_score(df: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """Add the health score, to one digit."""
    return df.withColumn("health_score", rounded(health_score(cfg), 1))


# Output columns that are rounded to two digits, in their order.
ROUNDED = [
    *[f"{kind}_{m}_percent" for m in UTILISATION for kind in ("avg", "peak")],
    "avg_network_rx_bytes",
    "avg_network_tx_bytes",
    "avg_errors_per_interval",
    "avg_response_time_ms",
]


def build_server_summary(df: DataFrame, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """One row per (server, hostname) with trend and health score.

    The trend belongs to the server, the other metrics to the (server, hostname) pair. Both
    come from one pass: the pairs carry the halves as sums and counts, and a window over
    the finished pairs (a few rows per server) combines them.
    """
    ts, disk = F.col("timestamp"), F.col("disk_usage_percent")
    mid = midpoint(df)
    early, late = F.when(ts < mid, disk), F.when(ts >= mid, disk)
    pairs = df.groupBy("server_id", "hostname").agg(
        *_summary_metrics(),
        F.sum(early).alias("_s1"),
        F.count(early).alias("_n1"),
        F.sum(late).alias("_s2"),
        F.count(late).alias("_n2"),
    )
    per_server = W.partitionBy("server_id")

    def mean(total: str, count: str) -> Column:
        return F.try_divide(F.sum(total).over(per_server), F.sum(count).over(per_server))

    summary = pairs.withColumns(
        {
            "errors_per_hour": rounded(per_hour(F.col("avg_errors_per_interval")), 2),
            "disk_trend_percent_change": rounded(mean("_s2", "_n2") - mean("_s1", "_n1"), 2),
        }
    ).drop("_s1", "_n1", "_s2", "_n2")
    return round_cols(with_health_score(summary, cfg), [*ROUNDED, "peak_response_time_ms"])


def build_daily_metrics(df: DataFrame) -> DataFrame:
    """One row per server and day, in order."""
    daily = df.groupBy("server_id", "dt").agg(
        *_common_metrics(), count_if(is_rule_anomaly()).alias("anomaly_count")
    )
    return round_cols(daily, ROUNDED).orderBy("server_id", "dt")
