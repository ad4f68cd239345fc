"""Thresholds, labels and the column expressions built from them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They must equal the reference's for results to be comparable.
MIN_VALID_TIMESTAMP = datetime(2020, 1, 1, tzinfo=timezone.utc)
ANOMALOUS_STATUSES = ("WARNING", "CRITICAL")
INTERVAL_MINUTES = 5
READINGS_PER_DAY = 288
CRITICAL_HEALTH = 60
WARNING_HEALTH = 85
MAD_TO_SIGMA = 0.6745


@dataclass(frozen=True)
class HealthConfig:
    """Weights and thresholds of the health score."""

    cpu_threshold: float = 80.0
    memory_threshold: float = 80.0
    disk_threshold: float = 90.0
    disk_weight: float = 1.5
    error_weight: float = 5.0
    anomaly_weight: float = 2.0


def rounded(value: Column, digits: int) -> Column:
    """Round half up on the decimal value, so ties do not depend on the binary double."""
    return F.round(value.cast("decimal(28,6)"), digits).cast("double")


def round_cols(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """Round several columns in one projection."""
    return df.withColumns({c: rounded(F.col(c), digits) for c in cols})


def validity_rules(as_of: Column, min_ts: datetime = MIN_VALID_TIMESTAMP) -> dict[str, Column]:
    """Named conditions that make a reading invalid, in evaluation order."""

    def outside_percent(name: str) -> Column:
        c = F.col(name)
        return c.isNull() | (c < 0) | (c > 100)

    def any_negative(*names: str) -> Column:
        bad = F.lit(False)
        for name in names:
            bad = bad | (F.col(name) < 0)
        return bad

    ts = F.col("timestamp")
    return {
        "missing_required_field": F.col("server_id").isNull() | ts.isNull(),
        "invalid_timestamp": ts.isNull() | (ts < F.lit(min_ts)) | (ts > as_of),
        "cpu_out_of_range": outside_percent("cpu_usage_percent"),
        "memory_out_of_range": outside_percent("memory_usage_percent"),
        "disk_out_of_range": outside_percent("disk_usage_percent"),
        "negative_io_or_network": any_negative(
            "disk_io_read", "disk_io_write", "network_rx_bytes", "network_tx_bytes"
        ),
        "negative_errors_or_latency": any_negative("application_error_count", "response_time_ms"),
    }


def reject_reason(rules: dict[str, Column]) -> Column:
    """One reason per row. When several rules fail, the one named last is reported."""
    return F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in reversed(rules.items())])


def all_reasons(rules: dict[str, Column]) -> Column:
    """Every failing rule, in evaluation order (empty for a valid row)."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def derive_status() -> Column:
    """Threshold status of one reading; a null metric trips no threshold."""
    cpu, mem, disk = (F.col(f"{m}_usage_percent") for m in ("cpu", "memory", "disk"))
    errors = F.col("application_error_count")
    return (
        F.when((cpu > 90) | (mem > 90) | (disk > 90), "CRITICAL")
        .when((cpu > 75) | (mem > 75) | (errors > 10), "WARNING")
        .otherwise("OK")
    )


def is_rule_anomaly(status: str = "status") -> Column:
    """The reading's status is WARNING or CRITICAL."""
    return F.col(status).isin(*ANOMALOUS_STATUSES)


def health_score(cfg: HealthConfig = HealthConfig()) -> Column:
    """100 minus weighted penalties, clamped to 0..100, from unrounded inputs.

    ``greatest``/``least`` skip nulls: a null peak costs nothing, and a null error average
    makes the whole penalty null, which clamps to 100.
    """

    def over(name: str, threshold: float) -> Column:
        return F.greatest(F.lit(0.0), F.col(name) - F.lit(threshold))

    penalty = (
        over("peak_cpu_percent", cfg.cpu_threshold)
        + over("peak_memory_percent", cfg.memory_threshold)
        + over("peak_disk_percent", cfg.disk_threshold) * F.lit(cfg.disk_weight)
        + F.col("avg_errors_per_interval") * F.lit(cfg.error_weight)
        + F.col("anomaly_count") * F.lit(cfg.anomaly_weight)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - penalty))


def health_band(score: Column) -> Column:
    """Critical below 60, Warning below 85, else Healthy."""
    return (
        F.when(score < CRITICAL_HEALTH, "Critical")
        .when(score < WARNING_HEALTH, "Warning")
        .otherwise("Healthy")
    )


def alert_severity(score: Column) -> Column:
    """Severity of a low health score; null where no alert is due."""
    return F.when(score < CRITICAL_HEALTH, "CRITICAL").when(score < WARNING_HEALTH, "WARNING")


def bytes_to_mb(value: Column) -> Column:
    """Bytes per interval to megabytes (10^6) per interval."""
    return value / F.lit(1e6)


def per_hour(mean_per_interval: Column, interval_minutes: int = INTERVAL_MINUTES) -> Column:
    """Mean per interval to a rate per hour."""
    return mean_per_interval * F.lit(60.0 / interval_minutes)


def label_result(flag: Column) -> Column:
    """ANOMALY or NORMAL; UNSCORED where there is no flag."""
    return F.when(flag == 1, "ANOMALY").when(flag == 0, "NORMAL").otherwise("UNSCORED")


def hour_in(ts: Column, tz: str = "UTC") -> Column:
    """Hour of day in a zone (the session itself runs in UTC)."""
    return F.hour(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))


def truth(column: str = "is_injected_anomaly") -> Column:
    return F.col(column) == 1


def count_if(condition: Column) -> Column:
    """Number of rows for which the condition is true, 0 when there is none."""
    return F.count(F.when(condition, 1))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
