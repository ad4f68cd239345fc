"""Detector features and per-server robust scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.rules import MAD_TO_SIGMA, READINGS_PER_DAY, hour_in
from fleetlake.operators.quantiles import column_quantiles
from fleetlake.operators.series import rolling_slopes
from fleetlake.session import stage

# The detector's features, in the order that breaks ties between them.
BASE_FEATURES = [
    "cpu_usage_percent",
    "memory_usage_percent",
    "disk_usage_percent",
    "network_rx_bytes",
    "network_tx_bytes",
    "error_count_log",
    "response_time_ms",
]
SLOPE_FEATURES = {"mem_slope_24h": "memory_usage_percent", "disk_slope_24h": "disk_usage_percent"}
FEATURES = [*BASE_FEATURES, *SLOPE_FEATURES]
MIN_MAD = 1e-6
STD_FLOOR = 1e-9


def build_features(df: DataFrame, window: int = READINGS_PER_DAY, **options) -> DataFrame:
    """Add log error counts and 24 h slopes of memory and disk (0 while warming up)."""
    logged = df.withColumn("error_count_log", F.log1p(F.col("application_error_count")))
    return rolling_slopes(logged, SLOPE_FEATURES, window, **options)


def hour_features(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """Hour of day as a point on a circle (optional, off by default)."""
    angle = hour_in(F.col("timestamp"), tz) * F.lit(2.0) * F.pi() / F.lit(24.0)
    return df.withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)})


def fit_scalers(df: DataFrame, features: list[str] = FEATURES, by: str = "server_id") -> DataFrame:
    """``(server, feature, median, scale)``.

    The scale is the median absolute deviation, or the sample standard deviation where that
    is (nearly) zero. All features are fitted together, in a few passes over ``df``, so hand
    in a written table rather than a long plan.
    """
    key = [by, "feature"]
    values = df.select(by, *[F.col(f).cast("double").alias(f) for f in features])
    centre = stage(column_quantiles(values, [by], features, {"median": 0.5}), "medians")
    deviations = values.join(_in_columns(centre, ["median"], features, by), by).select(
        by, *[F.abs(F.col(f) - F.col(f"_median_{f}")).alias(f) for f in features]
    )
    spread = column_quantiles(deviations, [by], features, {"mad": 0.5})
    fallback = values.groupBy(by).agg(
        *[(F.stddev_samp(f) + F.lit(STD_FLOOR)).alias(f) for f in features]
    )
    scale = F.when(F.col("mad") > MIN_MAD, F.col("mad")).otherwise(F.col("std"))
    return (
        centre.join(spread, key)
        .join(fallback.unpivot([by], features, "feature", "std"), key)
        .select(*key, "median", scale.alias("scale"))
    )


def _in_columns(stats: DataFrame, names: list[str], features: list[str], by: str) -> DataFrame:
    """``(server, feature, stat...)`` as one row per server with ``_<stat>_<feature>`` columns."""
    return stats.groupBy(by).agg(
        *[
            F.max(F.when(F.col("feature") == f, F.col(name))).alias(f"_{name}_{f}")
            for f in features
            for name in names
        ]
    )


def attach_scalers(df: DataFrame, scalers: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Put each server's medians and scales beside its readings.

    One scaler row per server; Spark broadcasts it while it is small, and otherwise joins
    by shuffle, where adaptive execution splits a server with very many readings.
    """
    wide = _in_columns(scalers, ["median", "scale"], features, "server_id")
    return df.join(wide, "server_id", "left")


def apply_scalers(
    df: DataFrame, scalers: DataFrame, features: list[str] = FEATURES, cap: float | None = None
) -> DataFrame:
    """Add ``z_<feature>``; null for a server without scalers (see ``unscaled_servers``)."""
    z = {
        f"z_{f}": F.lit(MAD_TO_SIGMA) * (F.col(f) - F.col(f"_median_{f}")) / F.col(f"_scale_{f}")
        for f in features
    }
    scaled = attach_scalers(df, scalers, features).withColumns(z).select(*df.columns, *z)
    return scaled if cap is None else winsorise(scaled, features, cap)


def unscaled_servers(df: DataFrame, scalers: DataFrame) -> DataFrame:
    """Servers whose readings cannot be scored because no scaler was fitted for them."""
    seen = df.groupBy("server_id").agg(F.count(F.lit(1)).alias("readings"))
    return seen.join(scalers.select("server_id").distinct(), "server_id", "left_anti")


def winsorise(df: DataFrame, features: list[str] = FEATURES, cap: float = 8.0) -> DataFrame:
    """Limit every z to plus or minus ``cap`` (optional, off by default)."""
    limited = {
        f"z_{f}": F.when(
            F.col(f"z_{f}").isNotNull(),
            F.greatest(F.lit(-cap), F.least(F.lit(cap), F.col(f"z_{f}"))),
        )
        for f in features
    }
    return df.withColumns(limited)
