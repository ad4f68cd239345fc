"""Flagged readings to incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import INTERVAL_MINUTES, rounded
from fleetlake.operators.scaling import FEATURES
from fleetlake.operators.series import MICROS, session_cells
from fleetlake.session import stage

# How an incident names a feature, and which raw column holds its value.
METRIC_LABELS = {
    "error_count_log": "application_error_count",
    "mem_slope_24h": "memory_usage_percent (trend)",
    "disk_slope_24h": "disk_usage_percent (trend)",
}
RAW_VALUE_COLUMNS = {
    "error_count_log": "application_error_count",
    "mem_slope_24h": "memory_usage_percent",
    "disk_slope_24h": "disk_usage_percent",
}
DETECTION_METHOD = "ml_isolation_forest"
MERGE_GAP = 30 * MICROS["minute"]

EVENT_COLUMNS = [
    "server_id",
    "timestamp",
    "peak_timestamp",
    "metric",
    "value",
    "peak_score",
    "readings",
    "duration_minutes",
    "detection_method",
    "severity",
    "description",
]


def _dominant(features: list[str], pick: dict[str, Column]) -> Column:
    """The entry of ``pick`` for the feature with the largest absolute z; ties in list order."""
    sizes = {f: F.abs(F.col(f"z_{f}")) for f in features}
    largest = F.greatest(*sizes.values()) if len(features) > 1 else sizes[features[0]]
    choice = None
    for f in features:
        condition = sizes[f] == largest
        choice = F.when(condition, pick[f]) if choice is None else choice.when(condition, pick[f])
    return choice


def dominant_feature(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """``dominant_feature``, its ``metric`` label and the raw ``value`` of each reading."""
    raw = {f: F.col(RAW_VALUE_COLUMNS.get(f, f)).cast("double") for f in features}
    label = {f: F.lit(METRIC_LABELS.get(f, f)) for f in features}
    return df.withColumns(
        {
            "dominant_feature": _dominant(features, {f: F.lit(f) for f in features}),
            "metric": _dominant(features, label),
            "value": _dominant(features, raw),
        }
    )


def peak_struct(score: str, columns: list[str], ts: str = "timestamp") -> Column:
    """The reading with the highest score, carried through an aggregation.

    Ties go to the earliest reading. The score and the negated time come first in the
    struct, so ``max`` picks the reading and no lookup join is needed.
    """
    return F.max(F.struct(F.col(score).alias("_score"), (-F.unix_micros(ts)).alias("_age"), *columns))


def build_events(
    flagged: DataFrame,
    features: list[str] = FEATURES,
    gap_micros: int = MERGE_GAP,
    method: str = DETECTION_METHOD,
) -> DataFrame:
    """One row per incident: flagged readings at most ``gap`` apart, per server.

    Readings are first combined to cells no wider than the gap (mostly on the map side), so
    what is ordered per server is bounded by the length of the time range.
    """
    return described(incident_spans(flagged, features, gap_micros), method)


def incident_spans(flagged: DataFrame, features: list[str] = FEATURES, gap_micros: int = MERGE_GAP) -> DataFrame:
    """``(server_id, timestamp, _end, readings, _peak)`` of every run of flagged readings; spans can be merged."""
    readings = dominant_feature(flagged.filter("is_anomaly = 1"), features)
    cells = session_cells(
        readings,
        gap_micros,
        aggregates=[
            F.count(F.lit(1)).alias("_n"),
            peak_struct("anomaly_score", ["metric", "value"]).alias("_peak"),
        ],
    )
    return cells.groupBy("server_id", "session").agg(
        F.min("_first").alias("timestamp"),
        F.max("_last").alias("_end"),
        F.sum("_n").alias("readings"),
        F.max("_peak").alias("_peak"),
    ).drop("session")


def described(spans: DataFrame, method: str = DETECTION_METHOD) -> DataFrame:
    """Incidents from their spans."""
    whole_minutes = F.floor((F.unix_micros("_end") - F.unix_micros("timestamp")) / MICROS["minute"])
    return spans.select(
        "server_id",
        "timestamp",
        F.timestamp_micros(-F.col("_peak._age")).alias("peak_timestamp"),
        F.col("_peak.metric").alias("metric"),
        rounded(F.col("_peak.value"), 4).alias("value"),
        rounded(F.col("_peak._score"), 4).alias("peak_score"),
        "readings",
        (whole_minutes + INTERVAL_MINUTES).cast("int").alias("duration_minutes"),
        F.lit(method).alias("detection_method"),
    )


def rank_all(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Position (from 1) of every row in one global order, without a one-task window.

    The rows are sorted across partitions and written with their position inside the
    partition; adding the sizes of the earlier partitions, a table with one row per
    partition, gives the global position.
    """
    inside = (F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("_inside")
    part = F.shiftright("_at", 33).alias("_part")
    placed = stage(
        df.orderBy(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .select(*df.columns, part, inside),
        "ranked",
    )
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_inside") + 1)
        .select(*df.columns, name)
    )


def assign_severity(events: DataFrame) -> DataFrame:
    """The third of incidents with the highest peak score (at least one) is CRITICAL."""
    order = [F.desc("peak_score"), F.col("server_id"), F.col("timestamp")]
    ranked = rank_all(events, order, "_rank")
    total = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    critical = F.col("_rank") <= F.greatest(F.lit(1), F.floor(total / F.lit(3)))
    return ranked.withColumn(
        "severity", F.when(critical, "CRITICAL").otherwise("WARNING")
    ).drop("_rank")


def event_description() -> Column:
    """One sentence per incident."""
    return F.format_string(
        "Isolation Forest flagged %s on %s: %s flagged readings spanning ~%s minutes "
        "(peak reading %s UTC, anomaly score %s).",
        "metric",
        "server_id",
        F.col("readings").cast("string"),
        F.col("duration_minutes").cast("string"),
        F.date_format("peak_timestamp", "yyyy-MM-dd HH:mm"),
        F.col("peak_score").cast("decimal(18,6)").cast("decimal(18,3)").cast("string"),
    )


def finish_events(events: DataFrame, ordered: bool = True) -> DataFrame:
    """Severity, text and final order; an empty input gives the same typed columns."""
    finished = (
        assign_severity(events).withColumn("description", event_description()).select(*EVENT_COLUMNS)
    )
    return finished.orderBy("server_id", "timestamp") if ordered else finished
