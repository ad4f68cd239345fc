"""The cleaning and incident logic on Structured Streaming (X01-X03), and the alert step.

The streams here end in tables that equal what the batch operators give for the same input, but for one thing:
of several readings with one key the stream keeps the first that arrives, and ``order_by`` decides only among
those of one micro-batch. A micro-batch that is run again after a failure leaves its table unchanged.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetlake.functions.rules import (
    INTERVAL_MINUTES,
    MIN_VALID_TIMESTAMP,
    alert_severity,
    rounded,
    validity_rules,
)
from fleetlake.operators.incidents import DETECTION_METHOD, dominant_feature, peak_struct
from fleetlake.operators.scaling import FEATURES
from fleetlake.operators.series import MICROS
from fleetlake.operators.silver import KEYS, classify
from fleetlake.session import listing_settings, settings
from fleetlake.sources import filelist
from fleetlake.sources.readings import LANDED, build_bronze, landed, stored
from fleetlake.sources.tables import publish, read_published
from fleetlake.streaming import key_index

ODD_PARTS = 64  # rows without a plausible timestamp are dealt to so many parts


def stream_bronze(
    spark: SparkSession,
    root: str,
    out: str,
    ckpt: str,
    max_files: int | None = None,
    schema: T.StructType = LANDED,
) -> StreamingQuery:
    """Pick up new landing files, add lineage, append to Bronze by day.

    Runs over what is there and stops; call it again (or change the trigger) to continue.
    """
    reader = spark.readStream.schema(stored(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with listing_settings(spark):
        return (
            build_bronze(landed(reader.parquet(root), schema))
            .writeStream.format("parquet")
            .partitionBy("dt")
            .option("checkpointLocation", ckpt)
            .option("path", out)
            .trigger(availableNow=True)
            .start()
        )


def _batch_key(spark: SparkSession, ckpt: str, batch_id: int) -> tuple[str, int]:
    """The query that a checkpoint belongs to, and the number of its micro-batch."""
    return json.loads(filelist.read_text(spark, f"{ckpt}/metadata"))["id"], batch_id


Each = Callable[[SparkSession, DataFrame, tuple[str, int]], None]


def stream_silver(
    spark: SparkSession,
    bronze: str,
    out: str,
    ckpt: str,
    schema: T.StructType,
    as_of: Column | None = None,
    min_ts: datetime = MIN_VALID_TIMESTAMP,
    order_by: list[Column] | None = None,
    max_files: int | None = None,
    each: Each | None = None,
) -> StreamingQuery:
    """Clean new Bronze rows; a key seen in any earlier batch, valid or not, is a copy.

    Rows are stored by day, and beside each file a filter of its keys by hour. A batch looks at the filters of
    the days it touches, opens the files that may hold one of its keys (few: copies are rare, chance hits one in
    hundreds) and leaves out the keys it finds there. So the check is exact however late a copy arrives, needs
    no state store, and its cost follows the batch and not what is stored. Invalid timestamps rule out an event-time
    watermark here: one reading from the year 2099 would make all later ones late.

    A batch becomes visible with one commit, which also says that it is done. ``each`` is called after it with the
    rows that the batch stored, rejects included; after a failure in between it is called for them again.
    """

    def clean(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query, _ = key = _batch_key(session, ckpt, batch_id)
        now = filelist.listing(session, out)
        if now.notes.get("done", {}).get(query, -1) < batch_id:
            now = _store(session, batch, now, query, batch_id)
        if each:
            last = [filelist.Folder(*f) for f in now.notes["last"]]
            rows = filelist.read_folders(session, out, last, now.schema)
            if rows is not None:
                each(session, rows, key)

    def _store(session: SparkSession, batch: DataFrame, now: filelist.Listing, query: str, batch_id: int) -> filelist.Listing:
        upper = F.current_timestamp() if as_of is None else as_of
        implausible = validity_rules(upper, min_ts)["invalid_timestamp"]
        # Plausible days are few; all other timestamps are dealt by their keys.
        odd = F.concat(F.lit("odd-"), F.pmod(key_index.key_hash(KEYS), F.lit(ODD_PARTS)).cast("string"))
        day = F.when(~implausible, F.to_date("timestamp").cast("string")).otherwise(odd)
        # Written where it will stay, out of sight until the commit. Only parts in which a stored key may come again
        # are read back and written once more without it.
        rows = classify(batch, min_ts, as_of, order_by).withColumn("_day", day)
        kept = [c for c in rows.columns if c != "_day"]
        schema = rows.select(*kept).schema
        added = filelist.write_folders(rows, out, F.col("_day"), keep=kept)
        touched, files = now.of({f.part for f in added}), []
        if touched:
            days = {f.part for f in touched}
            fresh = filelist.read_parts(session, out, [f for f in added if f.part in days], schema.json(), "_day")
            files = key_index.files_that_may_hold(session, out, touched, fresh, KEYS, "timestamp")
        if files:
            with listing_settings(session):
                known = session.read.schema(T.StructType.fromJson(json.loads(now.schema))).parquet(*files).select(*KEYS)
            known = known.withColumnsRenamed({k: f"_known_{k}" for k in KEYS})
            same = F.lit(True)
            for k in KEYS:
                same = same & F.col(k).eqNullSafe(F.col(f"_known_{k}"))
            holding = {"/".join(name.split("/")[-4:-1]) for name in files}
            again = {f.part for f in touched if f.path in holding}
            new = fresh.filter(F.col("_day").isin(sorted(again))).join(known, same, "left_anti")
            rewritten = filelist.write_folders(new, out, F.col("_day"), keep=kept)
            added = [f for f in added if f.part not in again] + rewritten
        schema_json = schema.json()
        for write in sorted({f.path.split("/")[1] for f in added}):
            key_index.write_index(session, out, [f for f in added if f.path.split("/")[1] == write], schema_json, KEYS, "timestamp")
        notes = {
            "done": {**now.notes.get("done", {}), query: batch_id},
            "last": [[f.part, f.path, f.files, f.size] for f in added],
            "opened": len(files),
            "touched": sum(f.files for f in touched),
        }
        return filelist.swap(session, out, [], added, schema_json, notes)

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with listing_settings(spark):
        return (
            reader.parquet(bronze)
            .writeStream.foreachBatch(clean)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start()
        )


def streamed_silver(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` as stored so far by ``stream_silver``."""
    rows = filelist.read(spark, out)
    reason = F.col("_reject_reason")
    return rows.filter(reason.isNull()).drop("_reject_reason"), rows.filter(reason.isNotNull())


def compact_silver(spark: SparkSession, out: str, small: int = filelist.SMALL_BYTES, target: int = filelist.TARGET_BYTES) -> filelist.Listing:
    """Rewrite the small files of streamed Silver together, with their key filters; a stream may go on meanwhile."""
    schema = filelist.listing(spark, out).schema

    def index(added: list[filelist.Folder]) -> None:
        key_index.write_index(spark, out, added, schema, KEYS, "timestamp")

    return filelist.compact(spark, out, small, target, index)


def session_events(
    scored: DataFrame,
    gap: str = "30 minutes",
    delay: str = "1 hour",
    features: list[str] = FEATURES,
) -> DataFrame:
    """Incidents of a scored stream (or batch), closed once the watermark passes them.

    Same columns as ``build_events``. Severity compares all incidents with each other, so it
    is assigned on the resulting table.
    """
    readings = dominant_feature(scored.filter("is_anomaly = 1"), features)
    if scored.isStreaming:
        readings = readings.withWatermark("timestamp", delay)
    incidents = readings.groupBy("server_id", F.session_window("timestamp", gap).alias("_span")).agg(
        F.min("timestamp").alias("_start"),
        F.max("timestamp").alias("_end"),
        F.count(F.lit(1)).alias("readings"),
        peak_struct("anomaly_score", ["metric", "value"]).alias("_peak"),
    )
    whole_minutes = F.floor((F.unix_micros("_end") - F.unix_micros("_start")) / MICROS["minute"])
    return incidents.select(
        "server_id",
        F.col("_start").alias("timestamp"),
        F.timestamp_micros(-F.col("_peak._age")).alias("peak_timestamp"),
        F.col("_peak.metric").alias("metric"),
        rounded(F.col("_peak.value"), 4).alias("value"),
        rounded(F.col("_peak._score"), 4).alias("peak_score"),
        "readings",
        (whole_minutes + INTERVAL_MINUTES).cast("int").alias("duration_minutes"),
        F.lit(DETECTION_METHOD).alias("detection_method"),
    )


def stream_events(
    scored: DataFrame, out: str, ckpt: str, gap: str = "30 minutes", delay: str = "1 hour"
) -> StreamingQuery:
    """Append closed incidents to a table."""
    # Combine a server's readings on the map side, so a busy server is not shuffled whole.
    with settings(scored.sparkSession, spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition="true"):
        return (
            session_events(scored, gap, delay)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", ckpt)
            .option("path", out)
            .trigger(availableNow=True)
            .start()
        )


ALERT_COLUMNS = [
    "server_id",
    "metric",
    "severity",
    "triggered_at",
    "resolved",
    "resolved_at",
]


def step_alerts(alerts: DataFrame, summary: DataFrame, now: Column) -> DataFrame:
    """The alert table after one more health summary.

    A server that crosses into a severity opens an alert, one that stays in it keeps the
    alert it has, one that leaves it has the alert resolved (and a new one opened if it
    moved to the other severity). A server missing from the summary is left as it is, and
    resolved alerts never change. Applying the same summary twice changes nothing.

    A server counts once, by the worst of its rows (a renamed host has several), and keeps
    one open alert per metric, the earliest.
    """
    metric = F.lit("health_score")
    worst = summary.groupBy("server_id").agg(F.min(F.col("health_score").cast("double")).alias("_score"))
    judged = worst.select(
        "server_id",
        metric.alias("metric"),
        alert_severity(F.col("_score")).alias("_severity"),
        F.lit(True).alias("_judged"),
    )
    rest = ["triggered_at", "severity", "resolved", "resolved_at"]
    is_open = (
        alerts.filter(~F.col("resolved"))
        .groupBy("server_id", "metric")
        .agg(F.min(F.struct(*rest)).alias("_a"))
        .select("server_id", "metric", *[F.col(f"_a.{c}") for c in ALERT_COLUMNS[2:]])
    )
    both = is_open.join(judged, ["server_id", "metric"], "full")
    before, after = F.col("severity"), F.col("_severity")
    stays = F.col("_judged").isNull() | before.eqNullSafe(after)

    def row(severity: Column, triggered: Column, resolved: Column, at: Column) -> Column:
        parts = [severity, triggered, resolved, at]
        return F.struct(*[p.alias(n) for p, n in zip(parts, ALERT_COLUMNS[2:])])

    no_time = F.lit(None).cast("timestamp")
    old = F.when(
        before.isNotNull(),
        F.when(stays, row(before, F.col("triggered_at"), F.lit(False), no_time)).otherwise(
            row(before, F.col("triggered_at"), F.lit(True), now)
        ),
    )
    new = F.when(after.isNotNull() & ~stays, row(after, now, F.lit(False), no_time))
    stepped = both.select(
        "server_id", "metric", F.explode(F.array_compact(F.array(old, new))).alias("a")
    ).select("server_id", "metric", "a.*")
    return alerts.filter("resolved").select(*ALERT_COLUMNS).unionByName(stepped)


def stream_alerts(
    spark: SparkSession, summaries: str, schema: T.StructType, root: str, ckpt: str
) -> StreamingQuery:
    """Step the published alert table for every new file of health summaries."""
    empty = spark.createDataFrame(
        [],
        "server_id string, metric string, severity string, triggered_at timestamp, "
        "resolved boolean, resolved_at timestamp",
    )

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        current = read_published(session, root)
        publish(
            step_alerts(empty if current is None else current, batch, F.current_timestamp()), root
        )

    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(summaries)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
