"""Alerts as a stateful stream (X04): open alerts live in the state store, changes are appended to a log.

Where ``step_alerts`` reads and writes the whole alert table for each snapshot, the stream keeps one small value
per (server, metric) that has an open alert, and puts out a row when an alert opens and one when it is resolved. A
snapshot counts for a server once the watermark has passed it: until then its scores wait in the state (the rows of
one snapshot may come in several files, and the worst counts), and a timer wakes the server up. So results do not
depend on how the snapshots were cut into files or micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fleetlake.functions.rules import CRITICAL_HEALTH, WARNING_HEALTH
from fleetlake.session import settings

METRIC = "health_score"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "server_id string, metric string, severity string, triggered long, resolved boolean, resolved_micros long"
NO_SCORE = float("inf")  # a server whose scores are all null is not alarming


def severity_of(score: float) -> str | None:
    return "CRITICAL" if score < CRITICAL_HEALTH else "WARNING" if score < WARNING_HEALTH else None


class AlertKeeper(StatefulProcessor):
    """One server's open alert and the snapshots that still wait for the watermark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "severity string, triggered long")
        self._waiting = handle.getMapState("waiting", "observed long", "score double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        worst: dict[int, float] = {}
        for row in rows:
            score = NO_SCORE if row.score is None else row.score
            worst[row.observed] = min(score, worst.get(row.observed, NO_SCORE))
        for observed, score in worst.items():
            if self._waiting.containsKey((observed,)):
                score = min(score, self._waiting.getValue((observed,))[0])
            else:
                self._handle.registerTimer(observed // 1000)
            self._waiting.updateValue((observed,), (score,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        found = sorted((k[0], v[0]) for k, v in self._waiting.iterator())
        for observed, score in found:
            if observed // 1000 > due:
                break
            self._waiting.removeKey((observed,))
            yield from self._step(key, severity_of(score), observed)

    def _step(self, key, severity: str | None, now: int) -> Iterator[Row]:
        before = self._open.get() if self._open.exists() else None
        if (before[0] if before else None) == severity:
            return
        names = {"server_id": key[0], "metric": key[1]}
        if before:
            yield Row(**names, severity=before[0], triggered=before[1], resolved=True, resolved_micros=now)
            self._open.clear()
        if severity:
            yield Row(**names, severity=severity, triggered=now, resolved=False, resolved_micros=None)
            self._open.update((severity, now))

    def close(self) -> None:
        pass


def alert_changes(summaries: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Rows of opened and resolved alerts from a stream of ``server_id, health_score, observed_at``."""
    scores = summaries.filter("observed_at is not null").withWatermark("observed_at", delay)
    keyed = scores.select(
        "server_id",
        F.lit(METRIC).alias("metric"),
        "observed_at",
        F.unix_micros("observed_at").alias("observed"),
        F.nanvl(F.col("health_score").cast("double"), F.lit(None)).alias("score"),
    )
    changes = keyed.groupBy("server_id", "metric").transformWithState(
        statefulProcessor=AlertKeeper(), outputStructType=CHANGES, outputMode="Append", timeMode="EventTime"
    )
    return changes.select(
        "server_id",
        "metric",
        "severity",
        F.timestamp_micros("triggered").alias("triggered_at"),
        "resolved",
        F.timestamp_micros("resolved_micros").alias("resolved_at"),
    )


def stream_alerts(
    spark: SparkSession, summaries: str, schema: T.StructType, out: str, ckpt: str, delay: str = "1 hour", max_files: int | None = None
) -> StreamingQuery:
    """Append the changes that new files of health summaries make; ``schema`` has ``observed_at``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    with settings(spark, spark__sql__streaming__stateStore__providerClass=STATE_STORE):
        return (
            alert_changes(reader.parquet(summaries), delay)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", ckpt)
            .option("path", out)
            .trigger(availableNow=True)
            .start()
        )


def streamed_alerts(spark: SparkSession, out: str) -> DataFrame:
    """The alert table from its log: every alert once, resolved if its resolution is there."""
    log = spark.read.schema(
        "server_id string, metric string, severity string, triggered_at timestamp, resolved boolean, resolved_at timestamp"
    ).parquet(out)
    return log.groupBy("server_id", "metric", "severity", "triggered_at").agg(
        F.max("resolved").alias("resolved"), F.max("resolved_at").alias("resolved_at")
    )
