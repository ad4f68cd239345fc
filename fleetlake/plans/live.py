"""Live runs: new landing files through Silver, Gold, alerts, scores and incidents, each as far as it has come.

Every table is a numbered file list, and every step keeps with its commit how far it is. A run that broke off is
run again: finished steps are passed over, the others start from what they last committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators.carried import continued_incidents
from fleetlake.plans.detection import recent, score_new
from fleetlake.session import stage
from fleetlake.sources import filelist
from fleetlake.sources.readings import LANDED
from fleetlake.streaming import alerts, live_gold, streams

BRONZE = T.StructType(
    [
        *LANDED.fields,
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)
SNAPSHOT = "server_id string, health_score double, observed_at timestamp"


def run_live(spark: SparkSession, landing: str, base: str, as_of: Column | None = None) -> None:
    """Pick up new landing files, clean them, and refresh the states and days they touch."""

    def refresh(session: SparkSession, rows: DataFrame, key: tuple[str, int]) -> None:
        live_gold.add_batch(session, f"{base}/gold", rows, key)

    streams.stream_bronze(spark, landing, f"{base}/bronze", f"{base}/ckpt-bronze").awaitTermination()
    streams.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/ckpt-silver", BRONZE, as_of=as_of, each=refresh
    ).awaitTermination()


def watch(spark: SparkSession, base: str, now: Column | None = None, delay: str = "1 minute") -> DataFrame | None:
    """Take a health snapshot of live Gold and step the alert stream; the alerts so far.

    A snapshot is judged once a later one has moved the watermark past it.
    """
    summary = live_gold.live_summary(spark, f"{base}/gold", f"{base}/silver")
    if summary is None:
        return None
    observed = F.current_timestamp() if now is None else now
    snapshot = summary.select("server_id", F.col("health_score").cast("double"), observed.alias("observed_at"))
    snapshot.write.mode("append").parquet(f"{base}/snapshots")
    schema = T.StructType.fromDDL(SNAPSHOT)
    alerts.stream_alerts(spark, f"{base}/snapshots", schema, f"{base}/alerts", f"{base}/ckpt-alerts", delay).awaitTermination()
    return alerts.streamed_alerts(spark, f"{base}/alerts")


def _until(spark: SparkSession, root: str) -> int:
    return filelist.listing(spark, root).notes.get("until", -(1 << 62))


def score_later(spark: SparkSession, valid: DataFrame, model: str, out: str, earlier: DataFrame | None = None) -> int:
    """M05-M07 for readings that no run has scored yet; the instant up to which they are scored (in microseconds).

    ``valid`` may hold any number of earlier readings, which are filtered out where they are read. Slopes go on from
    the last readings of each server (of ``earlier`` in the first run), incidents from those that were still open.
    """
    done = _until(spark, f"{out}/scores")
    fresh = stage(valid.filter(F.unix_micros("timestamp") > done), "fresh")
    last = fresh.agg(F.unix_micros(F.max("timestamp")).alias("until")).first()["until"]
    if last is None:
        return done
    notes = {"until": last}
    before = filelist.read(spark, f"{out}/recent")
    before = earlier if before is None else before
    scored = stage(score_new(fresh, model, before), "scored")
    if _until(spark, f"{out}/open") < last:
        spans = filelist.read(spark, f"{out}/open")
        end = F.timestamp_micros(F.lit(last))
        finished, still_open = continued_incidents(spans, scored, end)
        if _until(spark, f"{out}/incidents") < last:
            filelist.append(finished, f"{out}/incidents", notes=notes)
        gone = list(filelist.listing(spark, f"{out}/open").folders)
        filelist.replace(still_open, f"{out}/open", gone, notes=notes)
    filelist.append(scored, f"{out}/scores", F.to_date("timestamp"), notes)
    # After the scores, since a run that broke off before them needs the earlier readings again.
    both = fresh if before is None else fresh.unionByName(before.select(*fresh.columns))
    gone = list(filelist.listing(spark, f"{out}/recent").folders)
    filelist.replace(recent(both), f"{out}/recent", gone, notes=notes)
    return last
