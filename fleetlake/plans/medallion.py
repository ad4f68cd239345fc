"""Raw files to Gold and serving tables: the batch run, built from the operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.rules import MIN_VALID_TIMESTAMP, HealthConfig
from fleetlake.operators.gold import build_daily_metrics, build_server_summary
from fleetlake.operators.quality import orphans
from fleetlake.operators.serving import derive_alerts, insert_absent, server_rows, upsert
from fleetlake.operators.silver import classify, latest_hostname, split, with_outcome
from fleetlake.session import stage
from fleetlake.sources.readings import build_bronze, scan_landing
from fleetlake.sources.tables import (
    HEALTH_SUMMARY_TYPES,
    conform,
    publish,
    read_published,
    read_table,
    save_managed,
    update_published,
    write_split,
    write_table,
)


@dataclass(frozen=True)
class Lake:
    """Where the tables of one lake live: under a path, or in a catalog schema if one is named.

    Serving tables are always path tables, since each load publishes a new version of them.
    """

    root: str
    fmt: str = "parquet"
    schema: str | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
        if self.schema:
            save_managed(df, f"{self.schema}.{table}", partition_by, self.fmt)
        else:
            write_table(df, self.path(table), partition_by, self.fmt)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, f"{self.schema}.{table}" if self.schema else self.path(table), self.fmt)


def run_bronze(spark: SparkSession, landing: str, lake: Lake) -> None:
    """Landing files with lineage, by day (days grow without limit, servers need not)."""
    lake.write(build_bronze(scan_landing(spark, landing)), "bronze", ["dt"])


def run_silver(
    spark: SparkSession,
    lake: Lake,
    as_of: Column | None = None,
    min_ts: datetime = MIN_VALID_TIMESTAMP,
) -> None:
    """Clean once, write valid and rejected rows. Rejects are always written, even if empty.

    Path tables come from a single write by (outcome, dt); tables of a catalog or of another format are written one
    after the other, from a staged copy.
    """
    classified = classify(lake.read(spark, "bronze"), min_ts, as_of)
    if lake.schema is None and lake.fmt == "parquet":
        paths = {"valid": lake.path("silver"), "rejected": lake.path("telemetry_rejects")}
        write_split(with_outcome(classified), "outcome", paths, ["dt"])
        return
    valid, rejects = split(stage(classified, "silver"))
    lake.write(valid, "silver", ["dt"])
    lake.write(rejects, "telemetry_rejects")


def run_gold(spark: SparkSession, lake: Lake, cfg: HealthConfig = HealthConfig()) -> None:
    """Summary and daily metrics from the Silver table."""
    silver = lake.read(spark, "silver")
    lake.write(build_server_summary(silver, cfg), "gold_server_summary")
    lake.write(build_daily_metrics(silver), "gold_daily_metrics", ["dt"])


def run_serving(
    spark: SparkSession,
    lake: Lake,
    meta: DataFrame,
    now: Column | None = None,
    cfg: HealthConfig = HealthConfig(),
) -> None:
    """Load the serving tables: new servers, fresh health snapshot, alerts derived anew.

    Servers that the metadata does not know are loaded with nulls and reported below ``report/orphans``.
    """
    stamp = F.current_timestamp() if now is None else now
    # A renamed host has two rows in Gold; the serving tables have one row per server, over all
    # of its readings.
    summary = stage(build_server_summary(latest_hostname(lake.read(spark, "silver")), cfg), "snapshot")
    servers = server_rows(summary, meta).withColumn("created_at", stamp)
    health = conform(summary, HEALTH_SUMMARY_TYPES).withColumn("updated_at", stamp)

    write_table(orphans(summary.select("server_id", "hostname"), meta, "server_id"), lake.path("report/orphans"))

    def with_new_servers(known: DataFrame | None) -> DataFrame:
        return insert_absent(servers.limit(0) if known is None else known, servers, ["server_id"])

    def with_new_health(known: DataFrame | None) -> DataFrame:
        return upsert(health.limit(0) if known is None else known, health.drop("updated_at"), ["server_id"], stamp)

    update_published(spark, lake.path("servers"), with_new_servers)
    update_published(spark, lake.path("server_health_summary"), with_new_health)
    snapshot = read_published(spark, lake.path("server_health_summary"))
    publish(derive_alerts(snapshot, stamp), lake.path("alerts"))


def run_medallion(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    meta: DataFrame,
    as_of: Column | None = None,
    cfg: HealthConfig = HealthConfig(),
) -> None:
    """Landing to serving in one call."""
    run_bronze(spark, landing, lake)
    run_silver(spark, lake, as_of)
    run_gold(spark, lake, cfg)
    run_serving(spark, lake, meta, cfg=cfg)
