"""Lakehouse and serving tables: write, read, replace, export."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.sources import filelist

# Column types of the serving tables.
HEALTH_SUMMARY_TYPES = {
    "server_id": "string",
    "avg_cpu_percent": "decimal(5,2)",
    "peak_cpu_percent": "decimal(5,2)",
    "avg_memory_percent": "decimal(5,2)",
    "peak_memory_percent": "decimal(5,2)",
    "avg_disk_percent": "decimal(5,2)",
    "peak_disk_percent": "decimal(5,2)",
    "avg_network_rx_bytes": "decimal(14,2)",
    "avg_network_tx_bytes": "decimal(14,2)",
    "avg_errors_per_interval": "decimal(6,2)",
    "errors_per_hour": "decimal(6,2)",
    "avg_response_time_ms": "decimal(8,2)",
    "peak_response_time_ms": "decimal(8,2)",
    "anomaly_count": "int",
    "total_readings": "int",
    "disk_trend_percent_change": "decimal(6,2)",
    "health_score": "decimal(5,1)",
}
ANOMALY_TYPES = {
    "server_id": "string",
    "timestamp": "timestamp",
    "metric": "string",
    "value": "decimal(14,4)",
    "severity": "string",
    "detection_method": "string",
    "description": "string",
}
# Columns of the scored-readings file, before the features.
SCORED_KEYS = ["timestamp", "server_id", "result", "is_anomaly", "anomaly_score"]


def _layout(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """One file per partition value where it fits; oversized values are split."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet"
) -> None:
    """Overwrite a path table. ``fmt='delta'`` works where the connector is installed."""
    writer = _layout(df, partition_by).write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def write_split(df: DataFrame, outcome: str, paths: dict[str, str], partition_by: list[str]) -> None:
    """Overwrite several path tables with one write, by the value of ``outcome`` (all values are in ``paths``).

    Rows go once to ``outcome=<value>/...`` in a folder beside the tables, whose parts then become the tables by
    renaming. A table without rows is written empty, so that it can be read.
    """
    spark = df.sparkSession
    draft = f"{next(iter(paths.values()))}.{uuid.uuid4().hex}"
    _layout(df, [outcome, *partition_by]).write.partitionBy(outcome, *partition_by).parquet(draft)
    for value, path in paths.items():
        if not move_folder(spark, f"{draft}/{outcome}={value}", path):
            write_table(spark.createDataFrame([], df.drop(outcome).schema), path)
    remove_folder(spark, draft)


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def move_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Put a folder in the place of another; False if there is no such folder."""
    old, fs = _folder(spark, source)
    new, _ = _folder(spark, target)
    if not fs.exists(old):
        return False
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    target, fs = _folder(spark, path)
    fs.delete(target, True)


def save_managed(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Overwrite a catalog table and replace its schema.

    With a ``location`` the catalog points there instead of into its warehouse.
    """
    writer = _layout(df, partition_by).write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, ref: str, fmt: str = "parquet") -> DataFrame:
    """A reference with a slash or a scheme is a path, any other is a catalog name."""
    return spark.read.format(fmt).load(ref) if "/" in ref else spark.table(ref)


def publish(df: DataFrame, root: str) -> int:
    """Replace a path table that ``df`` may itself be reading.

    Plain Parquet cannot overwrite its own input, and a reader must never see half a table. So the new version goes
    to a folder of its own, and the table's numbered list then names this folder only. The last of several
    writers wins; one whose rows depend on the table uses ``update_published``. Old versions stay until they are expired.
    """
    added = tuple(filelist.write_folders(df, root))

    def change(base: filelist.Listing) -> filelist.Listing:
        return filelist.Listing(base.number, df.schema.json(), added, base.notes)

    return filelist.commit(df.sparkSession, root, change).number


def update_published(spark: SparkSession, root: str, change: Callable[[DataFrame | None], DataFrame]) -> int:
    """Replace a table by ``change`` of it (of None if it is new), again if another writer came first."""
    return filelist.update(spark, root, change).number


def read_published(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest published version, or ``None`` if nothing was published yet."""
    return filelist.read(spark, root)


def write_scores(scored: DataFrame, path: str, features: list[str]) -> None:
    """Scored readings, keys first and then the features."""
    scored.select(*SCORED_KEYS, *features).write.mode("overwrite").parquet(path)


def write_events(events: DataFrame, path: str) -> None:
    """Incidents."""
    events.write.mode("overwrite").parquet(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None
) -> None:
    """Export to an RDBMS. ``overwrite`` truncates, so keys and grants stay in place."""
    df.write.option("truncate", mode == "overwrite").jdbc(url, table, mode, properties or {})


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Project and cast to serving types; a value that does not fit becomes null."""
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def overflow_report(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column, how many non-null values do not fit the serving type."""
    lost = [
        F.count(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1)).alias(c)
        for c, t in types.items()
    ]
    return df.agg(*lost).unpivot([], list(types), "column_name", "lost_values")
