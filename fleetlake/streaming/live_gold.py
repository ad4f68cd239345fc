"""Gold kept up to date from streamed Silver (X02, A04, A05): mergeable states per server and day.

A state holds sums, counts and peaks of one (server, host, day). A micro-batch makes states of its own
rows, merges them with those of the days it touches, and puts the result in their place; the daily table is then
rebuilt for these days only. So a batch costs its own rows and one small file per touched day, however much is
stored. The summary is built from the states of all days and the readings of a single day, the one in the middle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import HealthConfig, count_if, is_rule_anomaly, per_hour, round_cols, rounded
from fleetlake.operators.gold import ROUNDED, UTILISATION, with_health_score
from fleetlake.session import stage
from fleetlake.sources import filelist

KEYS = ["server_id", "hostname", "dt"]
AVERAGED = {
    **{f"avg_{short}_percent": column for short, column in UTILISATION.items()},
    "avg_network_rx_bytes": "network_rx_bytes",
    "avg_network_tx_bytes": "network_tx_bytes",
    "avg_errors_per_interval": "application_error_count",
    "avg_response_time_ms": "response_time_ms",
}
PEAKS = {**{f"peak_{short}_percent": column for short, column in UTILISATION.items()}, "peak_response_time_ms": "response_time_ms"}
COUNTED = ["anomaly_count", "total_readings"]


def _sum(name: str) -> str:
    return f"{name}__sum"


def _count(name: str) -> str:
    return f"{name}__n"


def gold_states(valid: DataFrame) -> DataFrame:
    """One row per (server, host, day): what averages, peaks and counts are made of."""
    means = [e for name, c in AVERAGED.items() for e in (F.sum(F.col(c).cast("double")).alias(_sum(name)), F.count(c).alias(_count(name)))]
    peaks = [F.max(c).alias(name) for name, c in PEAKS.items()]
    counts = [count_if(is_rule_anomaly()).alias("anomaly_count"), F.count(F.lit(1)).alias("total_readings")]
    bounds = [F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp")]
    return valid.groupBy(*KEYS).agg(*means, *peaks, *counts, *bounds)


def merged(states: DataFrame, by: list[str] = KEYS) -> DataFrame:
    """States of the same group as one."""
    means = [F.sum(f(name)).alias(f(name)) for name in AVERAGED for f in (_sum, _count)]
    peaks = [F.max(name).alias(name) for name in PEAKS]
    counts = [F.sum(name).alias(name) for name in COUNTED]
    bounds = [F.min("first_timestamp").alias("first_timestamp"), F.max("last_timestamp").alias("last_timestamp")]
    return states.groupBy(*by).agg(*means, *peaks, *counts, *bounds)


def _means() -> list[Column]:
    return [F.try_divide(_sum(name), _count(name)).alias(name) for name in AVERAGED]


def daily_from_states(states: DataFrame) -> DataFrame:
    """A05 from states: the columns of ``build_daily_metrics``."""
    days = merged(states, ["server_id", "dt"])
    pairs = [c for short in UTILISATION for c in (f"avg_{short}_percent", f"peak_{short}_percent")]
    columns = ["server_id", "dt", *pairs, *ROUNDED[len(pairs) :], "anomaly_count"]
    peaks = [c for c in pairs if c in PEAKS]
    return round_cols(days.select("server_id", "dt", *_means(), *peaks, "anomaly_count"), ROUNDED).select(*columns)


def middle(states: DataFrame):
    """The middle instant of the fleet and its day, as one row, by the rule of ``gold.midpoint``."""
    first, last = F.unix_micros(F.min("first_timestamp")), F.unix_micros(F.max("last_timestamp"))
    micros = first + F.bround((last - first) / F.lit(2)).cast("long")
    return states.agg(micros.alias("micros"), F.to_date(F.timestamp_micros(micros)).cast("string").alias("day")).first()


def summary_from_states(states: DataFrame, readings_of_day, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """A04 from states: the rows of ``build_server_summary``.

    ``readings_of_day`` gives the valid readings of one day; only the day in the middle is asked for, since all
    readings of another day are in the same half.
    """
    states = stage(states, "states")
    mid = middle(states)
    disk = "avg_disk_percent"
    if mid["day"] is None:
        half = states.select("server_id", *[F.lit(0.0).alias(c) for c in ("_s1", "_s2")], *[F.lit(0).alias(c) for c in ("_n1", "_n2")])
    else:
        early, whole = F.col("dt") < F.lit(mid["day"]).cast("date"), states.filter(F.col("dt") != F.lit(mid["day"]).cast("date"))
        value = F.col("disk_usage_percent").cast("double")
        before = F.unix_micros("timestamp") < F.lit(mid["micros"])
        split = readings_of_day(mid["day"]).groupBy("server_id").agg(
            F.sum(F.when(before, value)).alias("_s1"),
            F.sum(F.when(~before, value)).alias("_s2"),
            F.count(F.when(before, value)).alias("_n1"),
            F.count(F.when(~before, value)).alias("_n2"),
        )
        half = whole.select(
            "server_id",
            F.when(early, F.col(_sum(disk))).alias("_s1"),
            F.when(~early, F.col(_sum(disk))).alias("_s2"),
            F.when(early, F.col(_count(disk))).otherwise(0).alias("_n1"),
            F.when(~early, F.col(_count(disk))).otherwise(0).alias("_n2"),
        ).unionByName(split)
    halves = half.groupBy("server_id").agg(*[F.sum(c).alias(c) for c in ("_s1", "_n1", "_s2", "_n2")])
    change = F.try_divide("_s2", "_n2") - F.try_divide("_s1", "_n1")
    trend = halves.select(F.col("server_id").alias("_server"), rounded(change, 2).alias("disk_trend_percent_change"))
    pairs = merged(states, ["server_id", "hostname"]).select("server_id", "hostname", *_means(), *PEAKS, *COUNTED)
    pairs = pairs.withColumn("errors_per_hour", rounded(per_hour(F.col("avg_errors_per_interval")), 2))
    summary = pairs.join(trend, F.col("server_id") == F.col("_server"), "left").drop("_server")
    columns = [
        *[c for short in UTILISATION for c in (f"avg_{short}_percent", f"peak_{short}_percent")],
        *ROUNDED[2 * len(UTILISATION) :],
        "peak_response_time_ms",
        "anomaly_count",
        "total_readings",
        "errors_per_hour",
        "disk_trend_percent_change",
        "health_score",
    ]
    scored = round_cols(with_health_score(summary, cfg), [*ROUNDED, "peak_response_time_ms"])
    return scored.select("server_id", "hostname", *columns)


def add_batch(spark: SparkSession, root: str, rows: DataFrame, key: tuple[str, int]) -> None:
    """Merge a micro-batch of Silver (rejects are left out) into the states and refresh the days it touches.

    ``key`` is query and number of the batch. A batch that is already in the states is not merged again; its days are.
    """
    query, number = key
    valid = rows.filter("_reject_reason is null").withColumn("dt", F.to_date("timestamp"))
    states = f"{root}/states"
    now = filelist.listing(spark, states)
    if now.notes.get("done", {}).get(query, -1) < number:
        # Written where they will stay, out of sight until the commit; only days that have states already are merged again.
        fresh = gold_states(valid)
        added = filelist.write_folders(fresh, states, F.col("dt"))
        days, schema = {f.part for f in added}, fresh.schema.json()
        old = now.of(days)
        if old:
            met = {f.part for f in old}
            both = filelist.read_folders(spark, states, old + [f for f in added if f.part in met], schema)
            added = [f for f in added if f.part not in met] + filelist.write_folders(merged(both), states, F.col("dt"))
        notes = {"done": {**now.notes.get("done", {}), query: number}, "days": sorted(days), "read": sum(f.files for f in old)}
        now = filelist.swap(spark, states, old, added, schema, notes)
    days = set(now.notes["days"])
    if days:
        daily = daily_from_states(filelist.read(spark, states, days, now))
        old = filelist.listing(spark, f"{root}/daily").of(days)
        filelist.replace(daily, f"{root}/daily", old, F.col("dt"))


def live_daily(spark: SparkSession, root: str) -> DataFrame | None:
    """The daily table as of the last batch."""
    return filelist.read(spark, f"{root}/daily")


def live_summary(spark: SparkSession, root: str, silver: str, cfg: HealthConfig = HealthConfig()) -> DataFrame | None:
    """The server summary as of the last batch, from the states below ``root`` and streamed Silver."""
    states = filelist.read(spark, f"{root}/states")
    if states is None:
        return None

    def readings_of_day(day: str) -> DataFrame:
        return filelist.read(spark, silver, {day}).filter("_reject_reason is null")

    return summary_from_states(states, readings_of_day, cfg)
