"""Fleet readings derived from the given ``events`` table (the test data's stand-in for telemetry)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.rules import derive_status

# One event in so many is delivered twice; a copy's id is raised by the offset.
COPY_EVERY = 61
COPY_OFFSET = 10**15
YEARS_TOO_EARLY_DAYS = 1826
YEARS_TOO_LATE_DAYS = 27394


def server_number() -> Column:
    """1 to 10, or a number from 100 on for every tenth user."""
    return F.expr("case when user_id % 10 <> 9 then (user_id div 2) % 10 + 1 else 100 + user_id end").cast("int")


def _two_digits(number: Column) -> Column:
    return F.concat(F.when(number < 10, F.lit("0")).otherwise(F.lit("")), number.cast("string"))


def servers_from_events(spark: SparkSession, sf_dir: str, known: Column | None = None) -> DataFrame:
    """The dimension of the servers that occur in ``events``; ``known`` leaves some of them out."""
    numbers = spark.read.parquet(f"{sf_dir}/events.parquet").select(server_number().alias("sv")).distinct()
    sv = F.col("sv")
    return (numbers if known is None else numbers.filter(known)).select(
        F.concat(F.lit("server"), _two_digits(sv)).alias("server_id"),
        F.concat_ws(".", F.lit("192.168"), F.floor(sv / 200).cast("string"), (sv % 200 + 1).cast("string")).alias("ip_address"),
        F.when(sv % 3 == 0, F.lit("staging")).otherwise(F.lit("live")).alias("environment"),
        F.when(sv % 2 == 0, F.lit("Debian 12")).otherwise(F.lit("Alma 9")).alias("operating_system"),
        F.concat(F.lit("service-"), (sv % 5).cast("string")).alias("application"),
    )


def readings_from_events(spark: SparkSession, sf_dir: str, only: Column | None = None) -> DataFrame:
    """Row-wise projection of ``events`` to readings, with planted incidents and defects.

    One user in ten has a server of its own and the others report for ten long series, so that
    a growing fleet and hot keys both occur. Instants keep their full precision. One event in
    ``COPY_EVERY`` is delivered twice, the second time with its server spelled differently and
    ``event_id`` raised by ``COPY_OFFSET``; ``event_id`` is the tie-break for deduplication.
    Everything is a narrow projection of the scan: no shuffle, and unused columns are pruned.
    ``only`` is a condition on ``events``; of the others nothing is made.
    """
    eid = F.col("eid")
    copies = F.when(F.col("event_id") % COPY_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    given = spark.read.parquet(f"{sf_dir}/events.parquet")
    events = (given if only is None else given.filter(only)).select(
        F.col("event_id").alias("eid"),
        F.explode(copies).alias("copy"),
        F.col("ts").cast("timestamp").alias("ts0"),
        "event_type",
        "value",
        server_number().alias("sv"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    e = events.withColumns({"dd": F.dayofmonth("ts0"), "hh": F.hour("ts0")})
    sv, k, dd, hh, value = (F.col(c) for c in ("sv", "k", "dd", "hh", "value"))
    number = _two_digits(sv)

    def every(n: int) -> Column:
        return eid % n == 0

    def on(server: int, day: int, before_hour: int = 24) -> Column:
        return (sv == server) & (dd == day) & (hh < before_hour)

    # The planted incidents, by the metric they show in.
    hot, leak, fill = on(1, 11, 6), on(3, 11), on(5, 11) | on(5, 12)
    surge, burst, slow = on(7, 11, 3), on(8, 11, 6), on(10, 11, 9)
    planted = hot | leak | fill | surge | burst | slow
    readings = e.select(
        (eid + F.col("copy") * F.lit(COPY_OFFSET)).alias("event_id"),
        F.when(every(503), F.lit(None))
        .when(every(7) | (F.col("copy") == 1), F.concat(F.lit("  SERVER"), number, F.lit(" ")))
        .otherwise(F.concat(F.lit("server"), number))
        .alias("server_id"),
        F.concat(F.lit("Web-App-"), number).alias("hostname"),
        F.when(every(499), F.col("ts0") - F.make_dt_interval(F.lit(YEARS_TOO_EARLY_DAYS)))
        .when(every(491), F.col("ts0") + F.make_dt_interval(F.lit(YEARS_TOO_LATE_DAYS)))
        .otherwise(F.col("ts0"))
        .alias("timestamp"),
        F.when(every(97), F.lit(None))
        .when(every(89), 105.0 + k)
        .when(hot, 95.0 + k / 20.0)
        .otherwise(10.0 + k * 0.5)
        .alias("cpu_usage_percent"),
        F.when(every(101), F.lit(None))
        .when(leak, 50.0 + hh * 2.0)
        .otherwise(40.0 + (eid * 37 % 1000) / 100.0)
        .alias("memory_usage_percent"),
        F.when(every(103), F.lit(None))
        .when(fill, 45.0 + ((dd - 11) * 24 + hh) * 1.0)
        .otherwise((48 + eid % 5).cast("double"))
        .alias("disk_usage_percent"),
        (value * 10.0).alias("disk_io_read"),
        F.when(every(271), -1.0 - value).otherwise(value).alias("disk_io_write"),
        F.when(surge, 5e6 + value).otherwise(3e5 + value * 1e3).alias("network_rx_bytes"),
        F.when(surge, 3e6 + value).otherwise(2e5 + value * 600.0).alias("network_tx_bytes"),
        F.when(every(277), F.lit(-1))
        .when(burst, 20 + k % 40)
        .when(F.col("event_type") == "error", k % 3)
        .otherwise(F.lit(0))
        .cast("long")
        .alias("application_error_count"),
        F.when(slow, 900.0 + k).otherwise(100.0 + k * 0.4).alias("response_time_ms"),
        planted.cast("int").alias("is_injected_anomaly"),
    )
    return readings.withColumns({"status": derive_status(), "dt": F.to_date("timestamp")})
