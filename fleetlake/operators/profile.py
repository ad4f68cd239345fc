"""The seven operational questions and their helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.rules import (
    INTERVAL_MINUTES,
    MAD_TO_SIGMA,
    count_if,
    hour_in,
    is_rule_anomaly,
    per_hour,
    ratio,
    rounded,
    truth,
)
from fleetlake.operators.quantiles import median_and_mad, quantiles
from fleetlake.operators.series import MICROS, slice_of, worst_slopes
from fleetlake.session import stage

CPU, MEMORY, DISK = "cpu_usage_percent", "memory_usage_percent", "disk_usage_percent"
RX, TX, LATENCY = "network_rx_bytes", "network_tx_bytes", "response_time_ms"
ERRORS = "application_error_count"
AROUND_BIN = MICROS["hour"]


# --- 1. CPU load


def cpu_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Mean, median, p99 and peak CPU per server, busiest first."""
    basics = df.groupBy("server_id").agg(F.avg(CPU).alias("avg_cpu"), F.max(CPU).alias("peak_cpu"))
    ranks = quantiles(df, ["server_id"], CPU, {"median_cpu": 0.5, "p99_cpu": 0.99}, exact)
    columns = ["avg_cpu", "median_cpu", "p99_cpu", "peak_cpu"]
    return (
        basics.join(ranks, "server_id", "left")
        .select("server_id", *[rounded(F.col(c), 2).alias(c) for c in columns])
        .orderBy(F.desc("avg_cpu"), "server_id")
    )


def cpu_spread(df: DataFrame) -> DataFrame:
    """Highest minus lowest per-server mean CPU (means to two digits, as reported)."""
    means = df.groupBy("server_id").agg(rounded(F.avg(CPU), 2).alias("avg_cpu"))
    return means.agg(rounded(F.max("avg_cpu") - F.min("avg_cpu"), 2).alias("spread"))


# --- 2. Application errors


def error_profile(df: DataFrame, interval_min: int = INTERVAL_MINUTES) -> DataFrame:
    """A10: total errors, hourly rate and worst interval per server, most errors first."""
    return (
        df.groupBy("server_id")
        .agg(
            F.coalesce(F.sum(ERRORS), F.lit(0)).alias("total_errors"),
            rounded(per_hour(F.avg(ERRORS), interval_min), 2).alias("errors_per_hour"),
            F.max(ERRORS).alias("worst_interval"),
        )
        .orderBy(F.desc("total_errors"), "server_id")
    )


def error_outlier(df: DataFrame) -> DataFrame:
    """The server with most errors against the fleet's median total.

    One row per server feeds the median, so its cost follows the fleet, not the readings.
    """
    sums = df.groupBy("server_id").agg(F.coalesce(F.sum(ERRORS), F.lit(0)).alias("total_errors"))
    totals = stage(sums, "error-totals")
    fleet_median = quantiles(totals, [], "total_errors", {"fleet_median": 0.5}).scalar()
    top = worst_by(totals, "server_id", "total_errors")
    return top.withColumn("fleet_median", fleet_median).withColumn(
        "times_median", rounded(ratio(F.col("total_errors"), F.col("fleet_median")), 2)
    )


# --- 3. Gradual growth


def days_since(origin: Column, ts: Column) -> Column:
    return (F.unix_micros(ts) - F.unix_micros(origin)) / F.lit(86400e6)


def _week_slopes(df: DataFrame, columns: dict[str, str]) -> list[Column]:
    """A slope does not depend on where the time axis starts, so days are counted from the
    fleet's first instant, and every server's slope comes out of one aggregation."""
    origin = df.agg(F.min("timestamp").alias("origin")).scalar()
    day = days_since(origin, F.col("timestamp"))
    return [F.regr_slope(F.col(source), day).alias(out) for out, source in columns.items()]


def week_slope(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Least-squares slope per server over the whole window, per day."""
    return df.groupBy("server_id").agg(*_week_slopes(df, columns))


def trend_report(df: DataFrame) -> DataFrame:
    """Whole-window slope, steepest 24 h slope and peak for memory and disk."""
    week = {"mem_week_slope": MEMORY, "disk_week_slope": DISK}
    overall = df.groupBy("server_id").agg(
        *_week_slopes(df, week), F.max(MEMORY).alias("mem_peak"), F.max(DISK).alias("disk_peak")
    )
    worst = worst_slopes(df, {"mem_worst_24h_slope": MEMORY, "disk_worst_24h_slope": DISK})
    digits = {"week_slope": 3, "worst_24h_slope": 2, "peak": 1}
    columns = [
        rounded(F.col(f"{metric}_{what}"), n).alias(f"{metric}_{what}")
        for metric in ("mem", "disk")
        for what, n in digits.items()
    ]
    return (
        overall.join(worst, "server_id", "left")
        .select("server_id", *columns)
        .orderBy(F.desc_nulls_last("mem_worst_24h_slope"), "server_id")
    )


# --- 4. Network


def network_profile(df: DataFrame) -> DataFrame:
    """Mean and peak traffic per server, and how far the peak exceeds the mean."""
    traffic = df.groupBy("server_id").agg(
        F.avg(RX).alias("avg_rx"),
        F.max(RX).alias("peak_rx"),
        F.avg(TX).alias("avg_tx"),
        F.max(TX).alias("peak_tx"),
    )
    return traffic.select(
        "server_id",
        *[rounded(F.col(c), 0).alias(c) for c in ("avg_rx", "peak_rx", "avg_tx", "peak_tx")],
        rounded(ratio(F.col("peak_rx"), F.col("avg_rx")), 1).alias("peak_to_avg_rx"),
    ).orderBy(F.desc("peak_to_avg_rx"), "server_id")


def with_fleet_z(df: DataFrame, column: str = RX, name: str = "robust_z") -> DataFrame:
    """Fleet-wide robust z-score; null where the spread is zero.

    The median and the deviation are two numbers, so they enter as scalar subqueries.
    """
    stats = median_and_mad(df, [], column)
    centre = stats.select("median").scalar()
    spread = F.nullif(stats.select("mad").scalar(), F.lit(0.0))
    return df.withColumn(name, F.lit(MAD_TO_SIGMA) * (F.col(column) - centre) / spread)


def fleet_robust_z(scored: DataFrame, cut: float = 6.0) -> DataFrame:
    """Per server, the largest z and the number of readings above the cut.

    ``scored`` is the result of ``with_fleet_z``.
    """
    return (
        scored.groupBy("server_id")
        .agg(
            rounded(F.max("robust_z"), 1).alias("max_robust_z"),
            count_if(F.col("robust_z") > cut).alias("intervals_above_cut"),
        )
        .orderBy(F.desc("max_robust_z"), "server_id")
    )


def fleet_z_p999(scored: DataFrame, exact: bool = True) -> DataFrame:
    """99.9th percentile of z over all readings."""
    tail = quantiles(scored, [], "robust_z", {"p999": 0.999}, exact)
    return tail.select(rounded(F.col("p999"), 1).alias("p999_robust_z"))


def surge_interval(scored: DataFrame, cut: float = 6.0) -> DataFrame:
    """When the server with the highest peak-to-mean traffic was above the cut.

    Everything needed is aggregated per server first; choosing the server comes last.
    """
    high = F.col("robust_z") > cut
    per_server = scored.groupBy("server_id").agg(
        rounded(ratio(F.max(RX), F.avg(RX)), 1).alias("peak_to_avg_rx"),
        F.min(F.when(high, F.col("timestamp"))).alias("surge_start"),
        F.max(F.when(high, F.col("timestamp"))).alias("surge_end"),
        count_if(high).alias("intervals"),
    )
    return worst_by(per_server, "server_id", "peak_to_avg_rx").withColumn(
        "minutes", F.col("intervals") * INTERVAL_MINUTES
    )


def around(df: DataFrame, lo: Column, hi: Column, hours: int = 6) -> DataFrame:
    """Readings from ``hours`` before ``lo`` to ``hours`` after ``hi``.

    Bounds given as literals or scalar subqueries stay simple filters on the scan.
    """
    margin = F.make_dt_interval(hours=F.lit(hours))
    return df.filter(F.col("timestamp").between(lo - margin, hi + margin))


def around_each(
    df: DataFrame, incidents: DataFrame, lo: str, hi: str, keys: list[str], minutes: int = 360, by: list[str] | None = None
) -> DataFrame:
    """P17 for many incidents: ``keys`` of each beside every reading within ``minutes`` of its span from ``lo`` to ``hi``.

    Spans are cut to the time bins they cover and readings fall into one, so the join is on the bin (and on the
    columns ``by``, for slices of an incident's own server) and the exact bounds are checked on what meets there.
    A span covers one bin more than it is long; a bin with very many readings is split as any skewed join is.
    """
    margin = F.make_dt_interval(mins=F.lit(minutes))
    by = by or []
    named = [F.col(c).alias(f"_of_{c}") for c in by]
    spans = incidents.select(*keys, *named, (F.col(lo) - margin).alias("_lo"), (F.col(hi) + margin).alias("_hi"))
    bins = F.explode(F.sequence(slice_of(F.col("_lo"), AROUND_BIN), slice_of(F.col("_hi"), AROUND_BIN))).alias("_bin")
    spans = spans.filter("_lo <= _hi").select("*", bins).withColumnsRenamed({k: f"_key_{k}" for k in keys})
    placed = df.withColumn("_at", slice_of(F.col("timestamp"), AROUND_BIN))
    same = F.col("_at") == F.col("_bin")
    for c in by:
        same = same & (F.col(c) == F.col(f"_of_{c}"))
    met = placed.join(spans, same & F.col("timestamp").between(F.col("_lo"), F.col("_hi")))
    return met.select(*[F.col(f"_key_{k}").alias(f"incident_{k}") for k in keys], *df.columns)


# --- 5. CPU against latency


def correlate(df: DataFrame, x: str = CPU, y: str = LATENCY, by: str | None = None) -> DataFrame:
    """Pearson correlation over the fleet, or per group and descending; null where a column does not vary."""
    # Of readings that have both; the built-in correlation fails on a column without any spread.
    a, b = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    r = rounded(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), 3).alias("pearson_r")
    if by is None:
        return df.agg(r)
    return df.groupBy(by).agg(r).orderBy(F.desc_nulls_last("pearson_r"), by)


def natural_experiment(df: DataFrame, cond: str, threshold: float, metric: str) -> DataFrame:
    """On the server with the highest ``cond``, mean ``metric`` above and up to a threshold."""
    per_server = df.groupBy("server_id").agg(
        F.max(cond).alias("_peak"),
        F.avg(F.when(F.col(cond) > threshold, F.col(metric))).alias("mean_above"),
        F.avg(F.when(F.col(cond) <= threshold, F.col(metric))).alias("mean_otherwise"),
    )
    return worst_by(per_server, "server_id", "_peak").select(
        "server_id",
        rounded(F.col("mean_above"), 1).alias("mean_above"),
        rounded(F.col("mean_otherwise"), 1).alias("mean_otherwise"),
    )


# --- 6. Rules against ground truth


def rule_vs_truth(df: DataFrame) -> DataFrame:
    """Per server, flagged and true readings, hits, recall and false alarms.

    Conditional counts give 0 for a server without hits, so no join is needed to align.
    """
    flagged = is_rule_anomaly()
    counts = df.groupBy("server_id").agg(
        count_if(flagged).alias("rule_flagged"),
        count_if(truth()).alias("injected_truth"),
        count_if(flagged & truth()).alias("caught"),
        count_if(flagged & ~truth()).alias("false_positives"),
    )
    recall = ratio(100 * F.col("caught"), F.col("injected_truth"))
    return counts.withColumn("recall_pct", rounded(recall, 1)).orderBy(
        F.desc("injected_truth"), "server_id"
    )


def per_server_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows matching each condition, for every server, 0 where none match."""
    return df.groupBy("server_id").agg(*[count_if(c).alias(name) for name, c in flags.items()])


def rule_totals(df: DataFrame) -> DataFrame:
    """Fleet-wide true and false positives, misses, precision and recall of the rules."""
    flagged = is_rule_anomaly()
    totals = df.agg(
        count_if(flagged & truth()).alias("tp"),
        count_if(flagged & ~truth()).alias("fp"),
        count_if(~flagged & truth()).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return totals.withColumns(
        {
            "precision": rounded(ratio(tp, tp + fp), 3),
            "recall": rounded(ratio(tp, tp + fn), 3),
        }
    )


def status_counts(df: DataFrame) -> DataFrame:
    """Readings per status, most frequent first."""
    counts = df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "status")


def truth_counts(df: DataFrame) -> DataFrame:
    """True incident readings per server."""
    return per_server_counts(df, {"injected_truth": truth()}).orderBy("server_id")


# --- 7. Time of day


def normal_only(df: DataFrame) -> DataFrame:
    """P20: leave out incident readings, so that patterns describe normal behaviour."""
    return df.filter(~truth())


def hourly_profile(df: DataFrame, tz: str = "UTC", digits: int | None = 2) -> DataFrame:
    """Mean CPU, traffic, latency and errors by hour of day on normal readings."""
    metrics = [CPU, RX, LATENCY, ERRORS]
    means = [F.avg(c) if digits is None else rounded(F.avg(c), digits) for c in metrics]
    return (
        normal_only(df)
        .groupBy(hour_in(F.col("timestamp"), tz).alias("hour"))
        .agg(*[m.alias(c) for m, c in zip(means, metrics)])
        .orderBy("hour")
    )


def hour_extremes(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """Peak and trough hour of mean CPU, and how far they are apart."""
    means = (
        normal_only(df)
        .groupBy(hour_in(F.col("timestamp"), tz).alias("hour"))
        .agg(F.avg(CPU).alias("cpu"))
    )
    return means.agg(
        F.max_by("hour", F.struct("cpu", -F.col("hour"))).alias("peak_hour"),
        rounded(F.max("cpu"), 1).alias("peak_cpu"),
        F.min_by("hour", F.struct("cpu", "hour")).alias("trough_hour"),
        rounded(F.min("cpu"), 1).alias("trough_cpu"),
        rounded(ratio(F.max("cpu"), F.min("cpu")), 2).alias("swing"),
    )


def business_hours(df: DataFrame, lo: int = 9, hi: int = 18, tz: str = "UTC") -> DataFrame:
    """Mean CPU in business hours (both ends included) and outside."""
    inside = hour_in(F.col("timestamp"), tz).between(lo, hi)
    means = normal_only(df).agg(
        F.avg(F.when(inside, F.col(CPU))).alias("_in"),
        F.avg(F.when(~inside, F.col(CPU))).alias("_out"),
    )
    return means.select(
        rounded(F.col("_in"), 1).alias("business_cpu"),
        rounded(F.col("_out"), 1).alias("off_hours_cpu"),
        rounded(ratio(F.col("_in"), F.col("_out")), 2).alias("ratio"),
    )


def weekday_profile(df: DataFrame) -> DataFrame:
    """Mean CPU by weekday."""
    return (
        normal_only(df)
        .groupBy(F.date_format("timestamp", "EEEE").alias("weekday"))
        .agg(rounded(F.avg(CPU), 2).alias("avg_cpu"))
        .orderBy("weekday")
    )


def weekday_spread(df: DataFrame) -> DataFrame:
    """Highest minus lowest weekday mean."""
    means = normal_only(df).groupBy(F.dayofweek("timestamp")).agg(F.avg(CPU).alias("cpu"))
    return means.agg(rounded(F.max("cpu") - F.min("cpu"), 2).alias("spread"))


def server_hour_matrix(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """Mean CPU per server (rows) and hour (24 columns ``h00`` to ``h23``)."""
    normal = normal_only(df).withColumn("hour", hour_in(F.col("timestamp"), tz))
    matrix = normal.groupBy("server_id").pivot("hour", list(range(24))).agg(F.avg(CPU))
    return matrix.select(
        "server_id", *[rounded(F.col(f"`{h}`"), 2).alias(f"h{h:02d}") for h in range(24)]
    ).orderBy("server_id")


# --- Choosing and showing rows


def worst_by(df: DataFrame, key: str, metric: str) -> DataFrame:
    """The row with the highest metric; ties go to the smallest key."""
    return df.orderBy(F.desc_nulls_last(metric), key).limit(1)


def in_series_order(df: DataFrame) -> DataFrame:
    """By server, then time (a range-partitioned sort)."""
    return df.orderBy("server_id", "timestamp")


def sample_rows(df: DataFrame, n: int = 4000, seed: int = 42, keys=("server_id", "timestamp")) -> DataFrame:
    """The same ``n`` rows for the same seed, however the data is partitioned.

    The order is that of an MD5 of seed and key, which other engines can repeat.
    """
    kinds = dict(df.dtypes)
    parts = [F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k) for k in keys]
    key = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return df.orderBy(F.md5(key), *keys).limit(n)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
