"""Registered queries: every operator run over the whole given tables.

Readings come from the ``events`` table. Each entry takes ``(spark, sf_dir)`` and returns a
DataFrame; the SQL that must give the same rows is in ``oracle.py``. ``as_of`` is fixed, so
no result depends on the clock. Where an operator reads its input several times, the input
is staged once, as a pipeline would read a written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.rules import (
    all_reasons,
    bytes_to_mb,
    derive_status,
    health_band,
    is_rule_anomaly,
    label_result,
    per_hour,
    round_cols,
    rounded,
    validity_rules,
)
from fleetlake.operators import carried, evaluation, forest, gold, incidents, profile, quality, scaling
from fleetlake.operators import series, serving, silver, sketches
from fleetlake.operators.scaling import FEATURES
from fleetlake.plans import detection
from fleetlake.session import pin_utc, scratch_path, stage
from fleetlake.sources import filelist
from fleetlake.sources import readings as landing
from fleetlake.sources import tables
from fleetlake.sources.events_readings import readings_from_events, servers_from_events
from fleetlake.streaming import alerts as alert_stream
from fleetlake.streaming import live_gold, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, with the session zone pinned."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# --- Shared inputs


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


AS_OF = "2024-02-01 00:00:00"
NOW = "2024-02-01 00:00:00"
BY_EVENT = "event_id"
SPLIT_DAY = "2024-01-16"
SOME = "sv % 4 <> 0"
# What features, scores and incidents are made from; queries that show nothing else carry only these columns.
DETECTOR_COLUMNS = [
    "server_id",
    "timestamp",
    *[f for f in scaling.BASE_FEATURES if f != "error_count_log"],
    "application_error_count",
]


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return readings_from_events(spark, sf)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return silver.classify(readings(spark, sf), as_of=at(AS_OF), order_by=[F.col(BY_EVENT)])


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return silver.split(classified(spark, sf))[0]


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return silver.split(classified(spark, sf))[1]


def staged(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Valid readings (all or some columns) as a written table."""
    rows = valid(spark, sf)
    return stage(rows.select(*columns) if columns else rows, "silver")


def summary(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """From ``rows``, or from the cleaned readings if a query needs them for nothing else."""
    return gold.build_server_summary(staged(spark, sf) if rows is None else rows)


def servers(snapshot: DataFrame, sf: str) -> DataFrame:
    return serving.server_rows(snapshot, servers_from_events(snapshot.sparkSession, sf))


def view(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    snapshot = stage(summary(spark, sf, rows), "summary")
    return serving.health_view(snapshot, servers(snapshot, sf))


def z_scores(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Features (slopes to four digits, so that both engines see the same) with their z."""
    featured = scaling.build_features(staged(spark, sf) if rows is None else rows)
    featured = stage(round_cols(featured, list(scaling.SLOPE_FEATURES), 4), "features")
    return scaling.apply_scalers(featured, stage(scaling.fit_scalers(featured), "scalers"))


def simple_scored(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Readings flagged by their largest absolute z: a detector that SQL can repeat."""
    largest = F.greatest(*[F.abs(F.col(f"z_{f}")) for f in FEATURES])
    scored = z_scores(spark, sf, rows).withColumn("score", rounded(largest, 6))
    flagged = forest.flag(stage(scored, "scored"), raw="score")
    return flagged.withColumn("anomaly_score", rounded(F.col("anomaly_score"), 6))


def simple_events(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    return incidents.finish_events(incidents.build_events(simple_scored(spark, sf, rows)), ordered=False)


def half_flagged(spark: SparkSession, sf: str) -> DataFrame:
    """A ``is_anomaly`` that needs no scaling: readings slower than 130 ms or in an error burst."""
    odd = (F.col("response_time_ms") > 130) | (F.col("application_error_count") > 1)
    flags = valid(spark, sf).withColumn("is_anomaly", odd.cast("int"))
    return flags.withColumn("result", label_result(F.col("is_anomaly")))


# --- S: sources and sinks


@query
def s01_csv_scan(spark, sf):
    """The file has its columns in another order than the schema."""
    path = scratch_path(spark, "csv")
    columns = sorted(f.name for f in landing.READING.fields)
    out = readings(spark, sf).select(*columns).write.option("header", True)
    out.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    return (
        landing.read_csv_readings(spark, path)
        .groupBy("status", "is_injected_anomaly")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("server_id").alias("with_server"),
            rounded(F.sum("cpu_usage_percent"), 2).alias("cpu_total"),
            F.max("timestamp").alias("last_timestamp"),
        )
    )


@query
def s02_utc_day(spark, sf):
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    raw = readings(spark, sf).select("event_id", text.alias("timestamp"))
    return landing.with_utc_day(raw)


def _landed(spark, sf, rows: DataFrame | None = None, root: str | None = None) -> str:
    root = root or scratch_path(spark, "landing")
    landing.land((readings(spark, sf) if rows is None else rows).drop("dt"), root)
    return root


LANDED_WITH_ID = T.StructType([T.StructField("event_id", T.LongType()), *landing.LANDED.fields])


@query
def s03_land(spark, sf):
    root = _landed(spark, sf, valid(spark, sf))
    return landing.scan_landing(spark, root).groupBy("server_id", "dt").agg(
        F.count(F.lit(1)).alias("n"), F.max("cpu_usage_percent").alias("peak_cpu")
    )


@query
def s05_scan_landing(spark, sf):
    """Raw ids (with their spaces, or missing) come back from the path unchanged."""
    scan = landing.scan_landing(spark, _landed(spark, sf), LANDED_WITH_ID)
    return scan.select("event_id", "server_id", "dt", "timestamp", "network_rx_bytes")


@query
def s06_bronze_lineage(spark, sf):
    bronze = landing.build_bronze(landing.scan_landing(spark, _landed(spark, sf), LANDED_WITH_ID))
    from_path = F.regexp_extract("_source_file", "dt=([0-9-]+)/", 1).cast("date")
    return bronze.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(from_path == F.col("dt"), 1)).alias("n_lineage_matches"),
        F.count("_ingested_at").alias("n_ingested"),
    )


@query
def s07_write_table(spark, sf):
    path = scratch_path(spark, "gold_daily")
    tables.write_table(gold.build_daily_metrics(valid(spark, sf)), path, ["dt"])
    return tables.read_table(spark, path).select("server_id", "dt", "avg_cpu_percent", "anomaly_count")


@query
def s07_compact(spark, sf):
    """Daily metrics of two runs, written in many small files, rewritten together and read back."""
    root = scratch_path(spark, "compacted")
    old, new = _two_runs(spark, sf)
    for rows in (old, new):
        for slot in range(3):
            filelist.append(rows.filter(F.pmod(F.xxhash64("server_id", "dt"), F.lit(3)) == slot), root, F.month("dt"))
    filelist.compact(spark, root)
    return filelist.read(spark, root)


@query
def s08_managed_table(spark, sf):
    path = scratch_path(spark, "managed")
    name = "fleetlake_" + path.rsplit("-", 1)[1]
    tables.save_managed(gold.server_base(valid(spark, sf)), name, location=path)
    return tables.read_table(spark, name).select("server_id", "hostname", "total_readings")


@query
def s09_read_table(spark, sf):
    path = scratch_path(spark, "rejects")
    tables.write_table(rejects(spark, sf), path)
    return tables.read_table(spark, path).select("event_id", "server_id", "_reject_reason")


@query
def s10_scores_and_events(spark, sf):
    path = scratch_path(spark, "ml")
    scored = stage(simple_scored(spark, sf), "flagged")
    tables.write_scores(scored, f"{path}/scores", FEATURES)
    tables.write_events(incidents.build_events(scored), f"{path}/events")
    scores = tables.read_table(spark, f"{path}/scores")
    events = tables.read_table(spark, f"{path}/events").groupBy("server_id").agg(
        F.count(F.lit(1)).alias("incidents"), F.sum("readings").alias("readings_in_incidents")
    )
    per_server = scores.groupBy("server_id").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("is_anomaly").alias("flagged")
    )
    return per_server.join(events, "server_id", "left")


@query
def s12_serving_anomalies(spark, sf):
    return serving.serving_anomalies(simple_events(spark, sf))


@query
def s14_conform(spark, sf):
    fitted = tables.conform(summary(spark, sf), tables.HEALTH_SUMMARY_TYPES)
    decimals = [f.name for f in fitted.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return fitted.withColumns({c: F.col(c).cast("string") for c in decimals})


@query
def s14_overflow_report(spark, sf):
    narrow = {"network_rx_bytes": "decimal(9,2)", "disk_io_read": "decimal(4,2)", "response_time_ms": "decimal(5,2)"}
    return tables.overflow_report(valid(spark, sf), narrow)


# --- P: row-level


@query
def p01_enforce_types(spark, sf):
    metrics = [*landing.METRIC_TYPES]
    text = readings(spark, sf).select(
        "event_id",
        "status",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        *[F.col(c).cast("string").alias(c) for c in metrics if c != "response_time_ms"],
        F.when(F.col("application_error_count") > 0, F.lit("n/a"))
        .otherwise(F.col("response_time_ms").cast("string"))
        .alias("response_time_ms"),
    )
    return silver.enforce_types(text)


@query
def p02_standardise(spark, sf):
    named = silver.standardise(readings(spark, sf))
    return named.groupBy("server_id", "hostname").agg(F.count(F.lit(1)).alias("n"))


@query
def p03_validity_rules(spark, sf):
    rules = validity_rules(at(AS_OF))
    rows = silver.standardise(silver.enforce_types(readings(spark, sf)))
    return rows.select("event_id", *[F.coalesce(c, F.lit(False)).alias(r) for r, c in rules.items()])


@query
def p04_reject_reason(spark, sf):
    return rejects(spark, sf).select("event_id", "_reject_reason")


@query
def p04_all_reasons(spark, sf):
    rows = silver.standardise(silver.enforce_types(readings(spark, sf)))
    reasons = F.array_join(all_reasons(validity_rules(at(AS_OF))), ",")
    return rows.select("event_id", reasons.alias("reasons"))


@query
def p05_valid_rows(spark, sf):
    return valid(spark, sf)


@query
def p05_reject_rows(spark, sf):
    return rejects(spark, sf)


@query
def p06_status(spark, sf):
    return readings(spark, sf).select("event_id", derive_status().alias("status"))


@query
def p07_rule_flag(spark, sf):
    return valid(spark, sf).select("event_id", is_rule_anomaly().alias("is_rule_anomaly"))


@query
def p08_health_band(spark, sf):
    return summary(spark, sf).select(
        "server_id", "health_score", health_band(F.col("health_score")).alias("band")
    )


@query
def p09_alerts(spark, sf):
    alerts = serving.derive_alerts(summary(spark, sf), at(NOW))
    return alerts.select("server_id", "metric", "severity", "message", "triggered_at", "resolved")


@query
def p10_round_cols(spark, sf):
    rows = readings(spark, sf).select(
        "event_id", (F.col("disk_io_read") * 0.05).alias("io"), "response_time_ms", "network_tx_bytes"
    )
    return round_cols(rows, ["io", "response_time_ms", "network_tx_bytes"], 1)


@query
def p11_round_scores(spark, sf):
    shown = evaluation.top_scores(simple_scored(spark, sf), 10, scaling.BASE_FEATURES)
    return round_cols(shown, ["anomaly_score", *scaling.BASE_FEATURES], 2)


@query
def p12_filter_servers(spark, sf):
    chosen = serving.filter_servers(view(spark, sf), ["server03", "server05", "server08"])
    return chosen.select("server_id", "hostname", "environment", "application", "status")


@query
def p13_filter_severity(spark, sf):
    critical = serving.filter_severity(simple_events(spark, sf), ["CRITICAL"])
    return critical.select("server_id", "timestamp", "severity")


@query
def p14_unresolved(spark, sf):
    return serving.unresolved(_stepped_alerts(spark, sf)).select("server_id", "severity", "triggered_at")


@query
def p15_units(spark, sf):
    base = gold.server_base(valid(spark, sf))
    return base.select(
        "server_id",
        rounded(bytes_to_mb(F.col("avg_network_rx_bytes")), 2).alias("avg_rx_mb"),
        rounded(bytes_to_mb(F.col("avg_network_tx_bytes")), 2).alias("avg_tx_mb"),
        rounded(per_hour(F.col("avg_errors_per_interval")), 2).alias("errors_per_hour"),
    )


@query
def p16_label_result(spark, sf):
    return half_flagged(spark, sf).select("event_id", "is_anomaly", "result")


@query
def p17_around(spark, sf):
    rows = staged(spark, sf)
    surge = rows.filter(F.col("network_rx_bytes") > 2e6)
    lo, hi = surge.agg(F.min("timestamp")).scalar(), surge.agg(F.max("timestamp")).scalar()
    return profile.around(rows, lo, hi).select("event_id", "server_id", "timestamp", "network_rx_bytes")


@query
def p17_around_incidents(spark, sf):
    """Readings of the same server in the hour before and after each incident."""
    # The flags are a projection of the staged scores and are asked for once, so they are not written again.
    scored = simple_scored(spark, sf, staged(spark, sf, BY_EVENT, *DETECTOR_COLUMNS))
    spans = stage(incidents.incident_spans(scored).select("server_id", "timestamp", "_end"), "spans")
    rows = scored.select("event_id", "server_id", "timestamp", "score")
    return profile.around_each(rows, spans, "timestamp", "_end", ["timestamp"], 60, by=["server_id"])


@query
def p18_health_table(spark, sf):
    return serving.health_table(view(spark, sf))


@query
def p19_description(spark, sf):
    return simple_events(spark, sf).select("server_id", "timestamp", "description")


@query
def p20_normal_only(spark, sf):
    return profile.normal_only(valid(spark, sf)).select("event_id", "server_id")


# --- D


@query
def d01_dedup(spark, sf):
    rows = silver.standardise(silver.enforce_types(readings(spark, sf)))
    return silver.dedup(rows, order_by=[F.col(BY_EVENT)]).select("event_id", "server_id", "timestamp")


@query
def d02_duplicate_count(spark, sf):
    return silver.duplicate_count(silver.standardise(readings(spark, sf)))


# --- J


@query
def j01_disk_halves(spark, sf):
    halves = gold.disk_halves(staged(spark, sf))
    return round_cols(halves, ["disk_first_half_avg", "disk_second_half_avg"], 3)


@query
def j02_health_view(spark, sf):
    return view(spark, sf)


@query
def j03_metadata(spark, sf):
    """A fourth of the servers is missing in the dimension and keeps nulls."""
    meta = servers_from_events(spark, sf, F.expr(SOME))
    return serving.server_rows(gold.server_base(valid(spark, sf)), meta)


@query
def j04_attach_scalers(spark, sf):
    rows = staged(spark, sf, "event_id", "server_id", "cpu_usage_percent", "response_time_ms")
    features = ["cpu_usage_percent", "response_time_ms"]
    fitted = scaling.fit_scalers(rows, features)
    return scaling.attach_scalers(rows, fitted, features).select(
        "event_id",
        *[F.col(f"_{s}_{f}").alias(f"{s}_{f}") for f in features for s in ("median", "scale")],
    )


@query
def j05_peak_reading(spark, sf):
    peak = incidents.peak_struct("response_time_ms", ["event_id", "cpu_usage_percent"])
    top = valid(spark, sf).groupBy("server_id").agg(peak.alias("p"))
    return top.select(
        "server_id",
        F.timestamp_micros(-F.col("p._age")).alias("peak_timestamp"),
        F.col("p._score").alias("peak_latency"),
        F.col("p.event_id").alias("event_id"),
        F.col("p.cpu_usage_percent").alias("cpu_at_peak"),
    )


@query
def j06_per_server_counts(spark, sf):
    flags = {
        "rule_flagged": is_rule_anomaly(),
        "slow": F.col("response_time_ms") > 500,
        "bursts": F.col("application_error_count") > 10,
    }
    return profile.per_server_counts(valid(spark, sf), flags)


def _two_runs(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Daily metrics of an earlier run (days before the 16th) and a later one (from the 11th)."""
    rows = staged(spark, sf)
    early = gold.build_daily_metrics(rows.filter(F.col("timestamp") < at(SPLIT_DAY)))
    late = gold.build_daily_metrics(rows.filter(F.col("timestamp") >= at("2024-01-11")))
    columns = ["server_id", "dt", "avg_cpu_percent", "anomaly_count"]
    old = early.select(*columns).withColumn("run", F.lit("early"))
    return old, late.select(*columns).withColumn("run", F.lit("late"))


@query
def j07_insert_absent(spark, sf):
    old, new = _two_runs(spark, sf)
    return serving.insert_absent(old, new, ["server_id", "dt"])


@query
def j08_upsert(spark, sf):
    old, new = _two_runs(spark, sf)
    old = old.withColumn("updated_at", at(SPLIT_DAY))
    return serving.upsert(old, new, ["server_id", "dt"], at(NOW))


@query
def j08_upsert_buckets(spark, sf):
    """The same on a stored table of which only the touched buckets are rewritten."""
    root = scratch_path(spark, "buckets")
    old, new = _two_runs(spark, sf)
    keys = ["server_id", "dt"]
    serving.upsert_buckets(old, root, keys, at(SPLIT_DAY), last_by=[F.desc("run")])
    serving.upsert_buckets(new, root, keys, at(NOW), last_by=[F.desc("run")])
    return filelist.read(spark, root)


@query
def j09_orphans(spark, sf):
    """Readings whose server is not in the dimension, which lacks a fourth of them here."""
    rows = silver.standardise(readings(spark, sf)).select("event_id", "server_id", "timestamp")
    return quality.orphans(rows, servers_from_events(spark, sf, F.expr(SOME)), "server_id")


@query
def j10_server_detail(spark, sf):
    rows = staged(spark, sf)
    return serving.server_detail(view(spark, sf, rows), simple_events(spark, sf, rows), "server03")


# --- A: aggregations


@query
def a01_server_base(spark, sf):
    base = gold.server_base(valid(spark, sf))
    return round_cols(base, [c for c in base.columns if c.startswith(("avg_", "peak_"))], 3)


@query
def a02_disk_trend(spark, sf):
    return gold.disk_trend(staged(spark, sf, "server_id", "timestamp", "disk_usage_percent"))


@query
def a03_health_score(spark, sf):
    scored = gold.with_health_score(gold.server_base(valid(spark, sf)))
    return scored.select("server_id", "hostname", "health_score")


@query
def a04_server_summary(spark, sf):
    return summary(spark, sf)


@query
def a05_daily_metrics(spark, sf):
    return gold.build_daily_metrics(valid(spark, sf))


@query
def a06_reject_breakdown(spark, sf):
    return quality.reject_breakdown(rejects(spark, sf))


@query
def a07_pipeline_counts(spark, sf):
    return quality.pipeline_counts(readings(spark, sf), classified(spark, sf))


@query
def a08_cpu_profile(spark, sf):
    return profile.cpu_profile(staged(spark, sf, "server_id", "cpu_usage_percent"))


@query
def a09_cpu_spread(spark, sf):
    return profile.cpu_spread(valid(spark, sf))


@query
def a10_error_profile(spark, sf):
    return profile.error_profile(valid(spark, sf))


@query
def a11_error_outlier(spark, sf):
    return profile.error_outlier(valid(spark, sf))


@query
def a12_week_slope(spark, sf):
    columns = {"mem_week_slope": "memory_usage_percent", "disk_week_slope": "disk_usage_percent"}
    return round_cols(profile.week_slope(staged(spark, sf), columns), list(columns), 3)


@query
def a13_trend_report(spark, sf):
    return profile.trend_report(staged(spark, sf))


@query
def a14_network_profile(spark, sf):
    return profile.network_profile(valid(spark, sf))


def _network_z(spark, sf) -> DataFrame:
    return profile.with_fleet_z(staged(spark, sf, "event_id", "server_id", "timestamp", "network_rx_bytes"))


@query
def a15_fleet_robust_z(spark, sf):
    return profile.fleet_robust_z(_network_z(spark, sf))


@query
def a15_z_p999(spark, sf):
    return profile.fleet_z_p999(stage(_network_z(spark, sf), "z"))


@query
def a16_surge_interval(spark, sf):
    return profile.surge_interval(_network_z(spark, sf))


@query
def a17_correlation_fleet(spark, sf):
    return profile.correlate(valid(spark, sf))


@query
def a17_correlation_by_server(spark, sf):
    return profile.correlate(valid(spark, sf), by="server_id")


@query
def a18_cpu_experiment(spark, sf):
    return profile.natural_experiment(valid(spark, sf), profile.CPU, 90, profile.LATENCY)


@query
def a18_latency_experiment(spark, sf):
    return profile.natural_experiment(valid(spark, sf), profile.LATENCY, 500, profile.CPU)


@query
def a19_rule_vs_truth(spark, sf):
    return profile.rule_vs_truth(valid(spark, sf))


@query
def a20_rule_totals(spark, sf):
    return profile.rule_totals(valid(spark, sf))


@query
def a21_status_counts(spark, sf):
    return profile.status_counts(valid(spark, sf))


@query
def a22_hourly_profile(spark, sf):
    return profile.hourly_profile(valid(spark, sf))


@query
def a23_hour_extremes(spark, sf):
    return profile.hour_extremes(valid(spark, sf))


@query
def a24_business_hours(spark, sf):
    return profile.business_hours(valid(spark, sf))


@query
def a25_weekday_profile(spark, sf):
    return profile.weekday_profile(valid(spark, sf))


@query
def a25_weekday_spread(spark, sf):
    return profile.weekday_spread(valid(spark, sf))


@query
def a26_server_hour_matrix(spark, sf):
    return profile.server_hour_matrix(valid(spark, sf))


@query
def a27_completeness(spark, sf):
    return quality.completeness(valid(spark, sf), days=30)


@query
def a28_null_counts(spark, sf):
    return quality.null_counts(readings(spark, sf).drop("event_id"))


@query
def a29_gap_histogram(spark, sf):
    return series.gap_histogram(staged(spark, sf, "server_id", "timestamp"))


@query
def a30_time_bounds(spark, sf):
    return quality.time_bounds(valid(spark, sf))


@query
def a31_evaluate_detector(spark, sf):
    return evaluation.evaluate_detector(half_flagged(spark, sf))


@query
def a32_evaluate_rules(spark, sf):
    return evaluation.evaluate_rules(valid(spark, sf))


@query
def a33_evaluate_by_server(spark, sf):
    return evaluation.evaluate_by_server(simple_scored(spark, sf))


@query
def a34_false_positives_by_hour(spark, sf):
    return evaluation.false_positives_by_hour(half_flagged(spark, sf))


@query
def a35_flag_rate(spark, sf):
    return evaluation.flag_rate(simple_scored(spark, sf))


@query
def a36_fleet_kpis(spark, sf):
    rows = staged(spark, sf)
    health = stage(view(spark, sf, rows), "view")
    events = stage(simple_events(spark, sf, rows), "events")
    return serving.fleet_kpis(health, events, serving.derive_alerts(health, at(NOW)))


@query
def a37_fleet_utilisation(spark, sf):
    return serving.fleet_utilisation(view(spark, sf))


@query
def a38_severity_counts(spark, sf):
    return serving.severity_counts(simple_events(spark, sf))


@query
def a39_incidents_per_server(spark, sf):
    return serving.incidents_per_server(simple_events(spark, sf))


@query
def a40_truth_counts(spark, sf):
    return profile.truth_counts(valid(spark, sf))


# --- W: windows


RUN_ENDS = ["2024-01-13", "2024-01-24"]


def _in_three_runs(rows: DataFrame) -> list[DataFrame]:
    """Readings up to the 13th, up to the 24th, and later ones."""
    ts, (one, two) = F.col("timestamp"), RUN_ENDS
    return [rows.filter(ts < at(one)), rows.filter((ts >= at(one)) & (ts < at(two))), rows.filter(ts >= at(two))]


@query
def w01_gaps(spark, sf):
    rows = staged(spark, sf, "event_id", "server_id", "timestamp")
    return series.gap_since_prev(rows)


@query
def w02_sessions(spark, sf):
    return series.sessionise(staged(spark, sf, "event_id", "server_id", "timestamp"))


@query
def w02_sessions_continued(spark, sf):
    """Session numbers of three runs, each going on from the state of the one before."""
    rows, state, told = staged(spark, sf, "event_id", "server_id", "timestamp"), None, []
    for part in _in_three_runs(rows):
        numbered, state = carried.continued_sessions(state, part)
        told.append(numbered)
    return serving.concat_all(told)


@query
def w03_slopes_continued(spark, sf):
    """Slopes of the last run only, from its own readings and the state that two earlier runs left."""
    rows = staged(spark, sf, "event_id", "server_id", "timestamp", profile.MEMORY, profile.DISK)
    *earlier, last = _in_three_runs(rows)
    state = None
    for part in earlier:
        state = carried.next_slope_state(state, part, scaling.SLOPE_FEATURES)
    slopes = carried.continued_slopes(state, last, scaling.SLOPE_FEATURES)
    return round_cols(slopes.select("event_id", *scaling.SLOPE_FEATURES), list(scaling.SLOPE_FEATURES), 4)


@query
def w03_rolling_slopes(spark, sf):
    rows = staged(spark, sf, "event_id", "server_id", "timestamp", profile.MEMORY, profile.DISK)
    slopes = series.rolling_slopes(rows, scaling.SLOPE_FEATURES)
    return round_cols(slopes.select("event_id", *scaling.SLOPE_FEATURES), list(scaling.SLOPE_FEATURES), 4)


@query
def w04_worst_slopes(spark, sf):
    worst = series.worst_slopes(staged(spark, sf), scaling.SLOPE_FEATURES)
    return round_cols(worst, list(scaling.SLOPE_FEATURES), 3)


@query
def w05_severity(spark, sf):
    """Every server-day ranked by its peak latency: the worst third is CRITICAL."""
    days = valid(spark, sf).groupBy("server_id", F.col("dt").cast("timestamp").alias("timestamp")).agg(
        F.max("response_time_ms").alias("peak_score")
    )
    return incidents.assign_severity(days)


@query
def w06_dedup_rank(spark, sf):
    """The rank of every reading among the copies of its key."""
    rows = silver.standardise(silver.enforce_types(readings(spark, sf)))
    ranks = silver.ranked(rows, order_by=[F.col(BY_EVENT)])
    return ranks.select("event_id", "server_id", F.col("_rank").alias("copy_rank"))


# --- T: order and limits


@query
def t01_top_by_anomalies(spark, sf):
    return serving.top_by_anomalies(summary(spark, sf)).select("server_id", "hostname", "anomaly_count")


@query
def t02_top_scores(spark, sf):
    return evaluation.top_scores(simple_scored(spark, sf))


@query
def t03_first_results(spark, sf):
    return evaluation.first_results(half_flagged(spark, sf))


@query
def t04_latest(spark, sf):
    return serving.latest(simple_events(spark, sf), "timestamp").select("timestamp", "server_id", "metric")


@query
def t05_worst_health(spark, sf):
    return serving.worst_health(summary(spark, sf)).select("server_id", "health_score")


@query
def t06_worst_server(spark, sf):
    base = gold.server_base(valid(spark, sf)).select("server_id", "peak_cpu_percent", "total_readings")
    return profile.worst_by(base, "server_id", "peak_cpu_percent")


@query
def t07_series_order(spark, sf):
    return profile.in_series_order(valid(spark, sf)).select("server_id", "timestamp", "event_id")


@query
def t08_sample_rows(spark, sf):
    return profile.sample_rows(valid(spark, sf)).select("event_id", "cpu_usage_percent", "response_time_ms")


@query
def t09_preview(spark, sf):
    return profile.preview(valid(spark, sf))


# --- U: sets


@query
def u01_concat(spark, sf):
    good, bad = silver.split(classified(spark, sf))
    parts = [good.select("event_id", "server_id"), bad.select("event_id", "server_id")]
    return serving.concat_all(parts)


@query
def u02_two_writers(spark, sf):
    """A second writer adds its rows while the first one is at work; the first begins again and none is lost."""
    root = scratch_path(spark, "daily")
    old, new = _two_runs(spark, sf)
    halves = [new.filter(F.col("dt") < at(SPLIT_DAY)), new.filter(F.col("dt") >= at(SPLIT_DAY))]
    tables.publish(old, root)
    others = [halves[0]]

    def first(known: DataFrame) -> DataFrame:
        if others:
            add = others.pop()
            tables.update_published(spark, root, lambda rows: rows.unionByName(add))
        return known.unionByName(halves[1])

    tables.update_published(spark, root, first)
    return tables.read_published(spark, root)


@query
def u02_reload(spark, sf):
    """The second publication reads the table it replaces."""
    root = scratch_path(spark, "daily")
    old, new = _two_runs(spark, sf)
    tables.publish(old, root)
    tables.publish(tables.read_published(spark, root).unionByName(new), root)
    return tables.read_published(spark, root)


# --- M: detector


@query
def m01_features(spark, sf):
    featured = scaling.build_features(staged(spark, sf)).select("event_id", *FEATURES)
    featured = featured.withColumn("error_count_log", rounded(F.col("error_count_log"), 6))
    return round_cols(featured, list(scaling.SLOPE_FEATURES), 4)


@query
def m02_scalers(spark, sf):
    featured = scaling.build_features(staged(spark, sf))
    featured = stage(round_cols(featured, list(scaling.SLOPE_FEATURES), 4), "features")
    return round_cols(scaling.fit_scalers(featured), ["median", "scale"], 5)


@query
def m02_scalers_sketch(spark, sf):
    """Scalers from one pass of sketches per day: whether their exact ranks are within the stated error."""
    featured = scaling.build_features(staged(spark, sf))
    featured = stage(round_cols(featured, list(scaling.SLOPE_FEATURES), 4), "features")
    days = stage(sketches.day_sketches(featured), "sketches")
    scalers = stage(sketches.scalers_from_sketches(days), "scalers")
    errors = sketches.rank_errors(featured, scalers)
    readings_of = scalers.select("server_id", "feature", F.col("n").alias("readings"))
    # One reading more or less is no error: ranks of few readings are that coarse.
    allowed = F.lit(sketches.RANK_ERROR) + F.lit(0.5) / F.col("readings")
    return errors.join(readings_of, ["server_id", "feature"]).select(
        "server_id",
        "feature",
        "readings",
        (F.col("median_error") <= allowed).alias("median_within"),
        (F.col("mad_error") <= allowed).alias("mad_within"),
    )


@query
def m03_z_scores(spark, sf):
    columns = [f"z_{f}" for f in FEATURES]
    return round_cols(z_scores(spark, sf).select("event_id", *columns), columns, 4)


@query
def m04_forest(spark, sf):
    return forest.fit_forest(z_scores(spark, sf))


@query
def m05_isolation_scores(spark, sf):
    z = z_scores(spark, sf)
    fitted = stage(forest.fit_forest(z), "forest")
    return forest.score(z, fitted).select("event_id", "server_id", "timestamp", "isolation")


@query
def m06_flags(spark, sf):
    return simple_scored(spark, sf).select("event_id", "score", "anomaly_score", "is_anomaly", "result")


@query
def m07_incidents(spark, sf):
    return incidents.build_events(simple_scored(spark, sf))


@query
def m07_incidents_continued(spark, sf):
    """Incidents of three runs; those that may still grow are carried to the next one."""
    scored, spans, told = stage(simple_scored(spark, sf), "flagged"), None, []
    for part, end in zip(_in_three_runs(scored), [*RUN_ENDS, None]):
        finished, spans = carried.continued_incidents(spans, part, at(end) if end else None)
        told.append(finished)
    return serving.concat_all(told)


@query
def m08_dominant_feature(spark, sf):
    named = incidents.dominant_feature(simple_scored(spark, sf).filter("is_anomaly = 1"))
    return named.select("event_id", "dominant_feature", "metric", rounded(F.col("value"), 4).alias("value"))


@query
def m09_finished_events(spark, sf):
    return simple_events(spark, sf)


@query
def m10_winsorised(spark, sf):
    capped = scaling.winsorise(z_scores(spark, sf))
    columns = [f"z_{f}" for f in FEATURES]
    return round_cols(capped.select("event_id", *columns), columns, 4)


@query
def m11_hour_features(spark, sf):
    rows = scaling.hour_features(valid(spark, sf)).select("event_id", "hour_sin", "hour_cos")
    return round_cols(rows, ["hour_sin", "hour_cos"], 5)


@query
def m12_detection(spark, sf):
    """The whole detector: features, scaling, forest, flags, incidents."""
    return detection.detect(staged(spark, sf, *DETECTOR_COLUMNS)).events


@query
def s11_model(spark, sf):
    """Scores from a saved and reloaded model, per server."""
    path = scratch_path(spark, "model")
    rows = staged(spark, sf, *DETECTOR_COLUMNS)
    z, scalers = detection.scale(rows)
    forest.save_model(scalers, forest.fit_forest(z), path, features=",".join(FEATURES))
    again = detection.score_new(rows, path)
    return again.groupBy("server_id").agg(
        F.count("isolation").alias("scored"), rounded(F.max("isolation"), 4).alias("most_isolated")
    )


@query
def s11_model_scalers(spark, sf):
    """Scalers as they come back from a saved model."""
    path = scratch_path(spark, "model")
    featured = scaling.build_features(staged(spark, sf))
    featured = stage(round_cols(featured, list(scaling.SLOPE_FEATURES), 4), "features")
    scalers = stage(scaling.fit_scalers(featured), "scalers")
    z = scaling.apply_scalers(featured, scalers)
    forest.save_model(scalers, forest.fit_forest(z, trees=8), path, features=",".join(FEATURES))
    again, _, settings = forest.load_model(spark, path)
    kept = again.filter(F.col("feature").isin(settings["features"].split(",")))
    return round_cols(kept.select("server_id", "feature", "median", "scale"), ["median", "scale"], 5)


@query
def p05_split_tables(spark, sf):
    """Valid and rejected rows from one write, read back as the two tables that a lake has."""
    root = scratch_path(spark, "split")
    rows = classified(spark, sf)
    paths = {"valid": f"{root}/silver", "rejected": f"{root}/telemetry_rejects"}
    tables.write_split(silver.with_outcome(rows), "outcome", paths, ["dt"])
    columns = ["event_id", "server_id", "dt"]
    good = tables.read_table(spark, paths["valid"]).select(*columns, F.lit("").alias("reason"))
    bad = tables.read_table(spark, paths["rejected"]).select(*columns, F.col("_reject_reason").alias("reason"))
    return good.unionByName(bad)


# --- X: streams


def _in_three_arrivals(spark, sf) -> list[DataFrame]:
    """Events up to the 10th, up to the 16th, and later ones; the copies of an event come with it."""
    ts = F.col("ts")
    second, third = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-10", SPLIT_DAY))
    arrivals = [ts < second, (ts >= second) & (ts < third), (ts >= third) | ts.isNull()]
    return [readings_from_events(spark, sf, arrival) for arrival in arrivals]


def _streamed_bronze(spark, sf, after_each: Callable[[str], None] | None = None) -> str:
    """Readings landed in three arrivals, each picked up by a run of the stream."""
    base = scratch_path(spark, "stream")
    for part in _in_three_arrivals(spark, sf):
        _landed(spark, sf, part, f"{base}/landing")
        streams.stream_bronze(
            spark, f"{base}/landing", f"{base}/bronze", f"{base}/ckpt-bronze", schema=LANDED_WITH_ID
        ).awaitTermination()
        if after_each:
            after_each(base)
    return base


@query
def x01_stream_bronze(spark, sf):
    base = _streamed_bronze(spark, sf)
    bronze = spark.read.parquet(f"{base}/bronze")
    return bronze.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), F.count("_source_file").alias("with_lineage")
    )


BRONZE_WITH_ID = T.StructType(
    [
        *LANDED_WITH_ID.fields,
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)


def _streamed_silver(spark, sf, each: streams.Each | None = None) -> str:
    """Silver of the arrivals, cleaned by a run of the stream after each of them; ``each`` hears of every batch."""

    def clean(base: str) -> None:
        streams.stream_silver(
            spark,
            f"{base}/bronze",
            f"{base}/silver",
            f"{base}/ckpt-silver",
            BRONZE_WITH_ID,
            as_of=at(AS_OF),
            order_by=[F.col(BY_EVENT)],
            each=each(base) if each else None,
        ).awaitTermination()

    return _streamed_bronze(spark, sf, clean)


@query
def x02_stream_silver(spark, sf):
    base = _streamed_silver(spark, sf)
    good, bad = streams.streamed_silver(spark, f"{base}/silver")
    columns = ["event_id", "server_id", "timestamp"]
    return good.select(*columns, F.lit("").alias("reason")).unionByName(
        bad.select(*columns, F.col("_reject_reason").alias("reason"))
    )


@query
def x02_compact_silver(spark, sf):
    """The same after its small files were rewritten together, and with one more run of the stream after that."""
    base = _streamed_silver(spark, sf)
    streams.compact_silver(spark, f"{base}/silver")
    # A copy of everything arrives once more under a new checkpoint: every key is known, in the new files.
    streams.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/ckpt-again", BRONZE_WITH_ID, as_of=at(AS_OF), order_by=[F.col(BY_EVENT)]
    ).awaitTermination()
    good, bad = streams.streamed_silver(spark, f"{base}/silver")
    columns = ["event_id", "server_id", "timestamp"]
    return good.select(*columns, F.lit("").alias("reason")).unionByName(
        bad.select(*columns, F.col("_reject_reason").alias("reason"))
    )


def _refreshing(base: str) -> streams.Each:
    def each(session: SparkSession, rows: DataFrame, key: tuple[str, int]) -> None:
        live_gold.add_batch(session, f"{base}/gold", rows, key)

    return each


@query
def x02_stream_gold(spark, sf):
    """Daily metrics kept up to date by the stream."""
    base = _streamed_silver(spark, sf, _refreshing)
    return live_gold.live_daily(spark, f"{base}/gold")


@query
def x02_stream_summary(spark, sf):
    """The server summary from the stream's daily states and the readings of one day."""
    base = _streamed_silver(spark, sf, _refreshing)
    return live_gold.live_summary(spark, f"{base}/gold", f"{base}/silver")


@query
def x03_stream_events(spark, sf):
    """Incidents closed by the stream; a day is added to the last flag so that all close."""
    base = scratch_path(spark, "events-stream")
    scored = stage(simple_scored(spark, sf).filter("is_anomaly = 1"), "flagged")
    scored.write.parquet(f"{base}/scored")
    source = spark.readStream.schema(scored.schema).parquet(f"{base}/scored")
    streams.stream_events(source, f"{base}/events", f"{base}/ckpt").awaitTermination()
    # The newest reading closes everything more than gap + delay older than itself.
    closer = scored.orderBy(F.desc("timestamp")).limit(1)
    closer = closer.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(F.lit(1)))
    closer.write.mode("append").parquet(f"{base}/scored")
    source = spark.readStream.schema(scored.schema).parquet(f"{base}/scored")
    streams.stream_events(source, f"{base}/events", f"{base}/ckpt").awaitTermination()
    return spark.read.schema(incidents.build_events(scored).schema).parquet(f"{base}/events")


def _snapshots(spark, sf) -> list[tuple[DataFrame, str]]:
    """Health summaries and their instants: up to the 11th, up to the 16th, from the 13th, all days."""
    rows = staged(spark, sf)
    ts = F.col("timestamp")
    periods = [
        (ts < at("2024-01-11"), "2024-01-11"),
        (ts < at("2024-01-16"), "2024-01-16"),
        (ts >= at("2024-01-13"), "2024-01-31"),
        (F.lit(True), "2024-02-01"),
    ]
    return [(gold.build_server_summary(rows.filter(period)), now) for period, now in periods]


def _stepped_alerts(spark, sf) -> DataFrame:
    """Alerts after the four snapshots."""
    alerts = spark.createDataFrame(
        [],
        "server_id string, metric string, severity string, triggered_at timestamp, "
        "resolved boolean, resolved_at timestamp",
    )
    for snapshot, now in _snapshots(spark, sf):
        alerts = stage(streams.step_alerts(alerts, snapshot, at(now)), "alerts")
    return alerts


@query
def x04_step_alerts(spark, sf):
    return _stepped_alerts(spark, sf)


@query
def x04_stream_alerts(spark, sf):
    """The same snapshots as files of a stream, two to a run; a last row without a server moves the watermark on."""
    base = scratch_path(spark, "alert-stream")
    columns = ["server_id", "health_score", "observed_at"]
    found = [s.withColumn("observed_at", at(now)).select(*columns) for s, now in _snapshots(spark, sf)]
    closer = spark.range(1).select(
        F.lit(None).cast("string").alias("server_id"), F.lit(None).cast("double").alias("health_score"), at("2024-02-03").alias("observed_at")
    )
    for rows in (found[:2], [*found[2:], closer]):
        for snapshot in rows:
            snapshot.write.mode("append").parquet(f"{base}/summaries")
        alert_stream.stream_alerts(
            spark, f"{base}/summaries", closer.schema, f"{base}/alerts", f"{base}/ckpt"
        ).awaitTermination()
    return alert_stream.streamed_alerts(spark, f"{base}/alerts")
