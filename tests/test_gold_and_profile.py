import pytest
from pyspark.sql import functions as F

from fleetlake.functions.rules import HealthConfig, derive_status, rounded
from fleetlake.operators import gold, profile, quality
from conftest import minutes


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def with_day(df):
    return df.withColumn("dt", F.to_date("timestamp"))


def test_health_score_counts_every_penalty(reading):
    rows = [
        {"cpu_usage_percent": 95.0, "status": "CRITICAL", "application_error_count": 0},
        {"timestamp": minutes(5), "disk_usage_percent": 94.0, "status": "CRITICAL", "application_error_count": 2},
    ]
    row = only(gold.build_server_summary(reading(*rows)))
    # 100 - (15 cpu + 0 memory + 1.5 * 4 disk + 5 * 1 errors + 2 * 2 readings)
    assert row.health_score == 70.0
    assert (row.anomaly_count, row.total_readings, row.errors_per_hour) == (2, 2, 12.0)
    heavier = gold.build_server_summary(reading(*rows), HealthConfig(anomaly_weight=10.0))
    assert only(heavier).health_score == 54.0


def test_health_score_floor_and_missing_errors(reading):
    many = [{"timestamp": minutes(5 * i), "status": "WARNING"} for i in range(60)]
    assert only(gold.build_server_summary(reading(*many))).health_score == 0.0
    unknown = {"application_error_count": None, "cpu_usage_percent": 99.0, "status": "CRITICAL"}
    assert only(gold.build_server_summary(reading(unknown))).health_score == 100.0


def test_trend_uses_the_fleet_midpoint_and_is_null_with_one_half(reading):
    rows = [
        {"disk_usage_percent": 50.0},
        {"timestamp": minutes(100), "disk_usage_percent": 60.0},
        {"server_id": "server02", "timestamp": minutes(1)},
    ]
    trend = {r.server_id: r.disk_trend_percent_change for r in gold.build_server_summary(reading(*rows)).collect()}
    assert trend == {"server01": 10.0, "server02": None}
    alone = {r.server_id: r.disk_trend_percent_change for r in gold.disk_trend(reading(*rows)).collect()}
    assert alone == trend


def test_renamed_host_gives_two_rows_with_the_servers_trend(reading):
    rows = [
        {"disk_usage_percent": 50.0},
        {"timestamp": minutes(100), "disk_usage_percent": 60.0, "hostname": "new-name"},
    ]
    summary = gold.build_server_summary(reading(*rows)).collect()
    assert sorted((r.hostname, r.disk_trend_percent_change) for r in summary) == [
        ("new-name", 10.0),
        ("web-app-01", 10.0),
    ]


def test_summary_reads_its_rows_once_besides_the_midpoint(reading, tmp_path):
    reading({}).write.parquet(str(tmp_path / "silver"))
    table = reading({}).sparkSession.read.parquet(str(tmp_path / "silver"))
    plan = gold.build_server_summary(table)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") - plan.count("Subquery") <= 1


def test_daily_metrics(reading):
    rows = [{}, {"timestamp": minutes(5), "cpu_usage_percent": 60.0}, {"timestamp": minutes(1440)}]
    daily = gold.build_daily_metrics(with_day(reading(*rows))).collect()
    assert [(str(r.dt), r.avg_cpu_percent, r.peak_cpu_percent) for r in daily] == [
        ("2026-07-15", 50.0, 60.0),
        ("2026-07-16", 40.0, 40.0),
    ]


@pytest.mark.parametrize(
    "change, status",
    [
        ({}, "OK"),
        ({"cpu_usage_percent": 90.0}, "WARNING"),
        ({"cpu_usage_percent": 90.1}, "CRITICAL"),
        ({"disk_usage_percent": 90.0}, "OK"),
        ({"disk_usage_percent": 90.1}, "CRITICAL"),
        ({"memory_usage_percent": 75.1}, "WARNING"),
        ({"application_error_count": 10}, "OK"),
        ({"application_error_count": 11}, "WARNING"),
        ({"cpu_usage_percent": None, "memory_usage_percent": None, "disk_usage_percent": None,
          "application_error_count": None}, "OK"),
    ],
)
def test_status_rule(reading, change, status):
    assert reading(change).select(derive_status()).first()[0] == status


def test_rounding_is_half_up_on_the_decimal(spark):
    df = spark.sql("select explode(array(0.125D, 2.675D, -0.125D, 1.005D)) as x")
    assert [r[0] for r in df.select(rounded(F.col("x"), 2)).collect()] == [0.13, 2.68, -0.13, 1.01]


def test_profile_questions(reading):
    rows = [
        {"cpu_usage_percent": 95.0, "response_time_ms": 200.0, "application_error_count": 4},
        {"timestamp": minutes(5), "cpu_usage_percent": 35.0, "response_time_ms": 100.0},
        {"server_id": "server02", "cpu_usage_percent": 20.0, "response_time_ms": 600.0},
        {"server_id": "server02", "timestamp": minutes(5), "cpu_usage_percent": 10.0},
    ]
    df = reading(*rows)
    top = profile.cpu_profile(df).collect()
    assert [(r.server_id, r.avg_cpu, r.median_cpu, r.p99_cpu) for r in top] == [
        ("server01", 65.0, 65.0, 94.4),
        ("server02", 15.0, 15.0, 19.9),
    ]
    assert only(profile.cpu_spread(df)).spread == 50.0
    worst = only(profile.error_outlier(df))
    assert (worst.server_id, worst.total_errors, worst.fleet_median, worst.times_median) == ("server01", 5, 3.5, 1.43)
    hot = only(profile.natural_experiment(df, profile.CPU, 90, profile.LATENCY))
    assert (hot.server_id, hot.mean_above, hot.mean_otherwise) == ("server01", 200.0, 100.0)
    slow = only(profile.natural_experiment(df, profile.LATENCY, 500, profile.CPU))
    assert (slow.server_id, slow.mean_above, slow.mean_otherwise) == ("server02", 20.0, 10.0)


def test_surge_and_zero_spread(reading):
    calm = [{"timestamp": minutes(5 * i), "network_rx_bytes": 1000.0 + i % 3} for i in range(30)]
    burst = [{"server_id": "server07", "timestamp": minutes(5 * i), "network_rx_bytes": 9e6} for i in range(3)]
    quiet = [{"server_id": "server07", "timestamp": minutes(100 + i), "network_rx_bytes": 1000.0} for i in range(5)]
    scored = profile.with_fleet_z(reading(*calm, *burst, *quiet))
    row = only(profile.surge_interval(scored))
    assert (row.server_id, row.intervals, row.minutes) == ("server07", 3, 15)
    flat = profile.with_fleet_z(reading({}, {"timestamp": minutes(5)}))
    assert flat.filter("robust_z is null").count() == 2


def test_around_keeps_the_margin(reading):
    df = reading(*[{"timestamp": minutes(m)} for m in (-361, -360, 0, 360, 361)])
    noon = F.lit(minutes(0))
    assert profile.around(df, noon, noon).count() == 3


def test_sample_is_the_same_however_partitioned(reading):
    df = reading(*[{"timestamp": minutes(i)} for i in range(200)])
    a = {r.timestamp for r in profile.sample_rows(df.repartition(3), 20).collect()}
    b = {r.timestamp for r in profile.sample_rows(df.repartition(7), 20).collect()}
    assert a == b and len(a) == 20


def test_recall_is_null_without_truth(reading):
    df = reading({"status": "WARNING"}, {"server_id": "s2", "is_injected_anomaly": 1})
    rows = {r.server_id: r for r in profile.rule_vs_truth(df).collect()}
    assert rows["server01"].recall_pct is None and rows["server01"].false_positives == 1
    assert rows["s2"].recall_pct == 0.0 and rows["s2"].caught == 0


def test_completeness_and_bounds(reading):
    row = only(quality.completeness(reading({}, {"timestamp": minutes(5)}), per_day=3, days=2))
    assert (row.expected_rows, row.actual_rows, row.missing_rows) == (6, 2, 4)
