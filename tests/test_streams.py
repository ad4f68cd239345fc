from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators import incidents, silver
from fleetlake.sources import readings, tables
from fleetlake.streaming import streams
from conftest import NOON, minutes
from test_detection import flagged

BRONZE = T.StructType(
    [
        *readings.LANDED.fields,
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)


def run(spark, base, as_of):
    streams.stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1").awaitTermination()
    streams.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/c2", BRONZE, as_of=as_of
    ).awaitTermination()


def keyed(df, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in df.collect())


def test_silver_stream_equals_batch(spark, reading, tmp_path):
    base, as_of = str(tmp_path), F.lit("2026-08-01").cast("timestamp")
    arrivals = [
        [{}, {"timestamp": minutes(5), "cpu_usage_percent": 140.0}, {"timestamp": None}],
        # Copies of a valid and of a rejected reading, a late day, and a second null time.
        [{"server_id": " SERVER01"}, {"timestamp": minutes(5)}, {"timestamp": minutes(-2880)}, {"timestamp": None}],
        [{"timestamp": minutes(-2880), "response_time_ms": 1.0}, {"server_id": "server02"}],
    ]
    for rows in arrivals:
        readings.land(reading(*rows), f"{base}/landing")
        run(spark, base, as_of)
    valid, rejects = streams.streamed_silver(spark, f"{base}/silver")
    bronze = spark.read.schema(BRONZE).parquet(f"{base}/bronze")
    want_valid, want_rejects = silver.clean_and_validate(bronze, as_of=as_of)
    keys = ["server_id", "timestamp", "response_time_ms"]
    assert keyed(valid, *keys) == keyed(want_valid, *keys)
    assert keyed(rejects, "timestamp", "_reject_reason") == keyed(want_rejects, "timestamp", "_reject_reason")
    assert bronze.count() == 9 and valid.count() == 3


def test_a_repeated_batch_changes_nothing(spark, reading, tmp_path):
    base, as_of = str(tmp_path), F.lit("2026-08-01").cast("timestamp")
    readings.land(reading({}, {"timestamp": minutes(5)}), f"{base}/landing")
    run(spark, base, as_of)
    # A lost checkpoint makes the stream process the same files again as batch 0.
    streams.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/other", BRONZE, as_of=as_of
    ).awaitTermination()
    assert streams.streamed_silver(spark, f"{base}/silver")[0].count() == 2


def test_bronze_stream_picks_up_only_new_files(spark, reading, tmp_path):
    base = str(tmp_path)
    for i in range(3):
        readings.land(reading({"timestamp": minutes(i)}), f"{base}/landing")
        streams.stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c").awaitTermination()
        assert spark.read.parquet(f"{base}/bronze").count() == i + 1


def test_stream_events_equal_batch_once_closed(spark, tmp_path):
    base = str(tmp_path)
    rows = [(0, 0.1), (30, 0.4), (60.5, 0.2), (65, 0.2), (300, 0.3)]
    scored = flagged(spark, rows)
    for i, part in enumerate([rows[:2], rows[2:], [(2000, 0.9)], [(4000, 0.9)]]):
        flagged(spark, part).write.mode("append").parquet(f"{base}/scored")
        source = spark.readStream.schema(scored.schema).parquet(f"{base}/scored")
        streams.stream_events(source, f"{base}/events", f"{base}/ckpt").awaitTermination()
    batch = incidents.build_events(scored)
    got = spark.read.schema(batch.schema).parquet(f"{base}/events")
    early = got.filter(F.col("timestamp") < F.lit(NOON + timedelta(minutes=1000)))
    assert keyed(early, *batch.columns) == keyed(batch, *batch.columns)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame(
        [],
        "server_id string, metric string, severity string, triggered_at timestamp, "
        "resolved boolean, resolved_at timestamp",
    )


def health(spark, **scores):
    return spark.createDataFrame(list(scores.items()), "server_id string, health_score double")


def test_alert_life_cycle(spark, empty):
    def step(alerts, day, **scores):
        now = F.lit(f"2026-08-{day:02d}").cast("timestamp")
        done = streams.step_alerts(alerts, health(spark, **scores), now)
        again = streams.step_alerts(done, health(spark, **scores), F.lit("2027-01-01").cast("timestamp"))
        assert keyed(done, *streams.ALERT_COLUMNS) == keyed(again, *streams.ALERT_COLUMNS)
        return done

    def state(alerts):
        return sorted(
            (r.server_id, r.severity, r.triggered_at.day, r.resolved, r.resolved_at and r.resolved_at.day)
            for r in alerts.collect()
        )

    one = step(empty, 1, a=50.0, b=70.0, c=99.0)
    assert state(one) == [("a", "CRITICAL", 1, False, None), ("b", "WARNING", 1, False, None)]
    two = step(one, 2, a=50.0, b=90.0, c=80.0)
    assert ("a", "CRITICAL", 1, False, None) in state(two) and ("b", "WARNING", 1, True, 2) in state(two)
    three = step(two, 3, a=70.0)  # moves to WARNING; b and c are not in this snapshot
    assert state(three) == [
        ("a", "CRITICAL", 1, True, 3),
        ("a", "WARNING", 3, False, None),
        ("b", "WARNING", 1, True, 2),
        ("c", "WARNING", 2, False, None),
    ]


def test_alert_stream_publishes_after_every_snapshot(spark, tmp_path):
    base = str(tmp_path)
    first = health(spark, a=50.0)
    for scores in ({"a": 50.0}, {"a": 50.0}, {"a": 95.0}):
        health(spark, **scores).coalesce(1).write.mode("append").parquet(f"{base}/summaries")
        streams.stream_alerts(spark, f"{base}/summaries", first.schema, f"{base}/alerts", f"{base}/c").awaitTermination()
    rows = tables.read_published(spark, f"{base}/alerts").collect()
    assert [(r.server_id, r.severity, r.resolved) for r in rows] == [("a", "CRITICAL", True)]


def test_a_renamed_host_has_one_alert(spark, empty):
    """Two rows of one server, low and healthy or both low, open one alert; repeats change nothing."""
    for scores in ((50.0, 55.0), (50.0, 99.0)):
        rows = spark.createDataFrame([("a", s) for s in scores], "server_id string, health_score double")
        alerts = empty
        for _ in range(4):
            alerts = streams.step_alerts(alerts, rows, F.lit(NOON))
        assert [(r.severity, r.resolved) for r in alerts.collect()] == [("CRITICAL", False)]
    healthy = spark.createDataFrame([("a", 99.0), ("a", 98.0)], "server_id string, health_score double")
    assert [r.resolved for r in streams.step_alerts(alerts, healthy, F.lit(NOON)).collect()] == [True]
