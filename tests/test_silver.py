from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators import quality, silver
from fleetlake.functions.rules import all_reasons, validity_rules
from conftest import NOON, minutes


@pytest.fixture(scope="module")
def clean(spark):
    as_of = F.lit(datetime(2026, 8, 1, tzinfo=timezone.utc))
    return lambda df, **kw: silver.clean_and_validate(df, as_of=as_of, **kw)


def outcome(pair):
    valid, rejects = pair
    return valid.count(), [r["_reject_reason"] for r in rejects.collect()]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"cpu_usage_percent": 140.0}, "cpu_out_of_range"),
        ({"cpu_usage_percent": -0.1}, "cpu_out_of_range"),
        ({"cpu_usage_percent": 100.0}, None),
        ({"cpu_usage_percent": float("nan")}, "cpu_out_of_range"),
        ({"memory_usage_percent": None}, "memory_out_of_range"),
        ({"disk_usage_percent": 101.0}, "disk_out_of_range"),
        ({"network_rx_bytes": -500.0}, "negative_io_or_network"),
        ({"network_rx_bytes": None}, None),
        ({"network_rx_bytes": float("nan")}, None),
        ({"network_rx_bytes": None, "disk_io_read": -1.0}, "negative_io_or_network"),
        ({"application_error_count": -5}, "negative_errors_or_latency"),
        ({"application_error_count": None}, None),
        ({"timestamp": datetime(2099, 1, 1, tzinfo=timezone.utc)}, "invalid_timestamp"),
        ({"timestamp": datetime(2019, 12, 31, tzinfo=timezone.utc)}, "invalid_timestamp"),
        ({"timestamp": None}, "invalid_timestamp"),
        ({"server_id": None}, "missing_required_field"),
        ({"server_id": None, "cpu_usage_percent": 140.0}, "cpu_out_of_range"),
        ({"cpu_usage_percent": 140.0, "response_time_ms": -1.0}, "negative_errors_or_latency"),
    ],
)
def test_one_reading(reading, clean, change, reason):
    assert outcome(clean(reading(change))) == ((1, []) if reason is None else (0, [reason]))


def test_exact_copy_collapses(reading, clean):
    assert outcome(clean(reading({}, {}))) == (1, [])


def test_spelling_variants_are_one_server(reading, clean):
    valid, rejects = clean(reading({}, {"server_id": "  SERVER01  "}, {"hostname": " WEB-APP-01"}))
    assert rejects.count() == 0
    assert [(r.server_id, r.hostname) for r in valid.collect()] == [("server01", "web-app-01")]


def test_only_bad_rows_of_a_batch_are_rejected(reading, clean):
    good = [{"server_id": f"server{i:02d}"} for i in range(1, 6)]
    bad = {"server_id": "server06", "application_error_count": -5}
    assert outcome(clean(reading(*good, bad))) == (5, ["negative_errors_or_latency"])


def test_tie_break_decides_which_copy_is_judged(reading, clean):
    extra = T.StructType([T.StructField("event_id", T.LongType())])
    rows = [{"event_id": 2}, {"event_id": 1, "cpu_usage_percent": 140.0}]
    first = clean(reading(*rows, extra=extra), order_by=[F.col("event_id")])
    last = clean(reading(*rows, extra=extra), order_by=[F.desc("event_id")])
    assert outcome(first) == (0, ["cpu_out_of_range"])
    assert outcome(last) == (1, [])


def test_null_keys_collapse_to_one(reading, clean):
    rows = [{"server_id": None, "cpu_usage_percent": float(i)} for i in range(4)]
    assert outcome(clean(reading(*rows))) == (0, ["missing_required_field"])


def test_text_columns_are_parsed_and_garbage_becomes_null(spark, clean):
    columns = {
        "timestamp": "2026-07-15 12:00:00", "server_id": "server01", "hostname": "h",
        "cpu_usage_percent": "n/a", "memory_usage_percent": "50", "disk_usage_percent": "60",
        "disk_io_read": "1", "disk_io_write": "1", "network_rx_bytes": "1",
        "network_tx_bytes": "1", "application_error_count": "3", "response_time_ms": "9.5",
        "status": "OK",
    }
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    assert outcome(clean(df)) == (0, ["cpu_out_of_range"])
    assert dict(silver.enforce_types(df).dtypes)["application_error_count"] == "bigint"


def test_valid_and_rejected_make_up_the_deduplicated_rows(reading, clean):
    rows = [{"timestamp": minutes(5 * (i % 7)), "cpu_usage_percent": 15.0 * i} for i in range(12)]
    df = reading(*rows)
    valid, rejects = clean(df)
    unique = silver.dedup(silver.standardise(silver.enforce_types(df))).count()
    assert valid.count() + rejects.count() == unique == 7


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_result_does_not_depend_on_partitions(reading, clean, partitions):
    rows = [{"timestamp": minutes(5 * (i % 5)), "cpu_usage_percent": 11.0 * i} for i in range(20)]
    valid, _ = clean(reading(*rows).repartition(partitions))
    kept = sorted((r.timestamp, r.cpu_usage_percent) for r in valid.collect())
    assert [c for _, c in kept] == [0.0, 11.0, 22.0, 33.0, 44.0]


def test_hot_key_is_cut_before_the_shuffle(reading):
    plan = silver.dedup(reading({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_all_reasons_and_counts(reading):
    as_of = F.lit(datetime(2026, 8, 1, tzinfo=timezone.utc))
    df = reading({"cpu_usage_percent": None, "response_time_ms": -1.0})
    reasons = df.select(all_reasons(validity_rules(as_of)).alias("r")).first()["r"]
    assert reasons == ["cpu_out_of_range", "negative_errors_or_latency"]
    assert silver.duplicate_count(reading({}, {}, {}, {"timestamp": minutes(5)})).first()[0] == 2


def test_pipeline_counts_and_breakdown(reading):
    df = reading({}, {}, {"server_id": "server02"}, {"server_id": "server03", "cpu_usage_percent": 101.0})
    done = silver.classify(df, as_of=F.lit(datetime(2026, 8, 1, tzinfo=timezone.utc)))
    row = quality.pipeline_counts(df, done).first()
    assert (row.bronze_rows, row.valid_rows, row.rejected_rows, row.servers) == (4, 2, 1, 2)
    assert row.pass_rate_percent == 50.0
    assert quality.reject_breakdown(silver.split(done)[1]).collect()[0]["n"] == 1


def test_null_counts_include_nan(reading):
    df = reading({"cpu_usage_percent": float("nan")}, {"cpu_usage_percent": None}, {})
    missing = {r.column_name: r.missing for r in quality.null_counts(df).collect()}
    assert missing["cpu_usage_percent"] == 2 and missing["server_id"] == 0


def test_base_row_is_noon(reading):
    assert reading({}).select(F.unix_micros("timestamp")).first()[0] == int(NOON.timestamp()) * 10**6
