import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.operators import series
from conftest import minutes

GAP = 30 * series.MICROS["minute"]


@pytest.fixture(scope="module")
def points(spark):
    """Three servers of different length with irregular steps, one of them much longer."""
    rng = np.random.default_rng(5)
    rows = []
    for server, n in (("a", 40), ("b", 700), ("c", 5)):
        t = 0.0
        for i in range(n):
            t += float(rng.choice([1, 5, 5, 5, 29, 30, 31, 200]))
            rows.append((server, minutes(t), float(rng.normal(50, 10))))
    return spark.createDataFrame(rows, "server_id string, timestamp timestamp, y double").repartition(5)


def in_order(df):
    by_server = {}
    for r in df.orderBy("server_id", "timestamp").collect():
        by_server.setdefault(r["server_id"], []).append(r)
    return by_server


def slopes_by_hand(values, window):
    x = np.arange(window)
    return [
        0.0 if i < window - 1 else float(np.polyfit(x, values[i - window + 1 : i + 1], 1)[0]) * window
        for i in range(len(values))
    ]


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 100, 41, 25])
def test_rolling_slope_equals_brute_force(points, rows_per_slice):
    window = 24
    got = in_order(series.rolling_slope(points, "y", window, rows_per_slice=rows_per_slice))
    for rows in got.values():
        want = slopes_by_hand([r["y"] for r in rows], window)
        assert np.allclose([r["y_slope"] for r in rows], want, atol=1e-8)
    assert sum(map(len, got.values())) == points.count()


@pytest.mark.parametrize("n, expected", [(287, 0), (288, 1)])
def test_first_full_window(spark, n, expected):
    df = spark.range(n).select(
        F.lit("a").alias("server_id"),
        F.timestamp_micros(F.col("id") * 300_000_000).alias("timestamp"),
        (F.col("id") / 288.0).alias("y"),
    )
    slopes = [r["y_slope"] for r in series.rolling_slope(df, "y").collect()]
    assert sum(s != 0 for s in slopes) == expected
    assert series.worst_slopes(df, {"w": "y"}).first()["w"] == (pytest.approx(1.0) if expected else None)


def test_null_in_a_window_makes_its_slope_null(spark):
    rows = [("a", minutes(i), None if i == 5 else float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "server_id string, timestamp timestamp, y double")
    got = [r["y_slope"] for r in in_order(series.rolling_slope(df, "y", 3))["a"]]
    assert got[5:8] == [None, None, None]
    assert got[4] == pytest.approx(3.0) and got[8] == pytest.approx(3.0)


@pytest.mark.parametrize("unit", ["minute", "hour", "day"])
def test_gaps_equal_plain_differences(points, unit):
    for rows in in_order(series.gap_since_prev(points, slice_micros=series.MICROS[unit])).values():
        t = [r["timestamp"] for r in rows]
        want = [None] + [int((b - a).total_seconds() * 1e6) for a, b in zip(t, t[1:])]
        assert [r["gap_micros"] for r in rows] == want


def test_sessions_equal_plain_running_sum(points):
    for rows in in_order(series.sessionise(points, GAP)).values():
        session, want, last = 0, [], None
        for r in rows:
            if last is None or (r["timestamp"] - last).total_seconds() > 1800:
                session += 1
            want.append(session)
            last = r["timestamp"]
        assert [r["session"] for r in rows] == want


@pytest.mark.parametrize("extra_micros, sessions", [(0, 1), (1, 2)])
def test_gap_of_exactly_thirty_minutes_merges(spark, extra_micros, sessions):
    df = spark.sql(
        f"select 'a' as server_id, timestamp_micros(id * {1_800_000_000 + extra_micros} + 17) as timestamp from range(2)"
    )
    assert series.sessionise(df, GAP).agg(F.max("session")).first()[0] == sessions


def test_gap_histogram(spark):
    rows = [("a", minutes(0)), ("a", minutes(5)), ("a", minutes(10)), ("b", minutes(0)), ("b", minutes(60))]
    df = spark.createDataFrame(rows, "server_id string, timestamp timestamp")
    assert {r["gap_seconds"]: r["n"] for r in series.gap_histogram(df).collect()} == {300.0: 2, 3600.0: 1}


def test_slice_must_exceed_lookback(points):
    with pytest.raises(ValueError):
        series.with_slices(points, 30, rows_per_slice=30)


def test_null_keys_are_kept(spark):
    rows = spark.sql("select * from values ('a', timestamp'2024-01-01 00:00:00'), (null, timestamp'2024-01-01 00:00:00'), "
                     "(null, timestamp'2024-01-01 00:05:00'), ('a', null) t(server_id, timestamp)")
    assert sorted(str(r.gap_micros) for r in series.gap_since_prev(rows).collect()) == ["300000000", "None", "None", "None"]
    assert series.sessionise(rows).count() == 4
