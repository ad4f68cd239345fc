from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.operators import evaluation, forest, incidents, scaling
from fleetlake.plans import detection
from fleetlake.session import stage
from fleetlake.sources import tables
from conftest import NOON, minutes


def fleet(reading, rows_per_server=400, outliers=8):
    """Two calm servers; ``server02`` has a burst of high latency and errors at the end."""
    rng = np.random.default_rng(3)
    rows = []
    for server in ("server01", "server02"):
        for i in range(rows_per_server):
            odd = server == "server02" and i >= rows_per_server - outliers
            rows.append(
                {
                    "server_id": server,
                    "timestamp": minutes(5 * i),
                    "cpu_usage_percent": float(30 + rng.normal(0, 4)),
                    "memory_usage_percent": float(45 + rng.normal(0, 3)),
                    "disk_usage_percent": float(50 + rng.normal(0, 1)),
                    "network_rx_bytes": float(5e5 + rng.normal(0, 8e4)),
                    "network_tx_bytes": float(3e5 + rng.normal(0, 6e4)),
                    "application_error_count": 40 if odd else int(rng.poisson(0.5)),
                    "response_time_ms": 1500.0 if odd else float(120 + rng.normal(0, 15)),
                    "is_injected_anomaly": int(odd),
                }
            )
    return reading(*rows)


@pytest.fixture(scope="module")
def silver(reading):
    return stage(fleet(reading), "fleet")


@pytest.fixture(scope="module")
def result(silver):
    return detection.detect(silver, trees=60, contamination=0.05)


def test_scaler_falls_back_on_the_standard_deviation(reading):
    df = reading(*[{"timestamp": minutes(i), "cpu_usage_percent": c} for i, c in enumerate([5.0, 5.0, 5.0, 9.0])])
    row = scaling.fit_scalers(df, ["cpu_usage_percent"]).first()
    assert row["median"] == 5.0
    assert row["scale"] == pytest.approx(np.std([5, 5, 5, 9], ddof=1) + 1e-9)


def test_unknown_server_is_unscored_and_reported(silver, reading):
    scalers = scaling.fit_scalers(silver, ["cpu_usage_percent"])
    stranger = reading({"server_id": "server99"})
    z = scaling.apply_scalers(stranger, scalers, ["cpu_usage_percent"])
    assert z.first()["z_cpu_usage_percent"] is None
    assert [r.server_id for r in scaling.unscaled_servers(stranger, scalers).collect()] == ["server99"]


def test_winsorise_limits_and_keeps_null(spark):
    df = spark.sql("select explode(array(-50D, 3D, 50D, null)) as z_x")
    assert [r[0] for r in scaling.winsorise(df, ["x"]).collect()] == [-8.0, 3.0, 8.0, None]


def test_planted_outliers_outrank_the_bulk(result):
    scored = result.scored.select("is_injected_anomaly", "isolation").toPandas()
    odd = scored[scored.is_injected_anomaly == 1].isolation
    bulk = scored[scored.is_injected_anomaly == 0].isolation
    assert odd.min() > bulk.quantile(0.97)
    assert 0 < bulk.min() and odd.max() <= 1


def test_flagged_share_and_sign(result):
    row = evaluation.flag_rate(result.scored).first()
    assert row.flagged / row.readings == pytest.approx(0.05, abs=0.005)
    assert result.scored.filter("is_anomaly = 1 and anomaly_score <= 0").count() == 0
    assert evaluation.evaluate_detector(result.scored).first().recall == 1.0


def test_forest_does_not_depend_on_partitions(silver):
    z, _ = detection.scale(silver)
    z = stage(z, "z")

    def trees(df):
        rows = forest.fit_forest(df, trees=5).orderBy("tree").collect()
        return [(r.tree, r.feature, r.threshold) for r in rows]

    assert trees(z.repartition(1)) == trees(z.repartition(7))


def test_samples_are_exact_and_without_repeats(silver):
    z, _ = detection.scale(silver)
    drawn = forest.draw_samples(stage(z, "z"), trees=20, sample_rows=64)
    sizes = {r.tree: r["count"] for r in drawn.groupBy("tree").count().collect()}
    assert len(sizes) == 20 and set(sizes.values()) == {64}


def test_scores_follow_the_published_formula():
    # One split at 0 on the only feature: three rows to the left, one to the right.
    feature, threshold, path = forest._grow(np.array([[-1.0], [-1.0], [-1.0], [5.0]]), 1, np.random.default_rng(0))
    assert feature[0] == 0 and -1 <= threshold[0] < 5
    assert path[1] == pytest.approx(1 + forest.expected_path(3)) and path[2] == 1.0
    trees = (feature[None, :], threshold[None, :], path[None, :])
    got = forest.isolation(np.array([[-1.0], [9.0]]), trees)
    assert got == pytest.approx([2 ** -path[1], 0.5])


def test_expected_path():
    assert forest.expected_path(1) == 0 and forest.expected_path(2) == 1
    assert forest.expected_path(256) == pytest.approx(10.244, abs=0.01)


def test_model_round_trip_scores_alike(silver, result, tmp_path):
    path = str(tmp_path / "model")
    forest.save_model(result.scalers, result.forest, path, contamination=0.05)
    assert forest.load_model(silver.sparkSession, path)[2] == {"contamination": "0.05"}
    again = detection.score_new(silver, path).select("server_id", "timestamp", F.col("isolation").alias("b"))
    both = result.scored.join(again, ["server_id", "timestamp"])
    assert both.filter("abs(isolation - b) > 1e-12").count() == 0


def test_run_detection_writes_all_tables(silver, tmp_path):
    out = str(tmp_path / "ml")
    detection.run_detection(silver, out, trees=10)
    spark = silver.sparkSession
    scores = tables.read_table(spark, f"{out}/anomaly_results")
    assert scores.columns == [*tables.SCORED_KEYS, *scaling.FEATURES] and scores.count() == silver.count()
    assert tables.read_table(spark, f"{out}/anomaly_events").columns == incidents.EVENT_COLUMNS
    assert tables.read_published(spark, f"{out}/anomalies").count() > 0
    # The saved model flags the same readings as the run that fitted it.
    again = detection.score_new(silver, f"{out}/model").select("server_id", "timestamp", "is_anomaly")
    assert again.exceptAll(scores.select("server_id", "timestamp", "is_anomaly")).count() == 0


# --- incidents


def flagged(spark, rows, z=None):
    """Rows of (minute, score); all other columns fixed."""
    z = z or {}
    df = spark.createDataFrame(
        [("s1", NOON + timedelta(minutes=m), float(sc), 1) for m, sc in rows],
        "server_id string, timestamp timestamp, anomaly_score double, is_anomaly int",
    )
    values = {f: F.lit(float(i)) for i, f in enumerate(scaling.FEATURES)}
    values |= {f"z_{f}": F.lit(float(z.get(f, 0.0))) for f in scaling.FEATURES}
    values |= {"application_error_count": F.lit(7).cast("long")}
    return df.withColumns(values)


def test_gap_of_thirty_minutes_merges_and_more_splits(spark):
    events = incidents.build_events(flagged(spark, [(0, 0.1), (30, 0.3), (60.5, 0.2)])).orderBy("timestamp").collect()
    assert [(e.readings, e.duration_minutes, e.peak_score) for e in events] == [(2, 35, 0.3), (1, 5, 0.2)]


def test_peak_ties_go_to_the_earliest_and_dominant_ties_to_feature_order(spark):
    z = {"network_rx_bytes": -9.0, "response_time_ms": 9.0}
    event = incidents.build_events(flagged(spark, [(0, 0.1), (5, 0.4), (10, 0.4)], z)).first()
    assert event.peak_timestamp == (NOON + timedelta(minutes=5)).replace(tzinfo=None)
    assert event.metric == "network_rx_bytes" and event.value == 3.0


def test_engineered_features_report_their_raw_metric(spark):
    event = incidents.build_events(flagged(spark, [(0, 0.1)], {"error_count_log": 5.0})).first()
    assert (event.metric, event.value) == ("application_error_count", 7.0)
    event = incidents.build_events(flagged(spark, [(0, 0.1)], {"disk_slope_24h": 5.0})).first()
    assert event.metric == "disk_usage_percent (trend)"


@pytest.mark.parametrize("n, critical", [(1, 1), (2, 1), (5, 1), (6, 2), (10, 3)])
def test_top_third_is_critical(spark, n, critical):
    df = flagged(spark, [(100 * i, 0.01 * i) for i in range(n)])
    events = incidents.finish_events(incidents.build_events(df)).collect()
    top = sorted(events, key=lambda e: -e.peak_score)
    assert [e.severity for e in top] == ["CRITICAL"] * critical + ["WARNING"] * (n - critical)
    assert events[0].description.startswith("Isolation Forest flagged cpu_usage_percent on s1: 1 flagged readings")


def test_no_flagged_rows_give_a_typed_empty_result(spark):
    none = flagged(spark, [(0, 0.1)]).withColumn("is_anomaly", F.lit(0))
    events = incidents.finish_events(incidents.build_events(none))
    assert events.columns == incidents.EVENT_COLUMNS and events.count() == 0


def test_rank_all_counts_across_partitions(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "id").repartition(6)
    ranked = incidents.rank_all(df, [F.col("k"), F.desc("id")]).orderBy("rank").collect()
    want = sorted(((i % 10, -i) for i in range(1000)))
    assert [(r.k, -r.id) for r in ranked] == want
    assert [r["rank"] for r in ranked] == list(range(1, 1001))


def test_evaluation_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "is_anomaly int, is_injected_anomaly int")
    row = evaluation.evaluate_detector(df).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.precision, row.f1) == (1, 1, 1, 2, 0.5, 0.5)
    assert evaluation.evaluate(df.filter("is_anomaly = 0"), F.lit(False)).first().precision == 0.0
    assert evaluation.evaluate_detector(df.drop("is_injected_anomaly")) is None


def test_samples_reach_every_part_of_large_data(spark):
    """Far above any fixed pool: every hundredth of the rows is drawn about equally often."""
    rows = spark.range(200_000).select(
        F.format_string("s%02d", F.col("id") % 7).alias("server_id"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
        F.col("id").cast("double").alias("z_x"),
    )
    drawn = forest.draw_samples(rows, ["x"], trees=100, sample_rows=256)
    parts = drawn.groupBy(F.floor(F.col("z_x") / 2000).alias("part"), "tree").count().toPandas()
    per_part = parts.groupby("part")["count"].sum()
    assert per_part.sum() == 100 * 256 and len(per_part) == 100
    assert per_part.min() > 256 - 6 * 16 and per_part.max() < 256 + 6 * 16
    assert drawn.groupBy("tree", "z_x").count().filter("count > 1").count() == 0
    # About as many distinct rows as independent draws would give.
    assert drawn.select("z_x").distinct().count() > 0.97 * 200_000 * (1 - (1 - 256 / 200_000) ** 100)
    again = forest.draw_samples(rows.repartition(7), ["x"], trees=100, sample_rows=256)
    assert again.exceptAll(drawn).count() == 0


def test_nothing_to_score_gives_typed_empty_results(reading, tmp_path):
    blank = reading({"cpu_usage_percent": None}, {"cpu_usage_percent": None, "timestamp": minutes(5)})
    for rows in (blank, blank.limit(0)):
        done = detection.detect(stage(rows, "blank"), trees=5)
        assert done.events.count() == 0 and "severity" in done.events.columns
        assert {r.result for r in done.scored.select("result").collect()} <= {"UNSCORED"}


def test_later_readings_use_the_history_of_their_server(reading, tmp_path):
    rows = stage(fleet(reading, rows_per_server=700), "history")
    split = minutes(5 * 650)
    early, late = rows.filter(F.col("timestamp") < split), rows.filter(F.col("timestamp") >= split)
    detection.run_detection(stage(early, "early"), str(tmp_path / "out"), trees=20)
    columns = ["server_id", "timestamp", *scaling.SLOPE_FEATURES]
    got = detection.score_new(late, f"{tmp_path}/out/model", earlier=early)
    whole = scaling.build_features(rows).filter(F.col("timestamp") >= split)
    want = {tuple(r[:2]): tuple(round(x, 6) for x in r[2:]) for r in whole.select(*columns).collect()}
    assert {tuple(r[:2]): tuple(round(x, 6) for x in r[2:]) for r in got.select(*columns).collect()} == want
    assert got.count() == 100 and any(v[0] != 0 for v in want.values())
