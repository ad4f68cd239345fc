"""File lists, key filters, live Gold, stateful alerts, carried series, sketches."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import NOON, minutes
from fleetlake.operators import carried, forest, gold, incidents, profile, scaling, series, serving, silver, sketches
from fleetlake.plans import detection, live
from fleetlake.session import expire_scratch, scratch_dir, stage
from fleetlake.sources import filelist, readings, tables
from fleetlake.streaming import alerts, key_index, live_gold, streams
from test_streams import BRONZE, health, keyed


def as_of():
    return F.lit("2026-08-01").cast("timestamp")


# --- File lists


def ids(df):
    return sorted(r.id for r in df.collect())


def test_put_if_absent_writes_once(spark, tmp_path):
    path = f"{tmp_path}/pointer/part-000000000001.json"
    assert filelist.put_if_absent(spark, path, "one") and not filelist.put_if_absent(spark, path, "two")
    assert filelist.read_text(spark, path) == "one"
    assert [p.name for p in (tmp_path / "pointer").iterdir() if not p.name.startswith(".")] == ["part-000000000001.json"]


def test_two_interleaved_writers_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.publish(spark.range(1), root)
    seen = []

    def slow(known):
        seen.append(known.count())
        if len(seen) == 1:  # the other one comes in between
            tables.update_published(spark, root, lambda rows: rows.union(spark.range(10, 12)))
        return known.union(spark.range(20, 21))

    tables.update_published(spark, root, slow)
    assert seen == [1, 3] and ids(tables.read_published(spark, root)) == [0, 10, 11, 20]
    filelist.append(spark.range(30, 31), root)
    assert ids(filelist.read(spark, root)) == [0, 10, 11, 20, 30]
    # An earlier list still gives the earlier table.
    assert ids(filelist.read(spark, root, at=filelist.listing(spark, root, 1))) == [0]


def test_replacing_a_folder_twice_is_a_conflict(spark, tmp_path):
    root = str(tmp_path / "t")
    base = filelist.append(spark.range(3), root)
    filelist.replace(spark.range(4), root, list(base.folders))
    with pytest.raises(filelist.Conflict):
        filelist.replace(spark.range(5), root, list(base.folders))
    assert ids(filelist.read(spark, root)) == [0, 1, 2, 3]


def test_bins_hold_small_folders_of_one_part():
    def folder(part, size, files=1):
        return filelist.Folder(part, f"data/x/_part={part}-{size}", files, size)

    found = [folder("a", s) for s in (60, 50, 30, 20, 10, 500)] + [folder("b", 10), folder("c", 10, 4)]
    packed = filelist.bins(found, small=100, target=100)
    assert [[f.size for f in p] for p in packed] == [[60, 30, 10], [50, 20], [10]]
    assert all(sum(f.size for f in p) <= 100 for p in packed) and packed[-1][0].part == "c"


def test_compaction_keeps_rows_and_swaps_once(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(6):
        rows = spark.range(10 * i, 10 * i + 10).withColumn("day", F.concat(F.lit("d "), (F.col("id") % 2).cast("string")))
        filelist.append(rows, root, F.col("day"))
    before = filelist.listing(spark, root)
    want = keyed(filelist.read(spark, root), "id", "day")
    after = filelist.compact(spark, root)
    assert after.number == before.number + 1 and len(before.folders) == 12 and sum(f.files for f in after.folders) == 2
    assert keyed(filelist.read(spark, root), "id", "day") == want
    # A reader that began before reads what it began with.
    assert keyed(filelist.read(spark, root, at=before), "id", "day") == want
    assert filelist.compact(spark, root) == after
    part = before.folders[0].part
    assert filelist.read(spark, root, {part}).select("day").distinct().count() == 1


def test_expiry_keeps_what_recent_lists_name(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(5):
        tables.publish(spark.range(n + 1), root)
    filelist.write_folders(spark.range(3), root)  # of a writer that never came to its commit
    assert filelist.expire(spark, root, keep=2) == 0  # nothing is a day old
    assert filelist.expire(spark, root, keep=2, hours=-1) == 4
    assert ids(filelist.read(spark, root)) == [0, 1, 2, 3, 4]
    assert ids(filelist.read(spark, root, at=filelist.listing(spark, root, 4))) == [0, 1, 2, 3]
    tables.publish(spark.range(2), root)
    assert filelist.listing(spark, root).number == 6


def test_old_scratch_tables_go(spark):
    kept = stage(spark.range(5), "kept")
    assert expire_scratch(spark, 1) == 0 and kept.count() == 5


# --- Upserts by bucket


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    old = spark.range(200).select("id", F.lit(1).alias("v"))
    serving.upsert_buckets(old, root, ["id"], as_of(), last_by=[F.desc("v")])
    first = filelist.listing(spark, root)
    new = spark.createDataFrame([(5, 2), (5, 3), (999, 7)], "id long, v int")
    serving.upsert_buckets(new, root, ["id"], as_of(), last_by=[F.desc("v")])
    rows = {r.id: r.v for r in filelist.read(spark, root).collect()}
    assert len(rows) == 201 and rows[5] == 3 and rows[999] == 7 and rows[6] == 1
    kept = set(first.folders) & set(filelist.listing(spark, root).folders)
    assert len(first.folders) - len(kept) <= 2 and len(kept) > 50


def test_upsert_reads_old_rows_without_a_shuffle(spark, tmp_path):
    root = str(tmp_path / "t")
    serving.upsert_buckets(spark.range(500).select("id", F.lit(1).alias("v")), root, ["id"], as_of(), last_by=[F.desc("v")])
    latest = spark.createDataFrame([(5, 2, None)], "id long, v int, updated_at timestamp")
    latest.write.parquet(f"{tmp_path}/latest")
    latest = spark.read.parquet(f"{tmp_path}/latest")
    joined = filelist.read(spark, root).join(latest.select("id"), ["id"], "left_anti").unionByName(latest)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


# --- Key filters and streamed Silver


def test_filters_miss_no_key(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    built = key_index.filters(rows, ["g"])
    sizes = {r.g: (r.words, len(r.bits)) for r in built.collect()}
    assert sizes == {g: (256, 256) for g in range(3)}
    asked = rows.union(spark.range(3000, 33000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h")))
    hits = asked.join(built, "g").filter(key_index.may_hold(F.col("h"), F.col("words"), F.col("bits")))
    assert rows.join(hits.select("h").distinct(), "h").count() == 3000
    assert hits.count() < 3000 + 30000 / 200


def test_files_opened_stay_level_over_many_batches(spark, reading, tmp_path):
    base = str(tmp_path)
    for i in range(50):
        rows = [{"timestamp": minutes(5 * i), "server_id": f"server{s:02d}"} for s in range(3)]
        if i % 10 == 9:  # a copy of an old reading, and one from the year 2099
            rows += [{"timestamp": minutes(5 * (i - 7)), "server_id": "server01"}, {"timestamp": NOON + timedelta(days=27000 + i)}]
        silver_rows = reading(*rows).withColumns(
            {"_source_file": F.lit("f"), "_ingested_at": F.lit(NOON), "dt": F.to_date("timestamp")}
        )
        silver_rows.select(*BRONZE.fieldNames()).coalesce(1).write.mode("append").parquet(f"{base}/bronze")
    streams.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/c", BRONZE, as_of=as_of(), max_files=1
    ).awaitTermination()
    history = [filelist.listing(spark, f"{base}/silver", n).notes for n in range(1, 51)]
    opened = [h["opened"] for h in history]
    assert history[-1]["touched"] >= 40  # so many files hold readings of the same day
    assert max(opened) <= 2 and sum(opened[i] for i in range(50) if i % 10 != 9) <= 2
    assert [opened[i] for i in range(9, 50, 10)] == [1] * 5 or sum(opened) <= 8
    valid, rejects = streams.streamed_silver(spark, f"{base}/silver")
    want = silver.clean_and_validate(spark.read.schema(BRONZE).parquet(f"{base}/bronze"), as_of=as_of())
    assert keyed(valid, "server_id", "timestamp") == keyed(want[0], "server_id", "timestamp") and valid.count() == 150
    assert keyed(rejects, "timestamp", "_reject_reason") == keyed(want[1], "timestamp", "_reject_reason")
    odd = {f.part for f in filelist.listing(spark, f"{base}/silver").folders if f.part.startswith("odd-")}
    assert len(odd) > 1
    # After compaction there is a file or so per part, and copies are still known.
    now = streams.compact_silver(spark, f"{base}/silver")
    assert len([f for f in now.folders if not f.part.startswith("odd-")]) <= 2
    streams.stream_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/c2", BRONZE, as_of=as_of()).awaitTermination()
    assert streams.streamed_silver(spark, f"{base}/silver")[0].count() == 150


def test_a_committed_batch_is_not_stored_again(spark, reading, tmp_path):
    base, calls = str(tmp_path), []
    readings.land(reading({}, {"timestamp": minutes(5)}), f"{base}/landing")
    streams.stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1").awaitTermination()

    def each(session, rows, key):
        calls.append((rows.count(), key[1]))
        if len(calls) == 1:
            raise RuntimeError("lost between the commit and the end of the batch")

    for _ in range(2):
        try:
            streams.stream_silver(
                spark, f"{base}/bronze", f"{base}/silver", f"{base}/c2", BRONZE, as_of=as_of(), each=each
            ).awaitTermination()
        except Exception as error:
            assert "lost between" in str(error)
    assert calls == [(2, 0), (2, 0)]
    assert streams.streamed_silver(spark, f"{base}/silver")[0].count() == 2
    assert filelist.listing(spark, f"{base}/silver").number == 1


# --- Live Gold


def test_live_gold_equals_batch_and_reads_touched_days_only(spark, reading, tmp_path):
    base = str(tmp_path)

    def each(session, rows, key):
        live_gold.add_batch(session, f"{base}/gold", rows, key)

    arrivals = [
        [{"timestamp": minutes(-1440 * d + 7 * i), "cpu_usage_percent": 10.0 * i + d, "hostname": f"h{d % 2}"} for d in range(4) for i in range(5)],
        [{"timestamp": minutes(-1440 + 500), "disk_usage_percent": 99.0, "status": "CRITICAL"}, {"timestamp": minutes(5), "server_id": "server02"}],
        [{"timestamp": minutes(9), "cpu_usage_percent": 140.0}, {"timestamp": minutes(11), "application_error_count": 7}],
    ]
    for rows in arrivals:
        readings.land(reading(*rows), f"{base}/landing")
        streams.stream_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1").awaitTermination()
        streams.stream_silver(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/c2", BRONZE, as_of=as_of(), each=each
        ).awaitTermination()
    bronze = spark.read.schema(BRONZE).parquet(f"{base}/bronze")
    valid = silver.clean_and_validate(bronze, as_of=as_of())[0].withColumn("dt", F.to_date("timestamp"))
    daily = gold.build_daily_metrics(valid)
    assert keyed(live_gold.live_daily(spark, f"{base}/gold"), *daily.columns) == keyed(daily, *daily.columns)
    summary = gold.build_server_summary(valid)
    live = live_gold.live_summary(spark, f"{base}/gold", f"{base}/silver")
    assert sorted(live.columns) == sorted(summary.columns)
    assert keyed(live, *summary.columns) == keyed(summary, *summary.columns)
    history = [filelist.listing(spark, f"{base}/gold/states", n).notes for n in range(1, 4)]
    assert [len(h["days"]) for h in history] == [4, 2, 1] and [h["read"] for h in history] == [0, 2, 1]
    # The same batch again changes nothing.
    key = (list(history[-1]["done"])[0], 2)
    last = filelist.listing(spark, f"{base}/silver")
    rows = filelist.read_folders(spark, f"{base}/silver", [filelist.Folder(*f) for f in last.notes["last"]], last.schema)
    live_gold.add_batch(spark, f"{base}/gold", rows, key)
    assert keyed(live_gold.live_daily(spark, f"{base}/gold"), *daily.columns) == keyed(daily, *daily.columns)


# --- Alerts


def test_alert_stream_equals_the_steps_however_files_are_cut(spark, tmp_path):
    base = str(tmp_path)
    rounds = [
        {"a": 50.0, "b": 70.0, "c": 99.0},
        {"a": 50.0, "b": 90.0, "c": 80.0},
        {"a": 70.0},
        {"a": None, "c": 80.0},
        {"a": 40.0, "b": 10.0, "c": 99.0},
    ]
    empty = spark.createDataFrame(
        [], "server_id string, metric string, severity string, triggered_at timestamp, resolved boolean, resolved_at timestamp"
    )
    want = empty
    for day, scores in enumerate(rounds, 1):
        now = F.lit(NOON + timedelta(days=day))
        snapshot = health(spark, **scores)
        # A healthy row of a renamed host beside each bad one, in another file of the snapshot.
        both = snapshot.union(snapshot.filter("health_score < 60").withColumn("health_score", F.lit(100.0)))
        want = stage(streams.step_alerts(want, both, now), "alerts")
        for part in (snapshot, both.exceptAll(snapshot)):
            part.withColumn("observed_at", now).coalesce(1).write.mode("append").parquet(f"{base}/s")
        if day in (2, 5):
            schema = spark.read.parquet(f"{base}/s").schema
            if day == 5:
                late = spark.createDataFrame([(None, None)], "server_id string, health_score double")
                late.withColumn("observed_at", F.lit(NOON + timedelta(days=9))).write.mode("append").parquet(f"{base}/s")
            alerts.stream_alerts(spark, f"{base}/s", schema, f"{base}/log", f"{base}/c", max_files=1).awaitTermination()
    got = alerts.streamed_alerts(spark, f"{base}/log")
    assert keyed(got, *streams.ALERT_COLUMNS) == keyed(want, *streams.ALERT_COLUMNS)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "unset") != alerts.STATE_STORE


# --- Carried series


@pytest.fixture
def long_series(spark):
    ts = (F.lit(NOON) + F.make_dt_interval(mins=(F.col("id") * 5 + F.when(F.col("id") % 97 == 0, 2).otherwise(0)).cast("int")))
    y = F.when(F.col("id") % 41 == 7, None).otherwise((F.col("id") * 37 % 101) / 3.0 + F.col("id") * 0.01)
    rows = spark.range(0, 1500).select(
        F.col("id").alias("event_id"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("server_id"), ts.alias("timestamp"), y.alias("y")
    )
    # One server with few rows, one that begins late, one without a name.
    return rows.filter("server_id <> 's2' or event_id < 200 or event_id > 1200").withColumn(
        "server_id", F.when((F.col("event_id") % 100 == 1), None).otherwise(F.col("server_id"))
    )


def cut(rows, *at):
    bounds = [None, *at, None]
    for lo, hi in zip(bounds, bounds[1:]):
        part = rows if lo is None else rows.filter(F.col("event_id") >= lo)
        yield part if hi is None else part.filter(F.col("event_id") < hi)


def test_continued_slopes_equal_those_of_the_whole(spark, long_series):
    columns = {"slope": "y"}
    want = series.rolling_slopes(long_series, columns, 50)
    state, got = None, []
    for part in cut(long_series, 30, 400, 1000):
        got += carried.continued_slopes(state, part, columns, 50).collect()
        state = carried.next_slope_state(state, part, columns, 50)
    assert state.groupBy("server_id").count().agg(F.max("count")).first()[0] == 49

    def told(rows):
        return sorted((r.event_id, None if r.slope is None else round(r.slope, 6)) for r in rows)

    assert told(got) == told(want.collect())
    assert carried.late_readings(long_series, state).count() == long_series.count()


def test_continued_sessions_equal_those_of_the_whole(long_series):
    gap = 15 * 60 * 10**6
    want = keyed(series.sessionise(long_series, gap), "event_id", "session")
    state, got = None, []
    for part in cut(long_series, 30, 400, 401, 1000):
        numbered, state = carried.continued_sessions(state, part, gap)
        got += keyed(numbered, "event_id", "session")
    assert sorted(got) == want


def test_continued_incidents_equal_those_of_one_run(spark):
    from test_detection import flagged

    spots = [(0, 0.1), (20, 0.5), (45, 0.4), (100, 0.9), (129, 0.3), (160, 0.2), (400, 0.7)]
    whole = flagged(spark, spots)
    want = incidents.build_events(whole)
    for ends in ([30], [50, 130], [10, 45, 46, 200]):
        spans, got = None, []
        bounds = [-1, *ends, 10**6]
        for lo, hi in zip(bounds, bounds[1:]):
            part = whole.filter((F.col("timestamp") >= F.lit(minutes(lo))) & (F.col("timestamp") < F.lit(minutes(hi))))
            done, spans = carried.continued_incidents(spans, part, F.lit(minutes(hi)) if hi < 10**6 else None)
            got += keyed(done, *want.columns)
        assert sorted(got) == keyed(want, *want.columns)


def test_later_scores_in_runs_equal_those_of_one(spark, reading, tmp_path):
    base = str(tmp_path)
    wave = [{"timestamp": minutes(5 * i), "cpu_usage_percent": 20.0 + i * 7 % 11, "response_time_ms": 100.0 + i * 13 % 17} for i in range(400)]
    odd = [{**r, "response_time_ms": 4000.0} if i in (310, 311, 350, 399) else r for i, r in enumerate(wave)]
    rows = reading(*odd)
    first = rows.filter(F.col("timestamp") < F.lit(minutes(1500)))
    z, scalers = detection.scale(first)
    sketched = {(r.server_id, r.feature): r for r in detection.scale(first, exact=False)[1].collect()}
    for r in scalers.collect():  # fewer values than a sketch keeps: off by one value at most
        assert abs(sketched[(r.server_id, r.feature)].median - r.median) <= abs(r.scale) + 1e-9
    forest.save_model(scalers, forest.fit_forest(z, trees=40), f"{base}/model", cut=0.6)
    want = detection.score_new(rows, f"{base}/model")
    for upto in (1000, 1555, 1560, 2000):
        part = rows.filter(F.col("timestamp") < F.lit(minutes(upto)))
        for _ in range(2):  # the second run finds nothing new
            live.score_later(spark, part, f"{base}/model", f"{base}/out")
    got = filelist.read(spark, f"{base}/out/scores")
    columns = ["server_id", "timestamp", "is_anomaly"]
    assert keyed(got, *columns) == keyed(want, *columns)
    whole = incidents.build_events(want)
    closed = filelist.read(spark, f"{base}/out/incidents")
    still_open = incidents.described(filelist.read(spark, f"{base}/out/open"))
    assert keyed(closed.unionByName(still_open), "timestamp", "readings") == keyed(whole, "timestamp", "readings")
    assert whole.count() >= 2 and still_open.count() == 1


def test_split_tables_are_written_once_and_always(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2026-01-01", "valid"), (2, "2026-01-02", "valid")], "id long, dt string, outcome string")
    paths = {"valid": f"{tmp_path}/silver", "rejected": f"{tmp_path}/rejects"}
    for _ in range(2):
        tables.write_split(rows, "outcome", paths, ["dt"])
        assert ids(spark.read.parquet(paths["valid"])) == [1, 2] and spark.read.parquet(paths["rejected"]).count() == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["rejects", "silver"]


# --- Interval join and sketches


def test_slices_around_incidents_equal_between(spark, long_series):
    spans = long_series.filter("event_id % 300 = 5").select(
        F.col("event_id").alias("n"), "server_id", F.col("timestamp").alias("lo"), (F.col("timestamp") + F.expr("interval 200 minutes")).alias("hi")
    )
    got = profile.around_each(long_series, spans, "lo", "hi", ["n"], 45, by=["server_id"])
    named = spans.withColumnRenamed("server_id", "s")
    margin = F.expr("interval 45 minutes")
    want = long_series.join(named, (F.col("server_id") == F.col("s")) & F.col("timestamp").between(F.col("lo") - margin, F.col("hi") + margin))
    assert keyed(got, "incident_n", "event_id") == keyed(want, "n", "event_id") and got.count() > 30
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    everyone = profile.around_each(long_series, spans, "lo", "hi", ["n"], 45)
    assert everyone.count() > got.count()


def test_sketched_scalers_are_within_the_stated_error(spark):
    h = F.xxhash64("id")
    wide = spark.range(60_000).select(
        F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("string")).alias("server_id"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("dt"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.pmod(h, F.lit(100_003)) / 7.0).alias("a"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.pmod(h, F.lit(9)) * 1.0).alias("b"),
        F.lit(3.0).alias("c"),
    )
    features = ["a", "b", "c"]
    days = sketches.day_sketches(wide, features)
    got = sketches.scalers_from_sketches(days).cache()
    exact = {(r.server_id, r.feature): r for r in scaling.fit_scalers(wide, features).collect()}
    errors = sketches.rank_errors(wide, got, features).collect()
    assert len(errors) == len(exact) == got.count()
    for r in errors:
        assert r.median_error <= sketches.RANK_ERROR and r.mad_error <= sketches.RANK_ERROR
    for r in got.collect():
        want = exact[(r.server_id, r.feature)]
        if r.feature == "c":  # no spread: the floor of the standard deviation
            assert (r.median, r.scale) == (want.median, pytest.approx(want.scale, abs=1e-8))
        elif r.feature == "a":
            assert r.scale == pytest.approx(want.scale, rel=0.1)


def test_key_filters_are_built_in_one_shuffle(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    plan = key_index.filters(rows, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_batch_is_not_cached(spark, reading, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def persist(self, *args):
        raise AssertionError("a cached batch keeps a partition for every shuffle partition")

    monkeypatch.setattr(DataFrame, "persist", persist)
    reading({"timestamp": NOON}).withColumns(
        {"dt": F.to_date("timestamp"), "_source_file": F.lit("f"), "_ingested_at": F.current_timestamp()}
    ).select(*BRONZE.names).write.parquet(str(tmp_path / "bronze"))
    streams.stream_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ckpt"), BRONZE).awaitTermination()
    assert sum(t.count() for t in streams.streamed_silver(spark, str(tmp_path / "silver"))) == 1


def test_filter_bits_are_those_that_the_probes_look_at(spark, monkeypatch):
    import pyarrow as pa

    rows = spark.range(400).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    want = {}
    for r in rows.collect():
        h, bits = r.h % 2**64, want.setdefault(r.g, [0] * 64)
        for probe in range(key_index.PROBES):
            place = ((h & 0xFFFFFFFF) + (h >> 32 | 1) * probe) % (64 * 64)
            bits[place // 64] |= 1 << place % 64
    signed = {g: [w - 2**64 if w >= 2**63 else w for w in bits] for g, bits in want.items()}
    built = key_index.filters(rows, ["g"])
    assert {r.g: r.bits for r in built.collect()} == signed
    assert "Generate" not in built._jdf.queryExecution().executedPlan().toString()  # a key makes no rows of its own
    # Filters that are made a few at a time, or of a cut of an array, are the same.
    lists = [[r.h for r in rows.collect() if r.g == g] for g in range(3)]
    monkeypatch.setattr(key_index, "SLICE_KEYS", 150)
    found = key_index._filter_bits.func(pa.array([[7], *lists], pa.list_(pa.int64())).slice(1), pa.array([1, 64, 64, 64]).slice(1))
    assert found.to_pylist() == [signed[g] for g in range(3)]
    assert key_index._filter_bits.func(pa.array([], pa.list_(pa.int64())), pa.array([], pa.int64())).to_pylist() == []


def _bronze_of(reading, base: str, *rows: dict) -> None:
    made = reading(*rows).withColumns({"_source_file": F.lit("f"), "_ingested_at": F.lit(NOON), "dt": F.to_date("timestamp")})
    made.select(*BRONZE.names).coalesce(1).write.mode("append").parquet(f"{base}/bronze")


def _writes(spark, root: str) -> set[str]:
    return {f.path.split("/")[1] for f in filelist.listing(spark, root).folders}


def _staged(spark) -> set[str]:
    from pathlib import Path

    folder = Path(scratch_dir(spark).removeprefix("file://")) / "fleetlake"
    return {p.name for p in folder.glob("batch*")}


def test_a_batch_is_written_once_and_only_days_with_known_keys_again(spark, reading, tmp_path):
    base, before = str(tmp_path), _staged(spark)
    day = timedelta(days=1)
    batches = [
        [{"timestamp": NOON}, {"timestamp": NOON - day}],
        [{"timestamp": NOON}, {"timestamp": NOON + timedelta(minutes=5)}, {"timestamp": NOON - 2 * day}],
    ]
    writes = []
    for rows in batches:
        _bronze_of(reading, base, *rows)
        streams.stream_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/c", BRONZE, as_of=as_of()).awaitTermination()
        writes.append(_writes(spark, f"{base}/silver"))
    assert _staged(spark) == before
    good, bad = streams.streamed_silver(spark, f"{base}/silver")
    assert sorted(r.timestamp for r in good.select("timestamp").collect()) == sorted(
        t.replace(tzinfo=None) for t in (NOON, NOON - day, NOON + timedelta(minutes=5), NOON - 2 * day)
    )
    assert bad.count() == 0
    # The second batch wrote its days, and the day of the copy again; both writes are live, with their filters.
    assert len(writes[0]) == 1 and len(writes[1] - writes[0]) == 2
    last = [filelist.Folder(*f) for f in filelist.listing(spark, f"{base}/silver").notes["last"]]
    assert len(last) == 2 and all((tmp_path / "silver" / key_index.index_path(f)).is_dir() for f in last)


def test_states_of_new_days_are_not_merged_again(spark, reading, tmp_path):
    root, before = str(tmp_path / "gold"), _staged(spark)
    day = timedelta(days=1)
    reject = F.lit(None).cast("string")
    for n, times in enumerate([[NOON, NOON - day], [NOON + timedelta(minutes=5), NOON + day]]):
        rows = reading(*[{"timestamp": t} for t in times]).withColumn("_reject_reason", reject)
        live_gold.add_batch(spark, root, rows, ("q", n))
    assert _staged(spark) == before
    states = filelist.read(spark, f"{root}/states")
    assert sorted((str(r.dt), r.total_readings) for r in states.collect()) == [
        (str((NOON + k * day).date()), n) for k, n in ((-1, 1), (0, 2), (1, 1))
    ]
    # The first batch is one write, the second one too but for the day that both have.
    assert len(_writes(spark, f"{root}/states")) == 3
    assert live_gold.live_daily(spark, root).count() == 3
