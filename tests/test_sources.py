from datetime import date

import pytest
from pyspark.sql import functions as F

from fleetlake.plans.medallion import Lake, run_medallion
from fleetlake.session import scratch_dir, scratch_path
from fleetlake.sources import readings, tables
from fleetlake.streaming import streams
from conftest import fleet, minutes


def test_csv_with_and_without_offset_is_utc(spark, tmp_path):
    path = tmp_path / "raw.csv"
    header = ",".join(f.name for f in readings.READING.fields)
    rest = "server01,web-app-01,1,2,3,4,5,6,7,8,9,0,OK"
    path.write_text(f"{header}\n2026-07-15 12:00:00+00:00,{rest}\n2026-07-15 12:00:00,{rest}\n")
    rows = readings.read_csv_readings(spark, str(path)).select(F.unix_micros("timestamp")).collect()
    assert {r[0] for r in rows} == {1784116800 * 10**6}


def test_utc_day_of_text_with_offset(spark):
    df = spark.createDataFrame([("2026-07-15T23:30:00-04:00",), ("nonsense",)], "timestamp string")
    days = [r.dt for r in readings.with_utc_day(df).collect()]
    assert days == [date(2026, 7, 16), None]


def test_landing_appends_and_never_overwrites(spark, reading, tmp_path):
    root = str(tmp_path / "landing")
    readings.land(reading({}, {"server_id": "server02"}), root)
    readings.land(reading({"timestamp": minutes(5)}), root)
    scan = readings.scan_landing(spark, root)
    assert scan.count() == 3
    assert {(r.server_id, r.dt) for r in scan.collect()} == {
        ("server01", date(2026, 7, 15)),
        ("server02", date(2026, 7, 15)),
    }
    files = spark.read.parquet(f"{root}/server_id=server01/dt=2026-07-15")
    assert "server_id" not in files.columns and "dt" not in files.columns


def test_one_day_and_server_is_pruned_to(spark, reading, tmp_path):
    root = str(tmp_path / "landing")
    readings.land(reading({}, {"timestamp": minutes(1440)}, {"server_id": "server02"}), root)
    day = readings.scan_landing(spark, root).filter("dt = date'2026-07-15' and server_id = 'server01'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and day.count() == 1


def test_thin_servers_share_a_folder_and_come_back(spark, reading, tmp_path):
    """Folders follow readings and days, not servers times days; odd ids and both ways of reading are whole."""
    root, base = str(tmp_path / "landing"), str(tmp_path)
    odd = [None, "", "  SERVER07 ", "__shared__", "__HIVE_DEFAULT_PARTITION__", "a=b/c"]
    many = [{"server_id": f"server{i:03d}", "timestamp": minutes(1440 * (i % 2))} for i in range(40)]
    thick = [{"server_id": "busy", "timestamp": minutes(i)} for i in range(5)]
    rows = reading(*many, *thick, *[{"server_id": s} for s in odd])
    readings.land(rows, root, max_folders=10, own_rows=5)
    folders = {tuple(p.parts[-3:-1]) for p in (tmp_path / "landing").rglob("*.parquet")}
    shared = "server_id=__shared__"
    assert folders == {("server_id=busy", "dt=2026-07-15"), (shared, "dt=2026-07-15"), (shared, "dt=2026-07-16")}
    # A small landing beside it keeps a folder for each pair, but for ids that a path would not give back.
    readings.land(reading({"server_id": "server000"}, {"server_id": ""}), root)
    want = sorted([*[str(r.server_id) for r in rows.collect()], "server000", ""])
    scan = readings.scan_landing(spark, root)
    assert scan.columns == readings.LANDED.names
    assert sorted(str(r.server_id) for r in scan.collect()) == want
    assert readings.scan_landing(spark, root, servers=["server000", "busy"]).count() == 7
    assert scan.filter("server_id = 'server000'").count() == 2
    streams.stream_bronze(spark, root, f"{base}/bronze", f"{base}/ckpt").awaitTermination()
    bronze = spark.read.parquet(f"{base}/bronze")
    assert sorted(str(r.server_id) for r in bronze.collect()) == want
    assert "_landed_id" not in bronze.columns and bronze.filter("_source_file like '%/dt=%'").count() == len(want)


def test_bronze_lineage(spark, reading, tmp_path):
    root = str(tmp_path / "landing")
    readings.land(reading({}), root)
    row = readings.build_bronze(readings.scan_landing(spark, root)).first()
    assert "/server_id=server01/dt=2026-07-15/" in row._source_file
    assert row._ingested_at is not None


def test_managed_table_replaces_schema(spark, reading):
    tables.save_managed(reading({}), "readings_m", ["server_id"])
    tables.save_managed(reading({}).select("server_id", F.lit(1).alias("n")), "readings_m")
    assert tables.read_table(spark, "readings_m").columns == ["server_id", "n"]
    spark.sql("drop table readings_m")


def test_published_table_can_be_rebuilt_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.read_published(spark, root) is None
    tables.publish(spark.range(3), root)
    tables.publish(tables.read_published(spark, root).filter("id > 0"), root)
    assert sorted(r.id for r in tables.read_published(spark, root).collect()) == [1, 2]


def test_conform_reports_what_does_not_fit(spark):
    df = spark.createDataFrame([("a", 5.456), ("b", 12345.0)], "server_id string, x double")
    types = {"server_id": "string", "x": "decimal(5,2)"}
    assert {r.server_id: r.x and str(r.x) for r in tables.conform(df, types).collect()} == {"a": "5.46", "b": None}
    lost = {r.column_name: r.lost_values for r in tables.overflow_report(df, types).collect()}
    assert lost == {"server_id": 0, "x": 1}


def test_scratch_is_the_sessions_shared_folder(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_medallion_end_to_end_and_again(spark, reading, tmp_path):
    root, lake = str(tmp_path / "landing"), Lake(str(tmp_path / "lake"))
    as_of = F.lit("2026-08-01").cast("timestamp")
    rows = [{"timestamp": minutes(5 * i), "server_id": s} for i in range(6) for s in ("server01", "SERVER02 ")]
    readings.land(reading(*rows, {"server_id": "server03", "cpu_usage_percent": 140.0}), root)
    for _ in range(2):
        run_medallion(spark, root, lake, fleet(spark, 1, 2), as_of)
    assert tables.read_table(spark, lake.path("silver")).count() == 12
    assert tables.read_table(spark, lake.path("telemetry_rejects")).count() == 1
    assert tables.read_table(spark, lake.path("gold_daily_metrics")).count() == 2
    known = tables.read_published(spark, lake.path("servers")).collect()
    assert {(r.server_id, r.ip_address) for r in known} == {("server01", "10.9.0.1"), ("server02", "10.9.0.2")}
    health = tables.read_published(spark, lake.path("server_health_summary"))
    assert dict(health.dtypes)["avg_cpu_percent"] == "decimal(5,2)" and health.count() == 2
    assert tables.read_published(spark, lake.path("alerts")).count() == 0


@pytest.mark.parametrize("mode, truncate", [("overwrite", True), ("append", False)])
def test_jdbc_writer_options(spark, monkeypatch, mode, truncate):
    seen = {}
    writer = type(spark.range(1).write)

    def jdbc(self, url, table, mode, properties):
        seen.update(url=url, table=table, mode=mode)

    def option(self, key, value):
        seen[key] = value
        return self

    monkeypatch.setattr(writer, "jdbc", jdbc)
    monkeypatch.setattr(writer, "option", option)
    tables.write_jdbc(spark.range(1), "jdbc:x", "alerts", mode)
    assert seen == {"url": "jdbc:x", "table": "alerts", "mode": mode, "truncate": truncate}


def test_csv_columns_go_by_name(spark, tmp_path):
    names = [f.name for f in readings.READING.fields]
    shuffled = [n for n in names if n != "hostname"] + ["extra", "hostname"]
    values = {n: "1" for n in shuffled} | {"timestamp": "2024-01-01T00:00:00.5Z", "cpu_usage_percent": "11", "memory_usage_percent": "22", "hostname": "h", "disk_io_read": "much"}
    (tmp_path / "a.csv").write_text("\n".join([",".join(shuffled), ",".join(values[n] for n in shuffled)]))
    row = readings.read_csv_readings(spark, str(tmp_path / "a.csv")).first()
    assert (row.hostname, row.cpu_usage_percent, row.memory_usage_percent, row.disk_io_read) == ("h", 11.0, 22.0, None)
    (tmp_path / "b.csv").write_text(",".join(n for n in names if n != "hostname") + "\n")
    with pytest.raises(ValueError, match="hostname"):
        readings.read_csv_readings(spark, str(tmp_path / "b.csv"))


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_dedup_keeps_every_event_at_every_scale(spark, scale):
    from fleetlake.operators import silver
    from fleetlake.sources.events_readings import readings_from_events

    events = spark.read.parquet(f"/root/testdata/{scale}/events.parquet")
    raw = readings_from_events(spark, f"/root/testdata/{scale}")
    keys = silver.standardise(raw).select("server_id", "timestamp", "event_id")
    kept = silver.dedup(keys, order_by=[F.col("event_id")]).count()
    # Copies go; events of one instant and one of the ten shared servers are rare.
    assert raw.count() > events.count() >= kept >= 0.99 * events.count()


def test_a_damaged_table_is_not_taken_for_a_missing_one(spark, tmp_path):
    df = spark.range(3)
    assert tables.read_published(spark, str(tmp_path / "t")) is None
    for n in (3, 2):
        tables.publish(df.limit(n), str(tmp_path / "t"))
    assert tables.read_published(spark, str(tmp_path / "t")).count() == 2
    for f in (tmp_path / "t" / "pointer").glob("part-*"):
        f.write_bytes(b"damaged")
    for f in (tmp_path / "t" / "pointer").glob(".*.crc"):
        f.unlink()
    with pytest.raises(Exception):
        tables.read_published(spark, str(tmp_path / "t"))


def test_serving_has_one_row_for_a_renamed_host(spark, reading, tmp_path):
    root, lake = str(tmp_path / "landing"), Lake(str(tmp_path / "lake"))
    rows = [{"timestamp": minutes(5 * i), "hostname": "old" if i < 4 else "new", "cpu_usage_percent": 10.0 * i} for i in range(6)]
    readings.land(reading(*rows), root)
    run_medallion(spark, root, lake, fleet(spark, 1), F.lit("2026-08-01").cast("timestamp"))
    row = tables.read_published(spark, lake.path("server_health_summary")).collect()
    assert len(row) == 1 and float(row[0].avg_cpu_percent) == 25.0


def test_many_folders_are_listed_by_few_tasks(spark, reading, tmp_path, monkeypatch):
    from fleetlake import session

    root = str(tmp_path / "landing")
    readings.land(reading(*[{"timestamp": minutes(1440 * i), "hostname": f"h{i}"} for i in range(40)]), root)
    monkeypatch.setattr(session, "LISTING_TASKS", 3)
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    try:
        scan = readings.scan_landing(spark, root)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages) == 3
    assert scan.count() == 40


def test_arrivals_need_no_shuffle_and_lose_nothing(spark):
    from fleetlake.plans import catalog

    sf = "/root/testdata/sf0.01"
    parts = catalog._in_three_arrivals(spark, sf)
    assert not any("Exchange" in p._jdf.queryExecution().executedPlan().toString() for p in parts)
    whole = catalog.readings(spark, sf)
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert all(p.limit(1).count() for p in parts)
    assert together.count() == whole.count() and together.exceptAll(whole).isEmpty()
