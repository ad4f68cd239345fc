from conftest import fleet
from fleetlake import __main__ as cli
from fleetlake.plans import analysis
from fleetlake.plans.medallion import Lake, run_medallion
from fleetlake.sources import filelist, readings, tables
from fleetlake.streaming import live_gold, streams


def test_from_csv_to_report(spark, tmp_path, capsys):
    header = ",".join(f.name for f in readings.READING.fields)
    lines = [
        f"2024-01-01 00:{m:02d}:00+00:00,server01,web-app-01,{10 + m},45,50,1,1,1000,1000,0,100,0,OK" for m in range(8)
    ]
    (tmp_path / "raw.csv").write_text("\n".join([header, *lines, lines[0].replace(",10,", ",140,").replace("00:00:00", "01:00:00")]))
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    cli.main(["land", str(tmp_path / "raw.csv"), landing])
    fleet(spark, 1).write.parquet(str(tmp_path / "servers"))
    cli.main(["batch", landing, lake, "--servers", str(tmp_path / "servers")])
    cli.main(["detect", lake])
    cli.main(["analyse", lake])
    cli.main(["stream", landing, lake])
    cli.main(["report", lake])
    assert "cpu_out_of_range" in capsys.readouterr().out
    assert tables.read_table(spark, f"{lake}/silver").count() == 8
    assert tables.read_table(spark, f"{lake}/report/orphans").count() == 0
    assert analysis.answer(spark, f"{lake}/analysis", "cpu_by_server").first().peak_cpu == 17.0
    assert {p.name for p in (tmp_path / "lake" / "analysis").iterdir()} == {*analysis.QUESTIONS, *analysis.NEEDS_TRUTH}
    assert tables.read_table(spark, f"{lake}/ml/anomaly_results").count() == 8
    assert streams.streamed_silver(spark, f"{lake}/stream/silver")[0].count() == 8
    assert live_gold.live_daily(spark, f"{lake}/stream/gold").first().peak_cpu_percent == 17.0
    cli.main(["score", lake])
    cli.main(["score", lake])
    cli.main(["compact", lake])
    cli.main(["expire", lake])
    assert filelist.read(spark, f"{lake}/stream/ml/scores").count() == 8
    assert streams.streamed_silver(spark, f"{lake}/stream/silver")[0].count() == 8


def test_lake_in_a_catalog_schema(spark, reading, tmp_path):
    spark.sql("create schema if not exists fleet")
    lake = Lake(str(tmp_path / "lake"), schema="fleet")
    readings.land(reading({"timestamp": None}, {}), str(tmp_path / "landing"))
    run_medallion(spark, str(tmp_path / "landing"), lake, fleet(spark, 1, 2))
    assert spark.table("fleet.bronze").count() == 2
    assert spark.table("fleet.telemetry_rejects").count() >= 1
    spark.sql("drop schema fleet cascade")
