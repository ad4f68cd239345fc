"""Run the plans from the command line.

    python -m fleetlake land    raw.csv LANDING
    python -m fleetlake batch   LANDING LAKE --servers PATH   Bronze, Silver, Gold and serving tables
    python -m fleetlake detect  LAKE                 scores, incidents and model
    python -m fleetlake analyse LAKE                 answers to the operational questions, a table each
    python -m fleetlake stream  LANDING LAKE         Bronze, Silver, Gold and alerts, incrementally
    python -m fleetlake score   LAKE                 scores and incidents of streamed readings, by the model of ``detect``
    python -m fleetlake compact LAKE                 rewrite the small files of streamed Silver
    python -m fleetlake expire  LAKE                 delete staged tables and old versions older than two days
    python -m fleetlake report  LAKE                 counts, worst servers, open alerts
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fleetlake.operators import quality, serving
from fleetlake.plans.analysis import run_analysis
from fleetlake.plans.detection import run_detection
from fleetlake.plans.live import run_live, score_later, watch
from fleetlake.plans.medallion import Lake, run_medallion
from fleetlake.session import build_session, expire_scratch
from fleetlake.sources import filelist
from fleetlake.sources.readings import land, read_csv_readings
from fleetlake.sources.tables import read_published
from fleetlake.streaming.streams import compact_silver, streamed_silver

EXPIRE_HOURS = 48
# Tables of a lake that are numbered lists of folders.
LISTED = [
    "servers", "server_health_summary", "alerts", "ml/anomalies", "stream/silver", "stream/gold/states", "stream/gold/daily",
    "stream/ml/scores", "stream/ml/incidents", "stream/ml/open", "stream/ml/recent",
]


def report(spark: SparkSession, lake: Lake) -> None:
    """The few small tables an operator looks at first."""
    quality.reject_breakdown(lake.read(spark, "telemetry_rejects")).show(truncate=False)
    serving.top_by_anomalies(lake.read(spark, "gold_server_summary")).show(truncate=False)
    alerts = read_published(spark, lake.path("alerts"))
    if alerts is not None:
        serving.unresolved(alerts).orderBy("severity", "server_id").show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fleetlake", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    for name, places in {
        "land": ["csv", "landing"],
        "batch": ["landing", "lake"],
        "detect": ["lake"],
        "analyse": ["lake"],
        "stream": ["landing", "lake"],
        "score": ["lake"],
        "compact": ["lake"],
        "expire": ["lake"],
        "report": ["lake"],
    }.items():
        command = commands.add_parser(name)
        for place in places:
            command.add_argument(place)
        if "lake" in places:
            command.add_argument("--format", default="parquet")
            command.add_argument("--schema", help="keep the tables in this catalog schema")
        if name == "batch":
            command.add_argument(
                "--servers", required=True,
                help="Parquet table: server_id, ip_address, environment, operating_system, application",
            )
    args = parser.parse_args(argv)

    spark = build_session(f"fleetlake-{args.command}")
    lake = Lake(args.lake, args.format, args.schema) if hasattr(args, "lake") else None
    if args.command == "land":
        land(read_csv_readings(spark, args.csv), args.landing)
    elif args.command == "batch":
        run_medallion(spark, args.landing, lake, spark.read.parquet(args.servers))
    elif args.command == "detect":
        run_detection(lake.read(spark, "silver"), lake.path("ml"))
    elif args.command == "analyse":
        run_analysis(lake.read(spark, "silver"), lake.path("analysis"))
    elif args.command == "stream":
        run_live(spark, args.landing, lake.path("stream"))
        watch(spark, lake.path("stream"))
    elif args.command == "score":
        valid, _ = streamed_silver(spark, lake.path("stream/silver"))
        score_later(spark, valid, lake.path("ml/model"), lake.path("stream/ml"))
    elif args.command == "compact":
        compact_silver(spark, lake.path("stream/silver"))
    elif args.command == "expire":
        expire_scratch(spark, EXPIRE_HOURS)
        for table in LISTED:
            filelist.expire(spark, lake.path(table), hours=EXPIRE_HOURS)
    else:
        report(spark, lake)


if __name__ == "__main__":
    main()
