import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T

from fleetlake.session import build_session
from fleetlake.sources.readings import READING

NOON = datetime(2026, 7, 15, 12, 0, tzinfo=timezone.utc)

BASE = {
    "timestamp": NOON,
    "server_id": "server01",
    "hostname": "web-app-01",
    "cpu_usage_percent": 40.0,
    "memory_usage_percent": 50.0,
    "disk_usage_percent": 60.0,
    "disk_io_read": 100.0,
    "disk_io_write": 80.0,
    "network_rx_bytes": 500_000.0,
    "network_tx_bytes": 300_000.0,
    "application_error_count": 1,
    "response_time_ms": 120.0,
    "is_injected_anomaly": 0,
    "status": "OK",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "fleetlake-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "shared"),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def reading(spark):
    """Build readings from overrides of one valid row, always with the explicit schema."""

    def build(*overrides: dict, drop: tuple[str, ...] = (), extra: T.StructType | None = None):
        fields = [f for f in READING.fields if f.name not in drop] + (extra.fields if extra else [])
        schema = T.StructType(fields)
        rows = [tuple({**BASE, **o}.get(f.name) for f in fields) for o in overrides]
        return spark.createDataFrame(rows, schema)

    return build


def fleet(spark, *numbers: int):
    """A server dimension with the given numbers."""
    rows = [(f"server{n:02d}", f"10.9.{n // 250}.{n % 250}", "live", "Debian 12", "orders") for n in numbers]
    columns = "server_id string, ip_address string, environment string, operating_system string, application string"
    return spark.createDataFrame(rows, columns)


def minutes(n: float) -> datetime:
    return NOON + timedelta(minutes=n)
