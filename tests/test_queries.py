"""Registered queries against their SQL on the smallest data folder.

By default one query for each row of the inventory, a few of the slow ones among them; ``FLEETLAKE_ALL_QUERIES=1``
runs every one.
"""

import os

import pytest

import __spark_entry__ as entry
from fleetlake.plans import catalog
from tools.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"

# Queries that run streams or the whole detector, or write many files; a few of them are enough every time.
SLOW = {
    "a33_evaluate_by_server", "a35_flag_rate", "a36_fleet_kpis", "a38_severity_counts", "a39_incidents_per_server",
    "j10_server_detail", "m03_z_scores", "m04_forest", "m07_incidents", "m08_dominant_feature", "m10_winsorised",
    "p11_round_scores", "p13_filter_severity", "p19_description", "s10_scores_and_events", "s12_serving_anomalies",
    "t02_top_scores", "t04_latest",
    "m02_scalers", "m02_scalers_sketch", "m05_isolation_scores", "m12_detection", "p17_around_incidents", "s07_compact",
    "s11_model", "s11_model_scalers", "x01_stream_bronze", "x02_compact_silver", "x02_stream_gold", "x02_stream_silver",
    "x02_stream_summary", "x03_stream_events", "x04_stream_alerts",
}
ALWAYS = {
    "a04_server_summary", "a05_daily_metrics", "a08_cpu_profile", "a13_trend_report", "a15_fleet_robust_z", "a19_rule_vs_truth",
    "a26_server_hour_matrix", "j08_upsert", "j08_upsert_buckets", "m02_scalers_sketch", "m06_flags", "m07_incidents_continued",
    "m09_finished_events", "p03_validity_rules", "p05_reject_rows", "p05_split_tables", "p05_valid_rows", "p17_around_incidents",
    "s05_scan_landing", "u02_two_writers", "w02_sessions", "w03_rolling_slopes", "w03_slopes_continued",
    "x04_step_alerts", "x04_stream_alerts",
}


def one_per_row() -> set[str]:
    """The first query of each row of the inventory, which its prefix names, but for the slow ones."""
    rows: dict[str, str] = {}
    for name in sorted(set(catalog.QUERIES) - SLOW):
        rows.setdefault(name.split("_")[0], name)
    return set(rows.values())


NAMES = sorted(catalog.QUERIES if os.environ.get("FLEETLAKE_ALL_QUERIES") else ALWAYS | one_per_row())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name)) == ""


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() == 9
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without_sql = set(catalog.QUERIES) - set(entry.oracle_sql())
    assert without_sql == {
        "m04_forest", "m05_isolation_scores", "m12_detection", "s11_model", "t09_preview",
    }
