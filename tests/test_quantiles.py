import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlake.operators import quantiles as Q

PROBS = {"q0": 0.0, "q1": 0.001, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}


def same(a, b):
    return (a is None and b is None) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-300)


def check(spark, groups: dict[str, list]):
    rows = [(g, None if v is None else float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r for r in Q.quantiles(df, ["g"], "x", PROBS).collect()}
    for g, values in groups.items():
        known = [v for v in values if v is not None and not math.isnan(v)]
        if not known:
            assert g not in got
            continue
        for name, p in PROBS.items():
            assert same(got[g][name], float(np.quantile(known, p))), (g, name)


@pytest.mark.parametrize("limit, parts", [(4_000_000, 4096), (50, 4096), (2, 3)])
def test_equal_to_numpy_however_often_buckets_are_divided(spark, monkeypatch, limit, parts):
    monkeypatch.setattr(Q, "MAX_OPEN_ROWS", limit)
    monkeypatch.setattr(Q, "PARTS", parts)
    rng = np.random.default_rng(1)
    check(
        spark,
        {
            "normal": list(rng.normal(0, 100, 3000)),
            "narrow": list(100 + rng.random(3000) * 1e-6),
            "mostly one value": [0.0] * 2000 + list(rng.random(500)),
            "one": [7.25],
            "two": [-1.0, 4.0],
            "holes": [None, float("nan"), 3.0, None, 5.0],
            "empty": [None, None],
            "extremes": [-1.7e308, -5e-324, 0.0, 5e-324, 1.7e308],
        },
    )


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=60))
def test_any_list(spark, values):
    check(spark, {"g": values})


def test_whole_table_and_mad(spark):
    values = [1.0, 2.0, 4.0, 8.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = Q.median_and_mad(df, [], "x").first()
    assert (row["median"], row["mad"]) == (4.0, 3.0)


def test_sketch_is_close(spark):
    df = spark.range(10_001).selectExpr("'a' as g", "cast(id as double) as x")
    assert abs(Q.quantiles(df, ["g"], "x", {"m": 0.5}, exact=False).first()["m"] - 5000) <= 2
