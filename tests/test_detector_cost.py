"""What the detector queries write on the way, and that scoring by ranks equals the plain descent."""

import math

import numpy as np
import pytest

from fleetlake.operators import forest
from fleetlake.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["p17_around_incidents", "m12_detection", "s11_model"])
def test_only_columns_of_the_detector_are_staged(spark, monkeypatch, name):
    written, real = [], catalog.stage

    def record(df, label):
        written.append((label, set(df.columns)))
        return real(df, label)

    monkeypatch.setattr(catalog, "stage", record)
    assert catalog.QUERIES[name](spark, SF).count() > 0
    silver = dict(written)["silver"]
    assert set(catalog.DETECTOR_COLUMNS) <= silver and not silver & {"hostname", "status", "disk_io_read", "dt"}
    assert "flagged" not in dict(written)  # the scores are written once


def _plain(x: np.ndarray, trees: tuple) -> list[float]:
    feature, threshold, path = trees
    out = []
    for row in x:
        total = 0.0
        for t in range(len(feature)):
            node = 0
            while feature[t, node] >= 0:
                node = 2 * node + 1 + int(row[feature[t, node]] > threshold[t, node])
            total += path[t, node]
        out.append(float(np.exp2(-total / len(feature))))
    return out


@pytest.mark.parametrize("sizes", [[256] * 9, [2, 1, 5, 256, 17], [3, 3], [1]])
def test_scores_by_rank_equal_the_plain_descent(sizes):
    """Trees of several depths, leaves on all levels, values equal to a threshold, and infinite ones."""
    rng = np.random.default_rng(3)
    data = np.round(rng.standard_t(3, size=(600, 4)), 1)
    grown = []
    for i, n in enumerate(sizes):
        depth = max(1, math.ceil(math.log2(max(n, 2))))
        grown.append(forest._grow(data[rng.choice(600, n, replace=False)], depth, np.random.default_rng([1, i])))
    width = max(len(g[0]) for g in grown)
    trees = tuple(np.full((len(sizes), width), fill, dtype=kind) for fill, kind in ((-1, np.int32), (0.0, float), (0.0, float)))
    for i, parts in enumerate(grown):
        for whole, part in zip(trees, parts):
            whole[i, : len(part)] = part
    x = data[:300].copy()
    x[0], x[1], x[2] = np.inf, -np.inf, trees[1][0, 0]
    assert forest.isolation(x, trees, block=64).tolist() == _plain(x, trees)
