"""Isolation forest as Spark jobs (M04-M06, S11), after Liu, Ting and Zhou (2008).

Spark draws the samples, grows the trees in parallel and scores the readings; the Python
helpers see one 256-row sample or one Arrow batch at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import label_result
from fleetlake.operators.quantiles import quantiles
from fleetlake.operators.scaling import FEATURES

TREES = 300
SAMPLE_ROWS = 256
CONTAMINATION = 0.05
SEED = 42
MAX_FOREST_NODES = 10_000_000
_EULER = 0.5772156649015329

TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, path array<double>"


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows: the path a leaf of n rows still hides."""
    n = np.asarray(n, dtype=float)
    grown = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + _EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, grown, np.where(n == 2, 1.0, 0.0))


def z_columns(features: list[str] = FEATURES) -> list[str]:
    return [f"z_{f}" for f in features]


def _complete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with every z present; the others stay unscored."""
    condition = F.lit(True)
    for c in cols:
        condition = condition & F.col(c).isNotNull() & ~F.isnan(c)
    return df.filter(condition)


def draw_samples(
    z: DataFrame,
    features: list[str] = FEATURES,
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
    keys: tuple[str, ...] = ("server_id", "timestamp"),
) -> DataFrame:
    """A sample without replacement for every tree: ``(tree, z columns)``.

    Rows are chosen by hashes of their key, so the draw does not depend on partitioning.
    Every reading has the same chance ``p = 1.5 * sample_rows / n`` in every tree, whatever
    their number. One hash decides whether a reading is in any tree, ``1 - (1 - p) ** trees``,
    and also which is its first (the geometric law); only readings that are in some tree are
    hashed for the later ones. About trees x 1.5 x sample rows leave the scan for any n.
    """
    cols = z_columns(features)
    rows = _complete(z.select(*keys, *cols), cols)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()

    def chance(*salt: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*keys, *salt), 11) / F.lit(float(1 << 53))

    p = F.least(F.lit(1.5 * sample_rows) / total, F.lit(1.0))
    # Null where p is 1: then every reading is in the first tree, and in all others.
    miss = F.log1p(-F.col("_p"))
    anywhere = F.coalesce(-F.expm1(F.lit(trees) * miss), F.lit(1.0))
    first = F.coalesce(F.floor(F.log1p(-F.col("_u")) / miss), F.lit(0)).cast("int")
    pool = rows.withColumns({"_p": p, "_u": chance(F.lit(seed))}).filter(F.col("_u") < anywhere)
    pool = pool.withColumn("_first", F.least(first, F.lit(trees - 1)))
    later = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: (t == F.col("_first")) | (t > F.col("_first")) & (chance(F.lit(seed + 1), t) < F.col("_p")),
    )
    drawn = pool.select(*keys, *cols, F.explode(later).alias("tree"))
    order = W.partitionBy("tree").orderBy(chance(F.lit(seed + 2), F.col("tree")), *keys)
    return (
        drawn.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= sample_rows)
        .select("tree", "_rank", *cols)
    )


def _grow(x: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """One tree as a complete binary array: children of node i are 2i+1 and 2i+2.

    A node with feature -1 is a leaf whose ``path`` is its depth plus the expected rest.
    """
    nodes = 2 ** (depth + 1) - 1
    feature = np.full(nodes, -1, dtype=np.int32)
    threshold = np.zeros(nodes)
    path = np.zeros(nodes)
    pending = [(0, 0, np.arange(len(x)))]
    while pending:
        node, level, members = pending.pop()
        sample = x[members]
        low, high = (sample.min(axis=0), sample.max(axis=0)) if len(members) else (None, None)
        varied = np.flatnonzero(high > low) if len(members) > 1 else np.array([], dtype=int)
        if level == depth or varied.size == 0:
            path[node] = level + float(expected_path(len(members)))
            continue
        f = int(rng.choice(varied))
        cut = rng.uniform(low[f], high[f])
        goes_right = sample[:, f] > cut
        feature[node], threshold[node] = f, cut
        pending.append((2 * node + 2, level + 1, members[goes_right]))
        pending.append((2 * node + 1, level + 1, members[~goes_right]))
    return feature, threshold, path


def fit_forest(
    z: DataFrame,
    features: list[str] = FEATURES,
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per tree. Groups are at most ``sample_rows`` rows by construction."""
    cols = z_columns(features)
    samples = draw_samples(z, features, trees, sample_rows, seed)

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        x = sample.sort_values("_rank")[cols].to_numpy(dtype=float)
        depth = max(1, math.ceil(math.log2(max(len(x), 2))))
        feature, threshold, path = _grow(x, depth, np.random.default_rng([seed, tree]))
        normal = max(float(expected_path(len(x))), 1e-12)
        return pd.DataFrame(
            {
                "tree": [tree],
                "feature": [feature],
                "threshold": [threshold],
                "path": [path / normal],
            }
        )

    return samples.groupBy("tree").applyInPandas(grow, TREE_SCHEMA)


def collect_forest(forest: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trees as (tree, node) arrays. Their size follows the model's settings, not the data."""
    nodes = forest.agg(F.sum(F.size("feature"))).first()[0] or 0
    if nodes > MAX_FOREST_NODES:
        raise ValueError(f"{nodes} tree nodes are too many to send to every executor")
    if not nodes:
        return np.zeros((0, 1), np.int32), np.zeros((0, 1)), np.zeros((0, 1))
    trees = forest.orderBy("tree").toPandas()
    width = int(trees["feature"].map(len).max())

    def padded(column: str, fill: float, dtype: type) -> np.ndarray:
        out = np.full((len(trees), width), fill, dtype=dtype)
        for i, values in enumerate(trees[column]):
            out[i, : len(values)] = values
        return out

    return padded("feature", -1, np.int32), padded("threshold", 0.0, float), padded("path", 0.0, float)


TOP_LEVELS = 3  # tests of these levels are made for all rows at once and packed to one byte


def _complete_trees(forest: tuple[np.ndarray, np.ndarray, np.ndarray], features: int) -> tuple:
    """The trees in the form ``isolation`` descends: thresholds as ranks among those of their feature, all leaves last.

    A value is above a threshold exactly if more of the feature's thresholds lie below it than below that one. A
    leaf above the last level never sends a row to the right, so its path is found at its leftmost descendant.
    """
    feature, threshold, path = (part.copy() for part in forest)
    levels = int(math.log2(feature.shape[1] + 1)) - 1
    cuts = [np.unique(threshold[feature == f]) for f in range(features)]
    never = max(len(c) for c in cuts)
    rank = np.full(feature.shape, never, dtype=np.int32)
    for f, c in enumerate(cuts):
        rank[feature == f] = np.searchsorted(c, threshold[feature == f])
    for level in range(levels):
        nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
        leaf = feature[:, nodes] < 0
        left = 2 * nodes + 1
        feature[:, left] = np.where(leaf, -1, feature[:, left])
        rank[:, left] = np.where(leaf, never, rank[:, left])
        path[:, left] = np.where(leaf, path[:, nodes], path[:, left])
    return cuts, np.maximum(feature, 0), rank, path[:, 2**levels - 1 :], levels


def _after_top(top: int) -> np.ndarray:
    """The node (counted from 0 in its level) below the top levels, for every outcome of their tests as bits."""
    outcome = np.arange(2 ** (2**top - 1))
    node = np.zeros(len(outcome), dtype=np.intp)
    for level in range(top):
        node = 2 * node + ((outcome >> (2**level - 1 + node)) & 1)
    return node


def isolation(
    x: np.ndarray, forest: tuple[np.ndarray, np.ndarray, np.ndarray], block: int = 4096
) -> np.ndarray:
    """2 ** -(mean relative path) for every row."""
    return _descend(x, _complete_trees(forest, x.shape[1]), block)


def _descend(x: np.ndarray, complete: tuple, block: int = 4096) -> np.ndarray:
    """``isolation`` by complete trees.

    A block of rows descends one tree after the other, so that its columns and the tree stay in
    the cache. Values are compared by rank, in small integers.
    """
    cuts, feature, rank, path, levels = complete
    trees, top = len(feature), min(TOP_LEVELS, levels)
    first, below = 2**top - 1, _after_top(top)
    by_level = [slice(2**level - 1, 2 ** (level + 1) - 1) for level in range(top, levels)]
    out = np.empty(len(x))
    for start in range(0, len(x), block):
        rows = x[start : start + block]
        n = len(rows)
        codes = np.stack([np.searchsorted(c, rows[:, f]) for f, c in enumerate(cuts)]).astype(np.int32)
        flat, every = codes.ravel(), np.arange(n)
        offset = feature.astype(np.intp) * n
        total = np.zeros(n)
        for t in range(trees):
            tests = codes[feature[t, :first]] > rank[t, :first, None]
            node = below[np.packbits(tests, axis=0, bitorder="little")[0]]
            for nodes in by_level:
                at = offset[t, nodes].take(node)
                at += every
                right = flat.take(at) > rank[t, nodes].take(node)
                node += node
                node += right
            total += path[t].take(node)
        out[start : start + block] = np.exp2(-total / trees)
    return out


def score(z: DataFrame, forest: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Add ``isolation`` in 0..1, higher for more isolated readings; null if a z is missing."""
    cols = z_columns(features)
    trees = z.sparkSession.sparkContext.broadcast(_complete_trees(collect_forest(forest), len(cols)))

    @F.pandas_udf("double")
    def isolated(vector: pd.DataFrame) -> pd.Series:
        x = vector.to_numpy(dtype=float)
        known = ~np.isnan(x).any(axis=1) & (len(trees.value[1]) > 0)
        result = np.full(len(x), np.nan)
        if known.any():
            result[known] = _descend(x[known], trees.value)
        return pd.Series(result).where(known)

    return z.withColumn("isolation", isolated(F.struct(*cols)))


def cutoff(
    scored: DataFrame,
    raw: str = "isolation",
    contamination: float = CONTAMINATION,
    exact: bool = True,
) -> DataFrame:
    """The score that the stated share of readings exceeds, as one row.

    ``scored`` is read more than once, so hand in a written table.
    """
    return quantiles(scored, [], raw, {"cut": 1.0 - contamination}, exact)


def flag(
    scored: DataFrame,
    raw: str = "isolation",
    contamination: float = CONTAMINATION,
    exact: bool = True,
    cut: float | None = None,
) -> DataFrame:
    """``anomaly_score`` (0 at the cut-off), ``is_anomaly`` and ``result``.

    Flags are strictly above the cut-off, which is taken from the readings themselves unless
    one is given (later readings are judged by the cut-off of the fit). A reading without a
    score has a null flag and the result UNSCORED.
    """
    limit = cutoff(scored, raw, contamination, exact).scalar() if cut is None else F.lit(cut)
    above = scored.withColumn("anomaly_score", F.col(raw) - limit)
    flagged = above.withColumn(
        "is_anomaly", (F.col("anomaly_score") > 0).cast("int")
    )
    return flagged.withColumn("result", label_result(F.col("is_anomaly")))


def save_model(scalers: DataFrame, forest: DataFrame, path: str, **settings: str | float) -> None:
    """Scalers, trees and settings as Parquet tables under one folder."""
    scalers.write.mode("overwrite").parquet(f"{path}/scalers")
    forest.write.mode("overwrite").parquet(f"{path}/trees")
    entries = [F.struct(F.lit(k).alias("k"), F.lit(str(v)).alias("v")) for k, v in settings.items()]
    meta = scalers.sparkSession.range(1).select(F.explode(F.array(*entries)).alias("e")).select("e.k", "e.v")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Scalers, trees and settings for scoring later readings."""
    meta = {r["k"]: r["v"] for r in spark.read.parquet(f"{path}/meta").collect()}
    return spark.read.parquet(f"{path}/scalers"), spark.read.parquet(f"{path}/trees"), meta
