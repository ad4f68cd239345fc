"""Exact quantiles that no single group, value or task has to hold.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a first
pass counts values per group in order-preserving buckets (combined on the map side), the
few buckets that hold the wanted ranks are located, and a second pass looks only at the
readings inside those. A bucket that still holds very many readings is divided again
first. A bucket whose values are all equal is settled by its count alone, so a value
repeated by most readings costs nothing more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.session import stage

BUCKETS_PER_E_FOLD = 512  # a bucket spans about 0.2 % of its value
PARTS = 4096  # of a bucket that is divided again
MAX_OPEN_ROWS = 4_000_000  # readings of one bucket that are ordered in one task
_LOG_LIMIT = 750  # |ln| of every finite double is below this


def _bucket(value: Column) -> Column:
    """A long that never decreases as the value grows: signed logarithm in fixed steps."""
    magnitude = F.ln(F.least(F.abs(value), F.lit(1.7e308)))
    step = F.floor(magnitude * BUCKETS_PER_E_FOLD) + F.lit(_LOG_LIMIT * BUCKETS_PER_E_FOLD)
    return F.when(value == 0, F.lit(0)).when(value > 0, step).otherwise(-step).cast("long")


def _ends(p: float) -> tuple[Column, Column, Column]:
    """The two ranks (from 0) a quantile lies between, and how far it is past the first."""
    position = F.lit(float(p)) * (F.col("_total") - 1)
    return F.floor(position), F.ceil(position), position - F.floor(position)


def _holds(rank: Column) -> Column:
    return (rank >= F.col("_lo")) & (rank < F.col("_hi"))


def _hit(probs: dict[str, float]) -> Column:
    """Whether the ranks ``_lo`` (included) to ``_hi`` (excluded) contain a wanted one."""
    hit = F.lit(False)
    for p in probs.values():
        below, above, _ = _ends(p)
        hit = hit | _holds(below) | _holds(above)
    return hit


def _inside(table: DataFrame, by: list[str], targets: DataFrame) -> DataFrame:
    """The values within the target intervals: one row per value, with the interval's columns.

    A group has a few targets per column, gathered to one array, so ``table`` meets one row
    per group and keeps its width; only the values that fall into a target come out. The
    targets are a written table: Spark knows its size before it plans the join, so it
    broadcasts it only if it is small, and splits hot groups otherwise.
    """
    columns = [c for c in targets.columns if c not in by]
    gathered = F.collect_list(F.struct(*columns)).alias("_targets")
    if by:
        joined = table.join(targets.groupBy(*by).agg(gathered), by)
    else:
        joined = table.withColumn("_targets", targets.agg(gathered).scalar())
    hits = F.filter("_targets", lambda t: F.get("_x", t["_column"]).between(t["_min"], t["_max"]))
    return (
        joined.select(*by, "_x", F.explode(hits).alias("_t"))
        .select(*by, "_t.*", F.get("_x", F.col("_t._column")).alias("_v"))
    )


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    ]


def _locate(values: DataFrame, group: list[str], probs: dict[str, float]) -> DataFrame:
    """The buckets with a wanted rank: value range, first and last rank, values in the group.

    The window sees one row per bucket: a few thousand, and never more than the doubles'
    range allows, however many values a group has.
    """
    upward = W.partitionBy(*group).orderBy("_bucket")
    ranked = (
        values.groupBy(*group, "_bucket")
        .agg(*_counts())
        .withColumns(
            {"_hi": F.sum("_n").over(upward), "_total": F.sum("_n").over(W.partitionBy(*group))}
        )
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
    )
    columns = [*group, "_bucket", "_total", "_lo", "_hi", "_min", "_max"]
    return stage(ranked.filter(_hit(probs)).select(*columns), "quantile-targets")


def _divide(inside: DataFrame, group: list[str], targets: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Cut each target interval into equal parts and keep those with a wanted rank."""
    share = (F.col("_v") - F.col("_min")) / (F.col("_max") - F.col("_min"))
    interval = [*group, "_bucket", "_total", "_lo"]
    upward = W.partitionBy(*interval).orderBy("_part")
    ranked = (
        inside.withColumn("_part", F.floor(share * PARTS))
        .groupBy(*interval, "_part")
        .agg(*_counts())
        .withColumn("_hi", F.col("_lo") + F.sum("_n").over(upward))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
    )
    return stage(ranked.filter(_hit(probs)).select(*targets.columns), "quantile-targets")


def column_quantiles(
    df: DataFrame, by: list[str], columns: list[str], probs: dict[str, float]
) -> DataFrame:
    """Exact, linearly interpolated quantiles of several columns: ``(by, feature, ...)``.

    Null and NaN values, and rows with a null group key, are left out. ``probs`` maps an
    output column to its probability. ``df`` is read at least twice.
    """
    table = df.select(*by, F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"))
    for b in by:
        table = table.filter(F.col(b).isNotNull())
    group = [*by, "_column"]
    values = (
        table.select(*by, F.posexplode("_x").alias("_column", "_v"))
        .filter("_v is not null and not isnan(_v)")
        .withColumn("_bucket", _bucket(F.col("_v")))
    )
    targets = _locate(values, group, probs)
    found = []
    while True:
        settled = targets.filter("_min = _max")
        found.append(settled.select(*group, "_total", "_lo", "_hi", F.col("_min").alias("_v")))
        targets = targets.filter("_min < _max")
        if not targets.filter(F.col("_hi") - F.col("_lo") > MAX_OPEN_ROWS).take(1):
            break
        targets = _divide(_inside(table, by, targets), group, targets, probs)

    interval = [*group, "_bucket", "_total", "_lo"]
    upward = W.partitionBy(*interval).orderBy("_v")
    ranked = (
        _inside(table, by, targets)
        .groupBy(*interval, "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_hi", F.col("_lo") + F.sum("_n").over(upward))
        .select(*group, "_total", (F.col("_hi") - F.col("_n")).alias("_lo"), "_hi", "_v")
    )
    for settled in found:
        ranked = ranked.unionByName(settled)

    def value_at(rank: Column) -> Column:
        return F.max(F.when(_holds(rank), F.col("_v")))

    ends = {name: _ends(p) for name, p in probs.items()}
    picked = [
        F.struct(
            value_at(below).alias("below"), value_at(above).alias("above"), F.max(past).alias("past")
        ).alias(f"_{name}")
        for name, (below, above, past) in ends.items()
    ]
    interpolated = [
        F.expr(f"_{name}.below + (_{name}.above - _{name}.below) * _{name}.past").alias(name)
        for name in probs
    ]
    names = F.array(*[F.lit(c) for c in columns])
    feature = F.get(names, F.col("_column")).alias("feature")
    return ranked.groupBy(*group).agg(*picked).select(*by, feature, *interpolated)


def quantiles(
    df: DataFrame, by: list[str], value: str, probs: dict[str, float], exact: bool = True
) -> DataFrame:
    """Quantiles of one column per group; see ``column_quantiles``.

    With ``exact=False`` a bounded sketch (``percentile_approx``) answers in one pass, with
    a rank error of 1 in 10,000.
    """
    if exact:
        return column_quantiles(df, by, [value], probs).drop("feature")
    v = F.col(value).cast("double")
    rows = df.select(*by, v.alias("_v")).filter("_v is not null and not isnan(_v)")
    for b in by:
        rows = rows.filter(F.col(b).isNotNull())
    sketches = [F.percentile_approx("_v", p, 10_000).alias(name) for name, p in probs.items()]
    return rows.groupBy(*by).agg(*sketches)


def median(df: DataFrame, by: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group."""
    return quantiles(df, by, value, {name: 0.5})


def median_and_mad(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Median and median absolute deviation per group.

    ``df`` is read several times, so hand in a written table rather than a long plan.
    """
    centre = stage(median(df, by, value), "medians")
    if by:
        deviations = df.join(centre, by)
    else:
        deviations = df.withColumn("median", centre.scalar())
    deviations = deviations.select(*by, F.abs(F.col(value) - F.col("median")).alias("_dev"))
    spread = median(deviations, by, "_dev", "mad")
    if by:
        return centre.join(spread, by)
    return centre.withColumn("mad", spread.scalar())
