"""Scalers from mergeable sketches (M02): one pass over new days, merges for everything else.

A sketch of a (server, day, feature) holds the quantiles of its values (KLL) and their count, mean and squared
deviations. Sketches of more days merge without looking at a reading again, so scalers over any range of days cost one
small row per server and day. The median is a quantile, and the median absolute deviation that of evenly spaced quantiles
of the same sketch. ``fit_scalers`` stays the exact way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.scaling import FEATURES, MIN_MAD, STD_FLOOR

ITEMS = 1024  # items a sketch keeps per level
RANK_ERROR = 0.01  # of both statistics: a sketch of so many items is off by less than a third of it
POINTS = 1000  # quantiles that stand for a sketch's values when the deviation is taken


def day_sketches(df: DataFrame, features: list[str] = FEATURES, by: str = "server_id", day: str = "dt") -> DataFrame:
    """``(server, day, feature, sketch, n, mean, squares)``: nulls and NaN are left out, as in ``fit_scalers``."""
    aggregates, parts = [], []
    for i, f in enumerate(features):
        value = F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
        aggregates += [
            F.kll_sketch_agg_double(value, ITEMS).alias(f"s{i}"),
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"m{i}"),
            F.var_pop(value).alias(f"v{i}"),
        ]
        parts.append(
            F.struct(
                F.lit(f).alias("feature"), F.col(f"s{i}").alias("sketch"), F.col(f"n{i}").alias("n"),
                F.col(f"m{i}").alias("mean"), (F.col(f"v{i}") * F.col(f"n{i}")).alias("squares"),
            )
        )
    wide = df.groupBy(by, day).agg(*aggregates)
    return wide.select(by, day, F.explode(F.array(*parts)).alias("p")).select(by, day, "p.*").filter("n > 0")


def merged_sketches(sketches: DataFrame, by: str = "server_id") -> DataFrame:
    """One sketch per (server, feature) over all the days given."""
    weighted = F.sum(F.col("mean") * F.col("n"))
    # Squares about the common mean: those about each day's mean, and the days' means about the common one.
    about = F.sum(F.col("squares") + F.col("n") * F.col("mean") * F.col("mean"))
    merged = sketches.groupBy(by, "feature").agg(
        F.kll_merge_agg_double("sketch", ITEMS).alias("sketch"), F.sum("n").alias("n"), weighted.alias("_w"), about.alias("_a")
    )
    mean = F.col("_w") / F.col("n")
    return merged.select(by, "feature", "sketch", "n", mean.alias("mean"), F.greatest(F.lit(0.0), F.col("_a") - F.col("_w") * mean).alias("squares"))


def scalers_from_sketches(sketches: DataFrame, by: str = "server_id") -> DataFrame:
    """``(server, feature, median, scale, mad, n)`` as ``fit_scalers`` gives them, within ``RANK_ERROR``."""
    ranks = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    known = merged_sketches(sketches, by).withColumns(
        {
            "median": F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)),
            "_points": F.kll_sketch_get_quantile_double("sketch", ranks),
        }
    )
    away = F.array_sort(F.transform("_points", lambda v: F.abs(v - F.col("median"))))
    mad = F.element_at(away, POINTS // 2)
    std = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))) + F.lit(STD_FLOOR)
    told = known.withColumn("mad", mad)
    scale = F.when(F.col("mad") > MIN_MAD, F.col("mad")).otherwise(std)
    return told.select(by, "feature", "median", scale.alias("scale"), "mad", "n")


def rank_errors(df: DataFrame, scalers: DataFrame, features: list[str] = FEATURES, by: str = "server_id") -> DataFrame:
    """``(server, feature, median_error, mad_error)``: how far from one half the exact ranks of both are.

    A value that occurs often has a range of ranks; the error is the distance of one half from that range.
    """
    long = df.select(by, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([by], features, "feature", "value")
    told = long.filter("value is not null and not isnan(value)").join(scalers, [by, "feature"])
    away = F.abs(F.col("value") - F.col("median"))

    def error(below: Column, upto: Column) -> Column:
        return F.greatest(F.lit(0.0), F.avg(below.cast("int")) - 0.5, F.lit(0.5) - F.avg(upto.cast("int")))

    return told.groupBy(by, "feature").agg(
        error(F.col("value") < F.col("median"), F.col("value") <= F.col("median")).alias("median_error"),
        error(away < F.col("mad"), away <= F.col("mad")).alias("mad_error"),
    )
