"""Pipeline counts and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.rules import READINGS_PER_DAY, count_if, ratio, rounded


def reject_breakdown(rejects: DataFrame) -> DataFrame:
    """Rejected rows by reason, most frequent first."""
    counts = rejects.groupBy("_reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "_reject_reason")


def pipeline_counts(bronze: DataFrame, classified: DataFrame) -> DataFrame:
    """Bronze, valid and rejected rows, pass rate and servers, as one row.

    ``classified`` is Silver before the split, so valid and rejected come from one pass.
    """
    outcome = classified.agg(
        count_if(F.col("_reject_reason").isNull()).alias("valid_rows"),
        count_if(F.col("_reject_reason").isNotNull()).alias("rejected_rows"),
        F.count_distinct(F.when(F.col("_reject_reason").isNull(), F.col("server_id"))).alias("servers"),
    )
    bronze_rows = bronze.agg(F.count(F.lit(1)).alias("n")).scalar()
    return outcome.withColumn("bronze_rows", bronze_rows).withColumn(
        "pass_rate_percent", rounded(ratio(100 * F.col("valid_rows"), F.col("bronze_rows")), 1)
    )


def completeness(df: DataFrame, per_day: int = READINGS_PER_DAY, days: int = 7) -> DataFrame:
    """Rows found against servers x readings per day x days."""
    found = df.agg(
        F.count(F.lit(1)).alias("actual_rows"), F.count_distinct("server_id").alias("servers")
    )
    return found.withColumn("expected_rows", F.col("servers") * per_day * days).withColumn(
        "missing_rows", F.col("expected_rows") - F.col("actual_rows")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column; NaN counts as missing."""

    def missing(field: T.StructField):
        c = F.col(field.name)
        is_float = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        return count_if(c.isNull() | F.isnan(c) if is_float else c.isNull()).alias(field.name)

    counts = df.agg(*[missing(f) for f in df.schema.fields])
    return counts.unpivot([], df.columns, "column_name", "missing")


def time_bounds(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """First and last instant."""
    return df.agg(F.min(ts).alias("first_timestamp"), F.max(ts).alias("last_timestamp"))


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension."""
    return facts.join(dim.select(key), key, "left_anti")
