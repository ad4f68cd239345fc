"""Cleaning: types, canonical keys, one row per key, validity, quarantine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from fleetlake.functions.rules import (
    MIN_VALID_TIMESTAMP,
    all_reasons,
    reject_reason,
    validity_rules,
)
from fleetlake.sources.readings import METRIC_TYPES

KEYS = ["server_id", "timestamp"]


def enforce_types(df: DataFrame) -> DataFrame:
    """Cast to the reading's types; text that does not parse becomes null."""
    types = {"timestamp": T.TimestampType(), **METRIC_TYPES, "status": T.StringType()}
    found = {f.name: f.dataType for f in df.schema.fields}

    def converted(name: str, dtype: T.DataType) -> Column:
        is_text = isinstance(found[name], T.StringType)
        return F.col(name).try_cast(dtype) if is_text else F.col(name).cast(dtype)

    return df.withColumns({name: converted(name, dtype) for name, dtype in types.items()})


def standardise(df: DataFrame) -> DataFrame:
    """Lower-case and strip the keys, so spelling variants of a server coincide."""
    return df.withColumns({c: F.trim(F.lower(F.col(c))) for c in ("hostname", "server_id")})


def default_tie_break(df: DataFrame) -> list[Column]:
    """Lineage columns first where present, then every other column, so the pick is total."""
    lineage = [c for c in ("_ingested_at", "_source_file", "event_id") if c in df.columns]
    rest = [c for c in df.columns if c not in lineage and c not in KEYS]
    return [F.col(c) for c in lineage + rest]


def dedup(df: DataFrame, keys: list[str] = KEYS, order_by: list[Column] | None = None) -> DataFrame:
    """The first row per key in a stated order; null keys count as equal.

    ``row_number() = 1`` lets Spark cut each key to one row per map task before the
    shuffle (``WindowGroupLimit``), so a key with very many copies never gathers anywhere.
    """
    return ranked(df, keys, order_by).filter("_rank = 1").drop("_rank")


def ranked(df: DataFrame, keys: list[str] = KEYS, order_by: list[Column] | None = None) -> DataFrame:
    """``_rank`` of every row among the rows of its key, 1 for the one that stays."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*(order_by or default_tie_break(df))))
    return df.withColumn("_rank", rank)


def latest_hostname(valid: DataFrame) -> DataFrame:
    """Every reading under the hostname its server used last, so that a server is one group."""
    newest = valid.groupBy("server_id").agg(
        F.max_by("hostname", F.struct("timestamp", "hostname")).alias("_host")
    )
    return valid.join(newest, "server_id", "left").withColumn("hostname", F.col("_host")).drop("_host")


def duplicate_count(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """How many rows are surplus copies of a key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def classify(
    df: DataFrame,
    min_ts: datetime = MIN_VALID_TIMESTAMP,
    as_of: Column | None = None,
    order_by: list[Column] | None = None,
    with_all_reasons: bool = False,
) -> DataFrame:
    """Types, keys, dedup, then ``_reject_reason`` (null for a valid row).

    ``as_of`` bounds plausible timestamps from above; it defaults to the query's start.
    """
    rules = validity_rules(F.current_timestamp() if as_of is None else as_of, min_ts)
    unique = dedup(standardise(enforce_types(df)), order_by=order_by)
    extra = {"_reject_reasons": all_reasons(rules)} if with_all_reasons else {}
    return unique.withColumns({"_reject_reason": reject_reason(rules), **extra})


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows of one classified table."""
    reason = F.col("_reject_reason")
    valid = classified.filter(reason.isNull()).drop("_reject_reason", "_reject_reasons")
    return valid, classified.filter(reason.isNotNull())


def clean_and_validate(
    df: DataFrame,
    min_ts: datetime = MIN_VALID_TIMESTAMP,
    as_of: Column | None = None,
    order_by: list[Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)``. To use both, stage ``classify(...)`` once and ``split`` it."""
    return split(classify(df, min_ts, as_of, order_by))


def with_outcome(classified: DataFrame) -> DataFrame:
    """``outcome``, valid or rejected, to write both kinds of rows in one pass."""
    return classified.withColumn("outcome", F.when(F.col("_reject_reason").isNull(), "valid").otherwise("rejected"))
