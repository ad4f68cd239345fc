"""Series that go on where an earlier run stopped: slopes (W03), sessions (W02), incidents.

Each run takes a small state, its own readings, and gives results for these and the next state, so a new day costs its
own rows. States hold one server's last rows, its number of sessions, or its incidents that may still grow; they are
tables and can be kept in any path table. Readings of a run must be later than those of the runs before it, server by
server; ``late_readings`` gives the others, which need their days computed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import READINGS_PER_DAY
from fleetlake.operators.incidents import DETECTION_METHOD, MERGE_GAP, described, incident_spans
from fleetlake.operators.scaling import FEATURES
from fleetlake.operators.series import MICROS, rolling_slopes, sessionise
from fleetlake.session import stage


def _same_server(left: str, right: str):
    return F.col(left).eqNullSafe(F.col(right))


def late_readings(rows: DataFrame, carried: DataFrame, by: str = "server_id", ts: str = "timestamp") -> DataFrame:
    """Readings that are not later than what their server's state has seen; ``carried`` has ``ts`` per row or server."""
    last = carried.groupBy(F.col(by).alias("_by")).agg(F.max(ts).alias("_last"))
    return rows.join(last, _same_server(by, "_by") & (F.col(ts) <= F.col("_last")), "left_semi")


# --- Slopes


def slope_state(
    rows: DataFrame, columns: dict[str, str], window: int = READINGS_PER_DAY, by: str = "server_id", ts: str = "timestamp"
) -> DataFrame:
    """The last ``window - 1`` readings of each server: all that the slopes of later readings can see.

    The rank is cut while the rows are still where they were read, so a long series is never gathered.
    """
    wanted = rows.select(by, ts, *dict.fromkeys(columns.values()))
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.desc(ts)))
    return wanted.withColumn("_rank", rank).filter(F.col("_rank") < window).drop("_rank")


def continued_slopes(
    state: DataFrame | None,
    rows: DataFrame,
    columns: dict[str, str],
    window: int = READINGS_PER_DAY,
    by: str = "server_id",
    ts: str = "timestamp",
    **options,
) -> DataFrame:
    """W03 for ``rows`` only, as if the readings before them were there: those of ``state`` are.

    With fewer than ``window - 1`` of them the series is that short, so the warm-up is the same, too.
    """
    if state is None:
        return rolling_slopes(rows, columns, window, by, ts, **options)
    both = rows.withColumn("_new", F.lit(True)).unionByName(state.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    return rolling_slopes(both, columns, window, by, ts, **options).filter("_new").drop("_new")


def next_slope_state(
    state: DataFrame | None, rows: DataFrame, columns: dict[str, str], window: int = READINGS_PER_DAY, by: str = "server_id", ts: str = "timestamp"
) -> DataFrame:
    """The state after ``rows``; written, so that the chain of runs does not grow into one plan."""
    wanted = slope_state(rows, columns, window, by, ts)
    return stage(wanted if state is None else slope_state(wanted.unionByName(state), columns, window, by, ts), "slope-state")


# --- Sessions


def continued_sessions(
    state: DataFrame | None, rows: DataFrame, gap_micros: int = 30 * MICROS["minute"], by: str = "server_id", ts: str = "timestamp"
) -> tuple[DataFrame, DataFrame]:
    """W02 for ``rows``, numbered on from ``state`` (``by, sessions, last``), and the next state.

    A server's first session of this run is its last one of the runs before, if it begins no more than a gap later.
    """
    numbered = stage(sessionise(rows, gap_micros, by, ts), "sessions")
    here = numbered.groupBy(by).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.max("session").alias("_n"))
    if state is None:
        state = here.limit(0).select(by, F.lit(0).cast("long").alias("sessions"), F.col("_last").alias("last"))
    before = state.select(F.col(by).alias("_by"), F.col("sessions").alias("_before"), F.col("last").alias("_at"))
    silence = F.unix_micros("_first") - F.unix_micros("_at")
    goes_on = F.when(silence <= gap_micros, 1).otherwise(0)
    joined = here.join(before, _same_server(by, "_by"), "full")
    offset = F.coalesce("_before", F.lit(0)) - goes_on
    told = stage(
        joined.select(
            F.coalesce(by, "_by").alias(by),
            offset.cast("long").alias("_offset"),
            F.when(F.col("_n").isNotNull(), offset + F.col("_n")).otherwise(F.col("_before")).cast("long").alias("sessions"),
            F.coalesce("_last", "_at").alias("last"),
        ),
        "session-state",
    )
    offsets = told.select(F.col(by).alias("_by"), "_offset")
    shifted = numbered.join(offsets, _same_server(by, "_by"), "left").withColumn("session", F.col("session") + F.col("_offset"))
    return shifted.select(*numbered.columns), told.select(by, "sessions", "last")


# --- Incidents


SPAN = ["server_id", "timestamp", "_end", "readings", "_peak"]


def merged_spans(spans: DataFrame, gap_micros: int = MERGE_GAP) -> DataFrame:
    """Spans of one server that touch or lie at most a gap apart become one; they may overlap."""
    order = W.partitionBy("server_id").orderBy("timestamp", "_end")
    reach = F.max("_end").over(order.rowsBetween(W.unboundedPreceding, -1))
    silence = F.unix_micros("timestamp") - F.unix_micros(reach)
    starts = F.when(silence.isNull() | (silence > gap_micros), 1).otherwise(0)
    run = F.sum("_starts").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return spans.withColumn("_starts", starts).withColumn("_run", run).groupBy("server_id", "_run").agg(
        F.min("timestamp").alias("timestamp"),
        F.max("_end").alias("_end"),
        F.sum("readings").alias("readings"),
        F.max("_peak").alias("_peak"),
    ).select(*SPAN)


def continued_incidents(
    open_spans: DataFrame | None,
    flagged: DataFrame,
    until=None,
    features: list[str] = FEATURES,
    gap_micros: int = MERGE_GAP,
    method: str = DETECTION_METHOD,
) -> tuple[DataFrame, DataFrame]:
    """M07 over runs: incidents that are finished, and the spans that later readings may still lengthen.

    ``flagged`` are the scored readings of this run, ``until`` the instant (a column) up to which readings have come:
    a span whose end is a gap or less before it stays open. Without ``until`` every span is finished.
    """
    spans = incident_spans(flagged, features, gap_micros).select(*SPAN)
    # Only spans that were open meet the new ones; both are far fewer than readings.
    both = spans if open_spans is None else merged_spans(spans.unionByName(open_spans.select(*SPAN)), gap_micros)
    found = stage(both, "spans")
    if until is None:
        return described(found, method), found.limit(0)
    is_open = F.unix_micros("_end") + F.lit(gap_micros) >= F.unix_micros(until)
    return described(found.filter(~is_open), method), found.filter(is_open)
