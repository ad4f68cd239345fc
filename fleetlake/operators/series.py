"""Per-server time series: gaps, sessions, rolling slopes.

A server may hold a large share of all readings, so nothing here sorts a whole server in
one task. Series are cut along time, and only the small per-slice results (at most one
row per slice of the time range, however many readings it has) are ordered per server.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import READINGS_PER_DAY
from fleetlake.session import stage

MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}
ROWS_PER_SLICE = 1_000_000


def slice_of(ts: Column, width_micros: int) -> Column:
    """Number of the fixed time slice an instant falls in."""
    return F.floor(F.unix_micros(ts) / F.lit(width_micros)).cast("long")


def _keep_left(rows: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the values of their key; null keys are keys like any other."""
    named = values.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(named, same, "left").drop(*[f"_of_{k}" for k in keys])


def gap_since_prev(
    df: DataFrame, by: str = "server_id", ts: str = "timestamp", slice_micros: int = MICROS["hour"]
) -> DataFrame:
    """Microseconds since the previous reading of the same server (null for the first).

    Readings without a server form a series of their own, those without a time have no gap.

    Inside a slice ``lag`` answers; a slice's first row takes the last instant of the
    nearest earlier slice that has readings.
    """
    sliced = df.withColumn("_slice", slice_of(F.col(ts), slice_micros))
    previous = (
        sliced.groupBy(by, "_slice")
        .agg(F.max(ts).alias("_last"))
        .select(
            by,
            "_slice",
            F.lag("_last").over(W.partitionBy(by).orderBy("_slice")).alias("_before"),
        )
    )
    inside = W.partitionBy(by, "_slice").orderBy(ts)
    before = F.coalesce(F.lag(ts).over(inside), F.col("_before"))
    return (
        _keep_left(sliced, previous, [by, "_slice"])
        .withColumn("gap_micros", F.unix_micros(ts) - F.unix_micros(before))
        .drop("_slice", "_before")
    )


def gap_histogram(df: DataFrame, by: str = "server_id", ts: str = "timestamp") -> DataFrame:
    """How often each gap length (in seconds) occurs."""
    gaps = gap_since_prev(df.select(by, ts), by, ts).filter("gap_micros is not null")
    return gaps.groupBy((F.col("gap_micros") / 1e6).alias("gap_seconds")).agg(
        F.count(F.lit(1)).alias("n")
    )


def session_cells(
    df: DataFrame,
    gap_micros: int,
    by: str = "server_id",
    ts: str = "timestamp",
    aggregates: list[Column] | None = None,
) -> DataFrame:
    """Readings pre-aggregated to cells as wide as the session gap, numbered by session.

    Two readings in one cell are less than a gap apart, so a cell never spans sessions and
    can be aggregated before anything is ordered. Sessions are then runs of cells: a new one
    starts where a cell's first reading is *more* than the gap after the previous cell's last.
    ``session`` counts from 1 per server.
    """
    cells = (
        df.withColumn("_cell", slice_of(F.col(ts), gap_micros))
        .groupBy(by, "_cell")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), *(aggregates or []))
    )
    order = W.partitionBy(by).orderBy("_cell")
    silence = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(order))
    starts = F.when(silence.isNull() | (silence > gap_micros), 1).otherwise(0)
    return cells.withColumn("_starts", starts).withColumn("session", F.sum("_starts").over(order)).drop(
        "_starts"
    )


def sessionise(
    df: DataFrame,
    gap_micros: int = 30 * MICROS["minute"],
    by: str = "server_id",
    ts: str = "timestamp",
) -> DataFrame:
    """Session number of every reading; a gap of exactly ``gap_micros`` still merges."""
    cells = session_cells(df.select(by, ts), gap_micros, by, ts).select(by, "_cell", "session")
    numbered = df.withColumn("_cell", slice_of(F.col(ts), gap_micros))
    return _keep_left(numbered, cells, [by, "_cell"]).drop("_cell")


def with_slices(
    df: DataFrame,
    lookback: int,
    by: str = "server_id",
    ts: str = "timestamp",
    unit_micros: int = MICROS["hour"],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Cut long series into slices that each also carry the ``lookback`` rows before them.

    Adds ``_slice`` and ``_own``; window functions over (``by``, ``_slice``) that look back
    at most ``lookback`` rows then equal those over the whole series on the ``_own`` rows.
    Series up to ``rows_per_slice`` stay in one slice and need no lookup. For longer ones,
    readings are counted per time unit, whole units are gathered into slices, and units
    that end within ``lookback`` rows of a later slice's start are copied to that slice.
    The row data is shuffled once, by the window that follows.
    """
    if rows_per_slice <= lookback:
        raise ValueError("a slice must be longer than the lookback")
    series = W.partitionBy(by)
    so_far = series.orderBy("_unit")
    units = (
        df.select(by, slice_of(F.col(ts), unit_micros).alias("_unit"))
        .groupBy(by, "_unit")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_size", F.sum("_n").over(series))
        .filter(F.col("_size") > rows_per_slice)
        .withColumn("_end", F.sum("_n").over(so_far))
        .withColumn("_from", F.col("_end") - F.col("_n"))
        .withColumn("_home", F.floor(F.col("_from") / rows_per_slice))
    )
    # Slice starts are at least one slice apart from the next but one, so no unit is needed
    # by more than the two slices after its own.
    next_start = W.partitionBy(by).orderBy("_home")
    slices = units.groupBy(by, "_home").agg(F.min("_from").alias("_start"))
    for step in (1, 2):
        slices = slices.withColumns(
            {
                f"_next{step}": F.lead("_home", step).over(next_start),
                f"_start{step}": F.lead("_start", step).over(next_start),
            }
        )
    needed = [
        F.when(F.col(f"_start{step}") - lookback < F.col("_end"), F.col(f"_next{step}"))
        for step in (1, 2)
    ]
    # Only the time units of long series, so usually empty. Written, so that the join knows
    # its size and a fleet without long series costs no extra shuffle.
    placement = stage(
        units.join(slices, [by, "_home"])
        .withColumn("_slices", F.array_compact(F.array(F.col("_home"), *needed)))
        .select(by, "_unit", "_slices"),
        "slices",
    )
    placed = df.withColumn("_unit", slice_of(F.col(ts), unit_micros)).join(
        placement, [by, "_unit"], "left"
    )
    whole = F.array(F.lit(0).cast("long"))
    return placed.select(
        *df.columns, F.posexplode(F.coalesce("_slices", whole)).alias("_copy", "_slice")
    ).select(*df.columns, "_slice", (F.col("_copy") == 0).alias("_own"))


def rolling_slopes(
    df: DataFrame,
    columns: dict[str, str],
    window: int = READINGS_PER_DAY,
    by: str = "server_id",
    ts: str = "timestamp",
    warmup: float | None = 0.0,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Least-squares slope over the last ``window`` rows, per ``window`` rows.

    ``columns`` maps an output to its input column. Rows without a full window behind them
    get ``warmup``. With S = sum(y) and Q = sum(i*y) over the window, the slope on an evenly
    spaced axis follows from differences of running sums, so the cost per row does not
    depend on the window. Each series is shifted by its first value, which leaves slopes
    unchanged and keeps the sums small; a null inside a window makes its slope null.
    """
    denominator = window * (window**2 - 1) / 12.0
    order = W.partitionBy(by, "_slice").orderBy(ts)
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    sliced = with_slices(df, window - 1, by, ts, rows_per_slice=rows_per_slice)

    steps: dict[str, Column] = {"_i": F.row_number().over(order)}
    for out, source in columns.items():
        y = F.col(source).cast("double")
        steps[f"_y_{out}"] = y - F.first(source, ignorenulls=True).over(running)
        steps[f"_z_{out}"] = F.count(F.when(y.isNull(), 1)).over(running)
    shifted = sliced.withColumns(steps)
    sums: dict[str, Column] = {}
    for out in columns:
        y = F.coalesce(f"_y_{out}", F.lit(0.0))
        sums[f"_s_{out}"] = F.sum(y).over(running)
        sums[f"_q_{out}"] = F.sum(y * F.col("_i")).over(running)
    summed = shifted.withColumns(sums)

    def over_window(name: str, empty: Column) -> Column:
        return F.col(name) - F.coalesce(F.lag(name, window).over(order), empty)

    slopes: dict[str, Column] = {}
    for out in columns:
        total = over_window(f"_s_{out}", F.lit(0.0))
        moment = over_window(f"_q_{out}", F.lit(0.0))
        centre = F.col("_i") - (window - 1) / 2.0
        slope = (moment - centre * total) / F.lit(denominator) * F.lit(float(window))
        clean = over_window(f"_z_{out}", F.lit(0)) == 0
        slopes[out] = F.when(F.col("_i") < window, F.lit(warmup).cast("double")).when(clean, slope)
    result = summed.withColumns(slopes).filter("_own")
    return result.select(*df.columns, *columns)


def rolling_slope(df: DataFrame, column: str, window: int = READINGS_PER_DAY, **options) -> DataFrame:
    """W03 for one column; the result column is ``<column>_slope``."""
    return rolling_slopes(df, {f"{column}_slope": column}, window, **options)


def worst_slopes(
    df: DataFrame, columns: dict[str, str], window: int = READINGS_PER_DAY, by: str = "server_id"
) -> DataFrame:
    """Steepest full-window slope per server (null for a series shorter than a window)."""
    slopes = rolling_slopes(
        df.select(by, "timestamp", *dict.fromkeys(columns.values())), columns, window, by, warmup=None
    )
    return slopes.groupBy(by).agg(*[F.max(out).alias(out) for out in columns])
