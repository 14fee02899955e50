"""Regular time grids: means over tumbling bins, gaps filled with nulls, wide frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import mean_of


def bin_start(ts: Column | str, minutes: int) -> Column:
    """Start of the bin, aligned to the epoch."""
    return F.window(ts, f"{minutes} minutes")["start"]


def resample_mean(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("meter_number",), ts: str = "timestamp", unit: str | int = 15) -> DataFrame:
    """Mean of each column in bins of ``unit``: minutes, 'hour', 'day' or 'week' (from Monday)."""
    start = bin_start(F.col(ts), unit) if isinstance(unit, int) else F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)
    return df.groupBy(*by, start.alias(ts)).agg(*(F.avg(c).alias(c) for c in columns))


def time_bounds(df: DataFrame, by: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    return df.groupBy(*by).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))


def time_grid(bounds: DataFrame, minutes: int = 15, keep: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """Every bin start from ``first_seen`` to ``last_seen``; the first is rounded down to the bin."""
    kind = bounds.schema["first_seen"].dataType
    step = F.expr(f"interval {minutes} minutes")
    first = F.timestamp_seconds(F.floor(F.unix_timestamp("first_seen") / (60 * minutes)) * 60 * minutes).cast(kind)
    return bounds.where("first_seen is not null").select(*keep, F.explode(F.sequence(first, "last_seen", step)).alias(ts))


def on_grid(resampled: DataFrame, grid: DataFrame, by: Sequence[str] = ("meter_number",), ts: str = "timestamp") -> DataFrame:
    """Resampled rows on a grid; bins without rows have null values. A grid without the keys holds for all of them.

    For such a grid only the resampled rows are shuffled: each makes its bin and the empty ones up to its key's next row.
    """
    if set(by) <= set(grid.columns):
        return grid.join(resampled, [*by, ts], "left")
    values = [c for c in resampled.columns if c not in (*by, ts)]
    bins = grid.withColumn("_i", F.dense_rank().over(Window.orderBy(ts)) - 1)  # a calendar: 35,040 bins a year
    size = bins.agg((F.coalesce(F.max("_i"), F.lit(-1)) + 1).alias("_n"))
    rows = resampled.join(F.broadcast(bins.select(ts, "_i").distinct()), ts, "left").crossJoin(F.broadcast(size))
    known = reduce(and_, (F.col(c).isNotNull() for c in by))  # keys that are null have no row of their own, like times off the grid
    rows = rows.select(*by, F.when(known, F.col("_i")).alias("_i"), "_n", *values)
    w = Window.partitionBy(*by).orderBy("_i")  # nulls come first; they only count where their key has nothing else
    last = F.lead(F.lit(True)).over(w).isNull()
    rows = rows.withColumns({"_a": F.when(F.lag("_i").over(w).isNull(), 0).otherwise(F.col("_i")), "_z": F.when(last, F.col("_n")).otherwise(F.lead("_i").over(w)) - 1})
    rows = rows.where(F.col("_i").isNotNull() | (F.col("_z") == F.col("_n") - 1))
    held = F.greatest("_z", "_i")  # rows of one bin are all kept
    rows = rows.select(*by, "_i", *values, F.explode(F.when(F.col("_a") <= held, F.sequence("_a", held))).alias("_at"))
    rows = rows.select(*by, F.col("_at").alias("_i"), *(F.when(F.col("_at") == F.col("_i"), F.col(c)).alias(c) for c in values))
    return rows.join(F.broadcast(bins), "_i").select(*by, *grid.columns, *values)


def wide_frame(df: DataFrame, meters: Sequence[str], columns: Sequence[str], ts: str = "timestamp", key: str = "meter_number") -> DataFrame:
    """One row for each time, one column ``{column}_{meter}`` for each, in the order of ``meters``."""
    aggregates = [F.first(F.when(F.col(key) == m, F.col(c)), ignorenulls=True).alias(f"{c}_{m}") for m in meters for c in columns]
    return df.where(F.col(key).isin(*meters)).groupBy(ts).agg(*aggregates)


def interpolate(df: DataFrame, column: str, by: Sequence[str], order: str) -> DataFrame:
    """Fill nulls of a column linearly between rows of a key, then with the nearest value at the ends."""
    w = Window.partitionBy(*by).orderBy(order)
    place = F.row_number().over(w)
    known = F.when(F.col(column).isNotNull(), F.struct(F.col("_i"), F.col(column).alias("v")))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    out = df.withColumn("_i", place).withColumn("_a", F.last(known, True).over(back)).withColumn("_b", F.first(known, True).over(ahead))
    between = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (F.col("_i") - F.col("_a._i")) / F.nullif(F.col("_b._i") - F.col("_a._i"), F.lit(0))
    return out.withColumn(column, F.coalesce(column, between, "_b.v", "_a.v")).drop("_i", "_a", "_b")


# --- derived quantities ------------------------------------------------------------------------------------------------


def add_current(df: DataFrame, phases: Sequence[str] = ("l1", "l2", "l3"), suffix: str = "") -> DataFrame:
    """``current_lX = (P14 - P23) / V`` for each phase that has all three; null where the voltage is 0."""
    new = {}
    for p in phases:
        names = [f"{q}_{p}{suffix}" for q in ("active_power_p14", "active_power_p23", "voltage")]
        if set(names) <= set(df.columns):
            a, b, v = map(F.col, names)
            new[f"current_{p}{suffix}"] = F.try_divide(a - b, v)
    return df.withColumns(new) if new else df


def add_phase_imbalance(df: DataFrame, phases: Sequence[str] = ("l1", "l2", "l3"), suffix: str = "", keep_current: bool = False) -> DataFrame:
    """Largest deviation of a phase from the mean: of voltage relative to the mean, of current absolute."""
    voltages = [F.col(f"voltage_{p}{suffix}") for p in phases if f"voltage_{p}{suffix}" in df.columns]
    new = {}
    if voltages:
        mean = mean_of(voltages)
        new[f"v_unbalance{suffix}"] = _largest([F.abs(F.try_divide(v - mean, mean)) for v in voltages])
    had = set(df.columns)
    df = add_current(df, phases, suffix)
    currents = [F.col(f"current_{p}{suffix}") for p in phases if f"current_{p}{suffix}" in df.columns]
    if currents:
        mean = mean_of(currents)
        new[f"i_unbalance{suffix}"] = _largest([F.abs(i - mean) for i in currents])
    out = df.withColumns(new) if new else df
    return out if keep_current else out.drop(*(c for c in out.columns if c.startswith("current_") and c not in had))


def _largest(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]
