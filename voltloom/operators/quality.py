"""Data quality, statistics and connectivity of meters, as one windowed plan over all of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schemas import PHASES


@dataclass(frozen=True)
class QualityConfig:
    """Fixed limits of the classifier; ``max_records`` is the expected number of records, by default each meter's own."""

    no_data: float = 0.025
    good: float = 0.1
    medium: float = 0.5
    voltage_limit: float = 207.0
    offset: float = 0.95
    run: int = 192
    frozen: int = 12
    max_records: int | None = None


#: Short names of the quantities in results. Columns are looked up here, never by parts of their names.
VARIABLES = {"V": "voltage", "P14": "active_power_p14", "P23": "active_power_p23", "Q12": "reactive_power_q12", "Q34": "reactive_power_q34"}


def by_phase(series: DataFrame, keep: Sequence[str] = ("meter_number", "timestamp"), variables: dict[str, str] = VARIABLES) -> DataFrame:
    """One row for each key and phase with a column for each variable (lower-case short name)."""
    entries = [F.struct(F.lit(p).alias("phase"), *(F.col(f"{c}_{p}").cast("double").alias(v.lower()) for v, c in variables.items())) for p in PHASES]
    return series.select(*keep, F.explode(F.array(*entries)).alias("_p")).select(*keep, "_p.*")


def frozen(value: Column, w: WindowSpec, length: int) -> Column:
    """Whether a value equals each of the ``length - 1`` before it."""
    frame = w.rowsBetween(-(length - 1), 0)
    return F.coalesce((F.count(value).over(frame) == length) & (F.min(value).over(frame) == F.max(value).over(frame)), F.lit(False))


def run_lengths(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Runs of equal neighbouring values (null equals null): ``run`` number from 1, value, length, first place."""
    w = Window.partitionBy(*by).orderBy(*order)
    change = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    marked = df.withColumn("_change", change).withColumn("run", F.sum("_change").over(w))
    return marked.groupBy(*by, "run").agg(F.first(value).alias(value), F.count("*").alias("length"), F.min(F.struct(*order)).alias("first"))


def voltage_states(phases: DataFrame, cfg: QualityConfig = QualityConfig(), by: Sequence[str] = ("meter_number", "phase"), order: str = "timestamp") -> DataFrame:
    """Which voltages are missing, zero, low, frozen, corrupt, usable, or usable but low."""
    w = Window.partitionBy(*by).orderBy(order)
    v = F.col("v")
    out = phases.withColumns({"is_null": v.isNull(), "is_zero": F.coalesce(v == 0, F.lit(False)), "is_low": F.coalesce(v < cfg.voltage_limit, F.lit(False)), "is_frozen": frozen(v, w, cfg.frozen)})
    has = ~F.col("is_null") & ~F.col("is_zero") & ~F.col("is_frozen")
    out = out.withColumns({"is_corrupt": F.expr("is_null or is_zero or is_low or is_frozen"), "has_data": has})
    return out.withColumn("is_offset", F.col("is_low") & F.col("has_data"))


def _share(c: str | Column) -> Column:
    return F.avg((F.col(c) if isinstance(c, str) else c).cast("double"))


def quality_fractions(states: DataFrame, by: Sequence[str] = ("meter_number", "phase"), variables: Sequence[str] = ("p14", "p23", "q12", "q34")) -> DataFrame:
    """Shares of each state, null shares of the other variables, and the counts that the summaries need."""
    shares = {"null_frac": "is_null", "zero_frac": "is_zero", "low_frac": "is_low", "frozen_frac": "is_frozen", "corrupt_frac": "is_corrupt", "has_frac": "has_data", "offset_frac": "is_offset"}
    others = [_share(F.col(v).isNull()).alias(f"{v}_null_frac") for v in variables if v in states.columns]
    return states.groupBy(*by).agg(F.count("*").alias("records"), F.count_if("has_data").alias("usable"), *(_share(c).alias(n) for n, c in shares.items()), *others)


def summary(share: Column, usable: Column, records: Column, cfg: QualityConfig) -> Column:
    """Good, Medium or Bad by the share of bad values; 'NaN' for a phase with hardly any data."""
    grade = F.when(share < cfg.good, "Good").when(share < cfg.medium, "Medium").otherwise("Bad")
    return F.when(usable < cfg.no_data * records, "NaN").otherwise(grade)


def quality_summary(fractions: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    records = F.lit(cfg.max_records) if cfg.max_records else F.col("records")
    graded = {"v_summary": summary(F.col("corrupt_frac"), F.col("usable"), records, cfg)}
    for c in fractions.columns:
        if c.endswith("_null_frac"):
            graded[f"{c.removesuffix('_null_frac')}_summary"] = summary(F.col(c), F.col("usable"), records, cfg)
    return fractions.withColumns(graded)


def connectivity(states: DataFrame, fractions: DataFrame, cfg: QualityConfig = QualityConfig(), by: Sequence[str] = ("meter_number", "phase"), order: str = "timestamp") -> DataFrame:
    """Per phase: connected, connection error (a constant offset), and switching (long runs both with and without voltage)."""
    records = F.lit(cfg.max_records) if cfg.max_records else F.col("records")
    longest = None
    for name, state in (("on", "has_data"), ("off", "is_zero")):
        runs = run_lengths(states.select(*by, order, state), state, by, [order]).where(state)
        runs = runs.groupBy(*by).agg(F.max("length").alias(f"longest_{name}"))
        longest = runs if longest is None else longest.join(runs, list(by), "full")
    out = fractions.join(longest, list(by), "left")
    connected = F.col("usable") > cfg.no_data * records
    error = connected & (F.try_divide(F.col("offset_frac"), F.col("has_frac")) > cfg.offset)
    switching = connected & (F.coalesce("longest_on", F.lit(0)) >= cfg.run) & (F.coalesce("longest_off", F.lit(0)) >= cfg.run)
    return out.withColumns({"connected": connected, "connection_error": F.coalesce(error, F.lit(False)), "switching": switching}).drop("longest_on", "longest_off")


def phase_statistics(phases: DataFrame, by: Sequence[str] = ("meter_number", "phase"), variables: Sequence[str] = ("v", "p14", "p23", "q12", "q34")) -> DataFrame:
    """Minimum, maximum, mean and sample deviation of each variable, nulls left out."""
    named = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}
    return phases.groupBy(*by).agg(*(f(v).alias(f"{v}_{n}") for v in variables if v in phases.columns for n, f in named.items()))


def trim(series: DataFrame, columns: Sequence[str], by: Sequence[str] = ("meter_number",), order: str = "timestamp") -> DataFrame:
    """Drop rows before the first and after the last that have any value of ``columns`` that is neither null nor 0."""
    some = F.coalesce(*(F.when(F.col(c) != 0, 1) for c in columns)).isNotNull()
    w = Window.partitionBy(*by)
    out = series.withColumns({"_a": F.min(F.when(some, F.col(order))).over(w), "_z": F.max(F.when(some, F.col(order))).over(w)})
    return out.where(F.col(order).between(F.col("_a"), F.col("_z"))).drop("_a", "_z")


def classify_meters(series: DataFrame, meters: DataFrame | None = None, cfg: QualityConfig = QualityConfig(), trim_to: Sequence[str] | None = None) -> DataFrame:
    """Characterisation of every meter: quality and statistics by phase and variable, and lists of phases.

    ``meters`` (``meter_number``) lists the meters wanted; those without data get a record of nulls. Rows are ordered by
    time before anything that depends on order; they are not trimmed unless ``trim_to`` names measurement columns.
    """
    series = trim(series, trim_to) if trim_to else series
    phases = by_phase(series)
    states = voltage_states(phases, cfg)
    fractions = quality_fractions(states)
    joined = connectivity(states, quality_summary(fractions, cfg), cfg).join(phase_statistics(phases), ["meter_number", "phase"])
    variables = [v.lower() for v in VARIABLES]
    record = F.struct(
        F.struct(F.struct(F.col("v_summary").alias("summary"), *(F.col(f"{c}_frac") for c in ("null", "zero", "low", "frozen", "corrupt"))).alias("v"),
                 *(F.struct(F.col(f"{v}_summary").alias("summary"), F.col(f"{v}_null_frac").alias("null_frac")).alias(v) for v in variables[1:])).alias("quality"),
        F.struct(*(F.struct(*(F.col(f"{v}_{n}").alias(n) for n in ("min", "max", "mean", "std"))).alias(v) for v in variables)).alias("statistics"),
    )
    lists = [F.array_sort(F.collect_list(F.when(F.col(c), F.upper("phase")))).alias(n) for c, n in (("connected", "connected_phases"), ("connection_error", "connection_errors"), ("switching", "switching_phases"))]
    out = joined.groupBy("meter_number").agg(F.map_from_entries(F.collect_list(F.struct(F.upper("phase"), record))).alias("phases"), *lists)
    return meters.select("meter_number").distinct().join(out, "meter_number", "left") if meters is not None else out


#: Categories of plots: which phases of a record make a meter part of one. ``p`` runs over the phases.
def plot_categories(records: DataFrame) -> DataFrame:
    """The categories that each meter's record falls in (``meter_number``, ``category``)."""
    grades = F.transform(F.map_values("phases"), lambda p: p["quality"]["v"]["summary"])
    n = F.size("connected_phases")
    categories = {
        "all_good": F.forall(grades, lambda g: g == "Good"),
        "any_medium": F.exists(grades, lambda g: g == "Medium"),
        "any_bad": F.exists(grades, lambda g: g == "Bad"),
        "any_nan": F.exists(grades, lambda g: g == "NaN"),
        "with_1_phase_connection": n == 1,
        "with_2_phase_connection": n == 2,
        "with_3_phase_connection": n == 3,
        "no_connection": n == 0,
        "with_connection_error": F.size("connection_errors") > 0,
        "with_switching_phase": F.size("switching_phases") > 0,
    }
    found = F.explode(F.array_compact(F.array(*(F.when(c, k) for k, c in categories.items()))))
    return records.where("phases is not null").select("meter_number", found.alias("category"))
