"""Processing levels: quality flags, corrections and phase maps applied to raw series at read time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LEVELS, PHASES, SERIES_KEYS


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Fail if a key occurs twice; a join on it would multiply measurements."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{what} holds repeated keys {tuple(keys)}")
    return df


def apply_quality_flags(raw: DataFrame, flags: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Null every value whose flag is not 0. A value without a flag row is nulled too; columns without flags stay."""
    flagged = [c for c in raw.columns if f"{c}_flag" in flags.columns]
    joined = raw.join(flags.select(*keys, *(f"{c}_flag" for c in flagged)), list(keys), "left")
    values = {c: F.when(F.col(f"{c}_flag") == 0, F.col(c)) for c in flagged}
    return joined.withColumns(values).select(*raw.columns) if flagged else joined.select(*raw.columns)


def apply_corrections(df: DataFrame, corrections: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Fill every null value, whatever made it null, with its correction if there is one."""
    values = [c for c in df.columns if c in corrections.columns and c not in keys]
    joined = df.join(corrections.select(*keys, *(F.col(c).alias(f"{c}_corr") for c in values)), list(keys), "left")
    return joined.withColumns({c: F.coalesce(c, f"{c}_corr") for c in values}).select(*df.columns)


def require_permutation(phase_map: DataFrame) -> DataFrame:
    """Fail unless every row maps the phases onto each other, one to one."""
    targets = F.array_sort(F.array(*(F.lower(f"{p}_maps_to") for p in PHASES)))
    if not phase_map.where(~targets.eqNullSafe(F.array(*map(F.lit, PHASES)))).isEmpty():
        raise ValueError("a phase map must be a permutation of " + ", ".join(PHASES))
    return phase_map


def apply_phase_map(df: DataFrame, phase_map: DataFrame, key: str = "meter_number") -> DataFrame:
    """Move every column that ends in a phase to the phase that it maps to, all at once; unmapped meters stay.

    A map has a row of a few bytes for each meter; Spark broadcasts it while it is small and sorts otherwise.
    """
    joined = df.join(phase_map.select(key, *(F.lower(f"{p}_maps_to").alias(f"_to_{p}") for p in PHASES)), key, "left")
    values = {}
    for c in df.columns:
        stem, _, phase = c.rpartition("_")
        if phase in PHASES and all(f"{stem}_{p}" in df.columns for p in PHASES):
            found = reduce(lambda w, p: w.when(F.col(f"_to_{p}") == phase, F.col(f"{stem}_{p}")), PHASES, F)  # noqa: B023
            values[c] = F.when(F.col("_to_l1").isNull(), F.col(c)).otherwise(found)
    return (joined.withColumns(values) if values else joined).select(*df.columns)


def assemble(
    level: str, raw: DataFrame, flags: DataFrame | None = None, corrections: DataFrame | None = None, phase_map: DataFrame | None = None, keys: Sequence[str] = SERIES_KEYS
) -> DataFrame:
    """Series at a processing level, as one lazy plan."""
    if level not in LEVELS:
        raise ValueError(f"unknown processing level {level!r}")
    if level == "raw":
        return raw
    if flags is None or corrections is None:
        raise FileNotFoundError("flags and corrections are needed for cleaned series")
    out = apply_corrections(apply_quality_flags(raw, flags, keys), corrections, keys)
    if level == "cleaned":
        return out
    if phase_map is None:
        raise FileNotFoundError("a phase map is needed for corrected series")
    return apply_phase_map(out, phase_map, keys[0])
