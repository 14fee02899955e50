"""Scalar expressions that the operators share."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PHASES, SHARDS

#: Texts that stand for a missing value in mapping files.
MISSING = ("nan", "none", "null", "<na>", "", "other")


def code_number(code: Column) -> Column:
    """``LvFeeder.12`` -> 12; null where no number follows the prefix."""
    return F.regexp_replace(F.trim(code), r"^\D+\.", "").try_cast("bigint")


def code_type(code: Column) -> Column:
    """``LvFeeder.12`` -> ``LvFeeder``."""
    return F.regexp_extract(code, r"^([A-Za-z]+)\.", 1)


def code_suffix(code: Column) -> Column:
    """What follows the first point; null without one."""
    return F.get(F.split(code, r"\.", 2), F.lit(1))


def code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(f"{prefix}."), number.cast("string"))


def zero_to_null(c: Column) -> Column:
    return F.when(c != 0, c)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Stored NaN means missing; Spark orders and compares it as a number, so every scan turns it into null."""
    kinds = dict(df.dtypes)
    names = [c for c in (columns or df.columns) if kinds[c] in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def clean_id(c: Column) -> Column:
    """Whole-number id from text like ``12`` or ``12.0``; missing texts become null."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(~text.isin(*MISSING), text.try_cast("double").cast("bigint"))


def clean_phase(c: Column) -> Column:
    """Upper-case phase name; missing texts become null, any other text than a phase is an error."""
    text = F.upper(F.trim(c.cast("string")))
    valid = [p.upper() for p in PHASES]
    bad = F.raise_error(F.concat(F.lit("Invalid phase value: "), text)).cast("string")
    return F.when(F.lower(text).isin(*MISSING) | text.isNull(), None).when(text.isin(*valid), text).otherwise(bad)


def feature_name(c: Column) -> Column:
    """Column name without its last part: ``voltage_l1_17`` -> ``voltage_l1``."""
    return F.regexp_replace(c, "_[^_]*$", "")


def first_number(c: Column) -> Column:
    return F.regexp_extract(c, r"(-?\d+(?:\.\d+)?)", 1).try_cast("double")


def days_since(c: Column, now: Column | None = None) -> Column:
    return F.datediff(now if now is not None else F.current_timestamp(), c)


def mean_of(columns: list[Column]) -> Column:
    """Mean over columns of one row, nulls left out; null if all are."""
    total = reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0.0)) for c in columns))
    n = reduce(lambda a, b: a + b, (c.isNotNull().cast("int") for c in columns))
    return F.when(n > 0, total / n)


def shard(meter: Column, shards: int = SHARDS) -> Column:
    """The storage shard of a meter: unsigned 64-bit xxHash of its text with seed 0, modulo ``shards``; null for null.

    Spark's own ``xxhash64`` has another seed, so the hash runs in Arrow batches, once for each different id of a batch.
    """

    def number(ids: pd.Series) -> pd.Series:
        import numpy as np
        import xxhash

        codes, different = pd.factorize(ids)
        found = np.array([xxhash.xxh64(m).intdigest() % shards for m in different] + [-1], np.int16)  # null has code -1
        return pd.Series(found[codes]).astype("Int16").mask(codes < 0)

    return F.pandas_udf(number, "smallint")(meter.cast("string"))


def shard_of(meter_ids: DataFrame, shards: int = SHARDS, column: str = "meter_number") -> DataFrame:
    """The storage shard of each distinct meter (see :func:`shard`)."""
    ids = meter_ids.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct()
    return ids.withColumn("shard", shard(F.col(column), shards))


def identity_hash(identity: dict) -> str:
    """First 12 hex digits of the SHA-256 of the sorted JSON of ``identity``."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps(identity, sort_keys=True, default=str).encode()).hexdigest()[:12]
