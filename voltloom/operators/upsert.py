"""Keyed merges on snapshots: an upsert returns the new table, which the caller writes as a new snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .levels import require_unique


def merge(table: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, insert: bool = True, set_: dict[str, Column] | None = None) -> DataFrame:
    """Insert rows with new keys and overwrite the ``update`` columns (all by default) of rows with known ones.

    ``set_`` gives other expressions for columns, over ``old`` and ``new`` structs. Repeated incoming keys are an error.
    """
    require_unique(incoming, keys, "the incoming batch")
    values = [c for c in table.columns if c not in keys]
    update = list(values) if update is None else list(update)
    old = table.select(*keys, F.struct(*values).alias("old"))
    new = incoming.select(*keys, F.struct(*(F.col(c) if c in incoming.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in values)).alias("new"))
    joined = old.join(new, list(keys), "full" if insert else "left")
    out = []
    for c in values:
        if set_ and c in set_:
            out.append(set_[c].alias(c))
        else:
            held = F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) if c in update else F.when(F.col("old").isNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
            out.append(held.alias(c))
    return joined.select(*keys, *out).select(*table.columns)


def insert_missing(table: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows with new keys (one for each key) and leave known ones alone."""
    new = incoming.select(*table.columns).dropDuplicates(list(keys)).join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(new)


def delete(table: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def last_of_each(batch: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key in the order of a column."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return batch.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_meter_stats(*parts: DataFrame) -> DataFrame:
    """Add up meter statistics: earliest first_seen, latest last_seen, summed total_rows. Needs no lookup of old rows."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("meter_number").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("total_rows").alias("total_rows"))


def next_sequence(files: DataFrame, known: DataFrame, ring: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number new files of each ring on from the largest known ``seq``."""
    top = known.groupBy(*ring).agg(F.max("seq").alias("_top"))
    w = Window.partitionBy(*ring).orderBy(*order)
    numbered = files.withColumn("_n", F.row_number().over(w)).join(top, list(ring), "left")
    return numbered.withColumn("seq", F.col("_n") + F.coalesce("_top", F.lit(0))).drop("_n", "_top")


def next_version(versions: DataFrame) -> int:
    return (versions.agg(F.max("version")).first()[0] or 0) + 1


def make_current(versions: DataFrame, version: int) -> DataFrame:
    """Exactly one version is current."""
    return versions.withColumn("is_current", F.col("version") == version)


def latest_version(versions: DataFrame, level: str) -> int:
    """The newest version at a processing level."""
    found = versions.where(F.col("processing_level") == level).agg(F.max("version")).first()[0]
    if found is None:
        raise ValueError(f"no topology version at level {level!r}")
    return found
