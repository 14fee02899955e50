"""Which meters belong to which cabinet, feeder, transformer, substation and zip code, and extraction by entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import code_number, code_suffix
from .meta import attribute_filter, available
from .resample import add_current, add_phase_imbalance, on_grid, resample_mean, time_bounds, time_grid, wide_frame

LEVELS = {"cabinet": "cabinet", "feeder": "lv_feeder", "transformer": "transformer", "secondary_substation": "secondary_substation", "zip": "zip_code"}


def cabinet_mapping(meter_rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """Meters of each cabinet: all, those with data, those without. Repeated rows are kept; lists are in order."""
    rows = meter_rows.where("cabinet is not null and meter_number is not null")
    rows = rows.select(F.get(F.split("cabinet", r"\."), F.lit(1)).alias("cabinet"), F.col("meter_number").cast("string").alias("meter_number"))
    have = inventory.where("total_rows > 0").select(F.col("meter_number").cast("string").alias("meter_number"), F.lit(True).alias("_has")).distinct()
    meter, has = F.col("meter_number"), F.col("_has").isNotNull()
    lists = [F.array_sort(F.collect_list(x)).alias(n) for n, x in (("meters", meter), ("available", F.when(has, meter)), ("missing", F.when(~has, meter)))]
    return rows.join(have, "meter_number", "left").groupBy("cabinet").agg(*lists)


def hierarchy(topology: DataFrame, meter_rows: DataFrame) -> DataFrame:
    """Long form of the nested mapping: one row for each meter and place, ids as text. Rows without a zip code are left out.

    A feeder's cabinets are the cabinets at either end of its edges.
    """
    last = lambda c: F.element_at(F.split(c, r"\."), -1)
    edges = topology.where("zip_code_secondary_substation is not null")
    ends = edges.select(
        F.col("zip_code_secondary_substation").cast("string").alias("zip_code"), last("secondary_substation").alias("secondary_substation"), last("transformer").alias("transformer"),
        last("lv_feeder").alias("lv_feeder"), F.explode(F.array("node1", "node2")).alias("end"),
    )
    places = ends.where(F.col("end").startswith("Cabinet.")).withColumn("cabinet", last("end")).drop("end").distinct()
    meters = meter_rows.where("cabinet is not null and meter_number is not null").select(last("cabinet").alias("cabinet"), F.col("meter_number").cast("string").alias("meter_number")).distinct()
    return places.join(meters, "cabinet", "left")


def nested_json(long: DataFrame) -> DataFrame:
    """The hierarchy as one JSON text for each zip code: substation, transformer, feeder, cabinet, meters."""
    out = long.groupBy("zip_code", "secondary_substation", "transformer", "lv_feeder", "cabinet").agg(F.array_sort(F.collect_set("meter_number")).alias("v"))
    for level in ("cabinet", "lv_feeder", "transformer", "secondary_substation"):
        rest = [c for c in ("zip_code", "secondary_substation", "transformer", "lv_feeder", "cabinet") if c in out.columns and c != level]
        out = out.groupBy(*rest).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(level, "v")), lambda a, b: F.when(a[level] < b[level], -1).when(a[level] > b[level], 1).otherwise(0))).alias("v"))
    return out.select("zip_code", F.to_json("v").alias("mapping"))


def reverse_mapping(long: DataFrame) -> DataFrame:
    """Where each meter is; of several places the last in order."""
    place = F.struct("zip_code", "secondary_substation", "transformer", "lv_feeder", "cabinet")
    return long.where("meter_number is not null").groupBy("meter_number").agg(F.max(place).alias("p")).select("meter_number", "p.*")


def lists_by_level(long: DataFrame, level: str) -> DataFrame:
    """Sorted distinct meters of each entity of a level."""
    column = LEVELS[level]
    return long.groupBy(column).agg(F.array_sort(F.collect_set("meter_number")).alias("meters"))


def entity_meters(long: DataFrame, inventory: DataFrame, level: str, entity: str, explicit: Sequence[str] | None = None, compat_suffix: bool = False) -> DataFrame:
    """Meters with data under an entity, or an explicit list. An unknown entity is an error.

    Ids are compared whole; ``compat_suffix`` also takes ids that end in the wanted one.
    """
    spark = long.sparkSession
    if explicit is not None:
        if any(m is None for m in explicit):
            raise ValueError("a meter list holds missing ids")
        return spark.createDataFrame([(str(m),) for m in explicit], "meter_number string")
    column = F.col(LEVELS[level])
    under = long.where(column == str(entity))
    if under.isEmpty():
        raise ValueError(f"{level} {entity} does not exist")
    if compat_suffix:
        under = long.where(column.endswith(str(entity)))
    return available(under.select("meter_number").distinct(), inventory)


def extract(series: DataFrame, meters: DataFrame, columns: Sequence[str], inventory: DataFrame, with_current: bool = False, with_imbalance: bool = False, minutes: int = 15) -> DataFrame:
    """Long extraction: 15-minute means of the meters on one grid over all of the inventory, with derived quantities.

    Wide frames come from :func:`extract_wide`; up to there rows stay long and the plan has no loop over meters.
    """
    chosen = series.join(meters.select("meter_number").distinct(), "meter_number", "left_semi")
    means = resample_mean(chosen, columns, unit=minutes)
    grid = time_grid(inventory.agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")), minutes)
    out = on_grid(means, grid)
    if with_imbalance:
        return add_phase_imbalance(out, keep_current=with_current)
    return add_current(out) if with_current else out


def extract_wide(long: DataFrame, meters: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return wide_frame(long, meters, columns)


def extract_attribute(series: DataFrame, meters: DataFrame, inventory: DataFrame, columns: Sequence[str], **wanted: bool | None) -> DataFrame:
    """Extraction of all meters with an attribute (heat pump, solar panel) that have data."""
    ids = attribute_filter(meters, **wanted).select(F.col("meter_number").cast("string").alias("meter_number"))
    return extract(series, available(ids, inventory), columns, inventory)


def transformer_ids(exported: DataFrame) -> DataFrame:
    """Distinct transformer ids of an exported topology."""
    return exported.select(code_suffix(F.col("transformer")).alias("transformer")).where("transformer is not null").distinct()


def unconnected_phases(records: DataFrame) -> DataFrame:
    """Column labels of phases that a record doesn't list as connected. records: meter_number, connected_phases,
    cabinet_id, feeder_id; a missing cabinet is written 'nan'."""
    gone = F.array_except(F.array(*(F.lit(p) for p in ("L1", "L2", "L3"))), F.coalesce("connected_phases", F.array().cast("array<string>")))
    parts = [F.lit("voltage"), F.lower("phase"), F.col("meter_number").cast("string"), F.coalesce(F.col("cabinet_id").cast("string"), F.lit("nan")), F.col("feeder_id").cast("string")]
    return records.withColumn("phase", F.explode(gone)).select("meter_number", F.concat_ws("_", *parts).alias("label"))


def series_bounds(series: DataFrame) -> DataFrame:
    return time_bounds(series, ["meter_number"])


def cabinet_ids(meter_rows: DataFrame) -> DataFrame:
    return meter_rows.select(code_number(F.col("cabinet")).alias("cabinet_id")).where("cabinet_id is not null").distinct()
