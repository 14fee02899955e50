"""Meter inventory, file index, batches, workflow states, run results and phase mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clean_id, clean_phase, identity_hash
from .upsert import last_of_each, merge


def meter_inventory(series: DataFrame, ts: str = "timestamp") -> DataFrame:
    return series.groupBy("meter_number").agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("total_rows"))


def series_info(inventory: DataFrame) -> DataFrame:
    """One row: earliest and latest time, and the ids that have rows, in order."""
    return inventory.agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.array_sort(F.collect_list(F.when(F.col("total_rows") > 0, F.col("meter_number")))).alias("meter_ids"))


def with_rows(inventory: DataFrame) -> DataFrame:
    """Ids of meters that have rows, as text, in order."""
    return inventory.where("total_rows > 0").select(F.col("meter_number").cast("string").alias("meter_number")).orderBy("meter_number")


def relative_length(inventory: DataFrame) -> DataFrame:
    """Each meter's rows relative to the largest meter; null where there is none."""
    top = inventory.agg(F.max("total_rows").alias("max_rows"))
    return inventory.crossJoin(F.broadcast(top)).withColumn("relative_length", F.try_divide("total_rows", "max_rows"))


def available(ids: DataFrame, inventory: DataFrame, missing: bool = False) -> DataFrame:
    """Those of ``ids`` that have rows, or with ``missing`` those that don't; null ids are neither."""
    have = inventory.where("total_rows > 0").select(F.col("meter_number").cast("string").alias("meter_number"))
    wanted = ids.where("meter_number is not null").withColumn("meter_number", F.col("meter_number").cast("string"))
    return wanted.join(have, "meter_number", "left_anti" if missing else "left_semi")


def attribute_filter(meters: DataFrame, **wanted: bool | None) -> DataFrame:
    """Meters whose attributes are as wanted; None leaves an attribute free, an unknown (null) one never matches."""
    for name, value in wanted.items():
        if value is not None:
            meters = meters.where(F.col(name) == F.lit(value))
    return meters


def query_results(
    results: DataFrame, equal: dict | None = None, created_from=None, created_to=None, order_by: str | None = None, descending: bool = False, tie: Sequence[str] = ("id",), offset: int = 0, limit: int | None = None
) -> DataFrame:
    """Results that match all given values, in order, a page of them. Paging needs an order, which ``tie`` completes."""
    for name, value in (equal or {}).items():
        if value is not None:
            results = results.where(F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(name) == F.lit(value))
    if created_from is not None:
        results = results.where(F.col("created_at") >= F.lit(created_from))
    if created_to is not None:
        results = results.where(F.col("created_at") <= F.lit(created_to))
    if order_by is not None:
        if order_by not in results.columns:
            raise ValueError(f"can't order by {order_by!r}")
        results = results.orderBy(F.desc(order_by) if descending else F.asc(order_by), *tie)
    elif offset or limit is not None:
        raise ValueError("a page needs an order")
    results = results.offset(offset) if offset else results
    return results.limit(limit) if limit is not None else results


def latest_run(results: DataFrame, by: Sequence[str], run: str = "run_id", created: str = "created_at") -> DataFrame:
    """All rows of the newest run of each key (of equal times, that with the larger run id)."""
    w = Window.partitionBy(*by)
    newest = F.max(F.struct(created, run)).over(w)
    return results.withColumn("_newest", newest).where(F.col(run).eqNullSafe(F.col(f"_newest.{run}"))).drop("_newest")


def clean_phase_mappings(batch: DataFrame, order: str | None = None) -> DataFrame:
    """Phase mappings from a mapper's output: ids and phases cleaned, incomplete rows dropped, the last of each key kept."""
    out = batch.withColumns({
        "meter_id": clean_id(F.col("meter_id")), "sm_phase": clean_phase(F.col("sm_phase")),
        "feeder_id": clean_id(F.col("feeder_id")), "feeder_phase": clean_phase(F.col("feeder_phase")),
        "transformer_id": clean_id(F.col("transformer_id")), "transformer_phase": clean_phase(F.col("transformer_phase")),
    }).where("meter_id is not null and sm_phase is not null")
    return last_of_each(out, ["meter_id", "sm_phase"], order) if order else out


def upsert_phase_mappings(table: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    return merge(table, clean_phase_mappings(batch, order).drop(order), ["meter_id", "sm_phase"])


def phase_mappings_of(results: DataFrame) -> DataFrame:
    """What a phase mapper's rows say of the places of meters' phases, as a batch of mappings. Rows of transformers that couldn't be
    mapped say nothing, so earlier mappings of their meters stay; of a meter under two transformers the larger transformer id counts."""
    said = results.where("status is null or status not like 'failed: %'")
    return said.select("meter_id", "sm_phase", F.col("true_feeder_id").alias("feeder_id"), "feeder_phase", F.col("true_transformer_id").alias("transformer_id"), "transformer_phase", clean_id(F.col("likely_cabinet_id")).alias("likely_cabinet_id"), F.col("transformer_id").alias("said_by"))


def store_phase_results(table: DataFrame, results: DataFrame) -> DataFrame:
    """Upsert a phase mapper's rows into the table of mappings."""
    return upsert_phase_mappings(table, phase_mappings_of(results), "said_by")


def workflow_name(base: str, identity: dict | None = None) -> str:
    return f"{base}:{identity_hash(identity)}" if identity else base


def workflow_completed(states: DataFrame, base: str, identity: dict | None = None, override: bool = False) -> bool:
    """Whether a step is done, under its own name or, for older states, the bare one."""
    if override:
        return False
    names = [workflow_name(base, identity), base]
    return not states.where(F.col("workflow").isin(names) & F.col("completed")).isEmpty()


def mark_workflow(states: DataFrame, base: str, identity: dict | None = None) -> DataFrame:
    row = states.sparkSession.createDataFrame([(workflow_name(base, identity), True)], "workflow string, completed boolean")
    return merge(states, row, ["workflow"])


def set_batch_status(batches: DataFrame, batch_id: str, status: str, **values) -> DataFrame:
    """Move a batch to in_progress, processed or failed, with what belongs to it (stats_json, error_log)."""
    hit = F.col("batch_id") == batch_id
    change = {"status": F.when(hit, F.lit(status)).otherwise(F.col("status"))}
    return batches.withColumns(change | {c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def named_workflows(base: str, identities: DataFrame) -> DataFrame:
    """The rows of ``identities`` with the name of the step that works on each (see :func:`workflow_name`), as ``workflow``."""
    names = list(identities.columns)
    of = F.udf(lambda *values: f"{base}:{identity_hash(dict(zip(names, values, strict=True)))}", "string")
    return identities.withColumn("workflow", of(*names))


def mark_workflows(states: DataFrame, base: str, identities: DataFrame, completed: bool = True) -> DataFrame:
    """Add or update the states of many steps at once; repeated identities count once."""
    new = named_workflows(base, identities.distinct()).select("workflow", F.lit(completed).alias("completed"))
    return merge(states, new, ["workflow"])


def completed_workflows(states: DataFrame, base: str, identities: DataFrame) -> DataFrame:
    """Whether the step of each identity is completed, by its own name or, for all, by the bare one."""
    whole = F.lit(workflow_completed(states.where(F.col("workflow") == base), base, None))
    known = states.where("completed").select("workflow", F.lit(True).alias("_done"))
    out = named_workflows(base, identities).join(known, "workflow", "left")
    return out.select(*identities.columns, "workflow", (F.coalesce("_done", F.lit(False)) | whole).alias("completed"))


def promote_batch(files: DataFrame, batches: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Make a batch's staged files ready and the batch processed; write both as one new snapshot."""
    staged = (F.col("batch_id") == batch_id) & (F.col("status") == "staged")
    return files.withColumn("status", F.when(staged, "ready").otherwise(F.col("status"))), set_batch_status(batches, batch_id, "processed")


def not_yet(ids: DataFrame, done: DataFrame, key: str = "meter_number") -> DataFrame:
    """Ids without an earlier result."""
    return ids.join(done.select(key).distinct(), key, "left_anti")


def merge_labels(loaded: DataFrame, new: DataFrame, key: str = "meter_number") -> DataFrame:
    """Earlier results and new ones; an earlier one wins."""
    return loaded.unionByName(not_yet(new, loaded, key))
