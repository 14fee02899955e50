"""Batch ingestion of measurement files: staging, promotion, statistics, file index, batch states."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import identity_hash
from ..operators.meta import meter_inventory, workflow_completed
from ..operators.upsert import last_of_each, merge_meter_stats, next_sequence
from ..sources.store import RULES, Store, month_order, scan_measurements, with_partitions

INDEX = "dt string, shard int, seq long, path string, batch_id string, rows long, bytes long, first_seen timestamp, last_seen timestamp, status string, committed_at timestamp"
STATES = "workflow string, completed boolean"
BATCHES = "batch_id string, source string, status string, stats_json string, error_log string"


RULES |= {  # what is added is merged when it is read
    "meter_stats": merge_meter_stats,
    "ingest_batches": lambda rows: last_of_each(rows, ["batch_id"], "_part"),
    "workflow_states": lambda rows: last_of_each(rows, ["workflow"], "_part"),
}


def ingest_files(store: Store, pattern: str, dest: str = "raw", override: bool = False, together: bool = False) -> dict[str, DataFrame | list[str]]:
    """Ingest CSV files in order of month; a file that was ingested before is skipped. Each file is one batch, or, ``together``, all
    new files are one, read by one plan."""
    paths = month_order(store.glob(pattern))
    done = []
    for group in [paths] if together else [[p] for p in paths]:
        done += ingest_batch(store, group, dest, override)
    return {"files": done, "index": store.snapshot("file_index"), "meters": store.snapshot("meter_stats")}


def _table(store: Store, name: str, schema: str) -> DataFrame:
    found = store.snapshot(name)
    return found if found is not None else store.spark.createDataFrame([], schema)


def _step(path: str) -> dict:
    return {"source": path.rsplit("/", 1)[-1]}


def ingest_file(store: Store, path: str, dest: str = "raw", override: bool = False) -> bool:
    """Ingest one file: False if it was ingested before."""
    return bool(ingest_batch(store, [path], dest, override))


def ingest_batch(store: Store, paths: list[str], dest: str = "raw", override: bool = False) -> list[str]:
    """Ingest those of some files that weren't ingested before, as one batch, and return them.

    The batch is recorded as in progress; its rows are staged and moved to the ready folder under names that begin with the
    batch; then its rows of index, statistics, workflow states and batches are added in one commit, whose size doesn't depend on what
    was ingested before. A batch that fails is recorded with its error; one that was lost on the way is found by the
    next try. What either has left is removed, so that a replay counts no row twice.
    """
    states = _table(store, "workflow_states", STATES)
    paths = [p for p in paths if not workflow_completed(states, "ingest", _step(p), override)]
    if not paths:
        return []
    source = ",".join(_step(p)["source"] for p in paths)

    def state(batch: str, status: str, error: str | None = None) -> DataFrame:
        return store.spark.createDataFrame([(batch, source, status, None, error)], BATCHES)

    lost = _table(store, "ingest_batches", BATCHES).where((F.col("source") == source) & (F.col("status") == "in_progress"))
    batch = uuid.uuid4().hex
    begun = state(batch, "in_progress")
    for r in lost.collect():
        clear(store, r.batch_id, dest)
        begun = begun.unionByName(state(r.batch_id, "failed", "lost"))
    store.commit({}, f"{batch}-begun", {"ingest_batches": begun})
    try:
        staging = f"staging/run={batch}"
        store.write_series(with_partitions(scan_measurements(store.spark, paths)), staging)
        finish(store, batch, paths, staging, dest, state(batch, "processed"))
    except Exception as e:
        clear(store, batch, dest)
        store.commit({}, f"{batch}-failed", {"ingest_batches": state(batch, "failed", str(e)[:1000])})
        raise
    return paths


def clear(store: Store, batch: str, dest: str) -> None:
    """Remove what a batch that wasn't committed has left."""
    store.delete(f"staging/run={batch}")
    for left in store.glob(f"{dest}/dt=*/shard=*/{batch}-*"):
        store.at(left).delete()


def finish(store: Store, batch: str, paths: list[str], staging: str, dest: str, processed: DataFrame) -> None:
    """Move a staged batch to the ready folder and commit what it adds."""
    spark = store.spark
    prefix = f"{batch}-"
    store.promote(staging, dest, prefix)
    added = store.glob(f"{dest}/dt=*/shard=*/{prefix}*.parquet")
    steps = [(f"ingest:{identity_hash(_step(p))}", True) for p in paths]
    new = {"ingest_batches": processed, "workflow_states": spark.createDataFrame(steps, STATES)}
    if added:
        rows = spark.read.option("basePath", store.path(dest)).parquet(*added)
        new["meter_stats"] = meter_inventory(rows.select("meter_number", "timestamp"))
        files = rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), F.col("dt").cast("string").alias("dt"), F.col("shard").cast("int").alias("shard")).agg(
            F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), F.count("*").alias("rows")
        )
        index = _table(store, "file_index", INDEX)
        entry = {"batch_id": F.lit(batch), "status": F.lit("ready"), "committed_at": F.current_timestamp()}
        new["file_index"] = next_sequence(files, index, ["dt", "shard"], ["path"]).withColumns(entry).select(*index.columns)
    elif store.snapshot("file_index") is None:
        new["file_index"] = spark.createDataFrame([], INDEX)
    store.commit({}, batch, new)
