"""Continuous ingestion: measurement files as a stream, and late-data-aware means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.meta import meter_inventory
from ..operators.upsert import merge_meter_stats
from ..sources.store import Store, with_partitions


def measurement_stream(spark: SparkSession, folder: str, header: Sequence[str] = ("timestamp_dst", "meter_number", *schemas.MEASUREMENTS), files_per_batch: int = 100) -> DataFrame:
    """New CSV files of a folder as a stream of measurement rows. ``header``: the files' columns in their order."""
    text = spark.readStream.schema(", ".join(f"`{c}` string" for c in header)).options(header=True, enforceSchema=False, maxFilesPerTrigger=files_per_batch).csv(folder)
    values = [F.col(c).try_cast("double").alias(c) for c in header if c in schemas.MEASUREMENTS]
    rows = text.select(F.trim("meter_number").alias("meter_number"), F.try_to_timestamp("timestamp_dst").alias("timestamp"), *values)
    return rows.where("timestamp is not null and meter_number is not null")


def ingest_stream(rows: DataFrame, store: Store, checkpoint: str, dest: str = "raw") -> StreamingQuery:
    """Append every micro-batch to the store and add up meter statistics.

    A batch's statistics are a snapshot named by its number, built on that of the batch before; a batch that runs again
    after a failure replaces its own files and snapshot.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        out = with_partitions(batch).withColumn("batch", F.lit(number))
        out.write.mode("overwrite").partitionBy("dt", "shard").parquet(store.path(dest, f"batch={number}"))
        stats = meter_inventory(batch.select("meter_number", "timestamp"))
        before = store.path("stream_stats", f"batch={number - 1}")
        if number and store.exists("stream_stats", f"batch={number - 1}"):
            stats = merge_meter_stats(batch.sparkSession.read.parquet(before), stats)
        stats.write.mode("overwrite").parquet(store.path("stream_stats", f"batch={number}"))
        batch.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def streaming_means(rows: DataFrame, columns: Sequence[str], minutes: int = 15, late: str = "1 hour", key: str = "meter_number") -> DataFrame:
    """Means over tumbling bins; rows later than the watermark are left out, bins are final once it has passed."""
    binned = rows.withWatermark("timestamp", late).groupBy(key, F.window("timestamp", f"{minutes} minutes"))
    return binned.agg(*(F.avg(c).alias(c) for c in columns)).select(key, F.col("window.start").alias("timestamp"), *columns)
