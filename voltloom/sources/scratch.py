"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []

#: Rows that one task of a join or an aggregation over a large graph gets.
TASK_ROWS = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only on one machine (a ``local`` master, as in tests) a temporary folder takes its place where the setting is absent;
    on a cluster that is an error, as executors wouldn't see the driver's folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not getattr(spark, "_voltloom_dir", None):
            spark._voltloom_dir = "file://" + tempfile.mkdtemp(prefix="voltloom-")
        found = spark._voltloom_dir
    return found.rstrip("/")


def folder(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_dir(spark)}/voltloom-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, never a recomputation of what came before, and every
    later reader sees the same rows. The table goes when the driver ends or :func:`discard` is called.
    """
    spark = df.sparkSession
    path = folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._voltloom_path = path
    return out


def grown(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: it meets the other side in a shuffle, even while it is small enough that Spark
    would send it to every executor by way of the driver."""
    return df.hint("merge")


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal a table of about ``rows`` rows over tasks by keys, so that what a task holds doesn't grow with the table, whatever the number
    of shuffle partitions. Few rows are left to Spark."""
    if rows <= TASK_ROWS:
        return df
    spark = df.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))  # with fewer, a join would shuffle anew
    return df.repartition(max(least, 1 + rows // TASK_ROWS), *keys)


def discard(*frames: DataFrame) -> None:
    """Delete tables of :func:`materialise` that nothing reads any more."""
    for df in frames:
        _delete(df.sparkSession, df._voltloom_path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already; the folder's owner then cleans up
            return
