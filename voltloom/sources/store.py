"""Storage: layered Parquet series, CSV and JSON scans, file listings, and their sinks.

Paths are URIs of any file system that Hadoop knows; nothing is opened by the driver's own file functions.
"""

from __future__ import annotations

import json
import logging
import os
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scalar import nan_to_null, shard
from .footers import read_footers
from .scratch import materialise

#: Names of back ends and the URI schemes they stand for.
BACKENDS = {"s3": "s3a", "minio": "s3a", "azure": "abfss", "az": "abfss", "azure_blob": "abfss", "local": "file", "file": "file"}
LAYERS = ("raw", "flags", "corrections", "phase_map")
#: Files moved at once.
MOVERS = 12
#: Every so many commits an entry of the log names whole tables, and tables of several parts are written as one.
COMPACT = 32
#: Seconds after which a number that a writer has claimed without using it may be claimed again.
CLAIM = 600
#: How the parts of a table become its rows, by the table's name; others are the union of their parts. The rows have ``_part``, which
#: rises with the commits.
RULES: dict[str, Callable[[DataFrame], DataFrame]] = {}

_log = logging.getLogger(__name__)


def resolve_backend(backend: str | None = None, env: Sequence[str] = ("STORAGE_BACKEND", "OBJECT_STORAGE_BACKEND")) -> str:
    """URI scheme of a back end: the argument, else the first variable of the environment that is set, else S3."""
    name = (backend or next(filter(None, map(os.environ.get, env)), None) or "s3").lower()
    if name not in BACKENDS:
        raise ValueError(f"unknown storage backend {name!r}")
    return BACKENDS[name]


@dataclass(frozen=True)
class Store:
    """A base path with a folder for each layer."""

    spark: SparkSession
    base: str

    def at(self, base: str) -> Store:
        return Store(self.spark, base.rstrip("/"))

    def path(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *(p.strip("/") for p in parts)])

    # --- files -----------------------------------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def exists(self, *parts: str) -> bool:
        fs, p = self._hadoop(self.path(*parts))
        return bool(fs.exists(p))

    def glob(self, pattern: str) -> list[str]:
        """Paths below the base that match, in order."""
        fs, p = self._hadoop(self.path(pattern))
        return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))

    def delete(self, *parts: str) -> bool:
        fs, p = self._hadoop(self.path(*parts))
        return bool(fs.delete(p, True))

    def copy(self, source: str, target: str) -> None:
        fs, p = self._hadoop(source)
        to, q = self._hadoop(target)
        jvm = self.spark.sparkContext._jvm
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, q, False, self.spark.sparkContext._jsc.hadoopConfiguration())

    def files(self, *parts: str) -> DataFrame:
        """Parquet files below a folder: path, bytes, and the date and shard in the path."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.path(*parts))
        dt, shard = F.regexp_extract("path", r"dt=([^/]+)", 1), F.regexp_extract("path", r"shard=(\d+)", 1)
        return found.select("path", F.col("length").alias("bytes"), F.nullif(dt, F.lit("")).alias("dt"), shard.try_cast("int").alias("shard"))

    def file_stats(self, *parts: str, ts: str = "timestamp") -> DataFrame:
        """Rows, bytes and earliest and latest time of every file, from footers that executors read. Files whose footers don't tell
        the times, as other writers' may not, are scanned for them."""
        path = self.path(*parts)
        found = materialise(read_footers(self.spark, path, ts), "footers")
        out = found.select("path", "bytes", "first_seen", "last_seen", "rows", "row_groups", "dt", "shard")
        if found.where("not known and rows > 0").isEmpty():
            return out
        name = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///").alias("path")
        scanned = self.spark.read.parquet(path).groupBy(name).agg(F.min(ts).cast("timestamp").alias("a"), F.max(ts).cast("timestamp").alias("z"))
        out = out.join(scanned, "path", "left").withColumns({"first_seen": F.coalesce("first_seen", "a"), "last_seen": F.coalesce("last_seen", "z")})
        return out.drop("a", "z")

    # --- scans -----------------------------------------------------------------------------------------------------------

    def parquet(self, *parts: str) -> DataFrame:
        return nan_to_null(self.spark.read.parquet(self.path(*parts)))

    def layer(self, name: str) -> DataFrame:
        """A layer's table; its folders may nest date and shard either way."""
        if name not in LAYERS:
            raise ValueError(f"unknown layer {name!r}")
        return self.parquet(name)

    def series(self, meters: Sequence[str] | DataFrame | None = None, first=None, last=None, layer: str = "raw") -> DataFrame:
        """Series of some meters. Few ids become a pushed-down filter with their shards pruned, a table a semi-join."""
        df = self.layer(layer)
        if first is not None:
            df = df.where(F.col("dt") >= F.lit(str(first)[:10])).where(F.col("timestamp") >= F.lit(first))
        if last is not None:
            df = df.where(F.col("dt") <= F.lit(str(last)[:10])).where(F.col("timestamp") <= F.lit(last))
        if meters is None:
            return df
        if isinstance(meters, DataFrame):
            return df.join(meters.select("meter_number").distinct(), "meter_number", "left_semi")
        import xxhash

        ids = [str(m) for m in meters]
        shards = sorted({xxhash.xxh64(m).intdigest() % schemas.SHARDS for m in ids})
        return df.where(F.col("shard").isin(shards) & F.col("meter_number").isin(ids))

    def csv(self, *parts: str, schema=None, columns: Sequence[str] | None = None, **options) -> DataFrame:
        """A CSV scan with a given schema, or all text."""
        reader = self.spark.read.options(header=True, **options)
        df = (reader.schema(schema) if schema is not None else reader).csv(self.path(*parts))
        return df.select(*columns) if columns else df

    def typed_csv(self, schema, *parts: str) -> DataFrame:
        """A flat file in declared types, columns by name; numbers and flags that don't parse are null."""
        text = self.csv(*parts)
        out = []
        for f in schema:
            c = F.trim(F.col(f.name)) if f.name in text.columns else F.lit(None).cast("string")
            kind = f.dataType.simpleString()
            if kind == "boolean":
                c = F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False)
            elif kind == "bigint":
                c = c.try_cast("double").cast("bigint")
            elif kind != "string":
                c = c.try_cast(kind)
            out.append(c.alias(f.name))
        return text.select(*out)

    def topology_csv(self, *parts: str) -> DataFrame:
        return self.typed_csv(schemas.TOPOLOGY, *parts)

    def meter_cabinet_csv(self, *parts: str) -> DataFrame:
        return self.typed_csv(schemas.METER_CABINET, *parts)

    def weather_csv(self, *parts: str, time_format: str = "dd/MM/yyyy HH:mm") -> DataFrame:
        """Hourly temperature; the day comes first in the time's text."""
        df = self.csv(*parts)
        return df.select(F.try_to_timestamp("DateTime", F.lit(time_format)).alias("timestamp"), F.col("T").try_cast("double").alias("T")).where("timestamp is not null")

    def json(self, *parts: str):
        """A JSON document; None if it is absent or, with a log entry, broken."""
        if not self.exists(*parts):
            *folder, name = parts
            if not self.exists(*folder, name + ".old"):  # a writer was lost between its two moves
                return None
            parts = (*folder, name + ".old")
        try:
            return json.loads(self._text(*parts))
        except ValueError as e:
            _log.warning("%s is no JSON: %s", self.path(*parts), e)
            return None

    def _text(self, *parts: str) -> str:
        found = self.spark.read.text(self.path(*parts), wholetext=True).first()
        return found[0] if found else ""

    def meters_by_folder(self, *parts: str) -> DataFrame:
        """Meters of a store with a folder for each (``meter_number=...``)."""
        names = [m[1] for p in self.glob("/".join([*parts, "meter_number=*"])) if (m := re.search(r"meter_number=([^/]+)$", p))]
        return self.spark.createDataFrame([(n,) for n in sorted(names)], "meter_number string")

    # --- sinks -----------------------------------------------------------------------------------------------------------

    def write_series(self, df: DataFrame, *parts: str, mode: str = "append", row_group: int = 1_000_000) -> None:
        """Series by date and shard, sorted by meter and time within files. Rows of a date and shard come together; what is larger
        than a task should hold is split at run time, what is small is put together."""
        df = df.hint("rebalance", "dt", "shard").sortWithinPartitions("dt", "shard", "meter_number", "timestamp")
        with self._times_with_statistics():
            df.write.mode(mode).option("compression", "zstd").option("parquet.block.row.count.limit", row_group).partitionBy("dt", "shard").parquet(self.path(*parts))

    @contextmanager
    def _times_with_statistics(self) -> Iterator[None]:
        """Write times as whole numbers, so that footers tell the earliest and latest."""
        conf, key = self.spark.conf, "spark.sql.parquet.outputTimestampType"
        before = conf.get(key)
        conf.set(key, "TIMESTAMP_MICROS")
        try:
            yield
        finally:
            conf.set(key, before)

    def write_layer(self, df: DataFrame, name: str) -> None:
        """Replace flags or corrections, nested by shard, then date."""
        df.hint("rebalance", "shard", "dt").write.mode("overwrite").option("compression", "zstd").partitionBy("shard", "dt").parquet(self.path(name))

    def write_parquet(self, df: DataFrame, *parts: str, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
        df.write.mode(mode).partitionBy(*by).parquet(self.path(*parts))

    def write_bucketed(self, df: DataFrame, *parts: str, by: Sequence[str], buckets: int) -> DataFrame:
        """Replace a table dealt into buckets by keys and sorted by them. Tables with the same keys and number of buckets join, and
        aggregate by the keys, without a shuffle: raw series, flags and corrections are dealt once, when they are written. A
        bucket is what one task reads, so their number goes with the largest layer."""
        path = self.path(*parts)
        name = f"voltloom_{uuid.uuid4().hex}"
        writer = df.repartition(buckets, *by).write.mode("overwrite").option("compression", "zstd").option("path", path)
        writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
        self.write_json({"by": list(by), "buckets": buckets, "columns": df.schema.jsonValue()}, *parts[:-1], f"{parts[-1]}.buckets.json")
        return self.spark.table(name)

    def bucketed(self, *parts: str) -> DataFrame:
        """A table of :meth:`write_bucketed`, with its buckets known to Spark in any session."""
        layout = self.json(*parts[:-1], f"{parts[-1]}.buckets.json")
        if layout is None:
            raise FileNotFoundError(f"{self.path(*parts)} holds no bucketed table")
        name, keys = f"voltloom_{uuid.uuid4().hex}", ", ".join(f"`{c}`" for c in layout["by"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(layout["columns"]))
        self.spark.sql(f"create table {name} ({columns}) using parquet location '{self.path(*parts)}' clustered by ({keys}) sorted by ({keys}) into {int(layout['buckets'])} buckets")
        return self.spark.table(name)

    def write_json(self, data, *parts: str) -> None:
        """One JSON document; it is written beside its place and moved there, so that no reader sees a part of it. The document before
        stays beside it until the new one is in place: a reader that finds none takes that one."""
        fs, p = self._hadoop(self.path(*parts))
        beside, (_, old) = self._beside(data, p), self._hadoop(self.path(*parts) + ".old")
        if fs.exists(p):
            fs.delete(old, False)
            fs.rename(p, old)
        if not fs.rename(beside, p):
            raise OSError(f"could not write {p.toString()}")
        fs.delete(old, False)

    def _beside(self, data, place):
        """Write a JSON document under another name in the folder of its place."""
        fs, p = self._hadoop(f"{place.getParent().toString()}/.{place.getName()}-{uuid.uuid4().hex}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(data, indent=2, default=str).encode()))
        finally:
            out.close()
        return p

    def commits(self) -> list[str]:
        """The log, oldest entry first: files that are never changed. An entry tells which parts commits add to tables or put in
        their place; every ``COMPACT``-th names all parts of all tables, and entries before the last but one of those are gone."""
        return self.glob("_commits/[0-9]*.json")

    def _entry(self, path: str) -> dict:
        return json.loads(self._text("_commits", path.rsplit("/", 1)[-1]))

    def current(self) -> dict[str, list[str]]:
        """The parts of every table. At most ``COMPACT`` entries are read, however long the log has become. A broken entry of the
        log is an error, never an empty store."""
        entries: list[dict] = []
        for path in reversed(self.commits()):
            entries.append(self._entry(path))
            if entries[-1].get("whole"):
                break
        tables: dict[str, list[str]] = {}
        for e in reversed(entries):
            tables |= e["tables"]
            for name, part in e.get("added", {}).items():
                tables[name] = [*tables.get(name, []), part]
        return tables

    def commit(self, frames: dict[str, DataFrame], snapshot: str, added: dict[str, DataFrame] | None = None) -> None:
        """Put ``frames`` in the place of tables and add the rows of ``added`` to tables; readers see all of it at once or nothing.

        Parts are written first; then one log entry names them. Its number is claimed by a file that only one writer can create,
        and the entry is written beside its place and moved there. What a commit writes is in proportion to its own rows; the parts of
        a table are put together by every ``COMPACT``-th commit.
        """
        log, tables, added = self.commits(), self.current(), added or {}
        number = int(log[-1].rsplit("/", 1)[-1].removesuffix(".json")) + 1 if log else 1
        part = f"{number:020d}-{snapshot}"
        whole = number % COMPACT == 0
        if whole:
            frames = dict(frames)
            for name, held in tables.items():
                if name not in frames and len(held) + (name in added) > 1:
                    rows = self._rows(name, held)
                    frames[name] = self._ruled(name, rows.unionByName(added[name].withColumn("_part", F.lit(part))) if name in added else rows)
            added = {n: df for n, df in added.items() if n not in frames}
        for name, df in (frames | added).items():
            df.write.mode("errorifexists").parquet(self.path(name, part))
        entry = {"tables": {name: [part] for name in frames}, "added": dict.fromkeys(added, part)}
        if whole:
            entry = {"whole": True, "tables": tables | {n: [*tables.get(n, []), part] for n in added} | entry["tables"]}
        fs, p = self._hadoop(self.path("_commits", f"{number:020d}.json"))
        beside = self._beside(entry, p)
        if not self._claim(fs, p) or fs.exists(p) or not fs.rename(beside, p):
            fs.delete(beside, False)
            raise RuntimeError(f"another writer has committed {p.getName()}")
        if whole:
            for old in log:
                if int(old.rsplit("/", 1)[-1].removesuffix(".json")) < number - COMPACT:
                    fs.delete(self._hadoop(old)[1], False)

    def _claim(self, fs, place) -> bool:
        """Claim an entry's number, by creating a file exclusively; a claim that has been left unused for long is followed by the next."""
        folder, name = place.getParent().toString(), place.getName()
        for nth in range(100):
            _, p = self._hadoop(f"{folder}/.{name}.{nth}.claim")
            try:
                fs.create(p, False).close()
                return True
            except Exception as e:  # noqa: BLE001  only what says that the file is there
                if not fs.exists(p):
                    raise
                _log.info("%s is claimed: %s", name, e)
            if time.time() - fs.getFileStatus(p).getModificationTime() / 1000 < CLAIM:
                return False
        return False

    def _rows(self, name: str, parts: list[str]) -> DataFrame:
        """The rows of all parts with the name of their part."""
        df = self.spark.read.parquet(*(self.path(name, p) for p in parts))
        return df.withColumn("_part", F.regexp_extract(F.col("_metadata.file_path"), rf"/{name}/([^/]+)/[^/]*$", 1))

    def _ruled(self, name: str, rows: DataFrame) -> DataFrame:
        return (RULES[name](rows) if name in RULES else rows).drop("_part")

    def write_snapshot(self, df: DataFrame, name: str, snapshot: str) -> None:
        """A table's new snapshot: readers see the old or the new one."""
        self.commit({name: df}, snapshot)

    def snapshot(self, name: str) -> DataFrame | None:
        """A table's rows, by the rule for its parts; None if it was never written."""
        found = self.current().get(name)
        return self._ruled(name, self._rows(name, found)) if found else None

    def promote(self, staging: str, ready: str, prefix: str = "") -> list[str]:
        """Move staged files to the ready folder, keeping date and shard and setting ``prefix`` before their names, some at a
        time; then drop the staging folder. Files that an earlier try has moved stay where they are."""

        def move(source: str) -> str:
            *place, name = source.split("/")[-3:]
            target = self.path(ready, *place, prefix + name)
            fs, p = self._hadoop(source)
            _, q = self._hadoop(target)
            fs.mkdirs(q.getParent())
            if not fs.rename(p, q):
                raise OSError(f"could not move {source}")
            return target

        with ThreadPoolExecutor(MOVERS) as movers:
            moved = list(movers.map(move, self.glob(f"{staging}/dt=*/shard=*/*.parquet")))
        if self.exists(staging):
            self.delete(staging)
        return moved


def month_order(paths: Sequence[str]) -> list[str]:
    """CSV files by the year and month in their names; other names last."""

    def key(path: str) -> tuple:
        m = re.search(r"(\d{4})_(\d{1,2})(?=\.csv$)", path)
        return (0, int(m[1]), int(m[2]), path) if m else (1, 0, 0, path)

    return sorted(paths, key=key)


def scan_measurements(spark: SparkSession, path: str | Sequence[str], ts: str = "timestamp_dst", keep_bad: bool = False) -> DataFrame:
    """Measurement rows of CSV files. Everything is read as text first, so ids keep their form; times without zone are
    UTC; rows with bad times or without a meter are left out."""
    text = spark.read.option("header", True).csv(path if isinstance(path, str) else list(path))
    numbers = [c for c in schemas.MEASUREMENTS if c in text.columns]
    out = text.select(
        F.trim("meter_number").alias("meter_number"), F.try_to_timestamp(ts).alias("timestamp"),
        *(F.col(c).try_cast("double").alias(c) if c in numbers else F.lit(None).cast("double").alias(c) for c in schemas.MEASUREMENTS),
    )
    out = out if keep_bad else out.where("timestamp is not null and meter_number is not null and meter_number != ''")
    return nan_to_null(out, list(schemas.MEASUREMENTS))


def with_partitions(df: DataFrame) -> DataFrame:
    """Add the date and the shard that rows are stored under; rows without a meter have no place and go."""
    known = df.where("meter_number is not null")
    return known.withColumns({"shard": shard(F.col("meter_number")), "dt": F.date_format("timestamp", "yyyy-MM-dd")})
