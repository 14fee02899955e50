"""A data source that lists Parquet files and reads their footers on executors, without a scan of their rows.

    spark.dataSource.register(ParquetFooters)
    spark.read.format("parquet_footers").option("path", "s3a://lake/raw").option("times", "timestamp").load()
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Tasks that share the folders, files of one task where a folder holds very many, and footers that a task reads at once.
TASKS, FILES, READERS = 256, 512, 8
SCHEMA = "path string, bytes long, rows long, row_groups int, first_seen timestamp, last_seen timestamp, known boolean, dt string, shard int"
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def canonical(path: str) -> str:
    """A URI in the form of Spark's file metadata."""
    return re.sub(r"^(file:)?/+", "file:///", path)


def file_system(path: str):
    """Arrow's file system of a URI, the path in it, and what to put before its paths to have URIs again."""
    from pyarrow import fs

    uri = canonical(path).rstrip("/")
    scheme, _, rest = uri.partition("://")
    if scheme == "file":
        return fs.LocalFileSystem(), unquote(rest), "file://"
    found, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
    return found, inner, uri[: len(uri) - len(inner)] if uri.endswith(inner) else f"{scheme}://"


@dataclass
class Share(InputPartition):
    """What one task looks at: folders with all that is below them, and single files."""

    folders: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)


class ParquetFooters(DataSource):
    """Options: ``path``; ``times``, a column whose earliest and latest values the footers tell; ``tasks``.

    A row for each file: its size, rows and row groups, the times in UTC, date and shard by its folders' names. ``known`` is false
    where some row group with values has no statistics of the column (``INT96`` never has): then the times are null.
    Names that begin with a point or an underscore are left out, as Spark does; an empty folder gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "parquet_footers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FooterReader:
        return FooterReader(self.options["path"], self.options.get("times"), int(self.options.get("tasks", TASKS)))


def _inside(fs, folder: str) -> tuple[list[str], list[str]]:
    """Folders and Parquet files in a folder, in order."""
    from pyarrow.fs import FileSelector, FileType

    found = [f for f in fs.get_file_info(FileSelector(folder)) if not f.base_name.startswith((".", "_"))]
    folders = sorted(f.path for f in found if f.type == FileType.Directory)
    return folders, sorted(f.path for f in found if f.type == FileType.File and f.base_name.endswith(".parquet"))


class FooterReader(DataSourceReader):
    def __init__(self, path: str, times: str | None, tasks: int):
        self.path, self.times, self.tasks = path, times, tasks

    def partitions(self) -> list[Share]:
        """Descend until there are folders for all tasks; the rest of the listing is theirs. So at most ``tasks`` folders are
        listed here, whatever the store holds."""
        fs, root, _ = file_system(self.path)
        level, files = [root], []
        while level and len(level) < self.tasks:
            below, listed = [], 0
            for at, folder in enumerate(level):
                if len(below) >= self.tasks:
                    below += level[at:]
                    break
                inner, own = _inside(fs, folder)
                below, files, listed = below + inner, files + own, listed + 1
            level = below
        shares = [Share(folders=level[i :: self.tasks]) for i in range(min(self.tasks, len(level)))]
        size = min(FILES, max(1, -(-len(files) // self.tasks)))
        return shares + [Share(files=files[i : i + size]) for i in range(0, len(files), size)] or [Share()]

    def read(self, partition: Share) -> Iterator:
        fs, _, prefix = file_system(self.path)

        def files() -> Iterator[str]:
            waiting = list(partition.folders)
            yield from partition.files
            while waiting:
                inner, own = _inside(fs, waiting.pop())
                waiting += inner
                yield from own

        def batches() -> Iterator[list[str]]:
            some: list[str] = []
            for f in files():
                some.append(f)
                if len(some) == FILES:
                    yield some
                    some = []
            if some:
                yield some

        with ThreadPoolExecutor(READERS) as pool:
            for some in batches():
                yield _batch(list(pool.map(lambda f: _footer(fs, f, prefix, self.times), some)))


def _micros(t) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=UTC)
    return (t - _EPOCH) // timedelta(microseconds=1)


def _footer(fs, path: str, prefix: str, times: str | None) -> tuple:
    import pyarrow.parquet as pq

    with fs.open_input_file(path) as f:
        size, md = f.size(), pq.read_metadata(f)
    at = next((i for i in range(md.num_columns) if md.schema.column(i).path == times), None)
    low, high, known = [], [], at is not None
    for g in range(md.num_row_groups if known else 0):
        s = md.row_group(g).column(at).statistics
        if s is not None and s.has_min_max:
            low.append(_micros(s.min))
            high.append(_micros(s.max))
        elif md.row_group(g).num_rows and not (s is not None and s.has_null_count and s.null_count == md.row_group(g).num_rows):
            known = False
    dt, shard = re.search(r"/dt=([^/]+)/", path), re.search(r"/shard=(\d+)/", path)
    span = (min(low), max(high)) if known and low else (None, None)
    return prefix + path, size, md.num_rows, md.num_row_groups, *span, known, dt and unquote(dt[1]), shard and int(shard[1])


def _batch(rows: list[tuple]):
    import pyarrow as pa

    time = pa.timestamp("us", tz="UTC")
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), time, time, pa.bool_(), pa.string(), pa.int32()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_footers(spark: SparkSession, path: str, times: str | None = None) -> DataFrame:
    """Footers of all Parquet files below a path."""
    spark.dataSource.register(ParquetFooters)
    reader = spark.read.format("parquet_footers").option("path", path)
    return (reader.option("times", times) if times else reader).load()
