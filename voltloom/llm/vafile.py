"""Compression of vectors into short codes: a codebook for each part of a vector, assignment by a vector-approximation file.

A part's nearest codebook entry is found in two steps. The entries' coordinates are quantised to a few bits: each dimension is cut
into cells, an entry is approximated by its cells. A query builds a lookup table of the least and the largest squared
distance to every cell of every dimension; their sums bound its distance to each entry from below and above. Only entries whose
lower bound doesn't pass the smallest upper bound are refined, with exact integer distances.

All arithmetic is on integers, so codebooks and codes don't depend on how rows are spread over tasks. The vectors are
written once as integers; each round is a pass over them that sends, for each task, the sums and counts of the entries, whose number
depends on the vectors' length only. Codebooks are all that the driver and the closures hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Parts of a vector, entries of a part's codebook, rounds of fitting, and the integer steps of one unit.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Bits of a coordinate in the approximation.
BITS = 3
#: Vectors whose tables are held at once.
CHUNK = 2048
#: A label with more than this share of all rows has its sum sent to all tasks; there are at most as many such labels as shares.
SHARES = 1000


class Cells:
    """The approximation of one part's codebook (entries by dimensions, integers)."""

    def __init__(self, book: np.ndarray, bits: int = BITS):
        self.book, n = book, 1 << bits
        low = book.min(0)
        span = book.max(0) - low + 1
        self.cell = (book - low) * n // span
        edge = low[:, None] + -(-np.arange(n + 1)[None, :] * span[:, None] // n)  # the first integer of each cell
        self.first, self.last = edge[:, :-1], edge[:, 1:] - 1

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible squared distance of each query to each entry's cells."""
        least = np.zeros((len(x), len(self.book)), np.int64)
        most = np.zeros_like(least)
        for j in range(x.shape[1]):
            under, over = self.first[j] - x[:, j, None], x[:, j, None] - self.last[j]
            gap = np.maximum(np.maximum(under, over), 0)
            reach = np.maximum(np.abs(under), np.abs(over))
            at = self.cell[:, j]
            least += (gap * gap)[:, at]
            most += (reach * reach)[:, at]
        return least, most

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry (of equal ones the first) of each query, its squared distance, and how many distances were taken."""
        least, most = self.bounds(x)
        row, entry = np.nonzero(least <= most.min(1)[:, None])
        step = x[row] - self.book[entry]
        exact = np.full(least.shape, np.iinfo(np.int64).max)
        exact[row, entry] = (step * step).sum(1)
        best = exact.argmin(1)
        return best, exact[np.arange(len(x)), best], len(row)


def _limit(width: int) -> int:
    """The largest component for which an error of ``PARTS`` parts of that width fits into 64 bits."""
    return isqrt((1 << 62) // (PARTS * max(1, width))) // 2


def _integers(df: DataFrame, vector: str, id_col: str, label: str) -> tuple[DataFrame, int]:
    """Usable rows as id, label and vec (bytes of integers, each part padded with zeros to the same width), and that width."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), v.alias("vec")).where("vec is not null and size(vec) > 0")
    rows = rows.where(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    size = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = size.d if size else 0
    width = -(-d // PARTS)
    limit = _limit(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b["vec"].flatten().to_numpy(zero_copy_only=False), np.float64).reshape(b.num_rows, d)
            whole = np.zeros((len(x), width * PARTS), "<i8")
            whole[:, :d] = np.clip(np.floor(x * SCALE), -limit, limit)
            yield pa.record_batch({"id": b["id"], "label": b["label"], "vec": pa.array([r.tobytes() for r in whole], pa.binary())})

    kind = dict(rows.dtypes)
    out = rows.where(F.size("vec") == d).mapInArrow(run, f"id {kind['id']}, label {kind['label']}, vec binary")
    return materialise(out, "integers"), width


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Vectors of a batch: rows, parts, dimensions."""
    return np.frombuffer(b"".join(batch["vec"].to_pylist()), "<i8").reshape(batch.num_rows, PARTS, width)


def first_books(vectors: DataFrame, width: int) -> np.ndarray:
    """Codebooks of the vectors with the smallest ids (null ids last, equal ids by their integers): parts, entries, dimensions."""

    def whole(b: bytes) -> list[int]:
        return np.frombuffer(b, "<i8").tolist()

    # equal ids: more rows than entries may have the smallest one, so their order is taken by Spark, on the components
    parts = F.udf(whole, "array<long>")
    top = vectors.orderBy(F.col("id").asc_nulls_last()).limit(ENTRIES).agg(F.max("id"), F.count("id"), F.count("*")).first()
    some = vectors if top[1] < top[2] else vectors.where(F.col("id") <= top[0])
    rows = some.select("id", parts("vec").alias("v")).orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), PARTS, width).transpose(1, 0, 2)


def _round(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry is the mean of its parts, rounded down; entries without parts stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for b in batches:
            x = _matrix(b, width)
            for at in range(0, len(x), CHUNK):
                for p in range(parts):
                    own = x[at : at + CHUNK, p]
                    best, _, _ = cells[p].nearest(own)
                    for e in range(entries):
                        mine = own[best == e]
                        total[p, e, :width] += mine.sum(0)
                        total[p, e, width] += len(mine)
        flat = total.ravel()
        some = np.flatnonzero(flat)
        yield pa.record_batch({"slot": pa.array(some), "value": pa.array(flat[some])})

    found = vectors.select("vec").mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(parts * entries * (width + 1), np.int64)
    for r in found:
        total[r.slot] = r.value
    total = total.reshape(parts, entries, width + 1)
    count = total[..., width:]
    return np.where(count > 0, total[..., :width] // np.maximum(count, 1), books)


def train(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, dimensions) of vectors in integers."""
    books = first_books(vectors, width)
    for _ in range(rounds if books.size else 0):
        books = _round(vectors, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """id, label, ``code`` (two hex digits for each part) and ``error`` (sum of squared distances) of every vector."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b) for b in books]
        for b in batches:
            x = _matrix(b, width)
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for at in range(0, len(x), CHUNK):
                own = slice(at, at + CHUNK)
                for p in range(parts):
                    code[own, p], near, _ = cells[p].nearest(x[own, p])
                    error[own] += near
            yield pa.record_batch({"id": b["id"], "label": b["label"], "code": pa.array([c.tobytes().hex() for c in code], pa.string()), "error": pa.array(error)})

    kind = dict(vectors.dtypes)
    return vectors.mapInArrow(run, f"id {kind['id']}, label {kind['label']}, code string, error long")


def with_label_sums(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the errors summed over equal labels, nulls together (null beyond 64 bits).

    Sums of labels with more than one of ``SHARES`` of all rows, of which there are fewer than ``SHARES``, are sent to all tasks; the
    others are joined by label, so no label makes a task large.
    """
    total = F.expr("try_cast(sum(cast(error as decimal(38, 0))) as bigint)")
    sums = materialise(coded.groupBy(F.col("label").alias("_l")).agg(F.count("*").alias("_n"), total.alias("label_error")), "labels")
    n = sums.agg(F.sum("_n")).first()[0] or 0
    hot = sums.where(F.col("_n") * SHARES > n)
    same = F.col("label").eqNullSafe(F.col("_l"))
    rare = coded.join(F.broadcast(hot), same, "left_anti").join(sums.where(F.col("_n") * SHARES <= n).hint("merge"), same)
    return coded.join(F.broadcast(hot), same).unionByName(rare).drop("_l", "_n")


def book_text(books: np.ndarray) -> str:
    """All components by part, entry and position."""
    return ",".join(map(str, books.ravel().tolist()))


def compress(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", label: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks.

    Null vectors and those with null or non-finite components are left out, and so are empty ones and those of another length than
    most (of equally common lengths the largest), for which a distance isn't defined. A length that isn't a multiple of
    ``PARTS`` is filled up with zeros. Components so large that a distance would leave 64 bits count as the largest that
    fits. Rows that are there twice count and come out twice; null ids come last in the choice of first entries; with fewer
    rows than entries, codebooks are smaller; an empty table gives an empty result. Other columns are ignored.

    Returns id, label, ``code``, ``error``, ``label_error`` under the names of the input's columns.
    """
    vectors, width = _integers(df, vector, id_col, label)
    books = train(vectors, width, rounds)
    if not books.size:
        books = np.zeros((PARTS, 1, width), np.int64)
    coded = with_label_sums(materialise(encode(vectors, books), "codes"))
    return coded.select(F.col("id").alias(id_col), F.col("label").alias(label), "code", "error", "label_error"), books
