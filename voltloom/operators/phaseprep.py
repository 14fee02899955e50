"""Preparation of phase identification over all transformers at once: coded series, usable rows, rank vectors, distances by blocks.

The mapper asks a series for three things only: where it is missing, low or jumping, and the order of its differences. So a series is read
once and kept as the ranks of its differences (two bytes for a value, four if long) and three bitmaps; voltages are never stored, and never
have a row for each value again. No task holds a long series of a transformer (``TASK_VALUES``): a phase's own codes are the largest thing in one row, and a product of
two blocks of phases over a slice of time the largest in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import grown, materialise
from .hclust import average_ranks

#: Phases of a block, and times of a slice.
BLOCK, SLICE = 256, 4096

#: Values whose codes one task joins or brings to their transformer, whatever the number of shuffle partitions.
TASK_VALUES = 1 << 23


def tolerances(first: float, step: float, least: float) -> list[float]:
    """The tolerances that are tried, from the highest on."""
    out = []
    while first >= least:
        out.append(first)
        first -= step
    return out


def choose(fine: list[int], kept: list[int], rows: int, rows_step: int) -> int | None:
    """Number of the first tolerance that leaves enough rows; fewer are asked for if none does. None if no phase is left before."""
    while True:
        for i, (n, k) in enumerate(zip(fine, kept, strict=True)):
            if not k:
                return None
            if n >= rows:
                return i
        rows -= rows_step


# --- series as codes ----------------------------------------------------------------------------------------------------------


def _pack(t: np.ndarray) -> bytes:
    """Rising times as their steps: equal for equal times, and a few bytes if they are regular."""
    return zlib.compress(np.diff(t, prepend=0).astype("<i8").tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), "<i8").cumsum()


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _flags(b: bytes | None, n: int, default: bool = False) -> np.ndarray:
    return np.full(n, default) if b is None else np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


def _largest(v: pa.Array, starts: np.ndarray) -> np.ndarray:
    """The largest value of each run of rows as in Spark: nulls don't count, NaN is the largest."""
    x = v.fill_null(-np.inf).to_numpy(zero_copy_only=False)
    known = np.add.reduceat(np.asarray(v.is_valid()).astype(int), starts) > 0
    return np.where(known, np.maximum.reduceat(x, starts), np.nan)


_CODES = [
    ("series", pa.string()), ("times", pa.binary()), ("c", pa.int64()), ("low", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
    ("mask", pa.binary()), ("lows", pa.binary()), ("jumps", pa.binary()), ("codes", pa.binary()),
]


def _code(t: np.ndarray, packed: bytes, v: np.ndarray, low: float, step: float) -> tuple:
    """One series: a row of ``_CODES`` without its name. ``mask`` tells the known values (null for all); other bits and codes are
    those of the known values alone (bits are null for none)."""
    known = ~np.isnan(v)
    x = v[known]
    n = len(x)
    if not n:
        return packed, 0, 0, None, None, _bits(known), None, None, b""
    at = t[known]
    with np.errstate(invalid="ignore"):  # of infinite values
        d = np.diff(x)
    jump = np.concatenate([[False], ~(np.abs(d) <= step)])
    under = x < low
    values, code = np.unique(d, return_inverse=True)
    code = np.concatenate([[0], code]).astype("<u2" if len(values) <= 1 << 16 else "<u4")
    bits = (None if n == len(v) else _bits(known)), *(_bits(f) if f.any() else None for f in (under, jump))
    return packed, n, int(under.sum()), int(at[0]), int(at[-1]), *bits, code.tobytes()


def coded(rows: DataFrame, keys: Sequence[str], values: Sequence[str], cfg) -> DataFrame:
    """Series as codes: ``keys``, series (name of the value column), times (packed), c (known values), low (those under the limit), first and last (known
    times), mask, lows and jumps (bits), codes (ranks of the differences of known values that follow each other; the first has none).

    rows: keys, timestamp and values; of rows of one time the largest values count, NaN is missing. They meet by keys and come in order of
    time, so a table that is dealt by its keys isn't shuffled. Ranks among some of the differences follow from ranks among all of them.
    """
    by_time = Window.partitionBy(*keys).orderBy("timestamp")
    rows = rows.select(*keys, "timestamp", *(F.col(v).cast("double").alias(v) for v in values), F.row_number().over(by_time).alias("_nth"))
    low, step, names = cfg.low, cfg.step, list(values)
    n_keys = len(keys)

    def emit(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        columns = [c.chunk(0) if c.num_chunks else c for c in part.columns]
        first = np.flatnonzero(columns[-1].to_numpy() == 1)
        time = columns[n_keys]
        valid = np.asarray(time.is_valid())
        t = time.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(t))))
        new = np.concatenate([[True], (np.diff(t) != 0) | (np.diff(of) != 0) | (np.diff(valid.astype(int)) != 0)])
        starts = np.flatnonzero(new)
        plain = len(starts) == len(t)
        v = [c.to_numpy(zero_copy_only=False) if plain else _largest(c, starts) for c in columns[n_keys + 1 : -1]]
        fine = valid[starts]
        t, of, v = t[starts][fine], of[starts][fine], [x[fine] for x in v]
        out, before, packed = [], None, b""
        ends = np.searchsorted(of, np.arange(len(first) + 1))
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            own = t[a:b]
            if before is None or not np.array_equal(own, before):
                before, packed = own, _pack(own)
            out += [(name, *_code(own, packed, x[a:b], low, step)) for name, x in zip(names, v, strict=True)]
        said = [pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(_CODES)]
        again = pa.array(np.repeat(first, len(names)))
        return pa.RecordBatch.from_arrays([*(c.take(again) for c in columns[:n_keys]), *said], names=[*part.column_names[:n_keys], *(c for c, _ in _CODES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            begins = np.flatnonzero(b.column(b.num_columns - 1).to_numpy() == 1)
            if len(begins) and (held or begins[-1]):  # what came before the last series is whole
                whole = [*held, b.slice(0, begins[-1])]
                yield emit(pa.Table.from_batches(whole))
                held = []
                b = b.slice(begins[-1])
            if b.num_rows:
                held.append(b)
        if held:
            yield emit(pa.Table.from_batches(held))

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n_keys])
    return rows.mapInArrow(run, f"{kind}, series string, times binary, c long, low long, first long, last long, mask binary, lows binary, jumps binary, codes binary")


def grids(leaves: DataFrame) -> DataFrame:
    """The times of each unit between its first and last known value: unit, n, grid (packed). leaves: unit, used, times, first, last."""
    used = [F.min(F.when(F.col("used"), F.col("first"))).alias("first"), F.max(F.when(F.col("used"), F.col("last"))).alias("last")]
    units = leaves.groupBy("unit").agg(F.collect_set("times").alias("times"), *used).where("first is not null")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for times, first, last in zip(b["times"], b["first"], b["last"], strict=True):
                t = np.empty(0, np.int64)
                for x in times:
                    t = np.union1d(t, _unpack(x))
                t = t[(t >= first) & (t <= last)]
                out.append((len(t), _pack(t)))
            yield pd.DataFrame({"unit": b["unit"], "n": [n for n, _ in out], "grid": [g for _, g in out]})

    return units.mapInPandas(run, "unit string, n long, grid binary")


def phases_kept(leaves: DataFrame, grid: DataFrame, cfg) -> DataFrame:
    """Used phases with ``n``, ``grid`` and ``k``: tolerances fall, so phases drop out one after the other, and a phase is kept for the first k of them."""
    limits = tolerances(cfg.tolerance, cfg.tolerance_step, cfg.least_tolerance)
    missing, low = (F.col("n") - F.col("c")) / F.col("n"), F.col("low") / F.col("n")
    return leaves.where("used").join(grown(grid), "unit").withColumn("k", sum(((missing < x) & (low <= x)).cast("int") for x in limits))


def _places(row, cache: dict) -> np.ndarray:
    """The rows of the unit's grid (from 0) in which a series has values."""
    if len(cache) > 64:
        cache.clear()
    for b in (row.grid, row.times):
        if b not in cache:
            cache[b] = _unpack(b)
    t = cache[row.times]
    return np.searchsorted(cache[row.grid], t if row.mask is None else t[_flags(row.mask, len(t))])


def levels(gone: np.ndarray, bad: np.ndarray, jump: np.ndarray, w: int) -> np.ndarray:
    """The tolerance from which on each row is complete and in no corrupt window, that is, at which the last phase that spoils it has dropped out."""
    n = len(gone)
    if n < w:
        return gone
    start = sliding_window_view(np.maximum(gone, bad), w).max(1)
    if w > 1:
        start = np.maximum(start, sliding_window_view(jump[1:], w - 1).max(1))
    return np.maximum(gone, sliding_window_view(np.pad(start, w - 1), w).max(1))


def choices(phases: DataFrame, cfg) -> DataFrame:
    """The tolerance of each unit and its usable rows, those that like the one before are complete and sound: unit, choice (null if no phase is
    usable), ok (bits by row of the grid). phases: as from :func:`phases_kept`. One pass counts the rows of all tolerances.
    """
    n_limits = len(tolerances(cfg.tolerance, cfg.tolerance_step, cfg.least_tolerance))
    spoilt = phases.where("k > 0 and (c < n or lows is not null or jumps is not null)").select("unit", "k", "n", "c", "grid", "times", "mask", "lows", "jumps")

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found: dict[str, np.ndarray] = {}
            cache: dict = {}
            for row in b.itertuples(index=False):
                at, n, c = _places(row, cache), int(row.n), int(row.c)
                marks = found.setdefault(row.unit, np.zeros((3, n), "<u2"))
                own = np.full(n, row.k, "<u2")
                own[at] = 0
                np.maximum(marks[0], own, out=marks[0])
                low = at[_flags(row.lows, c)]
                marks[1, low] = np.maximum(marks[1, low], row.k)
                jump = at[1:][_flags(row.jumps, c)[1:] & (np.diff(at) == 1)]
                marks[2, jump] = np.maximum(marks[2, jump], row.k)
            yield pd.DataFrame({"unit": list(found), "marks": [m.tobytes() for m in found.values()]})

    marks = spoilt.mapInPandas(mark, "unit string, marks binary").groupBy("unit").agg(F.collect_list("marks").alias("marks"))
    units = phases.groupBy("unit").agg(F.max("n").alias("n"), F.array(*(F.count_if(F.col("k") > i) for i in range(n_limits))).alias("kept"))
    window, rows, rows_step = cfg.window, cfg.rows, cfg.rows_step

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for n, kept, parts in zip(b["n"], b["kept"], b["marks"], strict=True):
                all_ = np.zeros((3, int(n)), "<u2")
                for m in parts if parts is not None else ():
                    all_ = np.maximum(all_, np.frombuffer(m, "<u2").reshape(3, -1))
                level = levels(*all_, window)
                at = choose([int((level <= i).sum()) for i in range(n_limits)], list(kept), rows, rows_step)
                fine = np.zeros(len(level), bool) if at is None else level <= at
                out.append((at, _bits(np.concatenate([[False], fine[1:] & fine[:-1]]))))
            yield pd.DataFrame({"unit": b["unit"], "choice": pd.array([c for c, _ in out], "Int32"), "ok": [x for _, x in out]})

    return units.join(grown(marks), "unit", "left").mapInPandas(pick, "unit string, choice int, ok binary")


def usable(long: DataFrame, cfg) -> tuple[DataFrame, DataFrame]:
    """Which rows and phases of each unit are used, as rows for each value (the mapper itself goes on with codes).

    long: unit, leaf (number), timestamp, v; one row for each (nulls count as missing), ``used``: false for phases that aren't looked at but whose
    times belong to the unit's grid. Returns phases (unit, leaf, k, choice; choice is null if none is usable) and differences (unit, leaf, r, d) of
    kept phases between neighbouring usable rows.
    """
    leaves = materialise(coded(long, ["unit", "leaf", "used"], ["v"], cfg), "codes")
    phases = materialise(phases_kept(leaves, grids(leaves), cfg), "kept")
    picked = materialise(choices(phases, cfg), "choices")
    phases = phases.select("unit", "leaf", "k").join(picked, "unit")
    known = long.where("used and v is not null")
    bounds = known.groupBy("unit").agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    grid = long.select("unit", "timestamp").distinct().join(bounds, "unit").where("timestamp between first and last")
    grid = grid.select("unit", "timestamp", F.row_number().over(Window.partitionBy("unit").orderBy("timestamp")).alias("r"))

    def fine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for unit, ok in zip(b["unit"], b["ok"], strict=True):
                yield pd.DataFrame({"unit": unit, "r": np.flatnonzero(_flags(ok, 8 * len(ok))) + 1})

    sound = picked.select("unit", "ok").mapInPandas(fine, "unit string, r int")
    rows = known.join(phases.where("k > choice"), ["unit", "leaf"]).join(grid, ["unit", "timestamp"])
    rows = rows.withColumn("d", F.col("v") - F.lag("v").over(Window.partitionBy("unit", "leaf").orderBy("r")))
    return phases.select("unit", "leaf", "k", "choice"), rows.join(grown(sound), ["unit", "r"]).select("unit", "leaf", "r", "d")


# --- rank vectors and distances -----------------------------------------------------------------------------------------------

_VECTORS = "unit string, leaf long, slice int, rows int, norm double, ranks binary"


def _kind(rows: int) -> str:
    """Numbers of a rank vector: twice the ranks less their mean, so whole, and in two bytes if the series isn't long."""
    return "<i2" if rows <= 1 << 15 else "<i4"


def _slices(unit: str, leaf: int, x: np.ndarray) -> Iterator[tuple]:
    norm, kind = float(np.sqrt((x.astype(float) ** 2).sum())), _kind(len(x))
    for i, a in enumerate(range(0, len(x), SLICE)):
        yield unit, leaf, i, len(x), norm, x[a : a + SLICE].astype(kind).tobytes()


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _VECTORS.split(", ")])


def rank_vectors(differences: DataFrame) -> DataFrame:
    """Average ranks of each phase's differences, doubled and centred, cut into slices of time: unit, leaf, slice, rows (of all slices), norm, ranks (bytes)."""
    series = differences.groupBy("unit", "leaf").agg(F.array_sort(F.collect_list(F.struct("r", "d"))).alias("s")).select("unit", "leaf", F.col("s.d").alias("s"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for unit, leaf, s in zip(b["unit"], b["leaf"], b["s"], strict=True):
                yield _frame(list(_slices(unit, leaf, 2 * average_ranks(np.asarray(s, float)[:, None])[:, 0] - len(s) - 1)))

    return series.mapInPandas(run, _VECTORS)


def code_vectors(leaves: DataFrame) -> DataFrame:
    """The same from codes. leaves: unit, leaf, times, mask, codes, c, grid, ok; phases that are kept, so known in all usable rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            cache: dict = {}
            for row in b.itertuples(index=False):
                at = _places(row, cache)
                if not len(at):
                    continue
                codes = np.frombuffer(row.codes, f"<u{len(row.codes) // len(at)}")
                codes = codes[_flags(row.ok, 8 * len(row.ok))[at]]
                counts = np.bincount(codes)
                out += _slices(row.unit, row.leaf, (2 * counts.cumsum() - counts - len(codes))[codes])
            yield _frame(out)

    return leaves.select("unit", "leaf", "times", "mask", "codes", "grid", "ok").mapInPandas(run, _VECTORS)


def _numbers(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank vectors of one slice as lines, and their norms (1 for constant series)."""
    x = np.frombuffer(b"".join(b["ranks"]), _kind(int(b["rows"].iloc[0]))).reshape(len(b), -1).astype(float)
    norm = b["norm"].to_numpy(float)
    return x, np.where(norm == 0, 1.0, norm)


def distance_blocks(vectors: DataFrame, numbers: DataFrame) -> DataFrame:
    """Spearman distances (1 minus the product of rank vectors) of the phases of each unit by blocks: unit, lo, hi (blocks, lo <= hi), m.

    numbers: unit, leaf, idx (from 0), size (phases of the unit). Products of slices are added up.
    """
    rows = vectors.join(numbers, ["unit", "leaf"]).withColumn("own", F.expr(f"idx div {BLOCK}"))
    rows = rows.withColumn("other", F.explode(F.expr(f"sequence(0, (size - 1) div {BLOCK})")))
    rows = rows.select("unit", "slice", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "idx", "rows", "norm", "ranks")

    def multiply(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("idx")
        lo, hi = int(b["lo"].iloc[0]), int(b["hi"].iloc[0])
        (left, l), (right, r) = (_numbers(b[b["own"] == own]) for own in (lo, hi))
        out = b[["unit", "lo", "hi"]].iloc[:1].copy()
        out["m"] = [((left @ right.T) / l[:, None] / r[None, :]).tobytes()]
        return out

    def add(b: pd.DataFrame) -> pd.DataFrame:
        out = b[["unit", "lo", "hi"]].iloc[:1].copy()
        out["m"] = [sum(np.frombuffer(m, "<f8") for m in b["m"]).tobytes()]
        return out

    kind = "unit string, lo int, hi int, m binary"
    return rows.groupBy("unit", "slice", "lo", "hi").applyInPandas(multiply, kind).groupBy("unit", "lo", "hi").applyInPandas(add, kind)


def assemble(n: int, blocks: pd.DataFrame) -> np.ndarray:
    """The distance matrix of one unit from its blocks."""
    out = np.zeros((n, n))
    for lo, hi, m in zip(blocks["lo"], blocks["hi"], blocks["m"], strict=True):
        a, b = int(lo) * BLOCK, int(hi) * BLOCK
        part = 1 - np.clip(np.frombuffer(m, "<f8").reshape(min(BLOCK, n - a), min(BLOCK, n - b)), -1, 1)
        out[a : a + BLOCK, b : b + BLOCK] = part
        out[b : b + BLOCK, a : a + BLOCK] = part.T
    np.fill_diagonal(out, 0)
    return out


def distances_of_one_block(n: int, vectors: pd.DataFrame) -> np.ndarray:
    """The distance matrix of a unit of one block from its rank vectors (idx, slice, rows, norm, ranks), slice by slice."""
    out = np.zeros((n, n))
    for _, b in vectors.sort_values("idx").groupby("slice"):
        x, norm = _numbers(b)
        out += x @ x.T
    if len(vectors):
        out = 1 - np.clip(out / norm[:, None] / norm[None, :], -1, 1)
    np.fill_diagonal(out, 0)
    return out
