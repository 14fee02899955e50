"""Nearest-neighbour searches over vectors: rotated one-bit codes, and an exact Voronoi join.

Both move vectors as packed blocks: a row holds up to a few thousand vectors as bytes, so that a search is a sequence of
matrix products between a block of queries and blocks of data, and the number of rows that meet in a join is that of
blocks, not of vectors. A task keeps the best of each query over all blocks that it sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks_for, materialise

#: Vectors of a data block, and data blocks that one task goes through for a query block.
BLOCK, RUN = 4096, 16
#: Queries of a query block at most, and bytes of their vectors. All data goes to every query block, so few large blocks move less.
QUERIES, HELD = 8192, 32 << 20
#: Standard deviations of the code's error within which a vector is reranked, and bits to which queries are rounded.
SIGMAS, PLANES = 3.0, 4
#: Pivots of the Voronoi join at least and at most; between them as many as the root of the number of vectors.
FEWEST, PIVOTS = 16, 256

_PACKED = "block long, n int, rid binary, id binary, vec binary"


def _usable(df: DataFrame, vector: str, id_col: str, zero: bool) -> DataFrame:
    """Rows whose vector takes part: ``rid`` (unique), ``id``, ``vec`` (array<double>), all of the commonest length."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where("id is not null and vec is not null")  # null ids name no row of a result
    fine = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where((F.size("vec") > 0) & fine)
    if not zero:
        rows = rows.where(F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0].d if sizes else 0)).withColumn("rid", F.monotonically_increasing_id())


def _dealt(rows: DataFrame, per_block: int, n: int) -> DataFrame:
    """Rows with a random ``block``, so that no value of the data makes a block large."""
    return rows.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(per_block)), F.lit(blocks_for(n, per_block))))


def _grouped(it: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups of a partition that is sorted by ``key``."""
    held: list[pd.DataFrame] = []
    for b in it:
        k = b[key].to_numpy()
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            if held and held[0][key].iloc[0] != k[a]:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(b.iloc[a:z])
    if held:
        yield pd.concat(held, ignore_index=True)


def _pack(rows: DataFrame, tasks: int, kind: str = "<f8") -> DataFrame:
    """One row for each block: numbers and vectors as bytes of that kind, in the order of rid."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _grouped(it, "block"):
            vec = np.concatenate(g["vec"].to_numpy()).astype(kind).tobytes()
            yield pd.DataFrame({"block": [g["block"].iloc[0]], "n": [len(g)], "rid": [g["rid"].to_numpy("<i8").tobytes()], "id": [g["id"].to_numpy("<i8").tobytes()], "vec": [vec]})

    return rows.select("block", "rid", "id", "vec").repartition(tasks, "block").sortWithinPartitions("block", "rid").mapInPandas(run, _PACKED)


def _queries_held(dim: int, size: int = 8) -> int:
    """Queries of a block, by the bytes of their vectors."""
    return max(64, min(QUERIES, HELD // max(1, dim * size)))


class Best:
    """The k best candidates so far of each of n queries: highest score first, then smallest id."""

    def __init__(self, n: int, k: int, kind: type):
        self.k, self.n = k, np.zeros(n, np.int64)
        self.score = np.full((n, k), -np.inf) if kind is float else np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.rid = np.full((n, k), -1)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        own = slice(0, int(self.n[q]))
        s, i, r = (np.concatenate([a[q, own], b]) for a, b in ((self.score, score), (self.id, ids), (self.rid, rids)))
        order = np.lexsort((r, i, -s))[: self.k]
        m = len(order)
        self.score[q, :m], self.id[q, :m], self.rid[q, :m], self.n[q] = s[order], i[order], r[order], m

    def frame(self, rid: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
        got = np.arange(self.k)[None, :] < self.n[:, None]
        each = got.sum(1)
        return pd.DataFrame({"query_rid": np.repeat(rid, each), "query_id": np.repeat(ids, each), "rid": self.rid[got], "vec_id": self.id[got], "score": self.score[got]})


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all tasks; Spark cuts to k before the shuffle too."""
    w = Window.partitionBy("query_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _unpacked(row, kind: str = "<f8") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row.rid, "<i8"), np.frombuffer(row.id, "<i8"), np.frombuffer(row.vec, kind).reshape(row.n, -1).astype(np.float64, copy=False)


def rotation(d: int, seed: int = 20) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(vec: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-bit codes of vectors: signs after rotation packed into 64-bit words, and two scalars.

    With the unit vector u of a vector o, u' = u rotated, and x = sign(u') / sqrt(d): for a query q, <x, q'> / <x, u'>
    is an unbiased estimate of <u, q>, with error of the order |q| sqrt((1 - <x, u'>^2) / <x, u'>^2 / (d - 1)). Returns
    the signs' words, |o| / <x, u'> / sqrt(d), and |o| times that factor of the error.
    """
    d = vec.shape[1]
    largest = np.abs(vec).max(1)  # squares of very large or small components would leave the range of numbers
    vec = vec / largest[:, None]
    norm = np.sqrt((vec * vec).sum(1))
    turned = vec @ turn
    inner = np.abs(turned).sum(1) / norm / np.sqrt(d)
    error = norm * np.sqrt(np.maximum(1 - inner**2, 0) / inner**2 / max(1, d - 1))
    return _words(turned > 0), largest * norm / inner / np.sqrt(d), largest * error


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, the last filled up with zeros."""
    packed = np.packbits(bits, axis=-1)
    room = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), np.uint8)
    room[..., : packed.shape[-1]] = packed
    return room.view("<u8")


class Asked:
    """Queries of unit length, rounded to ``PLANES`` bits a component after rotation, as bit planes that meet codes by and-ing and
    counting bits."""

    def __init__(self, q: np.ndarray, turn: np.ndarray):
        largest = np.abs(q).max(1)
        q = q / largest[:, None]
        norm = np.sqrt((q * q).sum(1))
        self.length = largest * norm
        turned = q @ turn / norm[:, None]
        self.low, high = turned.min(1), turned.max(1)
        self.step = np.where(high > self.low, (high - self.low) / ((1 << PLANES) - 1), 1.0)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = np.stack([_words((level >> i & 1).astype(bool)) for i in range(PLANES)])
        self.total = turned.sum(1)
        #: One standard deviation of what rounding adds, before a code's scale: components are off by up to half a step.
        self.rounding = self.step * np.sqrt(q.shape[1] / 12)

    def estimate(self, part: slice, words: np.ndarray, ones: np.ndarray, scale: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of some queries, at unit length, with all codes, and ``SIGMAS`` deviations of their errors."""
        dot = np.zeros((part.stop - part.start, len(words)), np.float32)
        for i in range(PLANES):
            for w in range(words.shape[1]):
                dot += np.bitwise_count(self.planes[i, part, w, None] & words[None, :, w]) * np.float32(1 << i)
        low, step, total = (x[part, None].astype(np.float32) for x in (self.low, self.step, self.total))
        dot *= 2 * step
        dot += 2 * low * ones
        dot -= total
        dot *= scale
        wide = error + self.rounding[part, None].astype(np.float32) * scale
        return dot, np.float32(SIGMAS) * wide + np.float32(1e-5) * scale


def search(df: DataFrame, k: int = 20, every: int = 20, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """The ``k`` largest inner products of each query with all other rows, found by randomly rotated one-bit codes.

    Queries are the rows whose id is divisible by ``every``. All vectors are encoded; a query's inner product with each
    is estimated from its packed bits and two scalars. In each block those with the highest estimates are taken exactly first;
    then those whose estimate plus ``SIGMAS`` times its error reaches the exact k-th best so far are reranked in double
    precision on the original vectors. Nothing is fitted: the rotation is drawn from a fixed seed.

    Vectors that are null, zero, empty, of another length than most, or hold null or non-finite components take no
    part, nor do null ids. Repeated ids are rows of their own; a row is never its own neighbour; ties go to the
    smaller id. An empty table gives an empty result; other columns are ignored.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.
    """
    rows = materialise(_usable(df, vector, id_col, zero=False), "vectors")
    n, dim = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    kind = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"  # as exact as the input, and no wider
    data = _coded(_pack(_dealt(rows, BLOCK, n), blocks_for(n, BLOCK), kind), kind)
    wanted = rows.where(F.pmod("id", F.lit(every)) == 0)
    m, held = wanted.count(), _queries_held(dim)
    queries = _pack(_dealt(wanted, held, m), blocks_for(m, held))
    found = _met(queries, data, blocks_for(m, held), blocks_for(n, BLOCK)).mapInPandas(_estimate(k, kind), _FOUND.format("double"))
    return _ranked(found, k)


_FOUND = "query_rid long, query_id long, rid long, vec_id long, score {}"


def _coded(blocks: DataFrame, kind: str) -> DataFrame:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            out = []
            for row in b.itertuples():
                _, _, vec = _unpacked(row, kind)
                words, scale, error = encode(vec, rotation(vec.shape[1]))
                out.append((words.tobytes(), scale.astype("<f8").tobytes(), error.astype("<f8").tobytes()))
            yield b.assign(bits=[x[0] for x in out], scale=[x[1] for x in out], error=[x[2] for x in out])

    return blocks.mapInPandas(run, f"{_PACKED}, bits binary, scale binary, error binary")


def _met(queries: DataFrame, data: DataFrame, query_blocks: int, data_blocks: int) -> DataFrame:
    """Every query block with every data block, dealt by query block and run of data blocks, data in order.

    The query set is stated and every row is a candidate, so each pair of blocks meets once; a row for each pair carries
    the data block, and the query block comes once for each run.
    """
    runs = _runs(data.sparkSession, query_blocks, data_blocks)
    d = data.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).withColumn("run", (F.col("block") % runs).cast("int"))
    q = queries.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))).withColumn("qb", F.col("block").cast("int"))
    names = [c for c in data.columns if c not in queries.columns]
    rows = q.withColumn("side", F.lit(0)).select("qb", "run", "side", *queries.columns, *(F.lit(None).cast("binary").alias(c) for c in names))
    rows = rows.unionByName(d.withColumn("side", F.lit(1)).select("qb", "run", "side", *queries.columns, *names))
    return _by_pair(rows.withColumn("pair", F.col("qb") * F.lit(runs) + F.col("run")), query_blocks * runs)


def _by_pair(rows: DataFrame, pairs: int) -> DataFrame:
    """Each pair in a task, or a few where there are very many; dealt by number, as hashes of few numbers collide."""
    tasks = min(pairs, 1 << 14)
    return rows.repartitionById(tasks, F.pmod("pair", F.lit(tasks)).cast("int")).sortWithinPartitions("pair", "side", "block")


def _runs(spark: SparkSession, query_blocks: int, data_blocks: int) -> int:
    """Into how many runs the data blocks are dealt: of ``RUN`` blocks, or shorter ones where tasks are fewer than cores."""
    busy = blocks_for(2 * spark.sparkContext.defaultParallelism, query_blocks)
    return max(blocks_for(data_blocks, RUN), min(data_blocks, busy))


def _estimate(k: int, kind: str):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, best, q_rid, q_id, q, asked = None, None, None, None, None, None
        for b in it:
            for row in b.itertuples():
                if row.pair != pair:
                    if best is not None:
                        yield best.frame(q_rid, q_id)
                    pair, best = row.pair, None
                if row.side == 0:
                    q_rid, q_id, q = _unpacked(row)
                    best, asked = Best(len(q), k, float), Asked(q, rotation(q.shape[1]))
                elif best is not None:
                    _rerank(best, q_rid, q, asked, row, k, kind)
        if best is not None:
            yield best.frame(q_rid, q_id)

    return run


def _rerank(best: Best, q_rid: np.ndarray, q: np.ndarray, asked: Asked, row, k: int, kind: str) -> None:
    rid, ids, vec = _unpacked(row, kind)
    scale, error = np.frombuffer(row.scale, "<f8"), np.frombuffer(row.error, "<f8")
    unit = float(scale.max())
    scale, error = (scale / unit).astype(np.float32), (error / unit).astype(np.float32)
    words = np.frombuffer(row.bits, "<u8").reshape(row.n, -1)
    ones = np.bitwise_count(words).sum(1, dtype=np.float32)
    first = min(row.n, 2 * k)
    for at in range(0, len(q), 64):
        guess, wide = asked.estimate(slice(at, min(at + 64, len(q))), words, ones, scale, error)
        top = np.argpartition(guess, row.n - first, axis=1)[:, row.n - first :]
        wide += guess  # the upper bound
        for j, i in enumerate(range(at, min(at + 64, len(q)))):
            size = float(asked.length[i]) * unit  # of what stands at 1 in the estimates
            bound = lambda: best.score[i, k - 1] / size if best.n[i] == k and 0 < size < np.inf else np.finfo(np.float32).min  # noqa: B023, E731
            near = top[j][rid[top[j]] != q_rid[i]]
            if wide[j, near].max(initial=-np.inf) >= bound():
                best.add(i, vec[near] @ q[i], ids[near], rid[near])
                wide[j, near] = -np.inf
            near = np.flatnonzero(wide[j] >= bound())
            near = near[rid[near] != q_rid[i]]
            if len(near):
                best.add(i, vec[near] @ q[i], ids[near], rid[near])


# --- exact Voronoi join ---------------------------------------------------------------------------------------------


def _augmented(vec: np.ndarray, top: float) -> np.ndarray:
    """Append sqrt(top - |v|^2): among vectors of one length, the largest inner product is the smallest distance."""
    return np.concatenate([vec, np.sqrt(np.maximum(top - (vec * vec).sum(1), 0))[:, None]], 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _assigned(rows: DataFrame, pivots: np.ndarray, top: float, query: bool) -> DataFrame:
    """The nearest pivot of each row (``cell``) and the distance to it. A query's additional coordinate is 0."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if not len(b):
                continue
            vec = np.stack(b["vec"].to_numpy()).astype(float)
            own = np.concatenate([vec, np.zeros((len(vec), 1))], 1) if query else _augmented(vec, top)
            d = _distances(own, pivots)
            cell = d.argmin(1)
            yield b.assign(cell=cell, far=d[np.arange(len(b)), cell])

    return rows.mapInPandas(run, "rid long, id long, vec array<double>, cell int, far double")


def choose_pivots(rows: DataFrame, n: int, top: float) -> np.ndarray:
    """About the root of ``n`` pivots, ``FEWEST`` to ``PIVOTS`` where there are so many different vectors: those of the rows with
    the smallest hashes. Of twice as many rows, repeated vectors count once."""
    many = min(PIVOTS, max(FEWEST, int(n**0.5)))
    sample = rows.select(F.xxhash64("rid").alias("h"), "rid", "vec").orderBy("h", "rid").limit(2 * many).collect()
    different = list({tuple(r.vec): None for r in sample})[:many]
    return _augmented(np.array(different), top)


def _chain(between: np.ndarray, have: list[int]) -> list[int]:
    """Cells so that neighbours follow each other: from each the nearest that is left."""
    left, out = set(have), []
    at = have[0]
    while left:
        at = min(left, key=lambda c: (between[at, c], c))
        out.append(at)
        left.discard(at)
    return out


def voronoi_join(df: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """The exact ``k`` largest integer inner products of each query with all other rows.

    Components become floor(scale * x). With one more coordinate, which gives all data vectors one length, the largest
    inner product is the smallest distance. Data and queries are grouped by their nearest pivot (:func:`choose_pivots`). From
    each cell's summary (its k + 1 smallest distances to the pivot) and each query group's radius follows a bound on the
    distance of a query's k-th neighbour, and from that the ring of each cell that can hold neighbours of the group; only
    those vectors are sent to the block that holds the group. There, cells come nearest first, and a query meets those of a
    cell's vectors whose distance to the pivot differs from its own by no more than its k-th neighbour's so far (or its
    bound); the rest is matrix products. Cells and groups of any size are split into blocks.

    Vectors that are null, empty, of another length than most, or hold null or non-finite components take no part, nor do
    null ids; a zero vector does. Repeated ids are rows of their own; a row is never its own neighbour; ties go to the
    smaller id. Scores must fit in 63 bits. An empty table gives an empty result; other columns are ignored.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (long).
    """
    rows = _usable(df, vector, id_col, zero=True)
    rows = rows.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))
    rows = materialise(rows.select("rid", "id", "vec"), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, top, most, dim = rows.agg(F.count("*"), F.max(square), F.max(F.array_max(F.transform("vec", F.abs))), F.max(F.size("vec"))).first()
    wanted = rows.where(F.pmod("id", F.lit(every)) == 0)
    if not n:
        return rows.selectExpr("id query_id", "0 rank", "id vec_id", "id score")
    pivots = choose_pivots(rows, n, top)
    data = materialise(_assigned(rows, pivots, top, query=False), "cells")
    queries = materialise(_assigned(wanted, pivots, top, query=True), "groups")

    near = Window.partitionBy("cell").orderBy("far", "rid")
    nearest = data.select("cell", "far", "rid").withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
    summary = [(r.cell, r.far) for r in nearest.select("cell", "far").collect()]  # at most PIVOTS * (k + 1)
    sizes = {r.cell: r.n for r in data.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    radius = {r.cell: (r.far, r.n) for r in queries.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    if not radius:
        return rows.limit(0).selectExpr("id query_id", "0 rank", "id vec_id", "cast(id as long) score")
    between = _distances(pivots, pivots)
    slack = 1e-6 * (1 + float(np.sqrt(top)))

    # groups that are near each other share a block of queries; a larger group has blocks of its own
    held, first, count, at, load = _queries_held(dim), {}, {}, 0, 0
    for g in _chain(between, sorted(radius)):
        m = radius[g][1]
        if load and load + m > held:
            at, load = at + 1, 0
        first[g], count[g] = at, blocks_for(m, held)
        load += m
        if count[g] > 1:
            at, load = at + count[g], 0
    total_q = max(first[g] + count[g] for g in first)
    rings: dict[tuple[int, int], list[float]] = {}  # of a cell and a block: the distances to the pivot that its groups ask for
    for g, (far, _) in radius.items():
        bounds = np.sort([far + between[g, c] + d for c, d in summary])
        reach = (bounds[k] if len(bounds) > k else np.inf) + far + slack
        for c in sizes:
            for qb in range(first[g], first[g] + count[g]):
                ring = rings.setdefault((c, qb), [np.inf, -np.inf, np.inf])
                ring[:] = min(ring[0], between[g, c] - reach), max(ring[1], between[g, c] + reach), min(ring[2], between[g, c])
    data_blocks = {c: blocks_for(m, BLOCK) for c, m in sizes.items()}
    start = dict(zip(data_blocks, np.cumsum([0, *data_blocks.values()]).tolist(), strict=False))
    runs = _runs(df.sparkSession, total_q, blocks_for(n, BLOCK))
    kind = "<i2" if most < 2**15 else "<f8"  # whole numbers, as narrow as they fit

    def numbered(df: DataFrame, begin: dict[int, int], count: dict[int, int]) -> DataFrame:
        """Rows with a ``block`` of their cell, dealt at random."""
        table = F.create_map(*(F.lit(x) for c in begin for x in (c, begin[c])))
        many = F.create_map(*(F.lit(x) for c in count for x in (c, count[c])))
        return df.withColumn("block", table[F.col("cell")] + F.pmod(F.xxhash64("rid", F.lit(7)), many[F.col("cell")]))

    cell_of = {start[c] + i: c for c in data_blocks for i in range(data_blocks[c])}

    def send(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Slices of data blocks to the query blocks whose groups may have neighbours in them."""
        for g in _grouped(it, "block"):
            g = g.sort_values(["far", "rid"], kind="stable", ignore_index=True)
            far, block = g["far"].to_numpy("<f8"), int(g["block"].iloc[0])
            vec = np.stack(g["vec"].to_numpy()).astype(kind)
            cell = cell_of[block]
            for qb in range(total_q):
                low, high, distance = rings[cell, qb]
                a, z = np.searchsorted(far, low - slack, "left"), np.searchsorted(far, high + slack, "right")
                if a < z:
                    raw = [x[a:z].tobytes() for x in (g["rid"].to_numpy("<i8"), g["id"].to_numpy("<i8"), vec, far)]
                    yield pd.DataFrame({"pair": qb * runs + block % runs, "side": [1 + distance], "block": block, "cell": cell, "n": int(z - a), "rid": raw[0], "id": raw[1], "vec": raw[2], "far": raw[3]})

    fields = "pair long, side double, block long, cell int, n int, rid binary, id binary, vec binary, far binary"
    dealt = numbered(data, start, data_blocks).repartition(blocks_for(n, BLOCK), "block").sortWithinPartitions("block", "rid")
    asked = _pack(numbered(queries, first, count), total_q).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
    asked = asked.select((F.col("block") * runs + F.col("run")).alias("pair"), F.lit(0.0).alias("side"), "block", F.lit(-1).alias("cell"), "n", "rid", "id", "vec", F.lit(None).cast("binary").alias("far"))
    met = _by_pair(asked.unionByName(dealt.mapInPandas(send, fields)), total_q * runs)
    bounds = np.array(sorted(summary), dtype=float).reshape(-1, 2)
    return _ranked(met.mapInPandas(_solve(k, kind, pivots, bounds, slack), _FOUND.format("long")), k)


class Group:
    """The queries of a block, their distances to the pivots, and an upper bound on the distance of each one's k-th neighbour."""

    def __init__(self, q: np.ndarray, k: int, pivots: np.ndarray, bounds: np.ndarray, slack: float):
        self.q, self.k, self.slack, self.top = q, k, slack, float((pivots[0] * pivots[0]).sum())
        self.length = (q * q).sum(1)
        self.pivots = _distances(np.concatenate([q, np.zeros((len(q), 1))], 1), pivots)
        self.reach = np.full(len(q), np.inf)
        if len(bounds) > k:  # of k + 1 vectors that near, one may be the query itself
            for at in range(0, len(q), 256):
                far = self.pivots[at : at + 256][:, bounds[:, 0].astype(int)] + bounds[:, 1]
                self.reach[at : at + 256] = np.partition(far, k, axis=1)[:, k] + slack

    def within(self, best: Best, cell: int, far: np.ndarray) -> np.ndarray:
        """Queries that some of a slice's vectors may be neighbours of; far: their ascending distances to the cell's pivot."""
        full = best.n == self.k
        # distance squared = |q|^2 + top - 2 * score, as all data vectors have one length
        known = np.sqrt(np.maximum(self.length + self.top - 2.0 * np.where(full, best.score[:, self.k - 1], 0), 0)) + self.slack
        reach = np.where(full, np.minimum(self.reach, known), self.reach)
        own = self.pivots[:, cell]
        return np.flatnonzero(np.searchsorted(far, own - reach, "left") < np.searchsorted(far, own + reach, "right"))


def _solve(k: int, kind: str, pivots: np.ndarray, bounds: np.ndarray, slack: float):
    none = np.iinfo(np.int64).min

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, best, q_rid, q_id, group = None, None, None, None, None
        for b in it:
            for row in b.itertuples():
                if row.pair != pair:
                    if best is not None:
                        yield best.frame(q_rid, q_id)
                    pair, best = row.pair, None
                if row.side == 0:
                    q_rid, q_id, q = _unpacked(row)
                    best, group = Best(len(q), k, int), Group(q, k, pivots, bounds, slack)
                elif best is not None:
                    rid, ids, vec = _unpacked(row, kind)
                    open_ = group.within(best, row.cell, np.frombuffer(row.far, "<f8"))
                    for at in range(0, len(open_), 512):
                        some(best, group.q, q_rid, open_[at : at + 512], rid, ids, vec)
        if best is not None:
            yield best.frame(q_rid, q_id)

    def some(best: Best, q: np.ndarray, q_rid: np.ndarray, open_: np.ndarray, rid: np.ndarray, ids: np.ndarray, vec: np.ndarray) -> None:
        own, n = q[open_], len(rid)
        exact = float(np.abs(own).max(initial=0) * np.abs(vec).max(initial=0) * q.shape[1]) < 2**53
        score = (own @ vec.T if exact else own.astype(np.int64) @ vec.T.astype(np.int64)).astype(np.int64)
        score[q_rid[open_][:, None] == rid[None, :]] = none
        least = np.partition(score, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_), none)
        least = np.maximum(least, np.where(best.n[open_] == k, best.score[open_, k - 1], none))
        for j in np.flatnonzero(score.max(1) >= least).tolist():
            near = np.flatnonzero((score[j] >= least[j]) & (rid != q_rid[open_[j]]))
            if len(near):
                best.add(int(open_[j]), score[j, near], ids[near], rid[near])

    return run
