"""Exact similarity join of word shingles, as a blocked product of the matrix of documents by n-grams with its transpose.

Rows are distinct shingle sets; a row's n-grams are put in order of rising frequency. Two sets that link share one of the first
``p = n - ceil(0.85 n) + 1`` n-grams of each, so the product is taken over these columns of each row, and no pair is lost.

1. One pass counts shingles in hashed counters, which only order n-grams: any order gives the same result. A second pass gives each
   document the digest of its set and the set's first n-grams; equal sets become one row of the matrix.
2. *Skeleton.* In each column, rows meet the next few in order of size. What passes the bounds is verified, and connected
   components are taken: a class of many near copies becomes one component by links in proportion to its rows.
3. *The rest.* Only pairs of rows in different components can add anything. In columns of up to ``SMALL`` rows they are joined. Rows of
   larger columns are dealt into blocks (rows of a large component into blocks of their own, which don't meet each other), blocks
   that share a column meet, and the incidence matrices of their whole sets are multiplied, some columns at a time: the product
   accumulates the overlap of every pair. Of the pairs that link, those that join components go on, not all.
4. Bounds that sizes give discard pairs: the ratio of sizes, the n-grams left after the place of a shared one, and the bits in which
   two parity signatures differ, which is at most the size of the symmetric difference. Pairs of the skeleton and of small
   columns that are left are verified by the overlap of the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise
from .components import connected_components
from .shingles import _PLACES, mix
from .suffix_kernel import _table, prefix_hash

#: Words of a shingle, and hundredths of the union that two sets that link have in common.
WORDS, SHARE = 4, 85
#: Hashed counters of shingles, and the counters of one row when tasks' counts are added up.
COUNTERS, STRIPE = 1 << 20, 1 << 13
#: Rows of a column that each row meets for the skeleton, and partners of a row that are verified for it.
AHEAD, PARTNERS = 8, 4
#: Rows of a column that is joined as it is; rows of a block of larger columns; columns multiplied at once.
SMALL, SIDE, COLUMNS = 64, 1024, 4096
#: Entries of a block, and rows of a column that one task puts in order.
ENTRIES, RUN = 1 << 18, 1 << 16
#: 64-bit words of a parity signature.
SIGNATURE = 8
#: Names of sets that are sent to all tasks at most, some 50 bytes each.
SENT = 200_000
#: Bytes of text that one numpy pass takes, and whole sets in one Arrow batch.
PASS, SETS = 1 << 22, 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(raw: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts that follow each other in the bytes ``raw`` and end at ``stops``: text numbers and 64-bit hashes,
    ascending. Two shingles are taken as equal if their hashes are."""
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    if not len(raw):
        return none
    low = _LOWER[raw]
    word = ~_SPACE[low]
    edge = np.zeros(len(low) + 1, bool)  # between bytes: where a text ends
    edge[0] = True
    edge[stops] = True
    starts = np.flatnonzero(word & (edge[:-1] | np.concatenate([[True], ~word[:-1]])))
    ends = np.flatnonzero(word & (edge[1:] | np.concatenate([~word[1:], [True]]))) + 1
    if not len(starts):
        return none
    prefix, inverse = prefix_hash(low), _table(len(low))[1]
    h = mix((prefix[ends] - prefix[starts]) * inverse[starts])
    text = np.searchsorted(stops, starts, "right")
    counts = np.bincount(text, minlength=len(stops))
    first = np.cumsum(counts) - counts
    at = np.flatnonzero(np.arange(len(h)) - first[text] < np.maximum(counts[text] - WORDS + 1, 1))
    last = (first + counts)[text[at]]
    out = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        ok = at + k < last
        out[ok] += (h[at[ok] + k] + np.uint64(k + 1)) * _PLACES[k]
    out, text = mix(out), text[at]
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (out[1:] != out[:-1])])
    return text[new], out[new]


def _passes(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a batch, a few megabytes of text at a time: first and last row, bytes, and where each text stops."""
    texts = batch["text"].cast(pa.large_string())
    stops = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(stops, stops[at] + PASS, "right")) - 1)
        yield at, to, raw[stops[at] : stops[to]], stops[at + 1 : to + 1] - stops[at]
        at = to


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts, tables are written with ``SETS`` rows in an Arrow batch: whole sets of long documents are large rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, SETS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _edges(text: np.ndarray, n: int) -> list[int]:
    return np.searchsorted(text, np.arange(n + 1)).tolist()


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """In how many texts shingles occur, by hashed counter. Tasks' counters are added in two steps of about the root of their number;
    the driver gets ``COUNTERS`` numbers at every size of the corpus."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for *_, raw, stops in _passes(b):
                total += np.bincount((shingle_sets(raw, stops)[1] & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        rows = total.reshape(-1, STRIPE)
        some = np.flatnonzero(rows.any(1))
        yield pa.record_batch({"part": pa.array([TaskContext.get().partitionId()] * len(some), pa.int32()), "stripe": pa.array(some, pa.int32()), "counts": pa.array([rows[i].astype("<i8").tobytes() for i in some], pa.binary())})

    def add(b: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(x, "<i8") for x in b["counts"]), np.zeros(STRIPE, np.int64))
        return pd.DataFrame({"part": [int(b["part"].iloc[0])], "stripe": [int(b["stripe"].iloc[0])], "counts": [total.tobytes()]})

    kind = "part int, stripe int, counts binary"
    parts = texts.select("text").mapInArrow(run, kind)
    ways = max(1, round(texts.rdd.getNumPartitions() ** 0.5))
    parts = parts.withColumn("part", F.col("part") % ways).groupBy("stripe", "part").applyInPandas(add, kind)
    out = np.zeros((COUNTERS // STRIPE, STRIPE), np.int64)
    for r in parts.groupBy("stripe").applyInPandas(add, kind).collect():
        out[r.stripe] = np.frombuffer(r.counts, "<i8")
    return np.minimum(out.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def _first(n: int) -> int:
    """N-grams of a set of n of which two sets that link share one."""
    return n + (-SHARE * n // 100) + 1


def _documents(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Rows (doc_id, doc, tid, text) with the number of shingles, the set's digest, and, once for each set of a batch, its first n-grams in
    order and its signature (parity of the shingles in each hashed place); no digest for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for b in batches:
            sizes, digests, prefixes, signs, seen = [], [], [], [], set()
            for at, to, raw, stops in _passes(b):
                text, h = shingle_sets(raw, stops)
                order = np.lexsort((h, counts[(h & np.uint64(COUNTERS - 1)).astype(np.int64)], text))
                ranked, edge = h[order], _edges(text, to - at)
                bits = 64 * SIGNATURE
                place = text * bits + ((h >> np.uint64(40)) % np.uint64(bits)).astype(np.int64)
                signature = np.packbits((np.bincount(place, minlength=(to - at) * bits) & 1).astype(np.uint8).reshape(to - at, bits), axis=1)
                for sign, a, z in zip(signature, edge[:-1], edge[1:], strict=True):
                    name = blake2b(h[a:z].tobytes(), digest_size=16).digest() if z > a else None
                    sizes.append(z - a)
                    digests.append(name)
                    new = name is not None and name not in seen
                    prefixes.append(ranked[a : a + _first(z - a)].tobytes() if new else None)
                    signs.append(sign.tobytes() if new else None)
                    seen.add(name)
            yield pa.record_batch({"doc_id": b["doc_id"], "doc": b["doc"], "tid": b["tid"], "n": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary()), "prefix": pa.array(prefixes, pa.binary()), "signature": pa.array(signs, pa.binary())})

    return rows.mapInArrow(run, "doc_id long, doc long, tid string, n long, digest binary, prefix binary, signature binary")


def _columns(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """The product's entries: g (n-gram), sid, n, pos (place of g in the set's order), m (rows of the column), for columns of two or more.

    Only columns that counters allow more than ``RUN`` rows are counted apart and joined, so that their rows may lie in many tasks.
    """

    def entries(often: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 1000):
                    part = b.slice(at, 1000)
                    lists = [np.frombuffer(p, "<u8") for p in part["prefix"].to_pylist()]
                    each = np.array([len(x) for x in lists])
                    g = np.concatenate(lists)
                    keep = np.flatnonzero((counts[(g & np.uint64(COUNTERS - 1)).astype(np.int64)] > RUN) == often)
                    pos = np.concatenate([np.arange(k) for k in each])[keep]
                    row = pa.array(np.repeat(np.arange(len(lists)), each)[keep])
                    yield pa.record_batch({"g": pa.array(g[keep].view(np.int64)), "sid": part["sid"].take(row), "n": part["n"].take(row).cast(pa.int32()), "pos": pa.array(pos, pa.int32())})

        return sets.select("sid", "n", "prefix").mapInArrow(run, "g long, sid long, n int, pos int")

    many = entries(True)
    sizes = many.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
    few = entries(False).withColumn("m", F.count("*").over(Window.partitionBy("g"))).where("m > 1")
    return few.unionByName(many.join(sizes.hint("merge"), "g"))


def _need(n: Column, other: Column) -> Column:
    """The smallest overlap of two sets that link."""
    return F.ceil((n + other) * SHARE / (100 + SHARE))


def _bounded(n: str, pos: str, other: str, place: str) -> Column:
    """Whether sizes and the places of a shared n-gram, if it is the first one, leave a link possible."""
    n, pos, other, place = (F.col(c) for c in (n, pos, other, place))
    return (F.least(n, other) * 100 >= F.greatest(n, other) * SHARE) & (F.least(n - pos, other - place) >= _need(n, other))


def _pairs_ahead(columns: DataFrame) -> DataFrame:
    """Pairs (a < b) of rows that are near each other in a column in order of size."""
    w = Window.partitionBy("g", F.pmod(F.xxhash64("sid"), F.ceil(F.col("m") / RUN))).orderBy("n", "sid")
    ahead = F.array(*(F.struct(*(F.lead(c, k).over(w).alias(f"{c}_b") for c in ("sid", "n", "pos"))) for k in range(1, AHEAD + 1)))
    pairs = columns.select("sid", "n", "pos", ahead.alias("o")).withColumn("o", F.explode("o")).select("sid", "n", "pos", "o.*")
    pairs = pairs.where(F.col("sid_b").isNotNull() & _bounded("n", "pos", "n_b", "pos_b"))
    return pairs.select(F.least("sid", "sid_b").alias("a"), F.greatest("sid", "sid_b").alias("b")).distinct()


def _signed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose signatures leave a link possible, with the number of bits in which they differ."""
    words = [F.conv(F.hex(F.substring("signature", 8 * k + 1, 8)), 16, -10).cast("long") for k in range(SIGNATURE)]
    signs = sets.select("sid", "n", *(w.alias(f"s{k}") for k, w in enumerate(words)))
    side = lambda c: signs.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), *(F.col(f"s{k}").alias(f"s{k}_{c}") for k in range(SIGNATURE))).hint("merge")
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(1, SIGNATURE)), F.bit_count(F.col("s0_a").bitwiseXOR(F.col("s0_b"))))
    n, other = F.col("n_a"), F.col("n_b")
    return both.select("a", "b", apart.alias("apart"), n, other).where(F.col("apart") <= n + other - 2 * _need(n, other)).select("a", "b", "apart")


def _whole(ends: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """Whole sets (sid, grams: sorted hashes) of the rows of ``ends``, from the text of one document each. Up to ``SENT`` names are sent to all
    tasks; beyond, texts are joined by name."""
    needed = materialise(sets.join(ends.hint("merge"), "sid", "left_semi").select("sid", "own.tid", "own.doc"), "needed")
    names = F.broadcast(needed) if needed.count() <= SENT else needed.hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, raw, stops in _passes(b):
                text, h = shingle_sets(raw, stops)
                edge = _edges(text, to - at)
                grams = [h[a:z].tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)]
                yield pa.record_batch({"sid": b["sid"].slice(at, to - at), "grams": pa.array(grams, pa.binary())})

    found = rows.join(names, ["tid", "doc"]).select("sid", "text").mapInArrow(run, "sid long, grams binary")
    return materialise(found.groupBy("sid").agg(F.min("grams").alias("grams")), "grams")  # a row may be there twice


def _verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs of sets that link, by the overlap of the whole sets."""
    pairs = materialise(pairs.select("a", "b"), "pairs")
    whole = _whole(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), sets, rows)
    side = lambda c: whole.select(F.col("sid").alias(c), F.col("grams").alias(f"grams_{c}")).hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for p, q in zip(batch["grams_a"], batch["grams_b"], strict=True):
                x, y = np.frombuffer(p.as_buffer(), "<u8"), np.frombuffer(q.as_buffer(), "<u8")
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                linked.append((100 + SHARE) * shared >= SHARE * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    with _small_batches(rows.sparkSession):
        found = materialise(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long"), "links")
    discard(pairs, whole)
    return found


def _pairs_across(columns: DataFrame) -> DataFrame:
    """Pairs (a < b) of rows of different components in columns of few rows. columns: with ``root``."""
    small = columns.where(F.col("m") <= SMALL)
    some = F.min("root").over(Window.partitionBy("g")) != F.max("root").over(Window.partitionBy("g"))
    small = small.withColumn("open", some).where("open").drop("open", "m")
    other = small.select("g", *(F.col(c).alias(f"{c}_b") for c in ("sid", "n", "pos", "root")))
    pairs = small.join(other.hint("merge"), "g").where((F.col("sid") < F.col("sid_b")) & (F.col("root") != F.col("root_b")) & _bounded("n", "pos", "n_b", "pos_b"))
    return pairs.select(F.col("sid").alias("a"), F.col("sid_b").alias("b")).distinct()


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of a partition that is sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        k = b[key].to_numpy()
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            if held and held[0][key][0].as_py() != k[a]:
                yield pa.Table.from_batches(held)
                held = []
            if z > a:
                held.append(b.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)


def multiply(columns: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """How many columns each pair of a left and a right row shares. columns, rows: of the entries of both incidence matrices."""
    names = np.intersect1d(*columns)
    out = np.zeros(shape, np.float32)
    for at in range(0, len(names), COLUMNS):
        part = names[at : at + COLUMNS]
        dense = []
        for g, r, n in zip(columns, rows, shape, strict=True):
            place = np.minimum(np.searchsorted(part, g), len(part) - 1)
            ok = part[place] == g
            x = np.zeros((n, len(part)), np.float32)
            x[r[ok], place[ok]] = 1
            dense.append(x)
        out += dense[0] @ dense[1].T
    return out


def _joining(a: np.ndarray, b: np.ndarray, root_a: np.ndarray, root_b: np.ndarray) -> np.ndarray:
    """Which of the links (a, b) join components that those before leave apart."""
    names, at = np.unique(np.concatenate([root_a, root_b]), return_inverse=True)
    up = list(range(len(names)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    keep = []
    for k, (x, y) in enumerate(zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            up[x] = y
            keep.append(k)
    return np.array(keep, np.int64)


def _links_of_blocks(columns: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a < b) between components in columns of many rows, by products of blocks: enough to join all components that
    links of these columns join. columns: with ``root``."""
    wide = columns.where(F.col("m") > SMALL)
    own = wide.groupBy("sid").agg(F.min(F.struct("pos", "g")).alias("lead"), F.first("n").alias("n"), F.first("root").alias("root"))
    own = materialise(own.withColumn("home", F.col("lead.g")).drop("lead"), "rows")
    classes = own.groupBy("home", "root").agg(F.count("*").alias("k"), F.sum("n").alias("e"))
    parts = lambda k, e: F.greatest(F.ceil(k / SIDE), F.ceil(e / ENTRIES))
    big = classes.where(F.col("k") >= SIDE // 4).select("home", "root", F.col("root").alias("alone"), parts(F.col("k"), F.col("e")).alias("parts"))
    rest = classes.where(F.col("k") < SIDE // 4).groupBy("home").agg(parts(F.sum("k"), F.sum("e")).alias("others"))
    placed = own.join(big.hint("merge"), ["home", "root"], "left").join(rest.hint("merge"), "home", "left")
    block = F.xxhash64("home", "alone", F.pmod(F.xxhash64("sid"), F.coalesce("parts", "others")))
    placed = materialise(placed.select("sid", "root", "alone", block.alias("block")), "blocks")
    held = materialise(wide.select("g", "sid").join(placed.hint("merge"), "sid").select("g", "block", "alone").distinct(), "held")
    other = held.select("g", F.col("block").alias("block_b"), F.col("alone").alias("alone_b"))
    meet = held.join(other.hint("merge"), "g").where((F.col("block") <= F.col("block_b")) & F.coalesce(F.col("alone") != F.col("alone_b"), F.lit(True)))
    meet = materialise(meet.select("block", "block_b").distinct().withColumn("key", F.monotonically_increasing_id()), "meetings")
    ends = F.expr("if(block = block_b, array(named_struct('block', block, 'side', 0)), array(named_struct('block', block, 'side', 0), named_struct('block', block_b, 'side', 1)))")
    sides = meet.select("key", (F.col("block") == F.col("block_b")).alias("same"), F.explode(ends).alias("end")).select("key", "same", "end.*")
    whole = _whole(placed.join(sides.select("block").distinct().hint("merge"), "block", "left_semi").select("sid"), sets, rows)

    def side(t: pa.Table, which: int) -> tuple[np.ndarray, ...]:
        own = t.filter(pa.array(t["side"].to_numpy() == which))
        grams = [np.frombuffer(g, "<u8") for g in own["grams"].to_pylist()]
        n = np.array([len(g) for g in grams], np.int64)
        return own["sid"].to_numpy(), own["root"].to_numpy(), n, np.concatenate([np.empty(0, "<u8"), *grams]), np.repeat(np.arange(len(n)), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "key"):
            sid_a, root_a, n_a, g_a, row_a = side(t, 0)
            sid_b, root_b, n_b, g_b, row_b = side(t, 0 if t["same"][0].as_py() else 1)
            shared = multiply((g_a, g_b), (row_a, row_b), (len(n_a), len(n_b)))
            n, other = n_a[:, None], n_b[None, :]
            ok = ((100 + SHARE) * shared.astype(np.int64) >= SHARE * (n + other)) & (root_a[:, None] != root_b[None, :])
            i, j = np.nonzero(ok)
            keep = _joining(i, j, root_a[i], root_b[j])
            a, b = sid_a[i[keep]], sid_b[j[keep]]
            yield pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    members = placed.select("sid", "root", "block").join(sides.hint("merge"), "block").drop("block").join(whole.hint("merge"), "sid")
    with _small_batches(rows.sparkSession):
        return materialise(members.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct(), "joined")


def overlap_join(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Link documents whose sets of distinct shingles of four words have 85 hundredths of their union in common.

    Words are what white space of ASCII parts, with A to Z in lower case; a text of fewer words than four has one shingle, of
    all of them. A text that is null or has no words has an empty set and links with nothing, not even with another
    empty one. Rows that are there twice link with each other; rows with null ids are linked but name no component, unless it
    has no other (then its name is null). An empty table gives an empty result; other columns are ignored.

    Returns for every row ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id that links reach.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tid", F.md5("text")).withColumn("doc", F.coalesce("doc_id", F.lit(-1)))
    counts = shingle_counts(rows)
    found = materialise(_documents(rows.select("doc_id", "doc", "tid", "text"), counts), "documents")
    sets = found.where("digest is not null").groupBy("digest").agg(F.max("prefix").alias("prefix"), F.max("signature").alias("signature"), F.first("n").alias("n"), F.min(F.struct("tid", "doc")).alias("own"))
    sets = materialise(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")
    ids = materialise(found.select("doc_id", "n", "digest"), "ids")
    discard(found)
    columns = materialise(_columns(sets, counts), "columns")
    sets, wide = materialise(sets.drop("prefix"), "names"), sets
    discard(wide)
    closest = Window.partitionBy("a").orderBy("apart", "b")
    ahead = _signed(_pairs_ahead(columns), sets).withColumn("nth", F.row_number().over(closest)).where(F.col("nth") <= PARTNERS)
    near = _verified(ahead, sets, rows)
    roots = materialise(connected_components(near), "roots")
    rooted = columns.join(roots.withColumnRenamed("node", "sid").hint("merge"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = materialise(rooted, "rooted")
    discard(columns)
    more = materialise(_verified(_signed(_pairs_across(rooted), sets), sets, rows).union(_links_of_blocks(rooted, sets, rows)), "more")
    discard(rooted)
    named = sets.select("digest", "sid").join(roots.withColumnRenamed("node", "sid").hint("merge"), "sid", "left")
    named = named.select("digest", F.coalesce("root", "sid").alias("root"))
    if not more.isEmpty():  # what joins components is a graph over their roots, much smaller than that over rows
        for end in ("a", "b"):
            more = more.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")).hint("merge"), end, "left").withColumn(end, F.coalesce(f"root_{end}", end)).drop(f"root_{end}")
        tops = materialise(connected_components(more), "tops")
        named = named.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")).hint("merge"), "root", "left").select("digest", F.coalesce("top", "root").alias("root"))
    firsts = ids.groupBy("digest").agg(F.min("doc_id").alias("first")).join(named.hint("merge"), "digest")
    firsts = materialise(firsts, "firsts")
    names = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    firsts = materialise(firsts.join(names.hint("merge"), "root").select("digest", "component_id"), "components")
    out = ids.join(firsts.hint("merge"), "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
