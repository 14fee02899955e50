"""Shards of even size by balanced label propagation.

Documents are linked where they share a *link key* (here: equal texts); a document's neighbours are the others with its
key. Links are kept as (document, key), never as pairs. In every round, counts of key and shard tell for each key where
most of its bytes lie among the shards that still have room; documents elsewhere ask to move there, and each shard admits
movers up to its quota, in the order of a hash of their key, so that neighbours move together. Rounds end when nobody
moves. Documents without neighbours, and what overfull shards must give up, then fill all shards evenly along one line of
bytes.

The driver sees only sums for each shard and hashed bucket, and the documents larger than 1/256 of a shard, of which there
are at most 256 times the number of shards.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, discard, materialise, utf8_bytes

#: Rounds at most; hashed buckets in which movers are admitted; a large document's share of a shard.
ROUNDS, ADMISSION, LARGE = 12, 512, 256
#: Documents of one stretch of the line, and stretches at most.
STRETCH, STRETCHES = 20_000, 1 << 16


def _lookup(values: list, index: Column, kind: str) -> Column:
    """``values[index]`` for a short list."""
    return F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), (index + 1).cast("int"))


def _sums(df: DataFrame, *by: str) -> dict:
    return {tuple(r[:-1]): int(r[-1]) for r in df.groupBy(*by).agg(F.sum("size")).collect()}


def _propagate(linked: DataFrame, shards: int, target: float) -> DataFrame:
    """Rounds of label propagation. linked: rid, key, crc, size, shard."""
    for turn in range(ROUNDS):
        load = np.zeros(shards)
        for (s,), n in _sums(linked, "shard").items():
            load[s] = n
        room = [bool(x < target) for x in load]
        tie = F.xxhash64("key", "crc", "shard")
        held = linked.groupBy("key", "crc", "shard").agg(F.sum("size").alias("w")).withColumn("rank", F.struct("w", tie.alias("tie"), "shard"))
        best = held.groupBy("key", "crc").agg(
            F.max(F.when(_lookup(room, F.col("shard"), "boolean"), F.col("rank"))).alias("best"),
            F.sum("w").alias("all"),
            F.map_from_entries(F.collect_list(F.struct("shard", "rank"))).alias("ranks"),  # at most one entry for each shard
        )
        best = materialise(best.where("best is not null and size(ranks) > 1"), "best")
        # neighbours are admitted together, except where the whole class can't fit in one shard anyway
        unit = F.when(F.col("all") > target / 2, F.xxhash64("rid", F.lit(turn))).otherwise(F.xxhash64("key", "crc", F.lit(turn)))
        asked = linked.join(best.hint("merge"), ["key", "crc"]).where(F.col("best") > F.col("ranks")[F.col("shard")])
        asked = asked.select("rid", "size", F.col("best.shard").alias("to"), F.pmod(unit, F.lit(ADMISSION)).cast("int").alias("bucket"))
        asked = materialise(asked, "asked")
        wishes = _sums(asked, "to", "bucket")
        limit = []
        for s in range(shards):
            left, k = target - load[s], 0
            while k < ADMISSION and (left := left - wishes.get((s, k), 0)) >= 0:
                k += 1
            limit.append(k)
        moved = asked.where(F.col("bucket") < _lookup(limit, F.col("to"), "int")).select("rid", "to")
        n_moved = moved.count()
        if n_moved:
            after = linked.join(moved.hint("merge"), "rid", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")
            after = materialise(after, "linked")
            discard(linked)
            linked = after
        discard(best, asked)
        if not n_moved:
            break
    return linked


def _fill(free: DataFrame, load: np.ndarray, rows: int) -> DataFrame:
    """Put free documents (rid, key, size) into shards so that all end at the same size, up to one document."""
    shards = len(load)
    total = sum(_sums(free, "large").values())
    target = (load.sum() + total) / shards
    load = load.copy()
    placed = {}
    heap = [(x, s) for s, x in enumerate(load.tolist())]
    heapq.heapify(heap)
    for r in sorted(free.where("large").select("rid", "size").collect(), key=lambda r: (-r.size, r.rid)):
        x, s = heapq.heappop(heap)
        placed[r.rid] = s
        load[s] += r.size
        heapq.heappush(heap, (x + r.size, s))
    spark = free.sparkSession
    large = spark.createDataFrame(list(placed.items()), "rid long, shard int")
    room = np.maximum(target - load, 0.0)
    small = sum(_sums(free.where("not large"), "large").values())
    ends = (np.cumsum(room) * (small / max(room.sum(), 1e-9))).tolist() if room.sum() > 0 else [small * (s + 1) / shards for s in range(shards)]
    stretches = min(STRETCHES, blocks_for(rows, STRETCH) * 16)
    line = free.where("not large").withColumn("h", F.xxhash64("key", "crc")).withColumn("stretch", F.pmod("h", F.lit(stretches)).cast("int"))
    sums = _sums(line, "stretch")
    offsets = np.concatenate([[0], np.cumsum([sums.get((k,), 0) for k in range(stretches)])])[:-1].tolist()
    offset = spark.createDataFrame(list(enumerate(offsets)), "stretch int, offset long")
    # a class of equal texts may be large: split every stretch further by document, with its own offsets
    line = line.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(16)).cast("int"))
    parts = line.groupBy("stretch", "part").agg(F.sum("size").alias("w"))
    before = F.coalesce(F.sum("w").over(Window.partitionBy("stretch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("stretch", "part", before.alias("shift")).join(F.broadcast(offset), "stretch").select("stretch", "part", (F.col("shift") + F.col("offset")).alias("shift"))
    own = F.sum("size").over(Window.partitionBy("stretch", "part").orderBy("h", "crc", "rid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    line = line.withColumn("own", own).join(F.broadcast(parts), ["stretch", "part"])
    middle = F.col("own") + F.col("shift") + F.col("size") / 2
    shard = sum((F.when(middle >= e, 1).otherwise(0) for e in ends[:-1]), F.lit(0)).cast("int")
    return line.select("rid", shard.alias("shard")).unionByName(large)


def shard(docs: DataFrame, shards: int = 16, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Deal all documents into ``shards`` shards of nearly equal bytes with equal texts together where they fit.

    A document's size is its UTF-8 bytes plus 1; a null text has size 1, crc32 0 and no links. Repeated rows are equal
    texts like any; null ids stay null; other columns are ignored; an empty table gives an empty result. A class larger
    than a shard is spread over several shards, as few as quotas allow.

    Returns ``doc_id``, ``size``, ``text_crc32``, ``law`` (always 'bytes'), ``shard``, ``slot`` (gapless in the shard).
    """
    body = F.col(text).cast("string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), (utf8_bytes(body) + 1).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).alias("crc"), F.when(body.isNotNull(), F.xxhash64(body)).alias("key"),
    )
    rows = materialise(rows, "documents")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    target = total / shards
    classes = rows.where("key is not null").groupBy("key", "crc").agg(F.count("*").alias("n")).where("n > 1").select("key", "crc")
    classes = materialise(classes, "classes")
    linked = rows.join(classes.hint("merge"), ["key", "crc"], "left_semi").select("rid", "key", "crc", "size")
    start = F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int")
    linked = _propagate(materialise(linked.withColumn("shard", start), "linked"), shards, target)

    # what overfull shards must give up goes to the free documents, class by class
    load = np.zeros(shards)
    for (s,), w in _sums(linked, "shard").items():
        load[s] = w
    limit = [ADMISSION] * shards
    bucket = F.pmod(F.xxhash64("key", "crc"), F.lit(ADMISSION)).cast("int")
    if (load > target).any():
        held = _sums(linked.withColumn("bucket", bucket), "shard", "bucket")
        for s in np.flatnonzero(load > target).tolist():
            while load[s] > target:
                limit[s] -= 1
                load[s] -= held.get((s, limit[s]), 0)
    stays = materialise(linked.where(bucket < _lookup(limit, F.col("shard"), "int")).select("rid", "shard"), "stays")
    free = rows.join(stays.select("rid").hint("merge"), "rid", "left_anti").select("rid", F.coalesce("key", "rid").alias("key"), "crc", "size", (F.col("size") > max(1.0, target / LARGE)).alias("large"))
    free = materialise(free, "free")
    placed = materialise(stays.unionByName(_fill(free, load, n)), "placed")
    discard(linked, stays, free, classes)

    parts = min(STRETCHES // shards, blocks_for(n, STRETCH) * 4)
    out = rows.join(placed.hint("merge"), "rid").withColumn("part", F.pmod(F.xxhash64("rid", F.lit("slot")), F.lit(parts)).cast("int"))
    counts = out.groupBy("shard", "part").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("shard", "part", before.alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("rid")) - 1
    out = out.withColumn("place", place).join(F.broadcast(offsets), ["shard", "part"])
    return out.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("place")).alias("slot"))
