"""Cost-balanced packing of tokenised documents into sequences of fixed capacity.

A document's ids are cut into full pieces of ``capacity`` ids, which are sequences of their own, and one tail. Tails
are dealt by hashes into blocks of about ``BLOCK`` documents, and every block is packed alone: it opens as few
sequences as its ids need, then takes its tails by descending length and puts each into the sequence with the lowest
estimated cost among those with room for it. The cost of a piece of ``n`` ids is ``linear * n + quadratic * n * n``:
the feed-forward part plus the attention within the piece. A tail for which no sequence has room is cut to fill the
cheapest one, and the rest goes on. So a block pads at most one sequence, whatever the lengths are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, materialise
from .tokens import encoder, without_cycles

#: Documents packed together. Padding is at most one sequence for each block.
BLOCK = 1024
#: Copies of one row that one row of a run stands for.
COPIES = 1000
#: Cost of a sequence: per id, and per pair of ids of one piece. At 2048 ids the quadratic part is half the linear one.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Sequence ids: the block in the high bits, the sequence within the block in the low ones.
LOCAL_BITS = 31
_WORD = (1 << 64) - 1

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pack the tails of one block.

    Returns (tail, start within the tail, length, sequence, offset) of each piece; equal lengths go by position.
    """
    total = int(lengths.sum())
    n = -(-total // capacity)
    if not n:
        return []
    room = np.full(n, capacity, np.int64)
    cost = np.zeros(n)
    waiting = [(-int(length), i, 0) for i, length in enumerate(lengths.tolist()) if length]
    heapq.heapify(waiting)
    out = []
    while waiting:
        left, i, start = heapq.heappop(waiting)
        length = -left
        fits = np.flatnonzero(room >= length)
        if len(fits):
            s = int(fits[np.argmin(cost[fits])])
            take = length
        else:
            some = np.flatnonzero(room)
            s = int(some[np.argmin(cost[some])])
            take = int(room[s])
            heapq.heappush(waiting, (take - length, i, start + take))
        out.append((i, start, take, s, capacity - int(room[s])))
        room[s] -= take
        cost[s] += linear * take + quadratic * take * take
    return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 2048, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    A document is its ids without special tokens, then ``end_id``; a null or empty text is that one id. Every id lies
    in exactly one piece; pieces of one document may lie in several sequences. Repeated rows are packed once each, a
    null id stays null, an empty table gives no pieces, and other columns are ignored. A giant text becomes many full
    pieces, which spread over all blocks. One shuffle moves the ids (two bytes each while they fit), dealt by a hash of the
    document's id, the piece's place and its ids; so the layout doesn't depend on how the rows are split over tasks. Rows that
    are there several times are numbered over the whole table and dealt by their number too, so no key of the data can make a
    task large; a block's memory is bounded by ``BLOCK`` documents' tails.

    Returns the pieces: ``doc_id``, ``start`` (ids of the document before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (place in the sequence, gapless from 0).
    """
    rows = _numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")))
    blocks = blocks_for(docs.count(), BLOCK)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_path)
        each = enc.width
        for b in batches:
            out = []
            for doc, t, number in zip(b["doc_id"], b["text"], b["number"], strict=True):
                with without_cycles():
                    raw = enc.packed(t) + end_id.to_bytes(each, "little")
                n = len(raw) // each
                for start in range(0, n, capacity):
                    ids = raw[start * each : (start + capacity) * each]
                    h = xxhash.xxh3_64_intdigest(ids, hash((none := bool(pd.isna(doc)), 0 if none else int(doc), start)) & _WORD)
                    block = xxhash.xxh3_64_intdigest(int(number).to_bytes(8, "little"), h) if number else h
                    out.append((doc, start, min(capacity, n - start), ids, n, block % blocks))
                if len(out) >= 4000:
                    yield _frame(out)
                    out = []
            if out:
                yield _frame(out)

    def fill(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["doc_id", "start", "ids"], kind="stable", ignore_index=True)  # the order of arrival is not fixed
        lengths = b["length"].to_numpy()
        full = lengths == capacity
        pieces = [(i, 0, capacity, k, 0) for k, i in enumerate(np.flatnonzero(full).tolist())]
        opened = len(pieces)
        tails = np.flatnonzero(~full)
        pieces += [(int(tails[i]), s, n, opened + q, o) for i, s, n, q, o in assign(lengths[tails], capacity)]
        at, start, length, seq, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
        raw, n = b["ids"].to_numpy(), lengths
        ids = [_widen(raw[i], n[i])[4 * s : 4 * (s + k)] for i, s, k in zip(at, start, length, strict=True)]
        return pd.DataFrame(
            {"doc_id": b["doc_id"].to_numpy()[at], "start": b["start"].to_numpy()[at] + start, "length": length, "ids": ids, "doc_tokens": b["doc_tokens"].to_numpy()[at], "sequence_id": (int(key[0]) << LOCAL_BITS) + seq, "offset": offset}
        )

    cuts = rows.mapInPandas(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, block long")
    return cuts.groupBy("block").applyInPandas(fill, PIECES)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``number``: 0, 1, ... for the copies of a row, over the whole table.

    Only rows whose hash is there twice are brought together, as one row and its count, and then dealt out again in runs
    of ``COPIES``, so that a row of a million copies is many tasks' work.
    """
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    twice = materialise(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "copies")
    if twice.isEmpty():
        return rows.select("doc_id", "text", F.lit(0).cast("long").alias("number"))
    once = rows.join(twice, "key", "left_anti").select("doc_id", "text", F.lit(0).cast("long").alias("number"))
    counted = rows.join(twice, "key", "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    runs = counted.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    runs = runs.repartition(F.xxhash64("doc_id", "text", "first"))
    number = F.explode(F.sequence("first", F.least(F.col("n"), F.col("first") + COPIES) - 1)).alias("number")
    return once.unionByName(runs.select("doc_id", "text", number))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "block"])
    return out.assign(doc_id=out["doc_id"].astype("Int64"))


def _widen(raw: bytes, n: int) -> bytes:
    return raw if len(raw) == 4 * n else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
