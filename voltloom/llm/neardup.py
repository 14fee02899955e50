"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. One pass counts in how many documents shingles occur, in ``BUCKETS`` hashed counters, whose size doesn't depend on
   the corpus; a weight depends on the share of documents. Each of several equal texts counts.
2. A second pass draws ``BANDS * ROWS`` weighted samples of each text: for each sample the shingle with the smallest
   ``ln a = ln c - r (t - beta) - r`` with ``t = floor(ln w / r + beta)``, where r and c follow Gamma(2, 1) and beta is
   uniform, all drawn from the shingle's hash. Two texts agree on a sample with the probability of their weighted
   Jaccard similarity.
3. Equal texts become one. Texts that agree on all samples of a band meet in a bucket. Within a bucket, sketches are
   compared locally and a maximum spanning forest of the pairs that may be similar, and a star around the text closest
   to all others, go on; the pairs of a bucket are never written out. Large buckets are dealt into blocks, and a few of
   their texts (hubs) are in all blocks, so that what is alike all through a bucket becomes one class.
4. The candidate pairs are verified on the whole texts by weighted Jaccard similarity; classes are the connected
   components of what remains.
5. Where a verified link is missing between classes of one bucket that may yet be similar, the texts meet in the bucket,
   and all such pairs are tested there, from the likeliest on, until the classes are joined or no pair is left. Blocks of a
   large bucket that holds several classes all meet, two by two; only blocks of the largest class don't meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise
from .components import connected_components
from .shingles import mix, shingles

WORDS, SIMILAR = 5, 0.8
#: Samples of a band, and bands: a pair at the threshold is missed with probability (1 - 0.8**3)**12 = 0.0002.
ROWS, BANDS = 3, 12
#: Hashed document counters, and the counters of one row when tasks' counts are added up.
BUCKETS, STRIPE = 1 << 18, 1 << 12
#: Weight of a shingle: its count times 1 + IDF * log(1 + documents / frequency) / log(1 + RARE), at most 1 + IDF. The factor is
#: small, so that in a large class of near copies the common text is not outweighed by the few words that differ. Counters
#: hold about 500 shingles of each document at every size of the corpus, so shares of documents under one of 500 all look alike.
IDF, RARE = 0.1, 512
#: Share of equal samples from which a pair is verified: 4.5 standard deviations below the threshold.
HOPE = 0.5
#: Texts of a bucket that are compared with each other at once.
BLOCK = 256
#: Texts of a large bucket, on average, that are in all its blocks.
HUBS = 16
#: Texts of a block where all blocks of a large bucket meet, two by two.
SIDE = 512
#: Characters of text that one numpy pass takes.
PASS = 1 << 20


@lru_cache(maxsize=1)
def _gamma() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, whose cumulative function is 1 - (1 + x) exp(-x), by bisection."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(len(p)), np.full(len(p), 60.0)
    for _ in range(60):
        x = (low + high) / 2
        under = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(under, x, low), np.where(under, high, x)
    return x


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    g = _gamma()
    seeds = np.random.default_rng(8).integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64)
    return g.astype(np.float32), (1 / g).astype(np.float32), np.log(g).astype(np.float32), seeds


def weights(h: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of shingles; idf: by hashed counter."""
    return count * idf[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]


def idf_table(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequency of each hashed counter, damped to 1 to 1 + IDF; it depends on shares of documents only."""
    share = np.maximum(frequency, 1) / max(1, documents)
    return (1 + IDF * np.minimum(1, np.log1p(1 / share) / np.log1p(RARE))).astype(np.float32)


def sketch(text: np.ndarray, h: np.ndarray, w: np.ndarray, n_texts: int) -> np.ndarray:
    """Samples of every text as unsigned 32-bit hashes, 0 for texts without shingles. text: ascending numbers."""
    out = np.zeros((n_texts, ROWS * BANDS), np.uint32)
    if not len(h):
        return out
    g, inverse, log_c, seeds = _draws()
    first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    have = text[first]
    slot = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
    log_w = np.log(w).astype(np.float32)
    scale = np.float32(2.0**-32)
    for i, seed in enumerate(seeds):
        z = (h ^ seed) * np.uint64(0x9FB21C651E98DF25)
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xD6E8FEB86659FD93)
        high = (z >> np.uint64(32)).astype(np.uint32)
        r_at = high & np.uint32(0xFFFF)
        beta = ((z & np.uint64(0xFFFFFFFF)).astype(np.uint32) * scale).astype(np.float32)
        r = g[r_at]
        t = np.floor(log_w * inverse[r_at] + beta)
        a = log_c[high >> np.uint32(16)] - r * (t - beta) - r
        least = np.minimum.reduceat(a, first)
        at = np.flatnonzero(a == least[slot])
        at = at[np.unique(slot[at], return_index=True)[1]]
        code = mix(h[at] + (t[at].astype(np.int64).astype(np.uint64) + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15))
        out[have, i] = (code >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return out


def _passes(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= PASS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _strings(column: pd.Series) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in column]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Hashed document frequencies of all shingles and the number of documents. texts: column ``text``.

    Every task adds up its own counters; tasks' counters are added in two steps of about the square root of their
    number. The driver gets ``BUCKETS`` counters, however large the corpus is.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            n += len(b)
            found = b["text"].value_counts(sort=False)  # copies in a batch are read once
            t, copies = found.index.tolist(), found.to_numpy()
            for at, to in _passes(t):
                text, h, _ = shingles(t[at:to], WORDS)
                bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int64)
                seen = np.unique(text * BUCKETS + bucket)  # a document counts once for a counter
                total += np.bincount(seen % BUCKETS, copies[at + seen // BUCKETS], BUCKETS).astype(np.int64)
        part = TaskContext.get().partitionId()
        if n:
            rows = total.reshape(-1, STRIPE)
            yield pd.DataFrame({"part": part, "stripe": range(len(rows)), "n": n, "counts": [r.astype("<i8").tobytes() for r in rows]})

    def add(b: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(x, "<i8") for x in b["counts"]), np.zeros(STRIPE, np.int64))
        return pd.DataFrame({"part": [int(b["part"].iloc[0])], "stripe": [int(b["stripe"].iloc[0])], "n": [int(b["n"].sum())], "counts": [total.tobytes()]})

    kind = "part int, stripe int, n long, counts binary"
    parts = texts.mapInPandas(run, kind)
    ways = max(1, round(texts.rdd.getNumPartitions() ** 0.5))
    parts = parts.withColumn("part", F.col("part") % ways).groupBy("stripe", "part").applyInPandas(add, kind)
    got = parts.groupBy("stripe").applyInPandas(add, kind).toPandas()
    out = np.zeros((BUCKETS // STRIPE, STRIPE), np.int64)
    for stripe, counts in zip(got["stripe"], got["counts"], strict=True):
        out[stripe] = np.frombuffer(counts, "<i8")
    return out.ravel(), int(got["n"].iloc[0]) if len(got) else 0


def _sketches(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.sort_values("doc", kind="stable").drop_duplicates("tid")  # one of a batch's copies
            t, ids, docs = _strings(b["text"]), b["tid"].to_numpy(), b["doc"].to_numpy()
            for at, to in _passes(t):
                text, h, count = shingles(t[at:to], WORDS)
                found = sketch(text, h, weights(h, count, idf), to - at)
                some = np.flatnonzero(found[:, 0])
                yield pd.DataFrame({"tid": ids[at:to][some], "doc": docs[at:to][some], "sketch": [x.tobytes() for x in found[some]]})

    return texts.mapInPandas(run, "tid string, doc long, sketch binary")


def _agreement(found: np.ndarray) -> np.ndarray:
    """How many samples each pair of sketches has in common; 0 on the diagonal."""
    m = len(found)
    if m <= 64:
        equal = (found[:, None, :] == found[None, :, :]).sum(2, dtype=np.int32)
    else:
        equal = np.zeros((m, m), np.int32)
        for column in found.T:
            equal += column[:, None] == column[None, :]
    np.fill_diagonal(equal, 0)
    return equal


def _forest(ids: list, found: np.ndarray) -> list[tuple]:
    """Links worth verifying among texts compared at once: a forest of the likeliest, and a star in each group that it connects."""
    m = len(ids)
    least = int(np.ceil(HOPE * found.shape[1]))
    if m == 2:
        return [(min(ids), max(ids))] if int((found[0] == found[1]).sum()) >= least else []
    equal = _agreement(found)
    x, y = np.nonzero(np.triu(equal >= least, 1))
    root = list(range(m))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, left = set(), m
    for i in np.argsort(-equal[x, y], kind="stable").tolist():
        a, b = int(x[i]), int(y[i])
        p, q = top(a), top(b)
        if p != q:
            root[max(p, q)] = min(p, q)
            links.add((a, b))
            left -= 1
            if left == 1:
                break
    strength = np.where(equal >= least, equal, 0).sum(1)
    groups: dict[int, list[int]] = {}
    for i in range(m):
        groups.setdefault(top(i), []).append(i)
    for members in groups.values():
        hub = max(members, key=lambda i: (strength[i], -i))
        links |= {(min(i, hub), max(i, hub)) for i in members if i != hub and equal[i, hub] >= least}
    return [(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in links]


def _groups(batches: Iterator[pd.DataFrame], *columns: str) -> Iterator[list[np.ndarray]]:
    """The columns of each group of a partition that is sorted by ``key``, the first of them; no frame for each group."""
    held: list[np.ndarray] | None = None
    for b in batches:
        arrays = [b[c].to_numpy() for c in columns]
        key = arrays[0]
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            part = [x[a:z] for x in arrays]
            if held is not None and held[0][0] == part[0][0]:
                held = [np.concatenate(pair) for pair in zip(held, part, strict=True)]
                continue
            if held is not None:
                yield held
            held = part
    if held is not None:
        yield held


def _matrix(sketches: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint32).reshape(len(sketches), -1)


def _frames(rows: Iterator[tuple], columns: list[str], size: int = 5000) -> Iterator[pd.DataFrame]:
    out = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield pd.DataFrame(out, columns=columns)
            out = []
    if out:
        yield pd.DataFrame(out, columns=columns)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "tid")


def _compare(rows: DataFrame) -> DataFrame:
    """Links (a, b) of every group. rows: key, tid, sketch."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for _, tid, sketches in _groups(batches, "key", "tid", "sketch"):
            yield from _forest(tid.tolist(), _matrix(sketches))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(found(batches), ["a", "b"])

    return _dealt(rows).mapInPandas(run, "a string, b string")


def _hopeful(found: np.ndarray, root: np.ndarray, own: np.ndarray, nth: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group that may be similar and aren't in one class yet, the likeliest first.

    own: the text's block; where two blocks meet, only pairs across them count. nth: number of the band whose blocks meet,
    so that a pair counts in the first band in which it agrees; -1 for a group that is compared by itself.
    """
    left = np.flatnonzero(own == own.min())
    right = np.flatnonzero(own == own.max())
    equal = np.zeros((len(left), len(right)), np.uint8)
    for column in found.T:
        equal += column[left][:, None] == column[right][None, :]
    names = np.unique(root, return_inverse=True)[1]
    equal[(names[left][:, None] == names[right][None, :]) | (equal < np.ceil(HOPE * found.shape[1]))] = 0
    if own.min() == own.max():
        equal = np.triu(equal, 1)
    x, y = np.nonzero(equal)
    order = np.argsort(-equal[x, y].astype(np.int16), kind="stable")
    x, y = left[x[order]], right[y[order]]
    if nth >= 0 and len(x):
        agree = np.stack([(found[x, i * ROWS : (i + 1) * ROWS] == found[y, i * ROWS : (i + 1) * ROWS]).all(1) for i in range(BANDS)])
        first = agree.argmax(0) == nth
        x, y = x[first], y[first]
    return x, y


def _crossings(groups: DataFrame) -> DataFrame:
    """All blocks of large buckets with several classes, two by two, as key, nth, own, tid and root. Texts of the bucket's
    largest class, dealt into blocks of their own, meet all others but not each other."""
    wide = groups.where(F.col("home") & (F.col("n") > BLOCK)).select("band", "nth", "tid", "root")
    classes = wide.groupBy("band", "root").agg(F.count("*").alias("m"))
    most = F.max(F.struct("m", "root"))
    open_ = classes.groupBy("band").agg(F.sum("m").alias("all"), most.alias("most")).where("most.m < all")
    open_ = open_.select("band", F.ceil((F.col("all") - F.col("most.m")) / SIDE).alias("others"), F.ceil(F.col("most.m") / SIDE).alias("largest"), F.col("most.root").alias("most"))
    rows = wide.join(open_.hint("merge"), "band").withColumn("main", F.col("root") == F.col("most"))
    place = F.xxhash64(F.lit("third"), "tid")
    own = F.when(F.col("main"), F.col("others") + F.pmod(place, "largest")).otherwise(F.pmod(place, "others"))
    rows = rows.withColumn("own", own)
    other = F.expr("explode(sequence(0L, if(main, others, others + largest) - 1))")
    rows = rows.select("band", "nth", "tid", "root", "own", other.alias("other"))
    key = F.xxhash64(F.lit("third"), "band", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(key.alias("key"), "nth", "own", "tid", "root")


def _unsettled(rows: DataFrame) -> DataFrame:
    """Members of groups that may be similar to a member of another class. rows: key, nth, own, tid, root, sketch."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for key, nth, own, tid, root, sketches in _groups(batches, "key", "nth", "own", "tid", "root", "sketch"):
            if (root != root[0]).any():
                open_ = np.unique(np.concatenate(_hopeful(_matrix(sketches), root, own, nth[0])))
                yield from ((key[i], nth[i], own[i], tid[i], root[i], sketches[i]) for i in open_.tolist())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(found(batches), ["key", "nth", "own", "tid", "root", "sketch"])

    return _dealt(rows).mapInPandas(run, "key long, nth int, own long, tid string, root string, sketch binary")


def _settled(rows: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Verify, in a group, pairs of different classes from the likeliest on until all that are left are tested, and join
    classes on the way. rows: key, nth, own, tid, root, sketch, text. Returns the links (a, b)."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        seen: dict[tuple[str, str], bool] = {}  # pairs meet in several bands
        for _, nth, own, tid, root, sketches, texts in _groups(batches, "key", "nth", "own", "tid", "root", "sketch", "text"):
            root = root.copy()
            x, y = _hopeful(_matrix(sketches), root, own, nth[0])
            sets = None
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                if root[i] == root[j]:
                    continue
                pair = (min(tid[i], tid[j]), max(tid[i], tid[j]))
                near = seen.get(pair)
                if near is None:
                    if sets is None:
                        text, h, count = shingles(list(texts), WORDS)
                        w = weights(h, count, idf).astype(np.float64)
                        edge = np.searchsorted(text, np.arange(len(tid) + 1))
                        sets = [(h[a:z], w[a:z]) for a, z in zip(edge[:-1], edge[1:], strict=True)]
                    near = weighted_jaccard(sets[i], sets[j]) >= threshold
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen[pair] = near
                if near:
                    yield pair
                    root[root == root[j]] = root[i]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames(found(batches), ["a", "b"])

    return _dealt(rows).mapInPandas(run, "a string, b string")


def candidate_links(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of texts (a < b) to verify, and the groups that were compared: key, band, its number (nth) and texts (n), tid, and
    whether the text is there as one of the block's own (home) or as a hub of the bucket.

    sketches: one row for each text, ``tid`` and ``sketch``.
    """
    whole = F.col("sketch")
    keys = [F.xxhash64(F.lit(i), F.substring(whole, i * ROWS * 4 + 1, ROWS * 4)) for i in range(BANDS)]
    bands = sketches.select("tid", F.posexplode(F.array(*keys)).alias("nth", "band"))
    sizes = materialise(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "bands")
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("tid", "band"), blocks)
    hub = (F.col("n") > BLOCK) & (F.pmod(F.xxhash64(F.lit("hub"), "tid", "band"), F.greatest(F.lit(1), F.floor(F.col("n") / HUBS))) == 0)
    groups = bands.join(sizes.hint("merge"), "band").withColumn("own", own).withColumn("hub", hub).withColumn("blocks", blocks)
    groups = groups.withColumn("place", F.explode(F.expr("if(hub, sequence(0L, blocks - 1), array(own))")))
    groups = groups.select(F.xxhash64("band", "place").alias("key"), "band", "tid", "nth", "n", (F.col("place") == F.col("own")).alias("home"))
    groups = materialise(groups, "groups")
    links = _compare(groups.select("key", "tid").join(sketches.hint("merge"), "tid")).distinct()
    return materialise(links, "candidates"), groups


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two texts given as ascending hashes with weights; 0 if neither has any."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    both = hb[at] == ha
    low = float(np.minimum(wa[both], wb[at[both]]).sum())
    return low / (float(wa.sum()) + float(wb.sum()) - low)


def _verified(pairs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 200):
                part = b.iloc[at : at + 200]
                names = dict(zip([*part["a"], *part["b"]], [*part["text_a"], *part["text_b"]], strict=True))
                text, h, count = shingles(list(names.values()), WORDS)
                w = weights(h, count, idf).astype(np.float64)
                edge = np.searchsorted(text, np.arange(len(names) + 1))
                place = {t: slice(edge[i], edge[i + 1]) for i, t in enumerate(names)}
                score = [weighted_jaccard((h[place[p]], w[place[p]]), (h[place[q]], w[place[q]])) for p, q in zip(part["a"], part["b"], strict=True)]
                yield pd.DataFrame({"a": part["a"], "b": part["b"], "similarity": score})

    return pairs.mapInPandas(run, "a string, b string, similarity double").where(F.col("similarity") >= threshold)


def near_duplicates(docs: DataFrame, threshold: float = SIMILAR, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Classes of equal and near-equal texts.

    Two texts are linked if the weighted Jaccard similarity of their five-word shingles is ``threshold`` or more; classes
    are the connected components. A null text counts as empty; empty texts are equal to each other and to nothing
    else. Rows that are there twice, and rows with null ids, belong to their text's class; an empty table gives an empty
    result; other columns are ignored.

    Returns for every row: ``doc_id``, ``tid`` (digest of the text), ``class_id`` (smallest id of the class),
    ``class_size`` (rows), ``class_tid`` (digest of the text that represents it: that of the smallest id, then the smallest).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tid", F.md5("text"))
    frequency, n = document_frequencies(rows.select("text"))
    idf = idf_table(frequency, n)
    own = rows.select("tid", F.coalesce("doc_id", F.lit(-1)).alias("doc"), "text")
    sketches = _sketches(own, idf).groupBy("tid").agg(F.max("sketch").alias("sketch"), F.min("doc").alias("doc"))
    firsts = materialise(sketches, "sketches")
    sketches = firsts.drop("doc")
    links, groups = candidate_links(sketches)
    # ends of links are read, and what large buckets hold, as any of it may meet any other later
    needed = links.select(F.col("a").alias("tid")).union(links.select("b")).union(groups.where(F.col("n") > BLOCK).select("tid")).distinct()
    # one document stands for each text; so a large class of equal texts is dealt out by document
    needed = materialise(firsts.select("tid", "doc").join(needed.hint("merge"), "tid", "left_semi"), "needed")
    texts = own.join(needed.hint("merge"), ["tid", "doc"], "left_semi").groupBy("tid").agg(F.min("text").alias("text"))
    texts = materialise(texts, "texts")
    pairs = links.join(texts.select(F.col("tid").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    pairs = pairs.join(texts.select(F.col("tid").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b").select("a", "b", "text_a", "text_b")
    near = materialise(_verified(pairs, idf, threshold).select("a", "b"), "near")
    # a forest may miss a link that a failed one stood for: go back to groups whose classes may yet be similar
    root = materialise(connected_components(near), "roots")
    groups = groups.join(root.withColumnRenamed("node", "tid").hint("merge"), "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    groups = materialise(groups, "rooted")
    met = groups.select("key", F.lit(-1).alias("nth"), F.lit(0).cast("long").alias("own"), "tid", "root")
    met = met.unionByName(_crossings(groups))
    # whoever has such a partner in its own block is an end of a tested pair, so its text is at hand
    open_ = materialise(_unsettled(met.join(sketches.hint("merge"), "tid")), "unsettled")
    more = materialise(_settled(open_.join(texts.hint("merge"), "tid"), idf, threshold).distinct(), "more")
    if not more.isEmpty():
        root = connected_components(near.unionByName(more))
    discard(firsts, texts, open_)
    ids = rows.select("doc_id", "tid").join(root.hint("merge"), F.col("tid") == F.col("node"), "left")
    ids = materialise(ids.select("doc_id", "tid", F.coalesce("root", "tid").alias("root")), "ids")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("first")
    classes = ids.groupBy("root").agg(F.count("*").alias("class_size"), first)
    classes = materialise(classes.select("root", "class_size", F.col("first.doc_id").alias("class_id"), F.col("first.tid").alias("class_tid")), "classes")
    return ids.join(classes.hint("merge"), "root").select("doc_id", "tid", "class_id", "class_size", "class_tid")
