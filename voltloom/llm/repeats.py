"""Removal of exact repeats: every byte covered by a string of ``window`` bytes that also starts anywhere else.

Suffixes are sorted by hash-compared mergesort (:mod:`suffix_kernel`). Sorting all suffixes of a corpus in one place is
out of the question, so windows are first dealt by an *anchor*: the gram of ``GRAM`` bytes with the smallest hash within
the window. Equal windows have equal anchors at the same place, so they meet in one group, and a group's windows need to
be compared only with each other. Neighbouring windows with one anchor form a *segment*.

1. A pass over the texts lists segments: anchor, hash of the segment's bytes, document, place (about one for each 170
   bytes; no text is moved). Where a text repeats itself at a short distance, its equal segments follow each other and are
   one row.
2. Segments whose anchor occurs once are unique. Where all segments of an anchor have one hash, all their windows are
   repeated.
3. Of the other anchors, one segment of each distinct hash is fetched, and a suffix sort within the group finds the
   windows that two of them share. Groups of more than ``GROUP`` distinct segments are split before that: their segments
   are cut into stretches of ``SPLIT`` windows, dealt by the bytes that all windows of a stretch share, and in the last
   resort into single windows, for which equality of the whole is all there is to find.
4. The repeated windows of each document are joined to its text.

A shorter window with a least number of words finds passages: all that two windows of the longer size share lies in runs of
the shorter, so the search for the longer one then needs to read those runs only.

Joins carry one row for each segment and split skewed keys at run time; a group of equal documents only adds to counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise
from .suffix_kernel import anchors, repeated_windows

WINDOW, GRAM = 400, 64
#: Distinct segments of one anchor that are sorted together, and windows of a stretch where there are more.
GROUP, SPLIT = 256, 16
#: Bytes of text that one numpy pass takes, and bytes of segments sorted together (a larger group goes alone).
PASS, SORT = 1 << 19, 1 << 19

#: Passages: runs of repeated strings of PASSAGE bytes (with anchors of PASSAGE_GRAM) that hold more than LEAST[0] words or have
#: LEAST[1] bytes or more. One of over fifty words is found if its words have three letters or more on average.
PASSAGE, PASSAGE_GRAM, LEAST = 200, 40, (50, WINDOW)

#: A row stands for ``times`` equal segments of ``count`` windows that follow each other.
_SEGMENT = "anchor long, piece long, doc long, text_hash long, start long, count int, times int, shift int"


def _segments(window: int, gram: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held: list[tuple] = []
            size = 0
            for doc, h, raw in zip(b["doc"], b["text_hash"], b["text"], strict=True):
                for at in range(0, max(1, len(raw) - window + 1), PASS):  # parts of a giant text overlap by a window less one byte
                    part = raw[at : at + PASS + window - 1]
                    if len(part) < window:
                        continue
                    if held and size + len(part) > PASS:
                        yield found(held)
                        held, size = [], 0
                    held.append((doc, h, at, part))
                    size += len(part)
            if held:
                yield found(held)

    def found(held: list[tuple]) -> pd.DataFrame:
        buffer = b"".join(x[3] for x in held)
        stops = np.cumsum([len(x[3]) for x in held])
        starts = stops - np.array([len(x[3]) for x in held])
        text, first, count, shift, anchor = anchors(np.frombuffer(buffer, np.uint8), starts, stops, window, gram)
        view = memoryview(buffer)
        piece = [xxhash.xxh3_64_intdigest(view[a:z]) for a, z in zip(first.tolist(), (first + count + window - 1).tolist(), strict=True)]
        piece = np.array(piece, np.uint64).view(np.int64)
        doc, h, at = (np.array([x[i] for x in held], np.int64) for i in range(3))
        again = first[1:] == first[:-1] + count[:-1]
        for x in (text, anchor, piece, count, shift):
            again &= x[1:] == x[:-1]
        one = np.flatnonzero(np.concatenate([np.ones(min(1, len(first)), bool), ~again]))
        times = np.diff(np.append(one, len(first)))
        text = text[one]
        return pd.DataFrame(
            {"anchor": anchor[one], "piece": piece[one], "doc": doc[text], "text_hash": h[text], "start": first[one] - starts[text] + at[text], "count": count[one].astype(np.int32), "times": times.astype(np.int32), "shift": shift[one].astype(np.int32)}
        )

    return run


def _sorted(window: int):
    """Suffix-sort the groups of a partition that is sorted by anchor; yields the windows found as runs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            held.append(b)
            if sum(map(len, held)) < 2000:
                continue
            rows = pd.concat(held, ignore_index=True)
            whole = rows["anchor"].to_numpy() != rows["anchor"].iloc[-1]  # the last group may go on in the next batch
            yield from solve(rows[whole])
            held = [rows[~whole]]
        if held:
            yield from solve(pd.concat(held, ignore_index=True))

    def solve(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        key = rows["anchor"].to_numpy()
        edges = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(rows))
        load = np.concatenate([[0], np.cumsum(rows["raw"].str.len().to_numpy())])
        at = 0
        while at < len(edges) - 1:
            to = at + 1
            while to < len(edges) - 1 and load[edges[to + 1]] - load[edges[at]] <= SORT:
                to += 1
            part = rows.iloc[edges[at] : edges[to]]
            at = to
            flags = repeated_windows(part["raw"].tolist(), part["anchor"].to_numpy(), part["shift"].to_numpy(np.int64), part["count"].to_numpy(np.int64), window)
            out = []
            for doc, h, start, copies, flag in zip(part["doc"], part["text_hash"], part["start"], part["copies"], flags, strict=True):
                if copies == 1 and flag.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8)))
                    out += [(doc, h, start + a, start + z - 1) for a, z in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
            if out:
                yield pd.DataFrame(out, columns=["doc", "text_hash", "low", "high"])

    return run


def _cut(window: int, low: int, high: int):
    """Take the bytes of a document's wanted segments, of groups of ``low`` to ``high`` segments, out of its text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for b in batches:
            out = []
            for doc, h, raw, wanted in zip(b["doc"], b["text_hash"], b["text"], b["wanted"], strict=True):
                if (doc, h) == last:
                    continue  # the same row again
                last = (doc, h)
                for w in wanted:
                    if low <= w["size"] <= high:
                        out.append((w["anchor"], doc, h, w["start"], w["count"], w["shift"], w["copies"], raw[w["start"] : w["start"] + w["count"] + window - 1]))
                if len(out) > 5000:
                    yield pd.DataFrame(out, columns=_CUT)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=_CUT)

    return run


_CUT = ["anchor", "doc", "text_hash", "start", "count", "shift", "copies", "raw"]
_CUT_TYPES = "anchor long, doc long, text_hash long, start long, count int, shift int, copies int, raw binary"
_RANGE = "doc long, text_hash long, low long, high long"
_ENDLESS = 1 << 62


def _sort_groups(rows: DataFrame, window: int) -> DataFrame:
    """Ranges of the segments with one copy that share windows with others of their group. rows: as ``_cut`` yields."""
    return rows.repartition("anchor").sortWithinPartitions("anchor", "doc", "text_hash", "start").mapInPandas(_sorted(window), _RANGE)


def _split_groups(rows: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """The same for groups too large for one task; also returns the table that the ranges are read from."""
    first, last = F.floor((F.col("shift") - F.col("count") + 1) / SPLIT), F.floor(F.col("shift") / SPLIT)
    rows = rows.withColumn("b", F.explode(F.sequence(first, last)))
    core = F.substring("raw", (F.col("shift") - F.col("b") * SPLIT + 1).cast("int"), F.lit(window - SPLIT + 1))
    near = F.least("shift", F.col("b") * SPLIT + SPLIT - 1)  # the distances of the stretch's first and last window
    far = F.greatest(F.col("shift") - F.col("count") + 1, F.col("b") * SPLIT)
    skip = F.col("shift") - near
    stretches = rows.select(
        F.xxhash64("anchor", "b", core).alias("anchor"), "doc", "text_hash", (F.col("start") + skip).alias("start"), (near - far + 1).cast("int").alias("count"), (near - F.col("b") * SPLIT).cast("int").alias("shift"), "copies",
        F.substring("raw", (skip + 1).cast("int"), (near - far + window).cast("int")).alias("raw"),
    )
    stretches = materialise(stretches.withColumn("piece", F.xxhash64("raw", "shift")), "stretches")
    # as among whole segments: equal stretches are repeated, and one of each goes on
    one = F.min(F.struct("doc", "text_hash", "start", "count", "shift", "raw")).alias("one")
    pieces = stretches.groupBy("anchor", "piece").agg(F.least(F.sum("copies"), F.lit(2)).cast("int").alias("copies"), one)
    pieces = materialise(pieces.select("anchor", "piece", "copies", "one.*"), "stretch-pieces")
    copied = stretches.where("copies = 1").join(pieces.where("copies > 1").select("anchor", "piece").hint("merge"), ["anchor", "piece"])
    copied = copied.select("doc", "text_hash", F.col("start").alias("low"), (F.col("start") + F.col("count") - 1).alias("high"))
    groups = pieces.groupBy("anchor").agg(F.count("*").alias("size"), F.count_if(F.col("copies") == 1).alias("single"))
    groups = materialise(groups.where("size > 1 and single > 0").select("anchor", "size"), "stretch-groups")
    met = pieces.join(groups.hint("merge"), "anchor")
    small = _sort_groups(met.where(f"size <= {GROUP}").select(*_CUT), window)
    single = met.where(f"size > {GROUP}").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    single = single.select(
        "doc", "text_hash", (F.col("start") + F.col("i")).alias("low"), "copies", "anchor", (F.col("shift") - F.col("i")).alias("shift"),
        F.sha1(F.substring("raw", F.col("i") + 1, F.lit(window))).alias("digest"),
    )
    equal = single.groupBy("anchor", "shift", "digest").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    equal = materialise(equal, "equal-windows")  # so that the join is between exchanges, which can be split
    single = single.where("copies = 1").join(equal.hint("merge"), ["anchor", "shift", "digest"]).select("doc", "text_hash", "low", F.col("low").alias("high"))
    return copied.unionByName(small).unionByName(single), stretches


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Find repeated windows.

    docs: ``doc``, ``text_hash``, ``text`` (binary) and what else is to be kept. Returns the documents with ``full`` (ranges of
    first and last starts of repeated windows, or null) and ``wanted`` (null where nothing more can be found), and the ranges
    found by sorting for the others (``doc``, ``text_hash``, ``found``).
    """
    segments = docs.where(F.octet_length("text") >= window).select("doc", "text_hash", "text").mapInPandas(_segments(window, gram), _SEGMENT)
    segments = materialise(segments, "segments")
    repeated = segments.groupBy("anchor").agg(F.sum("times").alias("n"), (F.min("piece") == F.max("piece")).alias("same"))
    repeated = materialise(repeated.where("n > 1").select("anchor", "same"), "anchors")
    hits = materialise(segments.join(repeated.hint("merge"), "anchor"), "hits")
    discard(segments, repeated)
    ranges = ("doc", "text_hash", F.col("start").alias("low"), (F.col("start") + F.col("count").cast("long") * F.col("times") - 1).alias("high"))
    mixed = hits.where("not same")
    one = F.min(F.struct("doc", "text_hash", "start", "count", "shift")).alias("one")
    pieces = materialise(mixed.groupBy("anchor", "piece").agg(F.sum("times").alias("copies"), one), "pieces")
    copied = mixed.join(pieces.where("copies > 1").select("anchor", "piece").hint("merge"), ["anchor", "piece"])
    sizes = pieces.groupBy("anchor").agg(F.count("*").alias("size"), F.count_if(F.col("copies") == 1).alias("single"))
    groups = materialise(sizes.where("single > 0 and size > 1").select("anchor", "size"), "groups")
    large = not groups.where(F.col("size") > GROUP).isEmpty()

    full = hits.where("same").select(*ranges).unionByName(copied.select(*ranges))
    full = full.groupBy("doc", "text_hash", "low").agg(F.max("high").alias("high"))  # rows that are there twice collapse
    wanted = pieces.join(groups.hint("merge"), "anchor").select("anchor", F.least("copies", F.lit(2)).cast("int").alias("copies"), "size", "one.*")
    want = F.struct("anchor", "start", "count", "shift", "copies", "size").alias("w")
    both = full.select("doc", "text_hash", F.struct("low", "high").alias("f"), F.lit(None).alias("w"))
    both = both.unionByName(wanted.select("doc", "text_hash", F.lit(None).alias("f"), want))
    by_doc = both.groupBy("doc", "text_hash").agg(F.collect_list("f").alias("full"), F.collect_list("w").alias("wanted"))
    by_doc = materialise(by_doc.select(F.col("doc").alias("_d"), F.col("text_hash").alias("_h"), "full", F.expr("if(size(wanted) > 0, wanted, null)").alias("wanted")), "by-doc")
    discard(hits, pieces, groups)
    same_row = (F.col("doc") == F.col("_d")) & (F.col("text_hash") == F.col("_h"))
    docs = materialise(docs.join(by_doc.hint("merge"), same_row, "left").drop("_d", "_h"), "docs")
    discard(by_doc)

    texts = docs.where("wanted is not null").select("doc", "text_hash", "text", "wanted")
    found = _sort_groups(texts.mapInPandas(_cut(window, 2, GROUP), _CUT_TYPES), window)
    if large:
        more, table = _split_groups(texts.mapInPandas(_cut(window, GROUP + 1, _ENDLESS), _CUT_TYPES), window)
        found = found.unionByName(more)
    found = found.groupBy("doc", "text_hash", "low").agg(F.max("high").alias("high"))
    found = found.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("low", "high")).alias("found"))
    found = materialise(found, "found")
    if large:
        discard(table)
    return docs, found


def _joined(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with both kinds of ranges; only those that wait for sorted ranges are moved."""
    done = docs.where("wanted is null").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    late = docs.where("wanted is not null").join(found.hint("merge"), ["doc", "text_hash"], "left")
    return done.unionByName(late).drop("wanted")


_SPANS = "array<struct<start:bigint,end:bigint>>"


def _runs(full: list | None, found: list | None, window: int) -> list[dict]:
    """Maximal runs of bytes covered by windows that start in the ranges."""
    out: list[dict] = []
    for low, high in sorted((x["low"], x["high"] + window) for x in (full or []) + (found or [])):
        if out and low <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], high)
        else:
            out.append({"start": low, "end": high})
    return out


def _passages(raw: bytes, runs: list[dict], least: tuple[int, int]) -> list[dict]:
    """Runs with more than so many words, or so many bytes or more."""
    words, size = least
    return [r for r in runs if r["end"] - r["start"] >= size or len(raw[r["start"] : r["end"]].decode("utf-8", "ignore").split()) > words]


def _without(raw: bytes, spans: list[dict]) -> bytes:
    """What remains of a text without the spans."""
    edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(raw)]
    return b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))


_ARROW = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), _SPANS: pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}


def _mapped(df: DataFrame, keep: list[str], fields: str, found) -> DataFrame:
    """``keep`` and what ``found`` makes of each row, given as a dict of the other columns and the text."""
    others = [c for c in df.columns if c not in keep or c == "text"]

    def run(batches: Iterator) -> Iterator:
        kinds = pa.schema([(f.split(" ", 1)[0], _ARROW[f.split(" ", 1)[1]]) for f in fields.split(", ")])
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                columns = [part.column(c).to_pylist() for c in others]
                rows = [found(dict(zip(others, x, strict=True))) for x in zip(*columns, strict=True)]
                made = [pa.array([r[i] for r in rows], k.type) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], [*keep, *kinds.names])

    kept = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.mapInArrow(run, f"{kept}, {fields}")


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", id_col: str = "doc_id", as_text: bool = False, least: tuple[int, int] | None = None, passages: tuple[int, int] | None = None
) -> DataFrame:
    """Remove every byte covered by a string of ``window`` bytes that starts at two or more places of the corpus.

    Places may lie in one document and may overlap; strings are judged on the input; none spans two documents. A null
    text counts as empty; texts shorter than the window stay whole; rows that are there twice are each other's repeats;
    null ids are an id like any other; an empty table gives an empty result; a text of any length is searched whole, and one
    that repeats itself at a short distance all along takes one row of the search for each such stretch.

    With ``least``, words (parted by white space) and bytes, only runs of more words or of so many bytes are removed. With
    ``passages``, a window no longer than the other and the length of its anchors, runs of that window for which ``LEAST``
    holds are listed too, and the text without them is given; ``kept`` stays as the longer window says.

    Returns the input's columns with ``kept`` (what remains, binary; with ``as_text`` a string without the characters of
    which a byte is gone), ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs as start and end in bytes) and, if asked
    for, ``passages`` (the same of passages) and ``rest`` (the text without passages and the characters of which a byte is in
    one, a string). They replace columns with those names.
    """
    given = ("kept", "n_bytes", "n_removed", "spans", *(("passages", "rest") if passages else ()))
    others = [c for c in docs.columns if c not in given]
    string = F.col(text).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"), F.xxhash64(F.col(id_col).isNull(), string).alias("text_hash"),
        F.coalesce(string, F.lit("")).cast("binary").alias("text"), F.struct(*(F.col(f"`{c}`") for c in others if c != text)).alias("row") if len(others) > 1 else F.struct(F.lit(0).alias("_none")).alias("row"),
    )
    size = passages[0] if passages else window
    found = _joined(*repeated_ranges(rows, size, passages[1] if passages else gram))

    def cut(raw: bytes, runs: list[dict]) -> tuple:
        spans = _passages(raw, runs, least) if least else runs
        left = _without(raw, spans)
        return left.decode("utf-8", "ignore") if as_text else left, len(raw), len(raw) - len(left), spans

    result = f"kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, spans {_SPANS}"
    if passages:
        listed = lambda x: (runs := _runs(x["full"], x["found"], size), _passages(x["text"], runs, LEAST))
        found = materialise(_mapped(found, ["doc", "text_hash", "text", "row"], f"runs {_SPANS}, passages {_SPANS}", listed), "runs")
        long = _within(found, window, gram)
        wide = F.exists("runs", lambda r: r["end"] - r["start"] >= window)
        late = found.where(wide).join(long.hint("merge"), ["doc", "text_hash"], "left")
        found = found.where(~wide).withColumn("full", F.lit(None).cast(long.schema["full"].dataType)).unionByName(late)
        both = lambda x: (*cut(x["text"], _runs(x["full"], None, window)), x["passages"], _without(x["text"], x["passages"]).decode("utf-8", "ignore"))
        out = _mapped(found.drop("doc", "text_hash", "runs"), ["row", "text"], f"{result}, passages {_SPANS}, rest string", both)
    else:
        out = _mapped(found.drop("doc", "text_hash"), ["row", "text"], result, lambda x: cut(x["text"], _runs(x["full"], x["found"], window)))
    columns = [F.col("text").cast("string").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in others]
    return out.select(*columns, *given)


def _within(found: DataFrame, window: int, gram: int) -> DataFrame:
    """Ranges of repeated windows of each document (``full``), searched for in its ``runs`` of that length or more."""
    run = F.explode(F.filter("runs", lambda r: r["end"] - r["start"] >= window)).alias("run")
    parts = found.select(F.col("doc").alias("of"), F.col("text_hash").alias("hash_of"), "text", run)
    start = F.col("run.start")
    parts = parts.select(
        F.col("of").alias("doc"), F.xxhash64("hash_of", start).alias("text_hash"), F.expr("substring(text, cast(run.start + 1 as int), cast(run.end - run.start as int))").alias("text"), "hash_of", start.alias("base"),
    )
    got = _joined(*repeated_ranges(materialise(parts, "parts"), window, gram)).where("full is not null or found is not null")
    each = F.explode(F.concat(F.coalesce("full", F.array()), F.coalesce("found", F.array()))).alias("r")
    ranges = got.select("doc", F.col("hash_of").alias("text_hash"), "base", each)
    ranges = ranges.select("doc", "text_hash", F.struct((F.col("base") + F.col("r.low")).alias("low"), (F.col("base") + F.col("r.high")).alias("high")).alias("r")).distinct()
    return materialise(ranges.groupBy("doc", "text_hash").agg(F.collect_list("r").alias("full")), "long")
