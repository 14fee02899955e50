"""A Merkle manifest of a table: a tree of hashes for each group of rows, a tree over the groups' roots, and a proof for each row.

1. A row's leaf is the hash of its fields, taken by Spark's own functions. Rows are sorted by group and id into ranges and numbered
   in their group by counting ranges, so a group that holds a third of all rows is spread over all ranges.
2. A group's nodes are cut into aligned buckets of ``FAN ** DEPTH``. Executors fold whole buckets, many at a time, as Arrow tables
   in DuckDB: a level is one ordered ``string_agg`` with ``sha256``. A bucket gives one root, buckets of roots are folded alike, so the
   number of rounds is the logarithm of the largest group to the base of a bucket; the groups' roots, in order, are a tree of their own.
3. On the way back each bucket gets the path from its root to the top (its outer proof, one row), and DuckDB joins it with the
   levels inside the bucket. Paths of rows are never shuffled, only those of buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Nodes that one hash joins, and levels inside a bucket.
FAN, DEPTH = 3, 8
#: Nodes that a task folds at once; a bucket is never cut.
BATCH = 1 << 16
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "proof string, lefts array<string>, rights array<string>, subroot string"


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of ``fields``: each '-' if null, else its length in UTF-8 bytes, ':' and its text."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in order with the number of their range (``part``) and their number in it, and one row for each group in a range:
    part, group, ``lo``, ``skip`` (rows of the group in earlier ranges), ``n`` (rows of the group)."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("mid", F.monotonically_increasing_id())
    ranged = materialise(ranged.withColumn("part", F.shiftright("mid", 33)), "ranged")
    own = Window.partitionBy(group)
    parts = ranged.groupBy("part", group).agg(F.min("mid").alias("lo"), F.count("*").alias("m"))
    skip = F.sum("m").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", group, "lo", F.coalesce(skip, F.lit(0)).alias("skip"), F.sum("m").over(own).alias("n"))
    return ranged, materialise(parts, "ranges")


def _placed(ranged: DataFrame, parts: DataFrame, group: str) -> DataFrame:
    """Rows with ``pos`` and ``n`` and whatever else ``parts`` knows of their group."""
    parts = parts.withColumnRenamed(group, "_g").withColumnRenamed("part", "_p")
    both = ranged.join(parts.hint("merge"), (F.col("part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return both.withColumn("pos", F.col("mid") - F.col("lo") + F.col("skip")).drop("_g", "_p", "mid", "part", "lo", "skip")


# --- folding in DuckDB ---------------------------------------------------------------------------------------------------


def _levels(top: int) -> str:
    """The nodes of all levels of the buckets of ``rows``: t0 (b, q, lv, h) to t``top``; lv is the number of a bucket's levels."""
    out = ["t0 as materialized (select b, q, lv, h from nodes)"]
    for k in range(top):
        out.append(f"t{k + 1} as materialized (select b, q // {FAN} as q, lv, sha256(string_agg(h, '' order by q)) as h from t{k} where lv > {k} group by b, q // {FAN}, lv)")
    return "with " + ",\n".join(out)


def roots_sql(top: int) -> str:
    """The root of each bucket."""
    return _levels(top) + " " + " union all ".join(f"select b, h from t{k} where lv = {k}" for k in range(top + 1))


def paths_sql(top: int, outer: int, other: bool) -> str:
    """Each node with its siblings: inner ones level by level, then those of its bucket's path (table ``paths``), which has at
    most ``outer`` levels. ``other``: fold another hash of the node, if it has one, along the path, and hash the proof."""
    w = f"(partition by b, q // {FAN} order by q)"
    before = ", ".join(f"lag(h, {i}) over {w}" for i in range(FAN - 1, 0, -1))
    after = ", ".join(f"lead(h, {i}) over {w}" for i in range(1, FAN))
    sql = _levels(top)
    for k in range(top):
        sql += f",\np{k} as materialized (select b, q, concat({before}) as l, concat({after}) as r from t{k} where lv > {k})"
    sides = [(f"coalesce(p{k}.l, '')", f"coalesce(p{k}.r, '')") for k in range(top)]
    joins = " ".join(f"left join p{k} on p{k}.b = n.b and p{k}.q = n.q // {FAN**k} and n.lv > {k}" for k in range(top))
    inner = " || ".join(f"{left} || {right}" for left, right in sides) or "''"
    if not other:
        lists = ["list_concat(list_slice([{}], 1, n.lv), o.{})".format(", ".join(s[i] for s in sides), c) if top else f"o.{c}" for i, c in enumerate(("lefts", "rights"))]
        return f"{sql} select n.i, {inner} || o.proof as proof, {lists[0]} as lefts, {lists[1]} as rights, o.subroot from nodes n join paths o on o.b = n.b {joins}"
    cells = "".join(f", {left} as l{k}, {right} as r{k}" for k, (left, right) in enumerate(sides))
    sql += f",\nf as (select n.i, n.lv, coalesce(n.other, n.h) as h, sha256({inner} || o.proof) as proof, o.subroot, o.lefts as ls, o.rights as rs{cells} from nodes n join paths o on o.b = n.b {joins})"
    at = "f"
    for k in range(top):
        sql += f",\nf{k} as (select * replace (case when lv > {k} then sha256(l{k} || h || r{k}) else h end as h) from {at})"
        at = f"f{k}"
    for k in range(1, outer + 1):
        sql += f",\ng{k} as (select * replace (case when len(ls) >= {k} then sha256(ls[{k}] || h || rs[{k}]) else h end as h) from {at})"
        at = f"g{k}"
    return f"{sql} select i, proof, h as folded, subroot from {at}"


def _depth(n: int, depth: int) -> int:
    """Levels inside a bucket of a group of ``n`` nodes."""
    levels = 0
    while n > 1 and levels < depth:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole buckets of a partition that is sorted by group and bucket, about ``BATCH`` rows at a time."""
    import numpy as np

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < BATCH:
            continue
        t = pa.Table.from_batches(held)
        s, b = t["s"].to_numpy(), t["bucket"].to_numpy()
        last = np.flatnonzero((s[1:] != s[:-1]) | (b[1:] != b[:-1]))
        if len(last):
            at = int(last[-1]) + 1
            yield t.slice(0, at)
            held = t.slice(at).to_batches()
            rows -= at
    if rows:
        yield pa.Table.from_batches(held)


def _folded(rows: DataFrame, schema: str, depth: int, step: Callable[[object, pa.Table, pa.Table, int], pa.Table]) -> DataFrame:
    """Apply ``step`` to whole buckets. rows: s, bucket, kind (0: the bucket's path, 1: a node), pos, n, ...

    ``step`` gets a DuckDB connection with the tables ``nodes`` (i: its row, b, q, lv, h, other) and, if rows carry paths,
    ``paths``, the Arrow tables of nodes and of paths, and the most levels of a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb
        import numpy as np
        import pyarrow.compute as pc

        db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        for t in _buckets(batches):
            s, bucket = t["s"].to_numpy(), t["bucket"].to_numpy()
            b = np.cumsum(np.concatenate([[False], (s[1:] != s[:-1]) | (bucket[1:] != bucket[:-1])]).astype(np.int64))
            t = t.append_column("b", pa.array(b))
            nodes, paths = t.filter(pc.equal(t["kind"], 1)), t.filter(pc.equal(t["kind"], 0))
            sizes, inverse = np.unique(nodes["n"].to_numpy(), return_inverse=True)
            lv = np.array([_depth(int(x), depth) for x in sizes], np.int64)[inverse]
            cells = {"i": pa.array(np.arange(len(nodes))), "b": nodes["b"], "q": pa.array(nodes["pos"].to_numpy() - nodes["bucket"].to_numpy() * FAN**depth), "lv": pa.array(lv), "h": nodes["h"]}
            if "other" in t.column_names:
                cells["other"] = nodes["other"]
            db.register("nodes", pa.table(cells))
            db.register("paths", paths)
            yield from step(db, nodes, paths, int(lv.max(initial=0))).to_batches()

    names = ["s", "bucket", "kind", "pos"]
    return rows.repartition("s", "bucket").sortWithinPartitions(*names).mapInArrow(run, schema)


def _ask(db: object, sql: str) -> pa.Table:
    """The result as plain strings and lists, whatever Arrow types the engine prefers."""
    found = db.sql(sql).to_arrow_table()
    plain = {"b": pa.int64(), "i": pa.int64(), "lefts": pa.list_(pa.string()), "rights": pa.list_(pa.string())}
    return found.cast(pa.schema([(c, plain.get(c, pa.string())) for c in found.column_names]))


def _bucketed(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("bucket", F.expr(f"pos div {FAN**depth}")).withColumn("kind", F.lit(1))


def _up(nodes: DataFrame, largest: int, depth: int) -> list[DataFrame]:
    """The nodes of every round (s, pos, n, h); in the last round each group has one. A group stops when one node is left."""
    rounds = [nodes]

    def step(db, nodes: pa.Table, _: pa.Table, top: int) -> pa.Table:
        found = _ask(db, roots_sql(top) + " order by b")
        b = nodes["b"].to_numpy()
        first = [0, *((b[1:] != b[:-1]).nonzero()[0] + 1)]
        heads = nodes.take(first)
        n = [-(-x // FAN**depth) for x in heads["n"].to_pylist()]
        return pa.table({"s": heads["s"], "pos": heads["bucket"], "n": pa.array(n, pa.int64()), "h": found["h"]})

    while largest > 1:
        rows = _bucketed(rounds[-1].where("n > 1").select("s", "pos", "n", "h"), depth)
        rounds.append(materialise(_folded(rows, "s long, pos long, n long, h string", depth, step), "roots"))
        largest = -(-largest // FAN**depth)
    return rounds


def _down(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """Paths of nodes that aren't rows of the table. outer: s, bucket and the path of each bucket."""

    def step(db, nodes: pa.Table, paths: pa.Table, top: int) -> pa.Table:
        found = _ask(db, paths_sql(top, 0, False) + " order by i")
        return pa.table({"s": nodes["s"], "pos": nodes["pos"], "h": nodes["h"], **{c: found[c] for c in ("proof", "lefts", "rights", "subroot")}})

    rows = _bucketed(nodes.select("s", "pos", "n", "h"), depth).unionByName(outer.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return materialise(_folded(rows, f"s long, pos long, h string, {_PATH}", depth, step), "paths")


def _no_path(s: str | Column, *more: Column) -> list[Column]:
    """The path of what is a top itself."""
    empty = F.array().cast("array<string>")
    return [F.col(s).alias("s") if isinstance(s, str) else s.alias("s"), F.lit(0).cast("long").alias("bucket"), F.lit("").alias("proof"), empty.alias("lefts"), empty.alias("rights"), *more]


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group: str = "source", text: str = "text", found: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """Prove every row of ``docs``, and check another state of its text against the proof.

    Leaves of a group ascend by id; equal ids by their leaf, null ids come first; groups ascend bytewise, null first. Rows that are
    there twice are two leaves. Every ``FAN`` consecutive nodes become the hash of their hashes (the last of a level may be
    fewer, even one) until one is left. found: the text as found now (default: as it is); a row with an equal text keeps its
    leaf. depth: levels of a bucket. Null and empty texts differ. An empty table gives an empty result; columns that aren't fields are ignored.

    Returns a row for each row: ``fields``' id as ``doc_id``, ``leaf``, ``subroot`` (of the group), ``root``, ``proof_sha256`` (hash of all
    siblings, from the leaf to the root, left to right), ``folded_root`` (from the leaf of the text as found and the siblings), ``verified``.
    """
    at = [F.col(c) for c in fields]
    now = [found if c == text and found is not None else F.col(c) for c in fields]
    first, second = leaf(at), leaf(now)
    changed = F.lit(False) if found is None else ~found.eqNullSafe(F.col(text))
    rows = docs.select(F.col(group).cast("string").alias("g"), F.col(id_col).alias("doc_id"), first.alias("h"), F.when(changed, second).alias("other"))
    rows = materialise(rows, "leaves")  # ranges are found by a sample: the texts are read once
    ranged, parts = _numbered(rows, "g", ["doc_id", "h", "other"])
    # groups, numbered in order; there is one tree over all of them
    groups = parts.groupBy("g").agg(F.max("n").alias("n")).withColumn("one", F.lit(0).cast("long"))
    ordered, spans = _numbered(groups.withColumnRenamed("n", "rows"), "one", ["g"])
    ordered = materialise(_placed(ordered, spans, "one").select("g", F.col("pos").alias("s"), F.col("n").alias("groups")), "groups")
    parts = parts.join(ordered.withColumnRenamed("g", "_g").hint("merge"), F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    leaves = materialise(_placed(ranged, parts, "g").select("s", "pos", "n", "doc_id", "h", "other"), "numbered")
    largest = parts.agg(F.max("n"), F.max("groups")).first()
    rounds = _up(leaves, largest[0] or 0, depth)
    ends = [r.where("n = 1").select("s", "h", F.lit(i).alias("ends")) for i, r in enumerate(rounds)]
    subroots = ends[0]
    for e in ends[1:]:
        subroots = subroots.union(e)
    tops = subroots.select(F.lit(0).cast("long").alias("s"), F.col("s").alias("pos"), F.lit(largest[1] or 0).cast("long").alias("n"), "h")
    above = _up(materialise(tops, "subroots"), largest[1] or 0, depth)
    root = above[-1].select("h").first()
    # back down: through the tree over groups, then through each group's rounds
    paths = above[-1].select(*_no_path("s", F.lit(None).cast("string").alias("subroot")))
    for level in reversed(above[:-1]):
        paths = _down(level, paths, depth).select("s", F.col("pos").alias("bucket"), "proof", "lefts", "rights", "subroot")
    if len(above) == 1:  # one group at most: its root is the root
        handed = above[0].select(*_no_path("pos", F.col("h").alias("subroot")))
    else:
        handed = paths.join(above[0].select(F.col("pos").alias("_s"), "h").hint("merge"), F.col("bucket") == F.col("_s"))
        handed = handed.select(F.col("_s").alias("s"), F.lit(0).cast("long").alias("bucket"), "proof", "lefts", "rights", F.col("h").alias("subroot"))
    handed = materialise(handed.join(subroots.select(F.col("s").alias("_s"), "ends").hint("merge"), F.col("s") == F.col("_s")).drop("_s"), "handed")
    paths = handed.where(F.col("ends") == len(rounds) - 1).drop("ends")
    for i in range(len(rounds) - 2, -1, -1):
        paths = _down(rounds[i + 1], paths, depth).select("s", F.col("pos").alias("bucket"), "proof", "lefts", "rights", "subroot")
        paths = paths.unionByName(handed.where(F.col("ends") == i).drop("ends"))

    def step(db, nodes: pa.Table, paths: pa.Table, top: int) -> pa.Table:
        outer = max((len(x) for x in paths["lefts"].to_pylist()), default=0)
        got = _ask(db, paths_sql(top, outer, True) + " order by i")
        return pa.table({"doc_id": nodes["doc_id"], "leaf": nodes["h"], "subroot": got["subroot"], "proof_sha256": got["proof"], "folded_root": got["folded"]})

    rows = _bucketed(leaves, depth).unionByName(paths.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    kind = dict(docs.select(F.col(id_col).alias("doc_id")).dtypes)["doc_id"]
    out = _folded(rows, f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string", depth, step)
    out = out.withColumn("root", F.lit(root[0] if root else None).cast("string"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
