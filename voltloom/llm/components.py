"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """Label the nodes of undirected ``edges`` (a, b of one orderable type) with their component's smallest node.

    A large star moves a node's larger neighbours to its smallest one, a small star its smaller ones, until after a large star
    every node has one neighbour, which has no smaller one; the number of rounds is logarithmic in practice. Each round is
    written out, so lineage doesn't grow; a node with very many neighbours is a skewed join key, which is split at run
    time. Loops, repeated and null edges do no harm.

    Returns ``node``, ``root`` for every node with an edge to another.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(e, "edges")
    while True:
        both = e.union(e.select("v", "u"))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = both.join(least.hint("merge"), "u").where("v > u")
        large = materialise(large.select(F.col("v").alias("u"), F.least("u", "m").alias("v"), (F.col("m") < F.col("u")).alias("moved")), "large")
        open_ = F.max("moved") | (F.min("v") != F.max("v"))
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m"), open_.alias("open")), "least")
        if least.where("open").isEmpty():
            return least.select(F.col("u").alias("node"), F.col("m").alias("root")).union(least.select("m", "m").distinct())
        small = large.join(least.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, materialise(small.union(least.select("u", "m")).distinct(), "small")
        discard(before, large)
