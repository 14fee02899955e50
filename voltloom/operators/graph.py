"""Queries over the undirected grid graph: reachability, paths, chains, and export to flat tables.

Edges are made symmetric once, so that a step is an equi-join. Reachability goes by component labels or a frontier, whose
size is that of the graph; only chains, which need paths, enumerate them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import code
from ..sources.scratch import discard, grown, materialise, spread


def symmetric(edges: DataFrame, a: str = "node1_id", b: str = "node2_id") -> DataFrame:
    """Both directions of every edge (``src``, ``dst``), once."""
    pairs = edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"))
    e = spread(pairs, edges.count(), "src", "dst").distinct()
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return e.select(F.explode(ways).alias("e")).select("e.src", "e.dst")


def reachable(edges: DataFrame, seeds: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """Nodes that each seed reaches (``seed``, ``node``), itself included, by breadth-first frontiers.

    edges: ``src``, ``dst``. A round joins only the newest frontier and drops what was seen; each round is written out and
    read again, so lineage and plans stay small and nothing is computed twice.
    """
    edges = materialise(edges, "graph")  # read in every round
    seen = materialise(seeds.select(F.col("seed"), F.col("seed").alias("node")).distinct(), "seen")
    frontier = seen
    for _ in range(max_rounds):
        step = frontier.join(grown(edges.withColumnRenamed("src", "node")), "node").select("seed", F.col("dst").alias("node")).distinct()
        new = materialise(step.join(grown(seen), ["seed", "node"], "left_anti"), "frontier")
        if new.isEmpty():
            return seen
        before, frontier = seen, new
        seen = materialise(before.unionByName(new), "seen")
        discard(before)
    raise RuntimeError("reachability didn't end")


def components(edges: DataFrame, nodes: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """Label every node with the smallest node of its component (``node``, ``component``). edges: both directions of each.

    Ends, nodes with one neighbour, take no part in the rounds: they belong where their neighbour does, and most nodes of a grid are
    ends. Each round takes the smallest label among neighbours and then follows labels one step, so that the number of rounds
    is about the logarithm of the longest path.
    """
    known = materialise(nodes.select("node").distinct(), "known")
    for end in ("dst", "src"):
        edges = edges.join(grown(known.withColumnRenamed("node", end)), end, "left_semi")
    edges = materialise(edges.select("src", "dst"), "graph")
    near = materialise(edges.groupBy("src").agg(F.min("dst").alias("to"), F.max("dst").alias("last")), "near")
    inner, ends = near.where("to < last").select("src"), near.where("to = last").select(F.col("src").alias("node"), "to")
    core = edges.join(grown(inner), "src", "left_semi").join(grown(inner.withColumnRenamed("src", "dst")), "dst", "left_semi")
    labels = _labels(core, inner.withColumnRenamed("src", "node"), max_rounds)
    at = labels.select(F.col("node").alias("to"), "component")
    ends = ends.join(grown(at), "to", "left").select("node", F.coalesce("component", F.least("node", "to")).alias("component"))  # else a pair of ends
    found = materialise(labels.unionByName(ends), "found")
    least = found.groupBy("component").agg(F.min("node").alias("least"))
    out = found.join(grown(least), "component").select("node", F.col("least").alias("component"))
    alone = known.join(grown(near.select(F.col("src").alias("node"))), "node", "left_anti").select("node", F.col("node").alias("component"))
    return materialise(out.unionByName(alone), "labels")


def _labels(edges: DataFrame, nodes: DataFrame, max_rounds: int) -> DataFrame:
    edges = materialise(edges, "graph")  # read in every round
    held = labels = materialise(nodes.select(F.col("node"), F.col("node").alias("component")).distinct(), "labels")
    for _ in range(max_rounds):
        near = edges.join(grown(labels.select(F.col("node").alias("dst"), F.col("component").alias("c"))), "dst").groupBy("src").agg(F.min("c").alias("c"))
        low = labels.join(grown(near.withColumnRenamed("src", "node")), "node", "left").select("node", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        jump = low.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = materialise(low.join(jump, "component", "left").select("node", "old", F.least("component", "next").alias("component")), "labels")
        changed = not new.where("old != component").isEmpty()
        discard(held)
        held = new
        labels = new.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError("component labels didn't settle")


def simple_paths(edges: DataFrame, seeds: DataFrame, max_depth: int = 100) -> DataFrame:
    """All simple paths from seeds: ``seed``, ``node``, ``path`` (array), ``depth``. Exponential on meshed graphs."""
    edges = materialise(edges, "graph")  # read in every round
    level = materialise(seeds.select(F.col("seed"), F.col("seed").alias("node"), F.array("seed").alias("path"), F.lit(0).alias("depth")), "paths")
    out = level
    for _ in range(max_depth):
        level = level.join(grown(edges.withColumnRenamed("src", "node")), "node").where("not array_contains(path, dst)")
        level = materialise(level.select("seed", F.col("dst").alias("node"), F.array_append("path", F.col("dst")).alias("path"), (F.col("depth") + 1).alias("depth")), "paths")
        if level.isEmpty():
            return out
        out = out.unionByName(level)
    raise RuntimeError(f"paths longer than {max_depth}")


def feeders_of_nodes(graph: dict[str, DataFrame]) -> DataFrame:
    """Every feeder of every node's component (``node``, ``feeder_id``)."""
    nodes = graph["node"]
    labels = components(symmetric(graph["edge"]), nodes.select(F.col("id").alias("node")))
    feeders = nodes.where("node_type = 'LvFeeder'").select(F.col("id").alias("node"), "feeder_id").join(grown(labels), "node").select("component", "feeder_id").distinct()
    return labels.join(grown(feeders), "component").select("node", "feeder_id")


def meters_of_feeders(graph: dict[str, DataFrame], assets: dict[str, DataFrame], feeder_ids: DataFrame) -> DataFrame:
    """Meters whose delivery point some of the feeders reaches (distinct meters, ordered by id). feeder_ids: ``feeder_id``."""
    nodes = feeders_of_nodes(graph).join(feeder_ids.select("feeder_id").distinct(), "feeder_id", "left_semi")
    points = graph["node"].where("node_type = 'DeliveryPoint'").select(F.col("id").alias("node"), "delivery_point_id").join(grown(nodes), "node", "left_semi")
    return assets["meter"].join(grown(points.select("delivery_point_id").distinct()), "delivery_point_id", "left_semi").select(*assets["meter"].columns).orderBy("id")


def meters_of(kind: str, entity: int, graph: dict[str, DataFrame], assets: dict[str, DataFrame]) -> DataFrame | None:
    """Meters under an entity; None for an unknown kind."""
    feeder, transformer, meter, point = (assets[n] for n in ("feeder", "transformer", "meter", "delivery_point"))
    if kind == "feeder":
        seeds = feeder.where(F.col("id") == entity)
    elif kind == "transformer":
        seeds = feeder.where(F.col("transformer_id") == entity)
    elif kind == "secondary_substation":
        under = transformer.where(F.col("substation_id") == entity).select(F.col("id").alias("transformer_id"))
        seeds = feeder.join(under, "transformer_id", "left_semi")
    elif kind == "delivery_point":
        return meter.where(F.col("delivery_point_id") == entity).orderBy("id")
    elif kind == "cabinet":
        under = point.where(F.col("cabinet_id") == entity).select(F.col("id").alias("delivery_point_id"))
        return meter.join(under, "delivery_point_id", "left_semi").select(*meter.columns).orderBy("id")
    else:
        return None
    return meters_of_feeders(graph, assets, seeds.select(F.col("id").alias("feeder_id")))


def topology_chain(meter_ids: DataFrame, graph: dict[str, DataFrame], assets: dict[str, DataFrame]) -> DataFrame:
    """For each meter (``meter_id``) and feeder that a simple path from its delivery point meets: the chain above it, with the
    first cabinet on the path, by depth. Order: depth, then feeder, then cabinet."""
    nodes = graph["node"].select(F.col("id").alias("node"), "node_type", "feeder_id", "cabinet_id", "delivery_point_id")
    start = meter_ids.join(grown(assets["meter"].select(F.col("id").alias("meter_id"), "delivery_point_id")), "meter_id")
    points = nodes.where("node_type = 'DeliveryPoint'").select(F.col("node").alias("seed"), "delivery_point_id")
    start = start.join(grown(points), "delivery_point_id")
    feeders = nodes.where("node_type = 'LvFeeder'").select("node", "feeder_id")
    edges = symmetric(graph["edge"])
    # no path to a feeder leads through a node with one neighbour, such as other delivery points
    through = edges.groupBy(F.col("src").alias("dst")).agg(F.count("*").alias("n")).where("n > 1").select("dst").union(feeders.select("node"))
    paths = simple_paths(edges.join(grown(through.distinct()), "dst", "left_semi").select("src", "dst"), start.select("seed").distinct())
    ends = paths.join(feeders, "node")
    steps = ends.select("seed", "feeder_id", "path", "depth", F.posexplode("path").alias("pos", "step")).where("pos > 0")
    steps = steps.join(nodes.where("node_type = 'Cabinet'").select(F.col("node").alias("step"), "cabinet_id"), "step")
    first = steps.groupBy("seed", "path").agg(F.min_by("cabinet_id", "pos").alias("cabinet_id"))
    chains = ends.join(grown(first), ["seed", "path"], "left").select("seed", "feeder_id", "cabinet_id", "depth").distinct()
    above = assets["feeder"].select(F.col("id").alias("feeder_id"), "transformer_id").join(assets["transformer"].select(F.col("id").alias("transformer_id"), F.col("substation_id").alias("secondary_substation_id")), "transformer_id")
    out = start.join(grown(chains), "seed").join(above, "feeder_id")
    return out.select("meter_id", "secondary_substation_id", "transformer_id", "feeder_id", "cabinet_id", "delivery_point_id", "depth").distinct().orderBy("meter_id", "depth", "feeder_id", "cabinet_id")


def nearest_chains(meter_ids: DataFrame, graph: dict[str, DataFrame], assets: dict[str, DataFrame], max_rounds: int = 10000) -> DataFrame:
    """The first row of :func:`topology_chain` for each delivery point's node, on any graph, meshed ones too.

    All feeders search at once. Of the shortest ways to a node, that with the smallest feeder, then the smallest first cabinet as seen from
    the node (none comes first), goes on; both are minima over neighbours one step nearer, so a node has one row, and the work is that
    of one pass over the edges, whatever the number of paths. A node's neighbours are at most one step nearer or farther, so a
    round looks back at two levels, never at all nodes.
    """
    nodes = graph["node"].select(F.col("id").alias("node"), "node_type", "feeder_id", "cabinet_id", "delivery_point_id")
    above = assets["feeder"].select(F.col("id").alias("feeder_id"), "transformer_id").join(assets["transformer"].select(F.col("id").alias("transformer_id"), F.col("substation_id").alias("secondary_substation_id")), "transformer_id")
    own = nodes.select(F.col("node").alias("dst"), (F.col("node_type") == "Cabinet").alias("is_cabinet"), F.col("cabinet_id").alias("own"))
    rows = 2 * graph["edge"].count()
    edges = materialise(spread(symmetric(graph["edge"]).withColumnRenamed("src", "node"), rows, "dst").join(grown(own), "dst"), "graph")
    edges = spread(edges, rows, "node")  # read in every round
    feeders = nodes.where("node_type = 'LvFeeder'").join(above.select("feeder_id"), "feeder_id", "left_semi")
    level = materialise(feeders.groupBy("node").agg(F.min("feeder_id").alias("feeder_id")).select("node", F.lit(0).alias("depth"), "feeder_id", F.lit(None).cast("long").alias("cabinet_id")), "levels")
    before, out = None, level
    best = F.struct("feeder_id", F.col("cabinet_id").isNotNull().alias("some"), "cabinet_id")
    for depth in range(1, max_rounds + 1):
        step = spread(level.join(grown(edges), "node"), rows, "dst").groupBy("dst").agg(F.min(best).alias("b"), F.any_value("is_cabinet").alias("is_cabinet"), F.any_value("own").alias("own"))
        step = step.select(F.col("dst").alias("node"), F.lit(depth).alias("depth"), "b.feeder_id", F.when(F.col("is_cabinet"), F.col("own")).otherwise(F.col("b.cabinet_id")).cast("long").alias("cabinet_id"))
        for known in filter(None, (before, level)):
            step = step.join(grown(known.select("node")), "node", "left_anti")
        before, level = level, materialise(step, "levels")
        if level.isEmpty():
            break
        out = out.unionByName(level)
    else:
        raise RuntimeError("the search from feeders didn't end")
    points = nodes.where("node_type = 'DeliveryPoint'").select("node", "delivery_point_id")
    start = meter_ids.join(grown(assets["meter"].select(F.col("id").alias("meter_id"), "delivery_point_id")), "meter_id").join(grown(points), "delivery_point_id")
    found = start.join(grown(out), "node").join(above, "feeder_id")
    return found.select("meter_id", "secondary_substation_id", "transformer_id", "feeder_id", "cabinet_id", "delivery_point_id", "depth").distinct()


def topology_map(meter_ids: DataFrame, chains: DataFrame, substations: DataFrame, with_data: DataFrame, order: str | None = None) -> DataFrame:
    """One row for each meter: its first chain, the substation's zip code, and whether it has data; order of input kept."""
    w = Window.partitionBy("meter_id").orderBy("depth", "feeder_id", "cabinet_id")
    first = chains.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "depth", "delivery_point_id")
    zips = substations.select(F.col("id").alias("secondary_substation_id"), "zip_code")
    have = with_data.select("meter_id").distinct().withColumn("has_data", F.lit(True))
    out = meter_ids.join(grown(first), "meter_id", "left").join(grown(have), "meter_id", "left").join(zips, "secondary_substation_id", "left")
    out = out.withColumn("has_data", F.coalesce("has_data", F.lit(False)))
    return out.orderBy(order) if order else out


def characterisation(meter_ids: DataFrame, chains: DataFrame, inventory: DataFrame, records: DataFrame) -> DataFrame:
    """One row for each meter: first chain, further feeders and cabinets, availability and its record."""
    ordered = F.array_sort(F.collect_list(F.struct("depth", "feeder_id", "cabinet_id", "transformer_id", "secondary_substation_id")))
    lists = chains.groupBy("meter_id").agg(ordered.alias("c"))
    first = [F.get("c", F.lit(0))[n].alias(n) for n in ("secondary_substation_id", "transformer_id", "feeder_id", "cabinet_id")]
    further = F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0)))
    rest = [further[n].alias(f"additional_{n}s") for n in ("feeder_id", "cabinet_id")]
    chain = lists.select("meter_id", *first, *rest)
    return meter_ids.join(grown(chain), "meter_id", "left").join(grown(inventory), "meter_id", "left").join(grown(records), "meter_id", "left")


def zip_codes(substations: DataFrame, ids: DataFrame) -> DataFrame:
    return substations.join(ids.select("id").distinct(), "id", "left_semi").select("id", "zip_code")


def with_data(inventory: DataFrame, ids: DataFrame) -> DataFrame:
    return inventory.where("total_rows > 0").join(grown(ids.select("meter_number").distinct()), "meter_number", "left_semi").select("meter_number")


# --- export -----------------------------------------------------------------------------------------------------------


def _node_code(node: str, feeder: str, cabinet: str, kind: str):
    own = F.when((F.col(kind) == "LvFeeder") & F.col(feeder).isNotNull(), code("LvFeeder", F.col(feeder)))
    own = own.when((F.col(kind) == "Cabinet") & F.col(cabinet).isNotNull(), code("Cabinet", F.col(cabinet)))
    return own.otherwise(F.concat(F.col(kind), F.lit("."), F.col(node).cast("string")))


def export_topology(graph: dict[str, DataFrame], assets: dict[str, DataFrame], distinct: bool = False) -> DataFrame:
    """The flat topology rows of a version.

    An end of an edge belongs to every feeder of its component, so an edge in a component of k feeders gives k * k rows;
    ``distinct`` drops the repeats.
    """
    nodes, reach = graph["node"], feeders_of_nodes(graph)
    out = graph["edge"].select("id", "node1_id", "node2_id")
    for i in ("1", "2"):
        n = nodes.select(F.col("id").alias(f"node{i}_id"), F.col("node_type").alias(f"type{i}"), F.col("feeder_id").alias(f"f{i}"), F.col("cabinet_id").alias(f"c{i}"))
        out = out.join(grown(n), f"node{i}_id")
    for i in ("1", "2"):
        out = out.join(grown(reach.select(F.col("node").alias(f"node{i}_id"), F.col("feeder_id").alias(f"nf{i}"))), f"node{i}_id", "left")
    out = out.withColumn("feeder_id", F.coalesce("nf1", "nf2"))
    out = out.join(assets["feeder"].select(F.col("id").alias("feeder_id"), "transformer_id", F.col("fuse_size_amps")), "feeder_id", "left")
    out = out.join(assets["transformer"].select(F.col("id").alias("transformer_id"), "substation_id", "capacity_kva"), "transformer_id", "left")
    out = out.join(assets["secondary_substation"].select(F.col("id").alias("substation_id"), "zip_code"), "substation_id", "left")
    out = out.join(grown(graph["edge_cable"].select(F.col("edge_id").alias("id"), "cable_id")), "id", "left")
    lines = out.where("cable_id is not null").join(grown(graph["cable"].drop("version")), "cable_id", "left")
    out = lines.unionByName(out.where("cable_id is null"), allowMissingColumns=True)
    rows = out.select(
        code("SecondarySubstation", F.col("substation_id")).alias("secondary_substation"), F.col("zip_code").cast("string").alias("zip_code_secondary_substation"),
        code("Transformer", F.col("transformer_id")).alias("transformer"), F.col("capacity_kva").cast("double").alias("transformer_capacity"),
        code("LvFeeder", F.col("feeder_id")).alias("lv_feeder"), F.col("fuse_size_amps").cast("double").alias("lv_feeder_fuse_size"),
        _node_code("node1_id", "f1", "c1", "type1").alias("node1"), _node_code("node2_id", "f2", "c2", "type2").alias("node2"),
        code("LvCable", F.col("cable_id")).alias("cable_id"), "cable_type", F.col("cable_length_m").alias("cable_length"), F.col("phase_size").cast("double").alias("phase_size"),
        "phase_material", F.col("capacity_a").cast("double").alias("cable_capacity"), F.col("resistance_ohm").alias("resistance"), F.col("reactance_ohm").alias("reactance"),
    )
    return rows.distinct() if distinct else rows


def export_meter_cabinet(graph: dict[str, DataFrame], assets: dict[str, DataFrame], reach: DataFrame | None = None) -> DataFrame:
    """The flat meter rows of a version, one for each feeder that reaches the delivery point; meters whose delivery point
    has no cabinet are left out. reach: the version's index (``feeder_id``, ``meter_id``), if there is one; else edges are followed."""
    points = assets["delivery_point"].select(F.col("id").alias("delivery_point_id"), "cabinet_id", F.col("fuse_size_amps").alias("service_fuse_size"))
    cabinets = assets["cabinet"].select(F.col("id").alias("cabinet_id"))
    rows = assets["meter"].withColumnRenamed("id", "meter_number").join(grown(points), "delivery_point_id").join(cabinets, "cabinet_id")
    if reach is None:
        nodes = graph["node"].where("node_type = 'DeliveryPoint'").select(F.col("id").alias("node"), "delivery_point_id")
        reach = nodes.join(grown(feeders_of_nodes(graph)), "node").select("delivery_point_id", "feeder_id").distinct()
        rows = rows.join(grown(reach), "delivery_point_id", "left")
    else:
        rows = rows.join(grown(reach.select(F.col("meter_id").alias("meter_number"), "feeder_id").distinct()), "meter_number", "left")
    return rows.select(
        "meter_number", "delivery_point_id", code("Cabinet", F.col("cabinet_id")).alias("cabinet"), code("LvFeeder", F.col("feeder_id")).alias("lv_feeder"),
        "has_heat_pump", "has_solar_panel", "capacity_solar_panel", "service_fuse_size",
    )
