"""The grid in the store: versions of the graph behind the commit log, and an index of what each feeder supplies.

An ingestion adds one part to every graph table and replaces the asset tables, in one commit: readers see a version whole or not at
all, an ingestion that is lost leaves nothing that a reader finds, and the next takes the same number. Older versions stay as they
are. Reachability is computed once for a version, by component labels, and written as rows of feeder and meter sorted by
feeder; so a lookup reads the row groups of its feeders and follows no edges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph as graphs
from ..operators.topology import Grid, ingest
from ..operators.upsert import latest_version
from ..sources.scratch import grown, materialise
from ..sources.store import Store

ASSETS = ("secondary_substation", "transformer", "feeder", "cabinet", "delivery_point", "meter")
GRAPH = ("node", "edge", "cable", "edge_cable")


def stored_assets(store: Store) -> dict[str, DataFrame]:
    found = {n: store.snapshot(f"asset_{n}") for n in ASSETS}
    return {n: df for n, df in found.items() if df is not None}


def stored_grid(store: Store) -> Grid:
    """All versions; its tables are read only where they are used."""
    return Grid(stored_assets(store), store.snapshot("topology_version"), *(store.snapshot(n) for n in GRAPH))


def reach(graph: dict[str, DataFrame], assets: dict[str, DataFrame]) -> DataFrame:
    """Which meters the feeders of one version reach, with the transformer and the substation above."""
    points = graph["node"].where("node_type = 'DeliveryPoint'").select(F.col("id").alias("node"), "delivery_point_id")
    meters = assets["meter"].select(F.col("id").alias("meter_id"), "delivery_point_id")
    rows = graphs.feeders_of_nodes(graph).join(grown(points), "node").join(grown(meters), "delivery_point_id").select("feeder_id", "meter_id").distinct()
    rows = rows.join(assets["feeder"].select(F.col("id").alias("feeder_id"), "transformer_id"), "feeder_id", "left")
    return rows.join(assets["transformer"].select(F.col("id").alias("transformer_id"), "substation_id"), "transformer_id", "left").select("substation_id", "transformer_id", "feeder_id", "meter_id")


def ingest_topology(store: Store, topology: DataFrame, meters: DataFrame, level: str = "raw") -> int:
    """Add a version of the graph, which becomes the current one, and return its number."""
    before = Grid(stored_assets(store), store.snapshot("topology_version"))
    new = ingest(topology, meters, level, before)
    version = new.current()
    graph = new.at(version)
    index = materialise(reach(graph, new.assets), "reach")
    index = index.repartitionByRange("substation_id", "transformer_id", "feeder_id").sortWithinPartitions("substation_id", "transformer_id", "feeder_id", "meter_id")
    # columns in a fixed order, so that parts of all versions read alike
    added = {n: graph[n].select(sorted(graph[n].columns)) for n in GRAPH} | {"meter_reach": index.select(F.lit(version).alias("version"), *index.columns)}
    replaced = {f"asset_{n}": materialise(df, n) for n, df in new.assets.items()} | {"topology_version": materialise(new.versions, "versions")}
    store.commit(replaced, uuid.uuid4().hex, added)
    return version


def version_of(store: Store, version: int | None = None, level: str | None = None) -> int:
    """A version as given, or the newest at a level, or the current one."""
    versions = store.snapshot("topology_version")
    if versions is None:
        raise ValueError("no topology was ingested")
    if version is not None:
        return version
    return latest_version(versions, level) if level else versions.where("is_current").agg(F.max("version")).first()[0]


def grid_at(store: Store, version: int | None = None, level: str | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Assets, and the graph tables of a version."""
    v = version_of(store, version, level)
    return stored_assets(store), {n: store.snapshot(n).where(F.col("version") == v) for n in GRAPH}


def feeder_meters(store: Store, version: int | None = None) -> DataFrame:
    """The index of a version: substation_id, transformer_id, feeder_id, meter_id."""
    return store.snapshot("meter_reach").where(F.col("version") == version_of(store, version)).drop("version")


def meters_for(store: Store, kind: str, entity: int, version: int | None = None) -> DataFrame | None:
    """Distinct meters under an entity, by id; None for an unknown kind. Only the index and the assets are read."""
    columns = {"feeder": "feeder_id", "transformer": "transformer_id", "secondary_substation": "substation_id"}
    if kind not in columns:
        return graphs.meters_of(kind, entity, {}, stored_assets(store))
    ids = feeder_meters(store, version).where(F.col(columns[kind]) == entity).select(F.col("meter_id").alias("id")).distinct()
    meter = store.snapshot("asset_meter")
    return meter.join(grown(ids), "id", "left_semi").select(*meter.columns).orderBy("id")
