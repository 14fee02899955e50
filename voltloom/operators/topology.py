"""The grid as a versioned graph: ingest from flat tables, edges, cables, diagnostics and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import code, code_number, code_type, zero_to_null
from ..sources.scratch import grown, materialise
from .upsert import insert_missing, make_current, merge, next_version

_filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""


def assets(topology: DataFrame, meters: DataFrame) -> dict[str, DataFrame]:
    """The asset tables that flat rows state, one row for each id. A value that some of an id's rows leave out is that of the
    others; rows that state different values are an error, raised when the table is read."""
    t, m = topology, meters

    def one(df: DataFrame, **columns) -> DataFrame:
        rows = df.select(*(c.alias(n) for n, c in columns.items())).where("id is not null")
        return rows.groupBy("id").agg(*(_stated(n, "id") for n in columns if n != "id"))

    return {
        "secondary_substation": one(t, id=code_number(F.col("secondary_substation")), zip_code=F.nullif(F.col("zip_code_secondary_substation").cast("string"), F.lit(""))),
        "transformer": one(t, id=code_number(F.col("transformer")), substation_id=code_number(F.col("secondary_substation")), capacity_kva=zero_to_null(F.col("transformer_capacity"))),
        "feeder": one(t, id=code_number(F.col("lv_feeder")), transformer_id=code_number(F.col("transformer")), fuse_size_amps=zero_to_null(F.col("lv_feeder_fuse_size"))),
        "cabinet": m.where(_filled("cabinet")).select(code_number(F.col("cabinet")).alias("id")).where("id is not null").distinct(),
        "delivery_point": one(m, id=F.col("delivery_point_id"), cabinet_id=code_number(F.col("cabinet")), fuse_size_amps=zero_to_null(F.col("service_fuse_size"))),
        "meter": one(m, id=F.col("meter_number"), delivery_point_id=F.col("delivery_point_id"), has_heat_pump=F.col("has_heat_pump"), has_solar_panel=F.col("has_solar_panel"), capacity_solar_panel=zero_to_null(F.col("capacity_solar_panel"))),
    }


def _stated(column: str, key: str):
    """The one value that a group's rows state."""
    said = F.concat(F.lit(f"different values of {column} for {key} "), F.col(key).cast("string"))
    one = F.min(column).eqNullSafe(F.max(column))
    return F.when(one, F.min(column)).otherwise(F.raise_error(said)).alias(column)


def upsert_assets(old: dict[str, DataFrame] | None, new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Known assets take the new values; cabinets have none and are only added."""
    if not old:
        return new
    return {n: insert_missing(old[n], df, ["id"]) if n == "cabinet" else merge(old[n], df, ["id"]) for n, df in new.items()}


def node_codes(topology: DataFrame, meters: DataFrame) -> DataFrame:
    """Distinct nodes that the flat tables name: ``code``, ``node_type``, ``asset_id``."""
    ends = topology.select(F.explode(F.array("node1", "node2")).alias("code")).where(_filled("code")).select(F.trim("code").alias("code"))
    points = meters.where("delivery_point_id is not null").select(code("DeliveryPoint", F.col("delivery_point_id")).alias("code"))
    cabinets = meters.where(_filled("cabinet")).select(F.trim("cabinet").alias("code"))
    feeders = meters.where(_filled("lv_feeder")).select(F.trim("lv_feeder").alias("code"))
    # written, so that filters and joins on what codes hold aren't moved before distinct(), to every flat row
    nodes = materialise(ends.unionByName(points).unionByName(cabinets).unionByName(feeders).distinct(), "codes")
    return nodes.select("code", code_type(F.col("code")).alias("node_type"), code_number(F.col("code")).alias("asset_id")).where(F.col("node_type").isin("LvFeeder", "Cabinet", "DeliveryPoint") & F.col("asset_id").isNotNull())


def existing_nodes(nodes: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Nodes whose asset is in its table. A cabinet that only the topology file names has none."""
    known = None
    for kind, table in (("LvFeeder", "feeder"), ("Cabinet", "cabinet"), ("DeliveryPoint", "delivery_point")):
        rows = tables[table].select(F.lit(kind).alias("node_type"), F.col("id").alias("asset_id"))
        known = rows if known is None else known.unionByName(rows)
    return nodes.join(grown(known), ["node_type", "asset_id"], "left_semi")


def grouped_edges(topology: DataFrame, meters: DataFrame) -> DataFrame:
    """Undirected edges with their cables: those of the topology file, and from each delivery point to its cabinet, or
    to its feeder where it has no cabinet. Parallel rows are one edge; ``cable_ids`` joins their cables by '||'."""
    topo = topology.where(_filled("node1") & _filled("node2") & (F.col("node1") != F.col("node2"))).select(F.col("node1").alias("a"), F.col("node2").alias("b"), F.col("cable_id").cast("string").alias("cable_id"))
    point = code("DeliveryPoint", F.col("delivery_point_id")).alias("b")
    linked = meters.where("delivery_point_id is not null")
    none = F.lit(None).cast("string").alias("cable_id")
    to_feeder = linked.where(~_filled("cabinet") & _filled("lv_feeder")).select(F.col("lv_feeder").alias("a"), point, none)
    to_cabinet = linked.where(_filled("cabinet")).select(F.trim("cabinet").alias("a"), point, none)
    edges = topo.unionByName(to_feeder).unionByName(to_cabinet)
    cables = F.array_join(F.array_sort(F.collect_list("cable_id")), "||")  # nulls are left out
    return edges.groupBy(F.least("a", "b").alias("n1_code"), F.greatest("a", "b").alias("n2_code")).agg(F.nullif(cables, F.lit("")).alias("cable_ids"))


def resolved_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends are both nodes, with the nodes' ids, the smaller first. nodes: ``id``, ``code``."""
    a = nodes.select(F.col("code").alias("n1_code"), F.col("id").alias("_a"))
    b = nodes.select(F.col("code").alias("n2_code"), F.col("id").alias("_b"))
    out = edges.join(grown(a), "n1_code").join(grown(b), "n2_code")
    return out.select(F.least("_a", "_b").alias("node1_id"), F.greatest("_a", "_b").alias("node2_id"), "n1_code", "n2_code", "cable_ids")


def edge_cables(edges: DataFrame, key: str = "id") -> DataFrame:
    """One row for each cable of an edge, numbered from 1 in the edge's order."""
    split = edges.where("cable_ids is not null").select(key, F.posexplode(F.split("cable_ids", r"\|\|")).alias("seq_no", "code"))
    return split.select(F.col(key).alias("edge_id"), "code", code_number(F.col("code")).alias("cable_id"), (F.col("seq_no") + 1).alias("seq_no"))


def cables(topology: DataFrame) -> DataFrame:
    """Distinct cables with their properties; a property of 0 is unknown, different ones are an error as in :func:`assets`."""
    t = topology.select(
        code_number(F.col("cable_id")).alias("cable_id"), "cable_type", zero_to_null(F.col("cable_length")).alias("cable_length_m"), zero_to_null(F.col("phase_size")).alias("phase_size"),
        "phase_material", zero_to_null(F.col("cable_capacity")).alias("capacity_a"), F.col("resistance").alias("resistance_ohm"), F.col("reactance").alias("reactance_ohm"),
    ).where("cable_id is not null")
    return t.groupBy("cable_id").agg(*(_stated(c, "cable_id") for c in t.columns if c != "cable_id"))


def edge_kinds(edges: DataFrame) -> DataFrame:
    """One row of counts: edges, with and without cables, by the kinds of their ends."""
    a, b = code_type(F.col("n1_code")), code_type(F.col("n2_code"))

    def kind(x: str, y: str):
        return ((a == x) & (b == y)) | ((a == y) & (b == x))

    return edges.agg(
        F.count("*").alias("edges"), F.count_if(F.col("cable_ids").isNotNull()).alias("with_cable"), F.count_if(F.col("cable_ids").isNull()).alias("without_cable"),
        F.count_if((a == "DeliveryPoint") | (b == "DeliveryPoint")).alias("to_delivery_point"), F.count_if(kind("DeliveryPoint", "LvFeeder")).alias("feeder_point"),
        F.count_if(kind("DeliveryPoint", "Cabinet")).alias("cabinet_point"), F.count_if(kind("Cabinet", "Cabinet")).alias("cabinet_cabinet"), F.count_if(kind("Cabinet", "LvFeeder")).alias("cabinet_feeder"),
    )


def _ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    a = nodes.select(F.col("code").alias("n1_code"), F.lit(True).alias("has_1"))
    b = nodes.select(F.col("code").alias("n2_code"), F.lit(True).alias("has_2"))
    return edges.join(grown(a), "n1_code", "left").join(grown(b), "n2_code", "left")


def edge_resolution(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: edges, those that resolve to nodes, and the dropped ones by which end is missing."""
    one, two = F.col("has_1").isNotNull(), F.col("has_2").isNotNull()
    return _ends(edges, nodes).agg(
        F.count("*").alias("edges"), F.count_if(one & two).alias("resolvable"), F.count_if(~(one & two)).alias("dropped"),
        F.count_if(~one & two).alias("missing_1"), F.count_if(one & ~two).alias("missing_2"), F.count_if(~one & ~two).alias("missing_both"),
    )


def missing_ends(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Codes that edges name and that are no nodes, with the number of edges."""
    ends = edges.select(F.explode(F.array("n1_code", "n2_code")).alias("code"))
    return ends.join(grown(nodes.select("code")), "code", "left_anti").groupBy("code").agg(F.count("*").alias("edges"))


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of a version with an end that isn't a node of it."""
    ids = nodes.select("version", "id")
    out = None
    for end in ("node1_id", "node2_id"):
        bad = edges.join(grown(ids.withColumnRenamed("id", end)), ["version", end], "left_anti").select(*edges.columns)
        out = bad if out is None else out.unionByName(bad)
    return out.distinct()


def check_edges(edges: DataFrame, nodes: DataFrame) -> None:
    if not dangling_edges(edges, nodes).isEmpty():
        raise RuntimeError("edges refer to nodes that don't exist")


@dataclass
class Grid:
    """The tables of a topology store. Graph tables hold all versions; assets have none."""

    assets: dict[str, DataFrame] = field(default_factory=dict)
    versions: DataFrame | None = None
    node: DataFrame | None = None
    edge: DataFrame | None = None
    cable: DataFrame | None = None
    edge_cable: DataFrame | None = None

    def current(self) -> int:
        return self.versions.where("is_current").agg(F.max("version")).first()[0]

    def at(self, version: int | None = None) -> dict[str, DataFrame]:
        """The graph tables of a version, by default the current one."""
        v = self.current() if version is None else version
        return {n: getattr(self, n).where(F.col("version") == v) for n in ("node", "edge", "cable", "edge_cable")}


def ingest(topology: DataFrame, meters: DataFrame, level: str = "raw", grid: Grid | None = None) -> Grid:
    """Add a version of the graph, which becomes the current one.

    Nodes are numbered from 1 within the version, edges by their ends: in 256 hashed parts, in order within a part; so the
    same files give the same ids. The caller writes the returned tables as a new snapshot.
    """
    grid = grid or Grid()
    spark = topology.sparkSession
    topology, meters = _dealt(topology, "topology"), _dealt(meters, "meters")  # read by every table
    tables = upsert_assets(grid.assets, assets(topology, meters))
    version = next_version(grid.versions) if grid.versions is not None else 1
    nodes = _numbered(existing_nodes(node_codes(topology, meters), tables), ["node_type", "asset_id"], version)
    for kind, column in (("LvFeeder", "feeder_id"), ("Cabinet", "cabinet_id"), ("DeliveryPoint", "delivery_point_id")):
        nodes = nodes.withColumn(column, F.when(F.col("node_type") == kind, F.col("asset_id")))
    nodes = materialise(nodes, "nodes")
    edges = resolved_edges(grouped_edges(topology, meters), nodes).dropDuplicates(["node1_id", "node2_id"])
    edges = materialise(_numbered(edges, ["node1_id", "node2_id"], version), "edges")
    known = cables(topology).withColumn("version", F.lit(version))
    parts = edge_cables(edges).where("cable_id is not null").withColumn("version", F.lit(version)).dropDuplicates(["edge_id", "cable_id"])
    check_edges(edges, nodes)
    row = spark.range(1).select(F.lit(version).cast("int").alias("version"), F.lit(level).alias("processing_level"), F.lit(True).alias("is_current"))
    versions = make_current(grid.versions.unionByName(row) if grid.versions is not None else row, version)
    new = Grid(tables, versions, nodes, edges.drop("n1_code", "n2_code", "cable_ids"), known, parts.drop("code"))
    for n in ("node", "edge", "cable", "edge_cable"):
        if getattr(grid, n) is not None:
            setattr(new, n, getattr(grid, n).unionByName(getattr(new, n)))
    return new


#: Flat rows of one task: codes are parsed for every table that reads them.
FLAT_ROWS = 1 << 17


def _dealt(flat: DataFrame, label: str) -> DataFrame:
    """Flat rows in files of some rows each, however few files and row groups they came from."""
    return materialise(flat.repartition(1 + flat.count() // FLAT_ROWS), label)


def _numbered(df: DataFrame, order: list[str], version: int) -> DataFrame:
    """Ids from 1 without gaps: in the order of columns within hashed parts, which are offset by the sizes of those before."""
    part = materialise(df.withColumn("_p", F.pmod(F.xxhash64(*order), F.lit(256)).cast("int")), "numbered")  # read twice
    sizes = part.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # 256 rows
    place = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    out = part.withColumn("_r", place).join(F.broadcast(sizes.select("_p", before.alias("_o"))), "_p")
    return out.withColumns({"id": F.col("_r") + F.col("_o"), "version": F.lit(version)}).drop("_p", "_r", "_o")
