"""Aggregates behind an inventory dashboard, and its text and plot-ready outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import code_type, first_number
from ..schemas import PHASES

# --- meters and files ---------------------------------------------------------------------------------------------------


def inventory_overview(meters: DataFrame) -> DataFrame:
    """One row of counts over the meter table; times are of meters with rows."""
    some = F.col("total_rows") > 0
    known = [F.count(c).alias(f"meters_with_{c}") for c in ("data_quality", "data_statistics", "connectivity") if c in meters.columns]
    return meters.agg(F.count("*").alias("total_meters"), F.count_if(some).alias("meters_with_rows"), *known, F.min(F.when(some, F.col("first_seen"))).alias("first_seen"), F.max(F.when(some, F.col("last_seen"))).alias("last_seen"))


def inventory_preview(meters: DataFrame, limit: int = 2000, key: str = "meter_number") -> DataFrame:
    """The largest meters first: a top-k report."""
    return meters.orderBy(F.desc("total_rows"), key).limit(limit)


def snapshot_preview(meters: DataFrame, limit: int = 5000, key: str = "meter_number") -> DataFrame:
    """The newest classifier results first: a top-k report."""
    return meters.orderBy(F.desc("updated_at"), key).limit(limit)


def file_inventory(files: DataFrame, path: str = "path") -> DataFrame:
    """Files by date and shard, both read from their paths."""
    dt, shard = F.regexp_extract(path, r"dt=(\d{4}-\d{2}-\d{2})", 1), F.regexp_extract(path, r"shard=(\d+)", 1)
    return files.groupBy(F.nullif(dt, F.lit("")).alias("dt"), shard.try_cast("int").alias("shard")).agg(F.count("*").alias("files"))


def latest_ready(files: DataFrame) -> DataFrame:
    return files.where("status = 'ready'").agg(F.max("committed_at").alias("latest"))


# --- topology -----------------------------------------------------------------------------------------------------------


def topology_inventory(assets: dict[str, DataFrame], graph: dict[str, DataFrame]) -> DataFrame:
    """One row of distinct counts for a version: assets of its feeders, nodes of each type, edges, cables."""
    node = graph["node"]
    feeders = node.where("node_type = 'LvFeeder'").select(F.col("feeder_id").alias("id")).distinct()
    own = assets["feeder"].join(feeders, "id").join(assets["transformer"].select(F.col("id").alias("transformer_id"), "substation_id"), "transformer_id")
    up = own.agg(F.countDistinct("substation_id").alias("substations"), F.countDistinct("transformer_id").alias("transformers"), F.countDistinct("id").alias("feeders"))
    kinds = node.agg(F.countDistinct("cabinet_id").alias("cabinets"), F.countDistinct("delivery_point_id").alias("delivery_points"), F.count("*").alias("nodes"))
    edges = graph["edge"].agg(F.count("*").alias("edges"))
    cables = graph["cable"].agg(F.count("*").alias("cables"))
    return up.crossJoin(kinds).crossJoin(edges).crossJoin(cables)  # four single rows


def versions_newest_first(versions: DataFrame) -> DataFrame:
    return versions.orderBy(F.desc("version"))


def node_kind(c: str) -> F.Column:
    return F.coalesce(F.nullif(code_type(F.col(c)), F.lit("")), F.lit("Unknown"))


def connection_types(exported: DataFrame) -> DataFrame:
    """Edges of an export by the types of their ends."""
    known = exported.where("node1 is not null and node2 is not null")
    return known.groupBy(node_kind("node1").alias("source_type"), node_kind("node2").alias("target_type")).agg(F.count("*").alias("connections"))


def component_counts(exported: DataFrame) -> DataFrame:
    """Distinct substations, transformers and feeders of an export, plus the ends of its edges, by type."""
    up = exported.agg(*(F.countDistinct(c).alias(n) for c, n in (("secondary_substation", "SecondarySubstation"), ("transformer", "Transformer"), ("lv_feeder", "LvFeeder"))))
    up = up.select(F.explode(F.create_map(*(x for n in up.columns for x in (F.lit(n), F.col(n))))).alias("component_type", "count"))
    ends = exported.select(F.explode(F.array("node1", "node2")).alias("end")).where("end is not null").groupBy(node_kind("end").alias("component_type")).agg(F.count("*").alias("count"))
    return up.unionByName(ends).groupBy("component_type").agg(F.sum("count").alias("count"))


def connected_balance(components: DataFrame, totals: DataFrame) -> DataFrame:
    """Connected and unconnected components of each category, against its total (component_type, total)."""
    out = totals.join(components, "component_type", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.select("component_type", F.least("count", "total").alias("connected"), F.greatest(F.col("total") - F.col("count"), F.lit(0)).alias("unconnected"))


def meter_overlay(meter_rows: DataFrame, meters: DataFrame, node: str) -> DataFrame:
    """Meters of each node, and how many have series and quality results."""
    rows = meter_rows.where(f"meter_number is not null and {node} is not null").select("meter_number", F.col(node).alias("node"))
    known = meters.select("meter_number", (F.col("total_rows") > 0).alias("_s"), F.col("data_quality").isNotNull().alias("_q"))
    return rows.join(known, "meter_number", "left").groupBy("node").agg(F.countDistinct("meter_number").alias("meters"), F.count_if("_s").alias("with_series"), F.count_if("_q").alias("with_quality"))


def scope_filter(exported: DataFrame, scope: str | None, value: str | None) -> DataFrame:
    """Rows of a substation, transformer or feeder; all without a scope."""
    column = {"substation": "secondary_substation", "transformer": "transformer", "feeder": "lv_feeder"}.get(scope or "")
    return exported.where(F.col(column) == value) if column and value else exported


def overlay_in_scope(overlay: DataFrame, exported: DataFrame) -> DataFrame:
    """Overlay rows of nodes that the exported rows name."""
    nodes = exported.select(F.explode(F.array("node1", "node2", "lv_feeder")).alias("node")).where("node is not null").distinct()
    return overlay.join(nodes, "node", "left_semi")


def graph_edges(exported: DataFrame, limit: int = 80) -> DataFrame:
    """The first distinct edges in order, for a drawing."""
    return exported.select("node1", "node2").where("node1 is not null and node2 is not null").distinct().orderBy("node1", "node2").limit(limit)


def availability_colour(share: F.Column) -> F.Column:
    return F.when(share.isNull(), "grey").when(share < 0.5, "red").when(share < 0.8, "orange").otherwise("green")


def graph_text(exported: DataFrame, overlay: DataFrame, limit: int = 80) -> str:
    """The drawing's text in the DOT language: at most ``limit`` edges, nodes coloured by availability."""
    edges = graph_edges(exported, limit)
    share = F.try_divide(F.col("with_series").cast("double"), F.col("meters").cast("double"))
    nodes = edges.select(F.explode(F.array("node1", "node2")).alias("node")).distinct().join(overlay, "node", "left")
    colours = nodes.select("node", availability_colour(share).alias("colour")).orderBy("node").collect()  # at most 2 * limit
    lines = [f'  "{r.node}" [color={r.colour}];' for r in colours] + [f'  "{r.node1}" -- "{r.node2}";' for r in edges.collect()]
    return "\n".join(["graph grid {", *lines, "}"])


# --- classifier results -------------------------------------------------------------------------------------------------


def flat_quality(records: DataFrame) -> DataFrame:
    """One row for each meter, phase and variable of nested records: summary and null share."""
    phases = records.select("meter_number", F.explode("phases").alias("phase", "_r"))
    variables = ("v", "p14", "p23", "q12", "q34")
    rows = F.explode(F.array(*(F.struct(F.lit(v.upper()).alias("variable"), F.col(f"_r.quality.{v}.summary").alias("summary"), F.col(f"_r.quality.{v}.null_frac").alias("null_frac")) for v in variables)))
    return phases.select("meter_number", "phase", rows.alias("_q")).select("meter_number", "phase", "_q.*")


def flat_statistics(records: DataFrame) -> DataFrame:
    phases = records.select("meter_number", F.explode("phases").alias("phase", "_r"))
    variables = ("v", "p14", "p23", "q12", "q34")
    rows = F.explode(F.array(*(F.struct(F.lit(v.upper()).alias("variable"), *(F.col(f"_r.statistics.{v}.{n}").alias(n) for n in ("min", "max", "mean", "std"))) for v in variables)))
    return phases.select("meter_number", "phase", rows.alias("_s")).select("meter_number", "phase", "_s.*")


def flat_connectivity(records: DataFrame) -> DataFrame:
    lists = [F.array_join(c, ", ").alias(c) for c in ("connected_phases", "connection_errors", "switching_phases")]
    return records.select("meter_number", *lists)


def summary_counts(flat: DataFrame) -> DataFrame:
    return flat.groupBy("variable", "summary").agg(F.count("*").alias("n"))


def quality_pivot(flat: DataFrame, rows: str = "phase", grades: Sequence[str] = ("Good", "Medium", "Bad", "NaN")) -> DataFrame:
    """Counts of each grade, 0 where there are none."""
    return flat.groupBy(rows).pivot("summary", list(grades)).agg(F.count(F.lit(1))).fillna(0)


def classifier_categories(phases: DataFrame) -> DataFrame:
    """Meters in each category of classifier results. phases: meter_number, phase, v_summary, connected,
    connection_error, switching (one row for each meter and phase)."""
    good = [F.count_if(F.col("v_summary") == g).alias(g.lower()) for g in ("Good", "Medium", "Bad", "NaN")]
    m = phases.groupBy("meter_number").agg(F.count("*").alias("n"), *good, *(F.count_if(c).alias(c) for c in ("connected", "connection_error", "switching")))
    flags = {
        "all_good": F.col("good") == F.col("n"), "any_medium": F.col("medium") > 0, "any_bad": F.col("bad") > 0, "any_no_data": F.col("nan") > 0, "one_phase": F.col("connected") == 1,
        "two_phases": F.col("connected") == 2, "three_phases": F.col("connected") == 3, "no_phase": F.col("connected") == 0, "connection_error": F.col("connection_error") > 0, "switching": F.col("switching") > 0,
    }
    counts = m.agg(*(F.count_if(c).alias(n) for n, c in flags.items()))
    return counts.select(F.explode(F.create_map(*(x for n in flags for x in (F.lit(n), F.col(n))))).alias("category", "meters"))


# --- labeler results ----------------------------------------------------------------------------------------------------


def phase_combinations(labels: DataFrame) -> DataFrame:
    """Meters by the combination of their detected phases. labels: meter_number and a flag for each phase."""
    combo = F.array_join(F.array_compact(F.array(*(F.when(F.col(p), F.lit(p.upper())) for p in PHASES))), ",")
    return labels.groupBy(F.coalesce(F.nullif(combo, F.lit("")), F.lit("none")).alias("phases")).agg(F.count("*").alias("meters"))


def codetection(labels: DataFrame) -> DataFrame:
    """For each pair of phases the meters in which both are detected, and their share of all."""
    pairs = [(a, b) for a in PHASES for b in PHASES]
    one = labels.agg(F.count("*").alias("n"), *(F.count_if(F.col(a) & F.col(b)).alias(f"{a}_{b}") for a, b in pairs))
    rows = F.explode(F.array(*(F.struct(F.lit(a).alias("phase_x"), F.lit(b).alias("phase_y"), F.col(f"{a}_{b}").alias("meters"), F.col("n")) for a, b in pairs)))
    return one.select(rows.alias("_r")).select("_r.phase_x", "_r.phase_y", "_r.meters", F.try_divide("_r.meters", "_r.n").alias("share"))


def parse_slopes(lines: DataFrame) -> DataFrame:
    """``slope l1: -0.5 (Threshold: -0.2)`` as phase, slope and threshold. lines: meter_number, line."""
    phase = F.regexp_extract("line", r"slope (?:.*_)?(l[123])", 1)
    return lines.where(F.col("line").startswith("slope ")).select("meter_number", phase.alias("phase"), first_number(F.regexp_extract("line", r": (\S+)", 1)).alias("slope"), first_number(F.regexp_extract("line", r"Threshold: ([^)]*)", 1)).alias("threshold"))


def slope_margins(slopes: DataFrame, thresholds: DataFrame) -> DataFrame:
    """How far each slope is under its threshold, and the phase's mean margin."""
    return slopes.join(thresholds, ["meter_number", "phase"]).withColumn("margin", F.col("threshold") - F.col("slope"))


def margin_by_phase(margins: DataFrame) -> DataFrame:
    return margins.groupBy("phase").agg(F.count("*").alias("meters"), F.avg("slope").alias("slope"), F.avg("margin").alias("margin"))


def slope_pivot(slopes: DataFrame) -> DataFrame:
    return slopes.groupBy("meter_number").pivot("phase", list(PHASES)).agg(F.avg("slope"))


def latest_result_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """The newest stamp for which both a labels and a meta file exist, with their paths."""
    stamp = F.regexp_extract(path, r"_(\d{8}[_-]?\d{6})\.json$", 1)
    kind = F.when(F.col(path).contains("meta"), "meta").otherwise("labels")
    known = paths.select(F.col(path).alias("path"), stamp.alias("stamp"), kind.alias("kind")).where("stamp != ''")
    pairs = known.groupBy("stamp").agg(*(F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in ("labels", "meta")))
    return pairs.where("labels is not null and meta is not null").agg(F.max("stamp").alias("stamp"), *(F.max_by(k, "stamp").alias(k) for k in ("labels", "meta")))


def sample_ids(ids: DataFrame, k: int, seed: int, key: str = "meter_number") -> DataFrame:
    """A reproducible random sample of ``k`` ids without replacement: a sampling operator."""
    return ids.select(key).distinct().orderBy(F.xxhash64(key, F.lit(seed)), key).limit(k)
