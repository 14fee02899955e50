"""The stored grid: versions, time travel, lost ingestions, and the index of meters under feeders; steps by the hash of what they work on."""

import random

import pytest
from pyspark.sql import functions as F

from voltloom.operators import graph, meta
from voltloom.operators import topology as topo
from voltloom.plans import grid, queries
from voltloom.plans.frames import meter_rows, topology
from voltloom.plans.queries import QUERIES
from voltloom.sources import scratch
from voltloom.sources.store import Store

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def files(spark):
    return topology(spark, DATA), meter_rows(spark, DATA)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_versions_stay_and_the_index_is_that_of_the_graph(spark, store, files, monkeypatch):
    t, m = files
    with pytest.raises(ValueError):
        grid.version_of(store)
    assert grid.ingest_topology(store, t, m, "raw") == 1
    first = {n: df.count() for n, df in grid.grid_at(store)[1].items()}
    assert grid.ingest_topology(store, t.where("cable_length < 0"), m, "cleaned") == 2
    assert grid.version_of(store) == 2 and grid.version_of(store, level="raw") == 1
    assert {n: df.count() for n, df in grid.grid_at(store, 1)[1].items()} == first
    assert grid.grid_at(store)[1]["edge"].count() < first["edge"]
    want = topo.ingest(t, m)
    assets, g = want.assets, want.at()
    assert rows(grid.feeder_meters(store, 1), "feeder_id", "meter_id") == rows(grid.reach(g, assets), "feeder_id", "meter_id")
    for kind, entity in (("feeder", 3), ("transformer", 7), ("secondary_substation", 2), ("cabinet", 4), ("delivery_point", 17)):
        assert rows(grid.meters_for(store, kind, entity, 1), "id") == rows(graph.meters_of(kind, entity, g, assets), "id")
    assert grid.meters_for(store, "street", 1) is None
    plan = grid.feeder_meters(store, 1).where("feeder_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(version,1)" in plan and "EqualTo(feeder_id,3)" in plan and "Exchange" not in plan

    # an ingestion that is lost before its entry is written is seen by nobody, and the next takes its number
    with monkeypatch.context() as patch:
        patch.setattr(Store, "_beside", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            grid.ingest_topology(store, t, m)
    assert grid.version_of(store) == 2 and grid.stored_grid(store).node.agg(F.max("version")).first()[0] == 2
    assert grid.ingest_topology(store, t, m) == 3
    assert rows(grid.feeder_meters(store), "feeder_id", "meter_id") == rows(grid.feeder_meters(store, 1), "feeder_id", "meter_id")
    assert store.snapshot("topology_version").where("is_current").count() == 1


def test_steps_of_a_table_are_those_of_one_by_one(spark):
    states = spark.createDataFrame([("clean:old", False)], "workflow string, completed boolean")
    steps = spark.createDataFrame([("a", 1), ("é\"", 2), ("a", 1), (None, 3)], "name string, k int")
    one = states
    for r in steps.distinct().collect():
        one = meta.mark_workflow(one, "clean", r.asDict())
    many = meta.mark_workflows(meta.mark_workflows(states, "clean", steps, completed=False), "clean", steps)
    assert rows(many, "workflow", "completed") == rows(one, "workflow", "completed")
    part = meta.mark_workflows(states, "clean", steps.where("k = 1"))
    assert rows(meta.completed_workflows(part, "clean", steps).where("completed"), "k") == [(1,), (1,)]
    assert meta.completed_workflows(meta.mark_workflow(part, "clean"), "clean", steps).where("completed").count() == 4


def test_sides_that_grow_are_not_sent_by_way_of_the_driver(spark):
    node = spark.range(9).select("id", F.when(F.col("id") == 0, "LvFeeder").otherwise("DeliveryPoint").alias("node_type"), F.when(F.col("id") == 0, 1).cast("long").alias("feeder_id"), F.lit(None).cast("long").alias("cabinet_id"), F.when(F.col("id") > 0, F.col("id")).alias("delivery_point_id"))
    edge = spark.range(1, 9).select("id", F.lit(0).cast("long").alias("node1_id"), F.col("id").alias("node2_id"))
    reached = graph.feeders_of_nodes({"node": node, "edge": edge})
    assert reached.count() == 9
    joined = node.select(F.col("id").alias("node")).join(graph.grown(reached), "node")
    for df in (reached, joined):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_large_graphs_are_bounded_by_rows(spark, monkeypatch):
    edges = spark.range(200).select(F.col("id").alias("node1_id"), (F.col("id") + 1).alias("node2_id"))
    edges = edges.unionByName(edges.select(F.col("node2_id").alias("node1_id"), F.col("node1_id").alias("node2_id")))
    want = rows(QUERIES["nearest_feeders_meshed"](spark, DATA), "meter_id", "feeder_id", "cabinet_id", "depth")
    monkeypatch.setattr(scratch, "TASK_ROWS", 16)
    sizes = [len(part) for part in graph.symmetric(edges).rdd.glom().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 60  # a task has about 16 edges in both directions
    monkeypatch.setattr(scratch, "TASK_ROWS", 1000)
    assert rows(QUERIES["nearest_feeders_meshed"](spark, DATA), "meter_id", "feeder_id", "cabinet_id", "depth") == want


def test_ends_take_the_label_of_their_neighbour(spark):
    """Random forests and meshes with pairs of ends, nodes without edges, and edges to what isn't a node, against plain merging."""
    rng = random.Random(5)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, 70), (71, 101), (102, 103), (90, 200), (200, 91)]
    nodes = [*range(75), 90, 91, *range(100, 105)]
    want = {n: n for n in nodes}
    for _ in nodes:
        for a, b in pairs:
            if a in want and b in want:
                want[a] = want[b] = min(want[a], want[b])
    edges = graph.symmetric(spark.createDataFrame(pairs, "node1_id long, node2_id long"))
    got = graph.components(edges, spark.createDataFrame([(n,) for n in nodes], "node long"))
    assert sorted(rows(got, "node", "component")) == sorted(want.items())


def test_exported_meters_come_from_the_index(spark, files, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    t, m = files
    monkeypatch.setattr(topo, "FLAT_ROWS", 20)
    grid.ingest_topology(store, t, m)
    assert len(topo._dealt(m, "meters").inputFiles()) > 1
    assets, g = grid.grid_at(store)
    want = rows(graph.export_meter_cabinet(g, assets), "meter_number", "delivery_point_id", "cabinet", "lv_feeder", "service_fuse_size")
    monkeypatch.setattr(graph, "feeders_of_nodes", lambda g: pytest.fail("edges are followed"))
    got = graph.export_meter_cabinet(g, assets, grid.feeder_meters(store))
    assert rows(got, "meter_number", "delivery_point_id", "cabinet", "lv_feeder", "service_fuse_size") == want
    monkeypatch.setattr(queries, "_stored", lambda *a: store)
    assert QUERIES["export_sm_cabinet"](spark, DATA).count() == len(want)
