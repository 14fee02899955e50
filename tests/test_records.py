"""Nested records, first chains on meshes, bucketed layers and stored results of the phase mapper."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from voltloom.operators import graph, levels, meta, records
from voltloom.sources.store import Store


def text(rows):
    return [None if r[0] is None else json.loads(r[0]) for r in rows]


def test_paths_of_records(spark):
    held = ['{"a": {"b": 1, "c": [1, 2]}, "x.y": "t"}', "{}", "3", None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(held)], "id int, h string").select("id", F.parse_json("h").alias("r"))
    new = F.parse_json(F.lit('{"n": 5}'))
    got = text(df.orderBy("id").select(F.to_json(records.set_path(F.col("r"), ["a", "b"], new))).collect())
    assert got == [{"a": {"b": {"n": 5}, "c": [1, 2]}, "x.y": "t"}, *[{"a": {"b": {"n": 5}}}] * 3]
    gone = text(df.orderBy("id").select(F.to_json(records.set_path(F.col("r"), ["a", "c"], F.lit(None).cast("variant")))).collect())
    assert gone[0] == {"a": {"b": 1}, "x.y": "t"} and gone[1] == {"a": {}}
    row = df.where("id = 0").select(*(records.get_path(F.col("r"), p, k) for p, k in ((["a", "b"], "long"), (["x.y"], "string"), (["a", "b", "c"], "long"), (["x.y"], "long"), (["q"], "string")))).first()
    assert list(row) == [1, "t", None, None, None]
    with pytest.raises(ValueError):
        records.set_path(F.col("r"), [], new)


def test_results_in_records_and_back(spark):
    meters = spark.createDataFrame([("1", '{"name": "a", "q": {"l9": {"v": "old"}}}'), ("2", None)], "m string, h string").select("m", F.parse_json("h").alias("record"))
    rows = spark.createDataFrame([("1", "l1", "Good", 2), ("1", "l2", None, 3), ("7", "l1", "Bad", 4), (None, "l1", "Bad", 1), ("2", None, "Bad", 1)], "m string, phase string, v string, n int")
    out = records.write_records(meters, records.nest(rows, "m", "phase", ["v", "n"]), "m", ["q"])
    assert sorted(r.m for r in out.collect()) == ["1", "2"]  # unknown meters are not added
    back = records.read_records(out, "m", ["q"], "phase", {"v": "string", "n": "long"})
    assert sorted(map(tuple, back.collect())) == [("1", "l1", "Good", 2), ("1", "l2", None, 3)]
    assert out.where("m = '1'").select(records.get_path(F.col("record"), ["name"], "string")).first()[0] == "a"
    twice = rows.unionByName(rows.where("n = 2"))
    with pytest.raises(Exception, match="(?i)duplicate"):
        records.nest(twice, "m", "phase", ["v"]).collect()


def chains(spark, nodes, edges, feeders, every=False):
    node = spark.createDataFrame(nodes, "id long, node_type string, feeder_id long, cabinet_id long, delivery_point_id long")
    g = {"node": node, "edge": spark.createDataFrame(edges, "node1_id long, node2_id long")}
    points = [n[4] for n in nodes if n[4] is not None]
    assets = {
        "meter": spark.createDataFrame([(p, p) for p in points], "id long, delivery_point_id long"),
        "feeder": spark.createDataFrame([(f, f) for f in feeders], "id long, transformer_id long"),
        "transformer": spark.createDataFrame([(f, 0) for f in feeders], "id long, substation_id long"),
    }
    ids = spark.createDataFrame([(p,) for p in points], "meter_id long")
    found = graph.topology_chain(ids, g, assets) if every else graph.nearest_chains(ids, g, assets)
    return [tuple(r) for r in found.select("meter_id", "depth", "feeder_id", "cabinet_id").collect()]


@pytest.mark.parametrize("seed", range(4))
def test_first_chain_on_small_meshes_is_that_of_all_paths(spark, seed):
    import random

    rng = random.Random(seed)
    kinds = ["LvFeeder"] * 2 + ["Cabinet"] * 4 + ["DeliveryPoint"] * 3
    nodes = [(i, k, *((i if k == own else None) for own in ("LvFeeder", "Cabinet", "DeliveryPoint"))) for i, k in enumerate(kinds)]
    edges = [e for e in itertools.combinations(range(len(kinds)), 2) if rng.random() < 0.3]
    feeders = [0, 1] if seed else [1]  # a feeder without a transformer is no end of a chain
    first = {}
    for row in sorted(chains(spark, nodes, edges, feeders, every=True), key=lambda r: (r[0], r[1], r[2], -1 if r[3] is None else r[3])):
        first.setdefault(row[0], row)
    assert sorted(chains(spark, nodes, edges, feeders)) == sorted(first.values()) and first


def test_first_chain_ends_on_a_large_mesh(spark):
    """A grid of 12 by 12 cabinets has far too many simple paths to list them."""
    n = 12
    nodes = [(i, "Cabinet", None, i, None) for i in range(n * n)] + [(1000, "LvFeeder", 5, None, None), (2000, "DeliveryPoint", None, None, 9)]
    edges = [(i, i + 1) for i in range(n * n) if i % n < n - 1] + [(i, i + n) for i in range(n * n - n)] + [(0, 1000), (n * n - 1, 2000)]
    assert chains(spark, nodes, edges, [5]) == [(9, 2 * (n - 1) + 2, 5, n * n - 1)]


def test_bucketed_layers_join_without_a_shuffle(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/lake")
    keys = ["meter_number", "timestamp"]
    raw = spark.sql("select cast(id % 5 as string) as meter_number, timestamp_seconds(id) as timestamp, cast(id as double) as voltage_l1 from range(100)")
    flags = raw.select(*keys, (F.col("voltage_l1") > 50).cast("int").alias("voltage_l1_flag"))
    fixes = raw.where("voltage_l1 > 90").select(*keys, F.lit(1.0).alias("voltage_l1"))
    for name, rows in (("raw", raw), ("flags", flags), ("corrections", fixes)):
        store.write_bucketed(rows, name, by=keys, buckets=3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = levels.assemble("cleaned", *(store.bucketed(n) for n in ("raw", "flags", "corrections")), keys=keys)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in levels.assemble("cleaned", raw, flags, fixes, keys=keys)._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, levels.assemble("cleaned", raw, flags, fixes, keys=keys).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    with pytest.raises(FileNotFoundError):
        store.bucketed("none")


def test_rows_of_the_mapper_become_mappings(spark):
    columns = "transformer_id string, feeder_id string, cabinet_id string, meter_id string, sm_phase string, feeder_phase string, transformer_phase string, true_feeder_id string, true_transformer_id string, likely_cabinet_id string, status string"
    rows = [
        ("5", "8", "3", "100025", "l1", "L2", "nan", "910228", "other", None, "Wrong Trafo"), ("5", "8", "3", "1", "l1", "l1", "l1", "9", "5", "12", "Normal"),
        ("4", "8", "3", "1", "l1", "l3", "l3", "8", "4", None, "Normal"), ("5", "8", "3", "nan", "l1", "l1", "l1", "9", "5", None, "Normal"), ("6", "8", "3", "2", "l1", "nan", "nan", "8", "6", None, "failed: no usable phase is left"),
    ]
    table = spark.createDataFrame([(2, "L1", 4, "L1", 6, "L1", None)], "meter_id long, sm_phase string, feeder_id long, feeder_phase string, transformer_id long, transformer_phase string, likely_cabinet_id long")
    got = meta.store_phase_results(table, spark.createDataFrame(rows, columns))
    assert sorted(map(tuple, got.collect())) == [(1, "L1", 9, "L1", 5, "L1", 12), (2, "L1", 4, "L1", 6, "L1", None), (100025, "L1", 910228, "L2", None, None, None)]
