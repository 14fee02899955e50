"""Literal expectations of single operators."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltloom.functions import scalar
from voltloom.operators import clean, explorer, graph, hclust, labeler, levels, mapping, meta, phasemap, quality, resample, topology, upsert
from voltloom.schemas import METER_CABINET, TOPOLOGY


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]


def test_flags(spark):
    raw = spark.createDataFrame([(1, 230.0), (2, 230.0), (3, 230.0)], "k int, v double")
    flags = spark.createDataFrame([(1, 0), (2, 3)], "k int, v_flag int")
    out = levels.apply_quality_flags(raw, flags, ["k"]).orderBy("k")
    assert values(out, "v") == [230.0, None, None]


def test_corrections(spark):
    df = spark.createDataFrame([(1, None), (2, 230.0), (3, None)], "k int, v double")
    corr = spark.createDataFrame([(1, 231.0), (2, 999.0), (3, None)], "k int, v double")
    assert values(levels.apply_corrections(df, corr, ["k"]).orderBy("k"), "v") == [231.0, 230.0, None]


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        levels.require_unique(df, ["k"], "flags")


def test_phase_map(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0), ("b", 1.0, 2.0, 3.0), ("c", 1.0, 2.0, 3.0)], "meter_number string, voltage_l1 double, voltage_l2 double, voltage_l3 double")
    m = spark.createDataFrame([("a", "l2", "l1", "l3"), ("b", "l1", "l2", "l3")], "meter_number string, l1_maps_to string, l2_maps_to string, l3_maps_to string")
    out = levels.apply_phase_map(df, m).orderBy("meter_number")
    assert values(out, "voltage_l1", "voltage_l2", "voltage_l3") == [(2, 1, 3), (1, 2, 3), (1, 2, 3)]
    bad = spark.createDataFrame([("a", "l1", "l1", "l3")], m.schema)
    with pytest.raises(ValueError):
        levels.require_permutation(bad)


def test_levels_need_their_layers(spark):
    raw = spark.createDataFrame([(1, 1.0)], "k int, v double")
    assert levels.assemble("raw", raw) is raw
    with pytest.raises(FileNotFoundError):
        levels.assemble("cleaned", raw)
    with pytest.raises(ValueError):
        levels.assemble("best", raw)


def test_shaping(spark):
    t = lambda m: dt.datetime(2025, 1, 1, 0, m)
    s = spark.createDataFrame([("42", t(0), 230.0), ("42", t(15), 231.0), ("42", t(45), 229.0)], "meter_number string, timestamp timestamp, voltage_l1 double")
    bounds = spark.createDataFrame([(t(0), dt.datetime(2025, 1, 1, 1, 0))], "first_seen timestamp, last_seen timestamp")
    out = resample.on_grid(resample.resample_mean(s, ["voltage_l1"]), resample.time_grid(bounds))
    wide = resample.wide_frame(out, ["42"], ["voltage_l1"]).orderBy("timestamp")
    assert wide.columns == ["timestamp", "voltage_l1_42"]
    assert values(wide, "voltage_l1_42") == [230.0, 231.0, None, 229.0, None]


def test_grid_start_is_rounded_down(spark):
    bounds = spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 7), dt.datetime(2025, 1, 1, 0, 31))], "first_seen timestamp, last_seen timestamp")
    assert [r.timestamp.minute for r in resample.time_grid(bounds).orderBy("timestamp").collect()] == [0, 15, 30]


def test_imbalance_and_current(spark):
    names = [f"{q}_{p}" for q in ("voltage", "active_power_p14", "active_power_p23") for p in ("l1", "l2", "l3")]
    df = spark.createDataFrame([(230.0, 231.0, 229.0, 460.0, 0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 231.0, 229.0, 460.0, 0.0, 0.0, 0.0, 0.0, 0.0)], ", ".join(f"{n} double" for n in names))
    out = resample.add_phase_imbalance(df, keep_current=True).collect()
    assert out[0].v_unbalance == pytest.approx(1 / 230)
    assert out[0].current_l1 == 2.0
    assert out[1].current_l1 is None
    assert "current_l1" not in resample.add_phase_imbalance(df).columns


def test_interpolation(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])], "i int, v double").withColumn("k", F.lit(1))
    assert values(resample.interpolate(df, "v", ["k"], "i").orderBy("i"), "v") == [1.0, 1.0, 2.0, 3.0, 3.0]


def test_frozen(spark):
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate([1.0, 1.0, 1.0, 1.0, 2.0])], "meter_number string, timestamp int, v double").withColumn("phase", F.lit("l1"))
    out = quality.voltage_states(df, quality.QualityConfig(frozen=3)).orderBy("timestamp")
    assert values(out, "is_frozen") == [False, False, True, True, False]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from([None, 0.0, 1.0]), min_size=1, max_size=30))
def test_runs(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, v double").withColumn("k", F.lit(1))
    got = [(r.v, r.length) for r in quality.run_lengths(df, "v", ["k"], ["i"]).orderBy("run").collect()]
    want = []
    for x in xs:
        if want and want[-1][0] == x:
            want[-1][1] += 1
        else:
            want.append([x, 1])
    assert got == [tuple(w) for w in want]


def test_classifier_record(spark):
    t0 = dt.datetime(2025, 1, 1)
    rows = [("1", t0 + dt.timedelta(minutes=15 * i), 230.0 + i % 3, None, 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, "meter_number string, timestamp timestamp, voltage_l1 double, voltage_l2 double, voltage_l3 double")
    for q in ("active_power_p14", "active_power_p23", "reactive_power_q12", "reactive_power_q34"):
        for p in ("l1", "l2", "l3"):
            df = df.withColumn(f"{q}_{p}", F.lit(1.0))
    meters = spark.createDataFrame([("1",), ("2",)], "meter_number string")
    out = {r.meter_number: r for r in quality.classify_meters(df, meters).collect()}
    assert out["1"].connected_phases == ["L1"]
    assert out["1"].phases["L1"].quality.v.summary == "Good"
    assert out["1"].phases["L2"].quality.v.summary == "NaN"
    assert out["1"].phases["L1"].statistics.v.max == 232.0
    assert out["2"].phases is None
    cats = quality.plot_categories(quality.classify_meters(df, meters))
    assert {r.category for r in cats.collect()} == {"any_nan", "with_1_phase_connection"}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from([None, 200.0, 230.0, 245.0]), min_size=2, max_size=2), min_size=1, max_size=14), st.integers(1, 5))
def test_corrupt_rows_against_loops(rows, w):
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], float)
    want = np.zeros(len(x), bool)
    for i in range(len(x) - w + 1):
        part = x[i : i + w]
        if (np.isnan(part) | (part < 207)).any() or (np.abs(np.diff(part, axis=0)) > 10).any():
            want[i : i + w] = True
    assert phasemap.corrupt_rows(x, w, 207, 10).tolist() == want.tolist()


def test_window_mask(spark):
    rows = [("u", "p", i, 100.0 if i == 4 else 230.0) for i in range(10)]
    df = spark.createDataFrame(rows, "unit string, phase string, timestamp int, v double")
    out = phasemap.corruption_mask(df, window=3, step=1000.0).orderBy("timestamp")
    assert [i for i, m in enumerate(values(out, "masked")) if m] == [2, 3, 4, 5, 6]
    short = phasemap.corruption_mask(df.where("timestamp in (3, 4)"), window=3)
    assert not any(values(short, "masked"))


def test_cleaning(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 3.0), ("a", None), ("b", None), (None, 4.0)], "g string, x double")
    out = values(clean.fill_numbers(df, ["x"], "g"), "g", "x")
    assert ("a", 2.0) in out and ("b", 3.0) in out  # means 2.5 and 3.0, half to even
    c = spark.createDataFrame([("a", "AL"), ("a", "CU"), ("a", "CU"), ("a", "AL"), ("a", None), ("b", "junk")], "g string, m string")
    assert sorted(values(clean.fill_categories(c, {"m": ("AL", "CU", "U")}, "g"), "g", "m")) == [("a", "AL")] * 3 + [("a", "CU")] * 2 + [("b", "AL")]
    e = spark.createDataFrame([("A", "B", 100, 1), ("A", "B", 200, 2), ("A", "B", 200, 3), ("B", "A", 50, 4), (None, "A", 9, 5)], "a string, b string, c int, i int")
    assert sorted(values(clean.drop_parallel(e, ["a", "b"], "c", ["i"]), "i")) == [2, 4]


def flat(spark, edges, meters=()):
    t = [{f.name: None for f in TOPOLOGY} | {"node1": a, "node2": b, "cable_id": c, "lv_feeder": f, "transformer": "Transformer.1", "secondary_substation": "SecondarySubstation.1", "zip_code_secondary_substation": "2600"} for a, b, c, f in edges]
    m = [{f.name: None for f in METER_CABINET} | x for x in meters]
    return spark.createDataFrame(t, TOPOLOGY), spark.createDataFrame(m, METER_CABINET)


def test_edge_grouping(spark):
    t, m = flat(spark, [("Cabinet.2", "LvFeeder.1", "LvCable.9", "LvFeeder.1"), ("LvFeeder.1", "Cabinet.2", "LvCable.3", "LvFeeder.1"), ("Cabinet.2", "Cabinet.2", "LvCable.4", "LvFeeder.1"), ("", "Cabinet.2", "LvCable.5", "LvFeeder.1")])
    assert values(topology.grouped_edges(t, m), "n1_code", "n2_code", "cable_ids") == [("Cabinet.2", "LvFeeder.1", "LvCable.3||LvCable.9")]


def small_grid(spark):
    edges = [("LvFeeder.1", "Cabinet.1", "LvCable.1", "LvFeeder.1"), ("Cabinet.1", "Cabinet.2", "LvCable.2", "LvFeeder.1"), ("Cabinet.2", "LvFeeder.1", "LvCable.3", "LvFeeder.1"), ("LvFeeder.8", "Cabinet.3", "LvCable.4", "LvFeeder.8")]
    meters = [
        {"meter_number": 10, "delivery_point_id": 100, "cabinet": "Cabinet.2", "lv_feeder": "LvFeeder.1", "has_heat_pump": True},
        {"meter_number": 11, "delivery_point_id": 101, "cabinet": "Cabinet.3", "lv_feeder": "LvFeeder.8"},
        {"meter_number": 12, "delivery_point_id": 102, "cabinet": "Cabinet.1", "lv_feeder": "LvFeeder.1"},
    ]
    return topology.ingest(*flat(spark, edges, meters))


def test_graph(spark):
    g = small_grid(spark)
    assert values(graph.meters_of("feeder", 1, g.at(), g.assets), "id") == [10, 12]
    assert values(graph.meters_of("feeder", 8, g.at(), g.assets), "id") == [11]
    assert values(graph.meters_of("transformer", 1, g.at(), g.assets), "id") == [10, 11, 12]
    assert graph.meters_of("street", 1, g.at(), g.assets) is None
    ids = spark.createDataFrame([(10,)], "meter_id long")
    chain = values(graph.topology_chain(ids, g.at(), g.assets), "feeder_id", "cabinet_id", "depth")
    assert chain == [(1, 2, 2), (1, 2, 3)]  # straight, and around the cycle
    out = graph.export_topology(g.at(), g.assets)
    assert {(r.node1, r.node2) for r in out.collect() if r.lv_feeder == "LvFeeder.8" and "DeliveryPoint" not in r.node1 + r.node2} in ({("Cabinet.3", "LvFeeder.8")}, {("LvFeeder.8", "Cabinet.3")})
    topology.check_edges(g.edge, g.node)
    with pytest.raises(RuntimeError):
        topology.check_edges(g.edge, g.node.where("node_type != 'Cabinet'"))


def test_walks(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 1), (5, 6)], "node1_id long, node2_id long")
    sym = graph.symmetric(e)
    seeds = spark.createDataFrame([(1,)], "seed long")
    assert sorted(values(graph.reachable(sym, seeds), "node")) == [1, 2, 3, 4]
    assert {r.depth for r in graph.simple_paths(sym, seeds).where("node = 4").collect()} == {1, 3}
    nodes = spark.createDataFrame([(i,) for i in range(1, 8)], "node long")
    assert sorted(values(graph.components(sym, nodes), "node", "component")) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 5), (7, 7)]


def test_versions(spark):
    g = small_grid(spark)
    again = topology.ingest(*flat(spark, [("LvFeeder.1", "Cabinet.1", "LvCable.1", "LvFeeder.1")], [{"meter_number": 12, "delivery_point_id": 102, "cabinet": "Cabinet.1", "lv_feeder": "LvFeeder.1"}]), level="cleaned", grid=g)
    assert again.current() == 2
    assert again.at(1)["edge"].count() == g.edge.count()
    assert upsert.latest_version(again.versions, "raw") == 1
    with pytest.raises(ValueError):
        upsert.latest_version(again.versions, "none")


def test_cabinet_mapping(spark):
    rows = spark.createDataFrame([(100025, "Cabinet.7"), (100026, "Cabinet.7"), (None, "Cabinet.8"), (100027, None)], "meter_number long, cabinet string")
    inv = spark.createDataFrame([("100025", 5)], "meter_number string, total_rows long")
    assert values(mapping.cabinet_mapping(rows, inv), "cabinet", "meters", "available", "missing") == [("7", ["100025", "100026"], ["100025"], ["100026"])]


def test_entity_lookup_is_exact(spark):
    long = spark.createDataFrame([("8", "1"), ("28", "2")], "lv_feeder string, meter_number string")
    inv = spark.createDataFrame([("1", 1), ("2", 1)], "meter_number string, total_rows long")
    assert values(mapping.entity_meters(long, inv, "feeder", "8"), "meter_number") == ["1"]
    assert sorted(values(mapping.entity_meters(long, inv, "feeder", "8", compat_suffix=True), "meter_number")) == ["1", "2"]
    assert values(mapping.entity_meters(long, inv, "feeder", "8", explicit=["5"]), "meter_number") == ["5"]
    with pytest.raises(ValueError, match="does not exist"):
        mapping.entity_meters(long, inv, "feeder", "99")
    with pytest.raises(ValueError):
        mapping.entity_meters(long, inv, "feeder", "8", explicit=["5", None])


def test_phase_cleaning(spark):
    rows = [("100025", "l1", "910228", "L2", "nan", "other", 1), ("100025.0", "L1", "910228", "nan", None, None, 2), ("1", "l2", None, None, None, None, 3), ("nan", "l1", None, None, None, None, 4), ("5", "nan", None, None, None, None, 5)]
    b = spark.createDataFrame(rows, "meter_id string, sm_phase string, feeder_id string, feeder_phase string, transformer_id string, transformer_phase string, i int")
    out = meta.clean_phase_mappings(b, "i").orderBy("meter_id")
    assert values(out, "meter_id", "sm_phase", "feeder_id", "feeder_phase") == [(1, "L2", None, None), (100025, "L1", 910228, None)]
    with pytest.raises(Exception, match="Invalid phase value"):
        meta.clean_phase_mappings(b.limit(1).withColumn("sm_phase", F.lit("l4"))).collect()


def test_unconnected_labels(spark):
    r = spark.createDataFrame([(100025, ["L1", "L3"], "996044", 910228), (2, ["L1", "L2", "L3"], None, 1), (3, ["L1", "L2"], None, 1)], "meter_number long, connected_phases array<string>, cabinet_id string, feeder_id long")
    assert sorted(values(mapping.unconnected_phases(r), "label")) == ["voltage_l2_100025_996044_910228", "voltage_l3_3_nan_1"]


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(2, "c", 5), (3, "d", 6)], "k int, s string, n int")
    assert sorted(values(upsert.merge(old, new, ["k"], update=["s"]), "k", "s", "n")) == [(1, "a", 1), (2, "c", 2), (3, "d", 6)]
    assert sorted(values(upsert.merge(old, new, ["k"], insert=False), "k", "s", "n")) == [(1, "a", 1), (2, "c", 5)]
    with pytest.raises(ValueError):
        upsert.merge(old, new.union(new), ["k"])
    assert sorted(values(upsert.insert_missing(old, new, ["k"]), "k", "s")) == [(1, "a"), (2, "b"), (3, "d")]


def test_workflows(spark):
    name = meta.workflow_name("step", {"source_path": "a", "threshold": 1})
    assert name.startswith("step:") and len(name) == len("step:") + 12
    assert name == meta.workflow_name("step", {"threshold": 1, "source_path": "a"}) != meta.workflow_name("step", {"source_path": "a", "threshold": 2})
    assert meta.workflow_name("step") == "step"
    states = spark.createDataFrame([("step", True)], "workflow string, completed boolean")
    assert meta.workflow_completed(states, "step", {"x": 1}) and not meta.workflow_completed(states, "step", {"x": 1}, override=True)
    assert not meta.workflow_completed(states, "other")
    assert meta.workflow_completed(meta.mark_workflow(states, "other", {"x": 1}), "other", {"x": 1})


def test_paging_needs_an_order(spark):
    r = spark.createDataFrame([(1,), (2,)], "id int")
    with pytest.raises(ValueError):
        meta.query_results(r, limit=1)
    with pytest.raises(ValueError):
        meta.query_results(r, order_by="x")


def test_weekly_changes(spark):
    t = dt.datetime(2024, 1, 1)
    weeks = [0.0, 0.0, 2.0, 3.0]
    df = spark.createDataFrame([("m", t + dt.timedelta(weeks=i), v, None, None) for i, v in enumerate(weeks)], "meter_number string, timestamp timestamp, l1 double, l2 double, l3 double")
    got = values(labeler.weekly_changes(df).orderBy("week"), "change")
    assert got == [None, None, math.inf, 0.5]


def test_quantile_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 8)], "x double")
    assert values(labeler.quantile_bins(df, "x", 3).orderBy("x"), "bin") == [0, 0, 1, 1, 2, 2, 2]


def test_heat_pump_leeway(spark):
    rows = [("m", "l1", -3.0, 100.0), ("m", "l2", -3.0, 100.0), ("m", "l3", -2.5, 100.0)]
    df = spark.createDataFrame(rows, "meter_number string, phase string, slope double, intercept double")
    assert values(labeler.heat_pump_phases(df), "heat_pump", "indicators") == [(True, 3)] * 3


def test_anova_against_known_values():
    # one factor without effect, one with
    a, b = np.repeat([0, 1], 6), np.tile([0, 0, 0, 1, 1, 1], 2)
    y = np.array([1, 2, 3, 5, 6, 7, 1, 2, 3, 5, 6, 7], float)
    out = labeler.two_way_anova(y, a, b)
    assert out["b"][0] == pytest.approx(48) and out["a"][0] == pytest.approx(0, abs=1e-9)
    assert out["b"][2] == pytest.approx(48) and out["b"][3] == pytest.approx(0.000121, rel=0.02)
    assert labeler.two_way_anova(y, np.zeros(12), b) is None
    assert labeler.f_survival(4.9646, 1, 10) == pytest.approx(0.05, abs=1e-4)


def test_anova_of_all_meters_against_least_squares(spark):
    """Unbalanced cells, cells and whole levels missing, factors that don't connect, one level, no freedom left."""
    rng = np.random.default_rng(21)
    rows = []
    for m in range(7):
        for i in range(40):
            a, b = int(rng.integers(0, 4)), int(rng.integers(0, 3))
            if m == 1 and a == 2 and b == 1:
                continue
            if m == 2:
                b = a % 2  # levels of one factor see one level of the other
            if m == 3:
                a = 1
            if m == 4 and i >= 3:
                continue
            rows.append((f"m{m}", a, b, float(rng.normal(a + 2 * b * (m == 5), 1))))
    rows += [("m5", None, 1, 5.0), ("m5", 1, None, 5.0), ("m5", 1, 1, None)]
    df = spark.createDataFrame(rows, "meter_number string, a int, b int, y double")
    got = {r.meter_number: r for r in labeler.anova(df, "y", "a", "b").collect()}
    for m in range(7):
        own = [r for r in rows if r[0] == f"m{m}" and None not in r]
        want = labeler.two_way_anova(np.array([r[3] for r in own]), np.array([r[1] for r in own]), np.array([r[2] for r in own])) if own else None
        assert (want is None) == (f"m{m}" not in got)
        if want is None:
            continue
        out = got[f"m{m}"]
        for name in ("a", "b", "interaction"):
            ss, free, f, p = want[name]
            assert out[f"ss_{name}"] == pytest.approx(ss, abs=1e-8) and out[f"df_{name}"] == free
            if want["residual"][1] > 0 and free:
                assert out[f"f_{name}"] == pytest.approx(f, rel=1e-6, abs=1e-9) and out[f"p_{name}"] == pytest.approx(p, rel=1e-5, abs=1e-9)
            else:
                assert out[f"f_{name}"] is None
        assert (out.ss_residual, out.df_residual) == (pytest.approx(want["residual"][0], abs=1e-8), want["residual"][1])


def test_bin_search_against_trying_each_number(spark):
    rng = np.random.default_rng(22)
    rows, want = [], {}
    for m in range(5):
        n = (600, 300, 100, 20, 48)[m]
        t = np.round(rng.normal(5, 8, n), 3 if m < 4 else 0)
        hour = rng.integers(0, 24, n) if m < 4 else np.arange(48) % 24
        loads = [np.round(np.maximum(0, 100 + 10 * t + rng.normal(0, 200, n)), 2) for _ in range(3)]
        for i in range(n):
            rows.append((f"m{m}", dt.datetime(2024, 1, 1, int(hour[i])) + dt.timedelta(days=i), float(t[i]), *(float(x[i]) if x[i] else None for x in loads)))
        _, cold, k = labeler.temperature_bins(t, hour, loads, labeler.LabelConfig())
        want |= {(f"m{m}", p): (k, c) for p, c in zip(("l1", "l2", "l3"), cold)}
    rows.append(("m9", dt.datetime(2024, 1, 1), None, 1.0, 1.0, 1.0))
    out = labeler.search_bins(spark.createDataFrame(rows, "meter_number string, timestamp timestamp, T double, l1 double, l2 double, l3 double"))
    assert {(r.meter_number, r.phase): (r.n_bins, r.bin) for r in out.collect()} == want
    assert len({k for k, _ in want.values()}) > 2


def test_sampling_is_reproducible():
    import pandas as pd

    rng = np.random.default_rng(1)
    n = 24 * 10
    rows = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=n, freq="h"), "T": rng.uniform(-5, 10, n), "l1": rng.uniform(0, 900, n), "l2": rng.uniform(0, 900, n), "l3": 0.0})
    cfg = labeler.LabelConfig(max_bins=2, draws=5, samples=20)
    a, b = labeler.sample_meter(rows, "m", cfg), labeler.sample_meter(rows, "m", cfg)
    assert a.equals(b) and a[a["phase"] == "l3"]["dead"].all()


def test_linkage_and_cut():
    x = np.array([0.0, 1.0, 10.0, 11.5, 30.0])
    z = hclust.complete_linkage(np.abs(x[:, None] - x[None, :]))
    assert z[:, 2].tolist() == [1.0, 1.5, 11.5, 30.0]
    assert sorted(map(sorted, hclust.cut(z, 3))) == [[0, 1], [2, 3], [4]]
    assert sorted(map(sorted, hclust.cut(z, 9))) == [[0], [1], [2], [3], [4]]


def test_majority():
    assert phasemap.commonest(["l1", "l1", "l2"], 0.5) == "l1"
    assert phasemap.commonest(["l1", "l1", "l2"], 0.8) is None
    assert phasemap.commonest([], 0.5) is None


def test_phase_identification(spark):
    rng = np.random.default_rng(0)
    n, rows, places = 400, [], []
    base = {p: 230 + rng.normal(0, 1.5, n).cumsum() * 0.05 + rng.normal(0, 1, n) for p in ("l1", "l2", "l3")}
    t0 = dt.datetime(2024, 1, 1)
    for m in range(9):
        phase = {p: base[p] + rng.normal(0, 0.2, n) for p in base}
        if m == 4:
            phase["l1"], phase["l2"] = phase["l2"], phase["l1"]
        rows += [(str(m), t0 + dt.timedelta(minutes=15 * i), float(phase["l1"][i]), float(phase["l2"][i]), float(phase["l3"][i])) for i in range(n)]
        places.append(("1", str(m), str(m % 2), str(m)))
    v = spark.createDataFrame(rows, "meter_number string, timestamp timestamp, voltage_l1 double, voltage_l2 double, voltage_l3 double")
    where = spark.createDataFrame(places, "transformer_id string, meter_number string, feeder_id string, cabinet_id string")
    out = {(r.meter_id, r.sm_phase): r for r in phasemap.identify_phases(v, where, cfg=phasemap.PhaseConfig(rows=100, step=50.0)).collect()}
    assert len(out) == 27 and not any(r.status.startswith("failed") for r in out.values())
    assert out["4", "l1"].feeder_phase == "l2" and "SM Phase Twist" in out["4", "l1"].status
    assert out["2", "l3"].feeder_phase == "l3"


def test_scalars(spark):
    df = spark.createDataFrame([("LvFeeder.12", "12.0", "a_b_x", "x -3.5 y"), ("LvFeeder", "other", "a", "none")], "c string, i string, f string, n string")
    out = df.select(scalar.code_number(F.col("c")).alias("n"), scalar.code_suffix(F.col("c")).alias("s"), scalar.clean_id(F.col("i")).alias("i"), scalar.feature_name(F.col("f")).alias("f"), scalar.first_number(F.col("n")).alias("x"))
    assert values(out, "n", "s", "i", "f", "x") == [(12, "12", 12, "a_b", -3.5), (None, None, None, "a", None)]


def test_shards(spark):
    ids = spark.createDataFrame([("100025",), ("17",), ("42",), ("42",), (None,)], "meter_number string")
    assert {r.meter_number: r.shard for r in scalar.shard_of(ids).collect()} == {"100025": 1, "17": 2, "42": 2}


def test_explorer_texts(spark):
    lines = spark.createDataFrame([("m", "slope active_l1: -0.5 (Threshold: -0.2)"), ("m", "Intercept l1: 4 Wh")], "meter_number string, line string")
    assert values(explorer.parse_slopes(lines), "phase", "slope", "threshold") == [("l1", -0.5, -0.2)]
    paths = spark.createDataFrame([("a/hp_20240101_120000.json",), ("a/meta_20240101_120000.json",), ("a/hp_20240102_120000.json",)], "path string")
    assert values(explorer.latest_result_files(paths), "stamp", "labels", "meta") == [("20240101_120000", "a/hp_20240101_120000.json", "a/meta_20240101_120000.json")]
    t = spark.createDataFrame([("A", "B"), ("A", "B")], "node1 string, node2 string")
    overlay = spark.createDataFrame([("A", 10, 3)], "node string, meters long, with_series long")
    assert explorer.graph_text(t, overlay) == 'graph grid {\n  "A" [color=red];\n  "B" [color=grey];\n  "A" -- "B";\n}'


def test_thermal_labels_run_with_the_operators_defaults(monkeypatch):
    from voltloom.plans import queries

    monkeypatch.setattr(queries, "_hourly", lambda spark, d: None)
    monkeypatch.setattr(queries.labeler, "label_heat_pumps", lambda hourly, cfg: cfg)
    cfg = queries.QUERIES["thermal_labels"](None, "")
    assert (cfg.max_bins, cfg.draws, cfg.samples) == (12, 100, 1000) and cfg == labeler.LabelConfig()


def test_conflicting_assets_are_refused(spark):
    same = [("LvFeeder.1", "Cabinet.1", "LvCable.1", "LvFeeder.1"), ("LvFeeder.1", "Cabinet.2", "LvCable.2", "LvFeeder.1")]
    meters = [{"meter_number": 1, "delivery_point_id": 7, "cabinet": c, "lv_feeder": "LvFeeder.1"} for c in ("Cabinet.1", None)]
    t, m = flat(spark, same, meters)
    assert values(topology.assets(t, m)["delivery_point"], "id", "cabinet_id") == [(7, 1)]  # a row that leaves it out agrees
    t, m = flat(spark, same, [meters[0], meters[0] | {"cabinet": "Cabinet.2"}])
    with pytest.raises(Exception, match="different values of cabinet_id for id 7"):
        topology.assets(t, m)["delivery_point"].collect()
    t = t.withColumn("transformer", F.concat(F.lit("Transformer."), F.col("cable_id").substr(9, 9)))
    with pytest.raises(Exception, match="different values of transformer_id for id 1"):
        topology.assets(t, m)["feeder"].collect()


def test_fill_in_one_pass_against_loops(spark):
    rng = np.random.default_rng(3)
    pick = lambda xs: xs[int(rng.integers(0, len(xs)))]
    rows = [(pick(["a", "b", "c", None]), pick(["AL", "CU", "junk", None]), pick([1.0, 2.0, 4.0, None]), i) for i in range(60)] + [("d", None, None, 60), ("e", "junk", None, 61)]
    out = {r.i: (r.m, r.x) for r in clean.fill(spark.createDataFrame(rows, "g string, m string, x double, i int"), ["x"], {"m": ("CU", "AL")}, "g").collect()}

    def mode(xs):
        return max(("CU", "AL"), key=lambda v: (xs.count(v), v == "CU")) if xs else None

    domain = [(g, m if m in ("CU", "AL") else None, x, i) for g, m, x, i in rows]
    per = {g: (mode([m for h, m, _, _ in domain if h == g and m]), [x for h, _, x, _ in domain if h == g and x is not None]) for g in "abcde"}
    first = [(g, m or (per[g][0] if g else None), x, i) for g, m, x, i in domain]
    every = mode([m for _, m, _, _ in first if m]), float(round(np.mean([x for _, _, x, _ in rows if x is not None])))
    for g, m, x, i in first:
        mean = float(round(np.mean(per[g][1]))) if g and per[g][1] else every[1]
        assert out[i] == (m or every[0], mean if x is None else x)
    assert clean.fill(spark.createDataFrame([], "g string, m string, x double"), ["x"], {"m": ("CU",)}, "g").count() == 0


def test_shard_column(spark):
    df = spark.createDataFrame([("100025",), ("17",), (None,), ("42",), ("17",)], "meter_number string")
    assert values(df.select("meter_number", scalar.shard(F.col("meter_number")).alias("s")), "meter_number", "s") == [("100025", 1), ("17", 2), (None, None), ("42", 2), ("17", 2)]


def test_characterisation(spark):
    ids = spark.createDataFrame([(10,), (11,)], "meter_id long")
    chains = spark.createDataFrame([(10, 1, 2, 5, 6, 3), (10, 1, 2, 5, 8, 2), (10, 1, 2, 7, 9, 4)], "meter_id long, secondary_substation_id long, transformer_id long, feeder_id long, cabinet_id long, depth int")
    inventory = spark.createDataFrame([(10, 96)], "meter_id long, total_rows long")
    records = spark.createDataFrame([(10, True)], "meter_id long, has_heat_pump boolean")
    out = graph.characterisation(ids, chains, inventory, records).orderBy("meter_id").collect()
    assert (out[0].feeder_id, out[0].cabinet_id, out[0].transformer_id, out[0].secondary_substation_id) == (5, 8, 2, 1)
    assert (out[0].additional_feeder_ids, out[0].additional_cabinet_ids) == ([5, 7], [6, 9])
    assert (out[0].total_rows, out[0].has_heat_pump, out[1].feeder_id, out[1].total_rows) == (96, True, None, None)


def test_nested_mapping(spark):
    import json

    rows = [("2600", "1", "2", "3", "4", "10"), ("2600", "1", "2", "3", "4", "11"), ("2600", "1", "2", "3", "5", "12"), ("2800", "9", "8", "7", "6", "13")]
    long = spark.createDataFrame(rows, "zip_code string, secondary_substation string, transformer string, lv_feeder string, cabinet string, meter_number string")
    got = {r.zip_code: json.loads(r.mapping) for r in mapping.nested_json(long).collect()}
    assert got == {"2600": {"1": {"2": {"3": {"4": ["10", "11"], "5": ["12"]}}}}, "2800": {"9": {"8": {"7": {"6": ["13"]}}}}}


def test_id_lists(spark):
    inv = spark.createDataFrame([("b", 2), ("a", 1), ("c", 0)], "meter_number string, total_rows long")
    assert values(meta.with_rows(inv), "meter_number") == ["a", "b"]
    assert values(graph.with_data(inv, spark.createDataFrame([("a",), ("c",), ("a",)], "meter_number string")), "meter_number") == ["a"]
    subs = spark.createDataFrame([(1, "2600"), (2, "2800"), (3, None)], "id long, zip_code string")
    assert sorted(values(graph.zip_codes(subs, spark.createDataFrame([(1,), (3,), (9,)], "id long")), "id", "zip_code")) == [(1, "2600"), (3, None)]
    picked = values(explorer.sample_ids(inv, 2, 7), "meter_number")
    assert len(set(picked)) == 2 and picked == values(explorer.sample_ids(inv, 2, 7), "meter_number")
    assert sorted(values(explorer.sample_ids(inv, 9, 7), "meter_number")) == ["a", "b", "c"]
    loaded, new = spark.createDataFrame([("a", 1)], "meter_number string, label int"), spark.createDataFrame([("a", 2), ("b", 3)], "meter_number string, label int")
    assert sorted(values(meta.merge_labels(loaded, new), "meter_number", "label")) == [("a", 1), ("b", 3)]


def test_phase_mappings_are_upserted(spark):
    columns = "meter_id long, sm_phase string, feeder_id long, feeder_phase string, transformer_id long, transformer_phase string"
    table = spark.createDataFrame([(1, "L1", 5, "L1", 9, "L1"), (2, "L2", 5, "L2", 9, "L2")], columns)
    batch = spark.createDataFrame([("1", "l1", "6", "l2", None, None, 1), ("1.0", "L1", "7", "l3", "9", "l3", 2), ("3", "l3", "5", "nan", None, None, 3)], columns.replace("long", "string") + ", i int")
    assert sorted(values(meta.upsert_phase_mappings(table, batch, "i"), "meter_id", "sm_phase", "feeder_id", "feeder_phase")) == [(1, "L1", 7, "L3"), (2, "L2", 5, "L2"), (3, "L3", 5, None)]


def test_batches(spark):
    files = spark.createDataFrame([("f", "b1", "staged"), ("g", "b2", "staged"), ("h", "b1", "ready")], "path string, batch_id string, status string")
    batches = spark.createDataFrame([("b1", "in_progress", None), ("b2", "in_progress", None)], "batch_id string, status string, error_log string")
    moved, done = meta.promote_batch(files, batches, "b1")
    assert values(moved.orderBy("path"), "status") == ["ready", "staged", "ready"] and values(done.orderBy("batch_id"), "status") == ["processed", "in_progress"]
    assert values(meta.set_batch_status(batches, "b2", "failed", error_log="x").orderBy("batch_id"), "status", "error_log") == [("in_progress", None), ("failed", "x")]


def test_classifier_views(spark):
    q = {v: {"summary": "Good" if v == "v" else "Bad", "null_frac": 0.25} for v in ("v", "p14", "p23", "q12", "q34")}
    s = {v: {"min": 1.0, "max": 3.0, "mean": 2.0, "std": 0.5} for v in q}
    one, many = "struct<summary:string,null_frac:double>", "struct<min:double,max:double,mean:double,std:double>"
    kinds = [", ".join(f"{v}: {k}" for v in q) for k in (one, many)]
    schema = f"meter_number string, phases map<string, struct<quality: struct<{kinds[0]}>, statistics: struct<{kinds[1]}>>>, connected_phases array<string>, connection_errors array<string>, switching_phases array<string>"
    df = spark.createDataFrame([("m", {"l1": {"quality": q, "statistics": s}}, ["L1", "L2"], [], None)], schema)
    flat_ = explorer.flat_quality(df)
    assert sorted(values(flat_, "phase", "variable", "summary", "null_frac"))[-1] == ("l1", "V", "Good", 0.25) and flat_.count() == 5
    assert sorted(values(explorer.summary_counts(flat_), "variable", "summary", "n"))[0] == ("P14", "Bad", 1)
    assert values(explorer.flat_statistics(df).where("variable = 'Q34'"), "min", "max", "mean", "std") == [(1.0, 3.0, 2.0, 0.5)]
    assert values(explorer.flat_connectivity(df), "connected_phases", "connection_errors", "switching_phases") == [("L1, L2", "", None)]


def test_snapshot_preview(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 2)]
    df = spark.createDataFrame([("b", t[0]), ("d", t[1]), ("c", t[2])], "meter_number string, updated_at timestamp")
    assert values(explorer.snapshot_preview(df, limit=2), "meter_number") == ["c", "d"]


def test_draws_follow_the_truncated_normal():
    rng = np.random.default_rng(5)
    mean, sd = np.array([500.0, 0.0, 2000.0]), np.array([200.0, 300.0, 100.0])
    got = labeler.truncated_normal(rng, mean, sd, 0, 1000, 40_000)
    assert got.min() >= 0 and got.max() <= 1000
    for m, s, x in zip(mean, sd, got, strict=True):
        cdf = lambda v: 0.5 * (1 + math.erf((v - m) / s / math.sqrt(2)))  # noqa: B023, E731
        for v in (100, 300, 500, 800, 990):
            if cdf(1000) - cdf(0) > 1e-6:
                assert (x <= v).mean() == pytest.approx((cdf(v) - cdf(0)) / (cdf(1000) - cdf(0)), abs=0.02)


def test_posterior_against_loops():
    rng = np.random.default_rng(6)
    n, steps, top, n_bins = 400, 5, 500.0, 2
    load, hour, bins = rng.uniform(0, 499, n), rng.integers(0, 24, n), rng.integers(0, n_bins, n)
    prior = rng.uniform(size=(steps, 24, n_bins))
    prior /= prior.sum(0)
    got = labeler.thermal_posterior(prior, load, hour, bins, 1, top, steps)
    for h in range(24):
        base = [sum(1 for x, k, b in zip(load, hour, bins, strict=True) if k == h and b == 1 and s * 100 <= x < (s + 1) * 100) for s in range(steps)]
        for t in range(n_bins):
            for seen in range(steps):
                joint = [base[min(max(seen - thermal, 0), steps - 1)] * prior[thermal, h, t] for thermal in range(steps)]
                total = sum(joint)
                want = [(j / total if total else 0.0) + 1e-6 for j in joint]
                assert got[:, seen, h, t] == pytest.approx(np.array(want) / sum(want))


def test_load_shares_are_those_of_sums_of_draws():
    rng = np.random.default_rng(8)
    mean, sd, top, steps, n = rng.uniform(0, 1000, (3, 6)), rng.uniform(5, 250, (3, 6)), 1000.0, 10, 200_000
    pools = [np.zeros(0), np.array([0.0, 0.0, 350.0]), rng.uniform(0, 900, 7)]
    got = labeler.load_shares(mean, sd, pools, top, steps)
    for i, pool in enumerate(pools):
        total = labeler.truncated_normal(rng, mean[i], sd[i], 0, top, n)
        if len(pool):
            total += rng.choice(pool, total.shape)
        for j in range(6):
            assert got[i, j, :-1] == pytest.approx(np.histogram(total[j], steps, (0, top))[0] / n, abs=0.006)
    assert got.sum(2) == pytest.approx(np.ones((3, 6)))


def test_counts_cost_less_than_their_sums(monkeypatch):
    monkeypatch.setattr(labeler, "truncated_normal", lambda *_: pytest.fail("single sums are drawn"))
    rng = np.random.default_rng(9)
    got = labeler.load_counts(rng, rng.uniform(0, 1000, (2, 4)), rng.uniform(0, 250, (2, 4)), [np.zeros(0), np.array([100.0])], 1000.0, 10, 1000)
    assert got.shape == (2, 4, 10) and (got.sum(2) <= 1000).all() and (got.sum(2)[0] == 1000).all()


def test_counts_of_large_pools_are_drawn_as_sums():
    pools = [np.linspace(0, 900, 100), np.linspace(0, 900, 100)[:20]]
    mean, sd = np.full((2, 3), 300.0), np.full((2, 3), 50.0)
    got = labeler.load_counts(np.random.default_rng(3), mean, sd, pools, 1000.0, 10, 1000)
    assert got.reshape(2, -1).sum(1) / 3000 == pytest.approx(labeler.load_shares(mean, sd, pools, 1000.0, 10)[:, 0, :-1].sum(1), abs=0.03)


def test_sampling_is_dealt_by_rows_not_bytes(spark, monkeypatch):
    monkeypatch.setattr(labeler, "TASK_ROWS", 24)
    plans = []
    kept = labeler.materialise
    monkeypatch.setattr(labeler, "materialise", lambda df, label: plans.append((label, df.rdd.getNumPartitions() if label == "sampled" else 0)) or kept(df, label))
    hours = [(str(m), dt.datetime(2024, 1, 1, h), 1.0 + h, 0.0, 0.0, float(h)) for m in range(16) for h in range(24)]
    labeler.label_heat_pumps(spark.createDataFrame(hours, "meter_number string, timestamp timestamp, l1 double, l2 double, l3 double, T double"), labeler.LabelConfig(max_bins=1, draws=2, samples=9))
    assert dict(plans)["sampled"] == 17


@pytest.mark.parametrize("large", [1, 4, 1000])
def test_large_groups_are_filled_without_a_shuffle_by_group(spark, monkeypatch, large):
    monkeypatch.setattr(clean, "LARGE", large)
    rows = [(i, "a", 4.0 if i % 2 else None) for i in range(40)] + [(100 + i, "bcd"[i % 3], float(i) if i > 2 else None) for i in range(9)] + [(200, None, None), (201, "e", None)]
    out = clean.fill_numbers(spark.createDataFrame(rows, "k int, g string, x double"), ["x"], "g")
    got = {r.k: r.x for r in out.collect()}
    assert len(got) == len(rows) and (got[0], got[100], got[101], got[102], got[107]) == (4.0, 4.0, 6.0, 6.0, 7.0) and got[200] == got[201] == 4.0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("hashpartitioning(g#" in plan) is False


def test_only_resampled_rows_are_shuffled_to_a_grid(spark):
    t = lambda m: dt.datetime(2025, 1, 1, 0, m)
    rows = [("a", t(0), 1.0), ("a", t(30), 2.0), ("a", t(30), 3.0), ("a", t(7), 9.0), ("b", t(15), 4.0), ("c", t(7), 5.0), ("c", None, 6.0), (None, t(0), 7.0), (None, t(15), 8.0), ("d", t(45), None)]
    means = spark.createDataFrame(rows, "meter_number string, timestamp timestamp, v double")
    grid = spark.createDataFrame([(t(m),) for m in (0, 15, 30, 45)], "timestamp timestamp")
    want = means.select("meter_number").distinct().crossJoin(grid).join(means, ["meter_number", "timestamp"], "left")
    out = resample.on_grid(means, grid)
    assert out.columns == want.columns
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert resample.on_grid(means, grid.limit(0)).isEmpty() and resample.on_grid(means.limit(0), grid).isEmpty()
    plan = out.groupBy("meter_number").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning(meter_number") and plan.count("Exchange hashpartitioning(meter_number") == 1
