"""Phase identification: the plan over all transformers against the arrays of one, and planted connections."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from voltloom.operators import hclust, phasemap, phaseprep
from voltloom.plans.queries import QUERIES


def naive_linkage(d):
    """Heights and members of every merge, by looking at all pairs of clusters."""
    clusters, out = [frozenset([i]) for i in range(len(d))], []
    while len(clusters) > 1:
        far = {(a, b): max(d[i, j] for i in a for j in b) for n, a in enumerate(clusters) for b in clusters[:n]}
        a, b = min(far, key=far.get)
        out.append((far[a, b], a | b))
        clusters = [c for c in clusters if c not in (a, b)] + [a | b]
    return out


@pytest.mark.parametrize("n", [2, 3, 7, 25])
def test_chains_give_the_tree_of_all_pairs(n):
    x = np.random.default_rng(n).random((n, n))
    d = x + x.T
    z = hclust.complete_linkage(d)
    members = hclust.leaves_of(z)
    assert [(h, frozenset(members[n + k])) for k, h in enumerate(z[:, 2])] == naive_linkage(d)
    assert (z[:, 0] < z[:, 1]).all() and z[:, 3].tolist() == [len(m) for m in members[n:]]


def test_linkage_of_ties_none_and_one():
    assert hclust.complete_linkage(np.zeros((0, 0))).shape == hclust.complete_linkage(np.zeros((1, 1))).shape == (0, 4)
    z = hclust.complete_linkage(np.ones((6, 6)))
    assert z[:, 2].tolist() == [1.0] * 5 and sorted(z[:, :2].ravel().tolist()) == list(range(10))


def series(rng, n, m):
    x = 230 + rng.normal(0, 1, (n, m))
    for j in range(m):
        x[rng.random(n) < [0.0, 0.02, 0.3, 0.97][j % 4], j] = np.nan
    x[rng.integers(n), 0] = 100.0
    x[rng.integers(n), 1] = 260.0
    x[:2], x[-3:] = np.nan, np.nan
    return x


def long_rows(spark, unit, x):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(unit, j, t0 + dt.timedelta(hours=i), None if np.isnan(v) else float(v), True) for i, line in enumerate(x) for j, v in enumerate(line)]
    return spark.createDataFrame(rows, "unit string, leaf long, timestamp timestamp, v double, used boolean")


@pytest.mark.parametrize("seed, window, rows", [(0, 3, 20), (1, 1, 45), (2, 4, 70), (3, 2, 200)])
def test_usable_rows_are_those_of_one_transformers_arrays(spark, seed, window, rows):
    cfg = phasemap.PhaseConfig(window=window, rows=rows, rows_step=10)
    x = series(np.random.default_rng(seed), 80, 6)
    phases, differences = phaseprep.usable(long_rows(spark, "u", x), cfg)
    found = {r.leaf: r.choice is not None and r.k > r.choice for r in phases.collect()}
    try:
        clean, keep = phasemap.clean_unit(x, cfg)
    except RuntimeError:
        assert not any(found.values())
        return
    assert [found[j] for j in range(6)] == keep.tolist()
    d = np.diff(clean, axis=0)
    d = d[~np.isnan(d).any(1)]
    got = differences.toPandas().pivot(index="r", columns="leaf", values="d").sort_index().to_numpy()
    assert got.shape == d.shape and np.allclose(got, d)


def test_distances_come_from_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(phaseprep, "BLOCK", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (50, 8)).round(1)
    x[:, 7] = 1.0
    rows = [("u", j, i, float(v)) for i, line in enumerate(x) for j, v in enumerate(line)]
    vectors = phaseprep.rank_vectors(spark.createDataFrame(rows, "unit string, leaf long, r long, d double"))
    numbers = spark.createDataFrame([("u", j, j, 8) for j in range(8)], "unit string, leaf long, idx long, size long")
    blocks = phaseprep.distance_blocks(vectors, numbers).toPandas()
    assert len(blocks) == 6
    assert np.allclose(phaseprep.assemble(8, blocks), hclust.spearman_distance(x))


def grid(rng, n=300):
    """Two transformers of three feeders; a twisted meter, one of another feeder, one of another transformer, gaps."""
    rows, places = [], []
    t0 = dt.datetime(2024, 1, 1)
    for unit in "AB":
        a = rng.uniform(-1, 1, (3, n))
        a -= a.mean(0)
        for f in range(3):
            feeder = rng.uniform(-1, 1, (3, n)) * 0.4
            for m in range(6):
                v = 230 + 2 * a + feeder + rng.uniform(-1, 1, (3, n)) * 0.05
                if (f, m) == (0, 1):
                    v = v[[1, 0, 2]]
                if (unit, f, m) == ("B", 1, 2):
                    v = np.tile(230 + 2 * rng.uniform(-1, 1, n), (3, 1)) + rng.uniform(-1, 1, (3, n)) * 0.05
                if (f, m) == (2, 5):
                    v[2, rng.random(n) < 0.95] = np.nan
                if (f, m) == (1, 4):
                    v[1] = np.nan
                v[:, 40] = np.where(m == 3, 150.0, v[:, 40])
                meter = f"{unit}{f}{m}"
                rows += [(meter, t0 + dt.timedelta(hours=i), *(None if np.isnan(y) else float(y) for y in v[:, i])) for i in range(n)]
                at = (f + 1) % 3 if (unit, f, m) == ("A", 2, 2) else f
                places.append((unit, meter, str(at), f"c{f}{m // 3}"))
    return rows, places


def test_plan_and_arrays_map_alike(spark):
    rows, places = grid(np.random.default_rng(7))
    v = spark.createDataFrame(rows + rows[:50], "meter_number string, timestamp timestamp, voltage_l1 double, voltage_l2 double, voltage_l3 double")
    where = spark.createDataFrame([*places, ("C", "C1", "0", None)], "transformer_id string, meter_number string, feeder_id string, cabinet_id string")
    off = spark.createDataFrame([("A14", "L2"), ("B14", "l2")], "meter_number string, phase string")
    cfg = phasemap.PhaseConfig(window=10, rows=200)
    got = phasemap.identify_phases(v, where, off, cfg).toPandas().sort_values(["meter_id", "sm_phase"]).reset_index(drop=True)
    parts = []
    for unit in "AB":
        long = pd.DataFrame(rows, columns=["meter", "t", "l1", "l2", "l3"]).merge(pd.DataFrame(places, columns=["unit", "meter", "feeder", "cabinet"]))
        long = long[long["unit"] == unit].melt(["meter", "t", "feeder", "cabinet"], ["l1", "l2", "l3"], "phase", "v")
        long["label"] = "voltage_" + long["phase"] + "_" + long["meter"] + "_" + long["cabinet"] + "_" + long["feeder"]
        gone = [phasemap.parse_label(x) for x in long["label"].unique() if "l2_A14" in x or "l2_B14" in x]
        parts.append(phasemap.identify_transformer(unit, long.pivot(index="t", columns="label", values="v"), gone, cfg))
    want = pd.concat(parts).sort_values(["meter_id", "sm_phase"]).reset_index(drop=True)
    assert got.equals(want[got.columns])
    status = got.set_index(["meter_id", "sm_phase"])["status"]
    assert status["A01", "l1"] == status["B01", "l2"] == "SM Phase Twist"
    assert status["A22", "l1"] == "Wrong Feeder" and status["B12", "l3"] == "Wrong Trafo"
    assert status["A25", "l3"] == "SM Phase Insufficient Data" and status["A14", "l2"] == "SM Phase Unconnected"


def test_transformers_that_cant_be_mapped_say_so(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=i), None, None, None) for i in range(3)] + [("b", t0 + dt.timedelta(hours=i), 1.0, 1.0, 1.0) for i in range(3)]
    v = spark.createDataFrame(rows, "meter_number string, timestamp timestamp, voltage_l1 double, voltage_l2 double, voltage_l3 double")
    where = spark.createDataFrame([("1", "a", "f", "c"), ("2", "b", "f", "c")], "transformer_id string, meter_number string, feeder_id string, cabinet_id string")
    got = {(r.transformer_id, r.status) for r in phasemap.identify_phases(v, where).collect()}
    assert got == {("1", "failed: a transformer without any voltage"), ("2", "failed: no usable phase is left")}


def test_planted_connections_are_all_found(spark):
    rows = QUERIES["phase_clusters"](spark, "/root/testdata/sf0.01").toPandas()
    assert not rows["status"].str.startswith("failed").any()
    said = set(rows["status"])
    assert {"Normal", "Wrong Trafo", "Wrong Feeder", "SM Phase Twist", "Feeder Phase Twist", "SM Phase Insufficient Data", "SM Phase Unconnected"} <= said


def test_voltages_are_made_by_as_many_tasks_as_their_meters_call_for(spark, monkeypatch):
    from voltloom.plans import frames

    monkeypatch.setattr(frames, "METERS_OF_A_TASK", 10)
    assert frames.planted_voltages(spark, "/root/testdata/sf0.01").rdd.getNumPartitions() == 16  # 150 meters


@pytest.mark.parametrize("name, rows", [("phase_clusters", 450), ("mapped_phases", 451)])
def test_scratch_tables_hold_few_bytes_a_value(spark, monkeypatch, name, rows):
    """Voltages are read once and go on as codes: neither stored nor shuffled."""
    import os

    from voltloom.plans import frames, queries

    paths = []

    def kept(df, label, write=phasemap.materialise):
        out = write(df, label)
        paths.append(out._voltloom_path.removeprefix("file:"))
        return out

    for module in (phasemap, phaseprep, queries):
        monkeypatch.setattr(module, "materialise", kept)
    assert QUERIES[name](spark, "/root/testdata/sf0.01").count() == rows
    values = 450 * 720
    assert sum(os.path.getsize(os.path.join(a, f)) for p in paths for a, _, files in os.walk(p) for f in files) < 4 * values
    monkeypatch.setattr(frames, "METERS_OF_A_TASK", 10)
    made = frames.planted_voltages(spark, "/root/testdata/sf0.01")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (made, phaseprep.coded(made, ["meter_number"], ["voltage_l1"], phasemap.PhaseConfig()))]
    assert plans[0].count("Exchange hashpartitioning(meter") == plans[1].count("Exchange hashpartitioning(meter") == 1


def test_codes_of_repeated_missing_and_split_rows(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(6)]
    rows = [("a", t[0], 1.0), ("a", t[0], float("nan")), ("a", t[1], 2.0), ("a", t[1], 230.0), ("a", t[2], None), ("a", t[2], 231.0), ("a", t[4], 250.0), ("a", None, 9.0)]
    rows += [("b", x, 230.0 + i % 2) for i, x in enumerate(t)] + [("c", None, 1.0), ("d", t[3], None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = {r.m: r for r in phaseprep.coded(spark.createDataFrame(rows, "m string, timestamp timestamp, v double"), ["m"], ["v"], phasemap.PhaseConfig()).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got) == ["a", "b", "c", "d"] and [(got[m].c, got[m].low) for m in "abcd"] == [(3, 0), (6, 0), (0, 0), (0, 0)]
    codes = {m: np.frombuffer(got[m].codes, "<u2").tolist() for m in "abcd"}
    assert codes == {"a": [0, 0, 1], "b": [0, 1, 0, 1, 0, 1], "c": [], "d": []}
    assert phaseprep._flags(got["a"].mask, 4).tolist() == [False, True, True, True] and phaseprep._flags(got["a"].jumps, 3).tolist() == [False, False, True]
    assert len(phaseprep._unpack(got["a"].times)) == 4 and len(phaseprep._unpack(got["c"].times)) == 0 and got["b"].mask is got["b"].jumps is got["b"].lows is None


def test_units_of_more_than_a_block_and_uneven_times(spark):
    rng = np.random.default_rng(11)
    n, t0 = 70, dt.datetime(2024, 1, 1)
    a = rng.uniform(-1, 1, (3, n))
    a -= a.mean(0)
    rows, places = [], []
    for m in range(90):
        v = 230 + 2 * a + rng.uniform(-1, 1, (3, n)) * 0.2
        v[:, 20] = np.where(m == 3, 150.0, v[:, 20])
        v[1, rng.random(n) < (0.6 if m == 5 else 0)] = np.nan
        at = [t0 + dt.timedelta(hours=i) for i in range(n)]
        if m == 7:  # a time that no other meter has, and one that it lacks
            at[40] += dt.timedelta(minutes=20)
        rows += [(f"m{m}", x, *(None if np.isnan(y) else float(y) for y in v[:, i])) for i, x in enumerate(at)]
        places.append(("A", f"m{m}", str(m % 3), f"c{m // 5}"))
    cfg = phasemap.PhaseConfig(window=2, rows=40, rows_step=10)
    v = spark.createDataFrame(rows, "meter_number string, timestamp timestamp, voltage_l1 double, voltage_l2 double, voltage_l3 double").repartition(3)
    where = spark.createDataFrame(places, "transformer_id string, meter_number string, feeder_id string, cabinet_id string")
    got = phasemap.identify_phases(v, where, None, cfg).toPandas().sort_values(["meter_id", "sm_phase"]).reset_index(drop=True)
    long = pd.DataFrame(rows, columns=["meter", "t", "l1", "l2", "l3"]).merge(pd.DataFrame(places, columns=["unit", "meter", "feeder", "cabinet"]))
    long = long.melt(["meter", "t", "feeder", "cabinet"], ["l1", "l2", "l3"], "phase", "v")
    long["label"] = "voltage_" + long["phase"] + "_" + long["meter"] + "_" + long["cabinet"] + "_" + long["feeder"]
    want = phasemap.identify_transformer("A", long.pivot(index="t", columns="label", values="v"), [], cfg).sort_values(["meter_id", "sm_phase"]).reset_index(drop=True)
    assert got.equals(want[got.columns]) and "Normal" in set(got["status"])
    assert got.set_index(["meter_id", "sm_phase"])["status"]["m5", "l2"] == "SM Phase Insufficient Data"


def test_long_series_of_few_phases_go_by_blocks_too(spark, monkeypatch):
    monkeypatch.setattr(phasemap, "TASK_VALUES", 50_000)
    asked = []
    monkeypatch.setattr(phasemap, "distance_blocks", lambda v, n: asked.append(n.count()) or phaseprep.distance_blocks(v, n))
    rows = QUERIES["phase_clusters"](spark, "/root/testdata/sf0.01").toPandas()
    assert asked and asked[0] > 0 and len(rows) == 450 and not rows["status"].str.startswith("failed").any()
