"""Phase identification: which feeder and transformer phase each meter phase is connected to.

Voltages of meter phases on one feeder phase move alike. Preparation (windows of corrupt data, differences, ranks and their
products) is a plan over all transformers (``phaseprep``); the clustering of one transformer's distance matrix and the rules
on its tree run in one grouped Arrow batch for each transformer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PHASES
from ..sources.scratch import grown, materialise
from .hclust import complete_linkage, cut, leaves_of, spearman_distance
from .phaseprep import BLOCK, TASK_VALUES, assemble, choices, code_vectors, coded, distance_blocks, distances_of_one_block, grids, phases_kept


@dataclass(frozen=True)
class PhaseConfig:
    """Fixed limits of the mapper."""

    window: int = 30
    low: float = 207.0
    step: float = 10.0
    tolerance: float = 0.9
    tolerance_step: float = 0.05
    least_tolerance: float = 0.099
    rows: int = 7500
    rows_step: int = 200
    feeder_share: float = 0.75
    phase_share: float = 0.58
    backup_share: float = 0.6
    twist_share: float = 0.66


class Leaf(NamedTuple):
    """A meter phase. A missing cabinet is 'nan'."""

    phase: str
    meter: str
    cabinet: str
    feeder: str

    @property
    def label(self) -> str:
        return f"voltage_{self.phase}_{self.meter}_{self.cabinet}_{self.feeder}"


def parse_label(label: str) -> Leaf:
    parts = label.split("_")
    if len(parts) != 5 or parts[0] != "voltage":
        raise ValueError(f"not a voltage label: {label!r}")
    return Leaf(*parts[1:])


# --- preparation as window expressions ----------------------------------------------------------------------------------


def corruption_mask(long: DataFrame, window: int = 30, low: float = 207.0, step: float = 10.0, by: Sequence[str] = ("unit",), order: str = "timestamp", value: str = "v", key: str = "phase") -> DataFrame:
    """Rows (``by``, ``order``) with ``masked``: whether some window of ``window`` rows over the row is corrupt.

    long: one row for each unit, time and phase. A window is corrupt if any phase is null or under ``low`` in it, or jumps
    by more than ``step`` between two of its rows. Units with fewer rows than a window are never masked.
    """
    own = Window.partitionBy(*by, key).orderBy(order)
    jump = F.abs(F.col(value) - F.lag(value).over(own)) > step
    marked = long.withColumns({"_bad": F.col(value).isNull() | (F.col(value) < low), "_jump": F.coalesce(jump, F.lit(False))})
    rows = marked.groupBy(*by, order).agg(F.max("_bad").alias("_bad"), F.max("_jump").alias("_jump"))
    w = Window.partitionBy(*by).orderBy(order)
    starts = F.max("_bad").over(w.rowsBetween(0, window - 1))
    if window > 1:
        starts = starts | F.max("_jump").over(w.rowsBetween(1, window - 1))
    whole = F.count("*").over(w.rowsBetween(0, window - 1)) == window
    rows = rows.withColumn("_start", whole & F.coalesce(starts, F.lit(False)))
    return rows.select(*by, order, F.coalesce(F.max("_start").over(w.rowsBetween(-(window - 1), 0)), F.lit(False)).alias("masked"))


def difference_scaled(long: DataFrame, by: Sequence[str], order: str = "timestamp", value: str = "v") -> DataFrame:
    """First differences of each series, scaled to mean 0 and population deviation 1 (a constant one is left unscaled)."""
    w, all_ = Window.partitionBy(*by).orderBy(order), Window.partitionBy(*by)
    out = long.withColumn("_d", F.col(value) - F.lag(value).over(w)).where("_d is not null")
    deviation = F.stddev_pop("_d").over(all_)
    scaled = (F.col("_d") - F.avg("_d").over(all_)) / F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
    return out.withColumn("z", scaled).drop("_d")


def spearman(long: DataFrame, key: str, order: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """1 minus the rank correlation of each pair of series (a <= b), over the times that all series of the unit have."""
    units = Window.partitionBy(*by, order) if by else Window.partitionBy(order)
    keys = long.where(F.col(value).isNotNull()).select(*by, key).distinct().groupBy(*by).agg(F.count("*").alias("_k"))
    known = long.where(F.col(value).isNotNull()).withColumn("_n", F.count("*").over(units))
    known = (known.join(keys, list(by)) if by else known.crossJoin(F.broadcast(keys))).where("_n = _k")
    w = Window.partitionBy(*by, key).orderBy(value)
    ties = F.count("*").over(Window.partitionBy(*by, key, value))
    ranked = known.select(*by, key, order, (F.rank().over(w) + (ties - 1) / 2).alias("_r"))
    a = ranked.select(*by, order, F.col(key).alias("a"), F.col("_r").alias("ra"))
    b = ranked.select(*by, order, F.col(key).alias("b"), F.col("_r").alias("rb"))
    return a.join(b, [*by, order]).where("a <= b").groupBy(*by, "a", "b").agg((1 - F.corr("ra", "rb")).alias("distance"))


def majority(df: DataFrame, value: str, share: float, by: Sequence[str], order: str) -> DataFrame:
    """The commonest value of each key if its share reaches ``share``, else null; of equal counts the first by ``order``."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    out = counts.groupBy(*by).agg(F.sum("_n").alias("_all"), F.min(F.struct((-F.col("_n")).alias("n"), "_first", value)).alias("_b"))
    return out.select(*by, F.when(-F.col("_b.n") >= share * F.col("_all"), F.col(f"_b.{value}")).alias(value))


# --- one transformer ---------------------------------------------------------------------------------------------------


def corrupt_rows(x: np.ndarray, window: int, low: float, step: float) -> np.ndarray:
    """The numpy form of :func:`corruption_mask` for a matrix of times and phases."""
    n = len(x)
    if n < window:
        return np.zeros(n, bool)
    bad = (np.isnan(x) | (x < low)).any(1)
    jump = np.concatenate([[False], (np.abs(np.diff(x, axis=0)) > step).any(1)])

    def any_of(flags: np.ndarray, width: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[width:] > total[:-width]

    start = any_of(bad, window)
    if window > 1:
        start |= any_of(jump, window - 1)[1:]
    cover = np.zeros(n + 1, int)
    np.add.at(cover, np.flatnonzero(start), 1)
    np.add.at(cover, np.flatnonzero(start) + window, -1)
    return cover.cumsum()[:n] > 0


def clean_unit(x: np.ndarray, cfg: PhaseConfig = PhaseConfig()) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are complete, and columns that are kept, for the highest tolerance that leaves enough rows.

    Columns with at least the tolerated share of missing, or more of low voltages, are dropped. If no tolerance leaves
    enough rows, fewer rows are asked for.
    """
    some = np.flatnonzero((~np.isnan(x)).any(1))
    if not len(some):
        raise RuntimeError("a transformer without any voltage")
    x = x[some[0] : some[-1] + 1]
    missing = np.isnan(x).mean(0)
    low = (x < cfg.low).mean(0)
    tolerance, rows = cfg.tolerance, cfg.rows
    masks: dict[bytes, np.ndarray] = {}
    while True:
        keep = (missing < tolerance) & (low <= tolerance)
        if not keep.any():
            raise RuntimeError("no usable phase is left")
        if keep.tobytes() not in masks:
            part = x[:, keep]
            masks[keep.tobytes()] = ~corrupt_rows(part, cfg.window, cfg.low, cfg.step) & ~np.isnan(part).any(1)
        fine = masks[keep.tobytes()]
        if fine.sum() >= rows:
            out = np.full((len(x), int(keep.sum())), np.nan)
            out[fine] = x[:, keep][fine]
            return out, keep
        tolerance -= cfg.tolerance_step
        if tolerance < cfg.least_tolerance:
            rows, tolerance = rows - cfg.rows_step, cfg.tolerance


def prepare_unit(x: np.ndarray) -> np.ndarray:
    """Differences between neighbouring complete rows, scaled by column."""
    d = np.diff(x, axis=0)
    d = d[~np.isnan(d).any(1)]
    deviation = d.std(0)
    return (d - d.mean(0)) / np.where(deviation == 0, 1.0, deviation)


def commonest(values: Iterable[str], share: float) -> str | None:
    """The commonest value (of equal counts the first seen) if it has the share."""
    counts = Counter(values)
    if not counts:
        return None
    value, n = counts.most_common(1)[0]
    return value if n >= share * counts.total() else None


@dataclass
class Evaluation:
    """What the rules find in a tree."""

    clusters: dict[str, list[Leaf]] = field(default_factory=dict)
    twisted: dict[Leaf, str] = field(default_factory=dict)
    wrong_feeder: dict[Leaf, str] = field(default_factory=dict)
    wrong_transformer: list[Leaf] = field(default_factory=list)
    doubled: list[Leaf] = field(default_factory=list)
    cabinet: dict[Leaf, str] = field(default_factory=dict)
    transformer_phase: dict[Leaf, str] = field(default_factory=dict)
    twisted_feeder: list[tuple[str, str]] = field(default_factory=list)


class Tree:
    """A transformer's phases and their clustering. Names are compared as parsed fields, never by parts of labels."""

    def __init__(self, leaves: Sequence[Leaf], linkage: np.ndarray, cfg: PhaseConfig = PhaseConfig()):
        self.leaves, self.linkage, self.cfg = list(leaves), linkage, cfg
        self.members = [[self.leaves[i] for i in c] for c in leaves_of(linkage)]

    def children(self, c: int) -> tuple[int, int] | None:
        i = c - len(self.leaves)
        return (int(self.linkage[i, 0]), int(self.linkage[i, 1])) if i >= 0 else None

    def transformer_clusters(self) -> dict[str, list[Leaf]]:
        """The three top clusters by their majority phases, which must differ."""
        out: dict[str, list[Leaf]] = {}
        for part in cut(self.linkage, 3):
            group = [self.leaves[i] for i in sorted(part)]
            phase = commonest((x.phase for x in group), 0.5)
            if phase is None or phase in out:
                raise ValueError("the three transformer clusters have no distinct majority phases")
            out[phase] = group
        if len(out) < 3:
            raise ValueError("fewer than three transformer clusters")
        return out

    def backup_phases(self, top: dict[str, list[Leaf]]) -> dict[Leaf, str]:
        """A phase for each leaf: the majority of its feeder within its transformer cluster, else the cluster's."""
        out = {}
        for phase, group in top.items():
            for feeder in {x.feeder for x in group}:
                part = [x for x in group if x.feeder == feeder]
                found = commonest((x.phase for x in part), self.cfg.backup_share) or phase
                out.update(dict.fromkeys(part, found))
        if set(out.values()) != set(PHASES):
            raise ValueError("a phase has no reference")
        return out

    def evaluate(self, verified: set[Leaf] | None = None) -> Evaluation:
        """Walk down from the root and accept clusters of one feeder phase. ``verified``: foreign leaves that a cluster may
        hold, known from an earlier pass."""
        top = self.transformer_clusters()
        backup, out = self.backup_phases(top), Evaluation()
        todo: list[tuple[int, list[Leaf]]] = [(2 * len(self.leaves) - 2, [])]
        while todo:
            c, parent = todo.pop()
            group = self.members[c]
            feeders = {x.feeder for x in group}
            feeder = commonest((x.feeder for x in group), self.cfg.feeder_share)
            phase = commonest((x.phase for x in group), self.cfg.phase_share)
            if len(group) > 1 and len({x.meter for x in group}) == 1 and len({x.feeder for x in parent}) > 1:
                foreign = [x for x in self.leaves if x[1:] == group[0][1:]]
                out.wrong_transformer += foreign
                out.clusters[f"{feeder}_LX"] = foreign
                continue
            kids = self.children(c)
            mixed = len(feeders) == 1 or (kids is not None and all(any(x.feeder == feeder for x in self.members[k]) for k in kids))
            apart = len(feeders) > 1 and feeder is not None and verified is not None and any(x.feeder != feeder and x not in verified for x in group)
            if kids is None or (feeder is not None and phase is not None and mixed and not apart):
                self._accept(out, group, feeder or group[0].feeder, phase or group[0].phase, backup)
            else:
                todo += [(kids[1], group), (kids[0], group)]
        self._feeder_twists(out, top)
        gone = set(out.wrong_transformer)
        out.twisted = {x: p for x, p in out.twisted.items() if x not in gone}
        out.cabinet = self._near_cabinets(out.wrong_feeder)
        return out

    def _accept(self, out: Evaluation, group: list[Leaf], feeder: str, phase: str, backup: dict[Leaf, str]) -> None:
        key, n = f"{feeder}_{phase}", 0
        while key in out.clusters:
            n += 1
            key = f"{feeder}_{phase}_{n}"
        out.clusters[key] = group
        clear = len(group) > 2 and sum(x.phase == phase for x in group) / len(group) > self.cfg.twist_share
        for x in group:
            wanted = phase if clear else backup[x]
            if x.phase != wanted:
                out.twisted[x] = wanted
            if x.feeder != feeder:
                out.wrong_feeder[x] = feeder
        meters = Counter(x.meter for x in group)
        out.doubled += [x for x in group if meters[x.meter] > 1]

    def _feeder_twists(self, out: Evaluation, top: dict[str, list[Leaf]]) -> None:
        """For each feeder the permutation of phases, if any, by which its sound phases lie in the transformer clusters."""
        gone = set(out.wrong_transformer)
        sound = {t: [x for x in group if x not in out.twisted and x not in gone] for t, group in top.items()}
        for feeder in sorted({x.feeder for x in self.leaves}):
            of = {p: [x for group in sound.values() for x in group if x.feeder == feeder and x.phase == p] for p in PHASES}
            inside = {(p, t): all(x in sound[t] for x in of[p]) for p in PHASES for t in PHASES}
            for targets in permutations(PHASES):
                hits = [inside[p, t] for p, t in zip(PHASES, targets, strict=True)]
                straight = targets == PHASES
                if sum(hits) >= 2 if straight else all(hits):
                    for p, t in zip(PHASES, targets, strict=True):
                        if p != t:
                            out.twisted_feeder.append((feeder, t))
                        out.transformer_phase.update(dict.fromkeys(of[p], t))
        known = dict(out.transformer_phase)
        for x, actual in out.twisted.items():
            seen = [t for y, t in known.items() if y.feeder == x.feeder and y.phase == actual and y not in out.twisted and y not in gone]
            out.transformer_phase[x] = Counter(seen).most_common(1)[0][0] if seen else actual

    def _near_cabinets(self, wrong: dict[Leaf, str]) -> dict[Leaf, str]:
        """The commonest cabinet among the nearest sound phases of a meter with a wrong feeder."""
        nearest: dict[str, list[str]] = {}
        n = len(self.leaves)
        for x in wrong:
            for c in range(n, len(self.members)):  # merges around a leaf come from the innermost on
                if x in self.members[c]:
                    sound = [y.cabinet for y in self.members[c] if y not in wrong]
                    if sound:
                        nearest.setdefault(x.meter, []).extend(sound)
                        break
        best = {m: Counter(v).most_common(1)[0][0] for m, v in nearest.items()}
        return {x: best[x.meter] for x in wrong if x.meter in best}


def consistent_wrong_feeders(wrong: dict[Leaf, str], corrupt: Iterable[Leaf]) -> set[Leaf]:
    """Wrong feeder labels of meters of which all usable phases have one."""
    usable = {}
    for x in corrupt:
        usable[x.meter] = usable.get(x.meter, 3) - 1
    counts = Counter(x.meter for x in wrong)
    return {x for x in wrong if counts[x.meter] == usable.get(x.meter, 3)}


RESULT = (
    "transformer_id string, feeder_id string, cabinet_id string, meter_id string, sm_phase string, feeder_phase string, "
    "transformer_phase string, true_feeder_id string, true_transformer_id string, likely_cabinet_id string, status string"
)
RESULT_COLUMNS = [f.split()[0] for f in RESULT.split(", ")]


def result_rows(transformer: str, leaves: Sequence[Leaf], found: Evaluation | None, corrupt: Iterable[Leaf] = (), unconnected: Iterable[Leaf] = ()) -> pd.DataFrame:
    """One row for each phase: where it is connected, and a status that joins all findings by ' / '."""
    found = found or Evaluation()
    corrupt, unconnected, foreign = set(corrupt), set(unconnected), set(found.wrong_transformer)
    known = {}
    for x in leaves:
        row = {"feeder_phase": found.twisted.get(x, x.phase), "transformer_phase": found.transformer_phase.get(x, "nan"), "true_feeder_id": found.wrong_feeder.get(x, x.feeder), "true_transformer_id": transformer}
        if x in foreign:
            row |= {"feeder_phase": "nan", "transformer_phase": "nan", "true_feeder_id": "nan", "true_transformer_id": "other"}
        if x in corrupt or x in unconnected:
            row = dict.fromkeys(row, "nan")
        known[x] = row
    out = []
    for x in leaves:
        row = known[x]
        if x in unconnected:  # a connected phase of the meter tells feeder and transformer
            other = next((known[y] for y in sorted(leaves) if y[1:] == x[1:] and known[y]["true_feeder_id"] != "nan"), None)
            if other:
                row = row | {k: other[k] for k in ("true_feeder_id", "true_transformer_id")}
        normal = (row["true_transformer_id"], row["true_feeder_id"], row["feeder_phase"], row["transformer_phase"]) == (transformer, x.feeder, x.phase, x.phase)
        said = [  # fixed values: the texts that results carry
            (normal, "Normal"), (x in unconnected, "SM Phase Unconnected"), (x in corrupt, "SM Phase Insufficient Data"), (x in found.twisted, "SM Phase Twist"), (x in found.doubled, "SM Phase Doubled"),
            (row["transformer_phase"] not in ("nan", row["feeder_phase"]), "Feeder Phase Twist"), (row["feeder_phase"] != "nan" and row["transformer_phase"] == "nan", "Unknown Feeder Phase"),
            (x in found.wrong_feeder, "Wrong Feeder"), (x in foreign, "Wrong Trafo"),
        ]
        out.append((transformer, x.feeder, x.cabinet, x.meter, x.phase, *row.values(), found.cabinet.get(x), " / ".join(t for ok, t in said if ok)))
    return pd.DataFrame(out, columns=RESULT_COLUMNS, dtype=object)


def map_leaves(transformer: str, leaves: Sequence[Leaf], kept: Sequence[Leaf], distance: np.ndarray, unconnected: Iterable[Leaf] = (), cfg: PhaseConfig = PhaseConfig()) -> pd.DataFrame:
    """Cluster the kept phases of one transformer and apply the rules, twice."""
    unconnected = set(unconnected)
    corrupt = [x for x in leaves if x not in unconnected and x not in set(kept)]
    tree = Tree(kept, complete_linkage(distance), cfg)
    first = tree.evaluate()
    found = tree.evaluate(consistent_wrong_feeders(first.wrong_feeder, corrupt))
    return result_rows(transformer, leaves, found, corrupt, unconnected)


def identify_transformer(transformer: str, wide: pd.DataFrame, unconnected: Iterable[Leaf] = (), cfg: PhaseConfig = PhaseConfig()) -> pd.DataFrame:
    """Map one transformer in memory. wide: a row for each time, a column for each leaf's label."""
    leaves, unconnected = [parse_label(c) for c in wide.columns], set(unconnected)
    used = [x for x in leaves if x not in unconnected]
    clean, keep = clean_unit(wide[[x.label for x in used]].to_numpy(float), cfg)
    kept = [x for x, k in zip(used, keep, strict=True) if k]
    return map_leaves(transformer, leaves, kept, spearman_distance(prepare_unit(clean)), unconnected, cfg)


def identify_phases(voltages: DataFrame, places: DataFrame, unconnected: DataFrame | None = None, cfg: PhaseConfig = PhaseConfig()) -> DataFrame:
    """Map the phases of all transformers.

    voltages: meter_number, timestamp, voltage_l1, _l2, _l3 (repeated rows: the largest value counts); places: transformer_id,
    meter_number, feeder_id, cabinet_id; unconnected: meter_number, phase. A transformer that can't be mapped gives rows with
    status 'failed: <reason>' and does not stop the others. One task holds a transformer's distances, and its series only as rank vectors of
    at most a block of phases and ``TASK_VALUES`` values. Voltages are read once and aren't stored (see ``phaseprep``).
    """
    ids = [F.col(c).cast("string").alias(c) for c in ("transformer_id", "meter_number", "feeder_id")]
    where = places.select(*ids, F.coalesce(F.col("cabinet_id").cast("string"), F.lit("nan")).alias("cabinet_id"))
    off = F.array().cast("array<string>").alias("off")
    if unconnected is None:
        where = where.select("*", off)
    else:
        lists = unconnected.groupBy(F.col("meter_number").cast("string").alias("meter_number")).agg(F.collect_set(F.lower("phase")).alias("off"))
        where = where.join(lists, "meter_number", "left").withColumn("off", F.coalesce("off", off))
    v = voltages.select(F.col("meter_number").cast("string").alias("meter_number"), "timestamp", *(F.col(f"voltage_{p}").alias(p) for p in PHASES))
    codes = materialise(coded(v, ["meter_number"], PHASES, cfg).withColumnRenamed("series", "phase"), "codes")
    phase = F.explode(F.array(*(F.lit(p) for p in PHASES))).alias("phase")
    label = F.concat_ws("_", F.lit("voltage"), "phase", "meter_number", "cabinet_id", "feeder_id").alias("label")
    names = where.where("meter_number is not null").select(F.col("transformer_id").alias("unit"), "*", phase)
    names = names.select("unit", "meter_number", "phase", label, (~F.array_contains("off", F.col("phase"))).alias("used")).distinct()
    names = grown(names).join(codes.drop("codes"), ["meter_number", "phase"])  # leaves out meters without voltages
    names = materialise(names.withColumn("leaf", F.monotonically_increasing_id()), "names")
    grid = materialise(grids(names), "grids")
    phases = phases_kept(names, grid, cfg)
    picked = materialise(choices(phases, cfg), "choices")
    leaves = names.select("unit", "leaf", "meter_number", "phase", "label", "used", "c").join(phases.select("unit", "leaf", "k"), ["unit", "leaf"], "left")
    leaves = leaves.join(grown(picked.select("unit", "choice", F.lit(True).alias("some"))), "unit", "left")
    kept = Window.partitionBy("unit", F.expr("k > choice"))  # null for phases that aren't looked at
    leaves = leaves.withColumn("idx", F.when(F.expr("k > choice"), F.row_number().over(kept.orderBy("label")) - 1)).withColumn("size", F.when(F.expr("k > choice"), F.count("*").over(kept))).withColumn("amount", F.sum("c").over(kept))
    leaves = materialise(leaves, "leaves")
    large = F.expr(f"size > {BLOCK} or amount > {TASK_VALUES}")
    values, some_large = leaves.where("idx is not null").agg(F.sum("c"), F.max(large)).first()
    tasks = max(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + (values or 0) // TASK_VALUES)
    numbers = leaves.where("idx is not null").select("unit", "leaf", "meter_number", "phase", "idx", "size", "amount")
    one = codes.select("meter_number", "phase", "times", "mask", "codes").repartition(tasks, "meter_number", "phase").join(grown(numbers.repartition(tasks, "meter_number", "phase")), ["meter_number", "phase"])
    held = grid.join(picked.where("choice is not null"), "unit").select("unit", "grid", "ok")
    vectors = code_vectors(one.join(held, "unit"))
    block = {"lo": "int", "hi": "int", "m": "binary"}
    parts = vectors.select("*", *(F.lit(None).cast(k).alias(c) for c, k in block.items()))
    if some_large:  # blocks of units of many phases or long series are multiplied by tasks of their own
        vectors = materialise(vectors, "vectors")
        small = numbers.where(~large).select("unit").distinct()
        parts = vectors.join(grown(small), "unit", "left_semi").unionByName(distance_blocks(vectors, numbers.where(large).select("unit", "leaf", "idx", "size")), allowMissingColumns=True)

    def run(key: tuple, own: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("label")
        names = [parse_label(x) for x in own["label"]]
        gone = {x for x, used in zip(names, own["used"], strict=True) if not used}
        k, choice = own["k"].to_numpy(float), own["choice"].to_numpy(float)
        try:
            if np.isnan(choice).all():
                raise RuntimeError("no usable phase is left" if own["some"].notna().any() else "a transformer without any voltage")
            kept = [x for x, ok in zip(names, k > choice, strict=True) if ok]
            if parts["m"].notna().any():
                distance = assemble(len(kept), parts)
            else:
                distance = distances_of_one_block(len(kept), parts.assign(idx=parts["leaf"].map(own.set_index("leaf")["idx"])))
            return map_leaves(key[0], names, kept, distance, gone, cfg)
        except (ValueError, RuntimeError) as e:
            return result_rows(key[0], names, None, names).assign(status=f"failed: {e}")

    return leaves.repartition(tasks, "unit").groupBy("unit").cogroup(parts.repartition(tasks, "unit").groupBy("unit")).applyInPandas(run, RESULT)
