"""Statistical labels of meters: holiday homes and heat pumps, from active power and outdoor temperature.

The deterministic parts are window and aggregate plans over all meters, the analysis of variance too. The sampling of base and thermal loads has no
relational form; it runs once for each meter and phase in a grouped Arrow batch, seeded by the run's seed, the meter and the phase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PHASES
from ..sources.scratch import materialise


@dataclass(frozen=True)
class LabelConfig:
    """Fixed thresholds of the labeler."""

    weekly_change: float = 0.01
    static_days: float = 0.4
    weekend_ratio: float = 0.45
    max_bins: int = 12
    min_bins: int = 1
    filter_temp: int = 3
    slope: float = -0.027
    leeway: float = 0.75
    anova_p: float = 0.01
    draws: int = 100
    samples: int = 1000
    seed: int = 7


def power_phases(series: DataFrame, keep: Sequence[str] = ("meter_number", "timestamp")) -> DataFrame:
    """Imported active power of the phases as l1, l2, l3; missing counts as 0."""
    return series.select(*keep, *(F.coalesce(F.col(f"active_power_p14_{p}"), F.lit(0.0)).alias(p) for p in PHASES))


def weekly_changes(power: DataFrame, by: Sequence[str] = ("meter_number",), ts: str = "timestamp", columns: Sequence[str] = PHASES) -> DataFrame:
    """Mean over phases of the relative change of weekly means to the week before, as absolute value (null: undefined).

    A week without a mean takes the last one known. Against a mean of 0, a change is infinite, and 0 to 0 is undefined.
    """
    w = Window.partitionBy(*by).orderBy("week")
    weekly = power.groupBy(*by, F.date_trunc("week", F.col(ts)).cast(power.schema[ts].dataType).alias("week")).agg(*(F.avg(c).alias(c) for c in columns))
    held = weekly.withColumns({c: F.last(c, True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in columns})
    changes = []
    for c in columns:
        before = F.lag(c).over(w)
        ratio = F.when(before != 0, F.col(c) / F.nullif(before, F.lit(0.0)) - 1).when((before == 0) & (F.col(c) != 0), F.lit(float("inf")))
        changes.append(F.abs(ratio))
    changed = held.withColumns({f"_d{i}": x for i, x in enumerate(changes)})
    names = [F.col(f"_d{i}") for i in range(len(columns))]
    known = sum((n.isNotNull().cast("int") for n in names), F.lit(0))
    total = sum((F.coalesce(n, F.lit(0.0)) for n in names), F.lit(0.0))
    return changed.select(*by, "week", F.when(known > 0, total / known).alias("change"))


def active_rows(power: DataFrame, cfg: LabelConfig = LabelConfig(), by: Sequence[str] = ("meter_number",), ts: str = "timestamp") -> DataFrame:
    """All rows with ``kept``: whether the week's load changed by more than the limit."""
    weeks = weekly_changes(power, by, ts).select(*by, "week", (F.coalesce("change", F.lit(0.0)) > cfg.weekly_change).alias("kept"))
    week = F.date_trunc("week", F.col(ts)).cast(power.schema[ts].dataType)
    return power.withColumn("week", week).join(weeks, [*by, "week"]).drop("week")


#: Fixed dates of the holiday mask: month, first and last day.
HOLIDAYS = ((10, 16, 20), (12, 18, 23), (12, 25, 29), (1, 1, 3), (2, 12, 16), (3, 25, 29), (4, 26, 26))


def is_holiday(ts: Column) -> Column:
    out = F.lit(False)
    for month, first, last in HOLIDAYS:
        out = out | ((F.month(ts) == month) & F.dayofmonth(ts).between(first, last))
    return out


def label_summerhouse(power: DataFrame, cfg: LabelConfig = LabelConfig(), by: Sequence[str] = ("meter_number",), ts: str = "timestamp") -> DataFrame:
    """Consumption on weekends and holidays, rows in weeks without change, and whether a meter looks like a holiday home."""
    rows = active_rows(power, cfg, by, ts)
    load = sum((F.coalesce(F.col(p), F.lit(0.0)) for p in PHASES), F.lit(0.0))
    weekend = F.weekday(F.col(ts)) >= 5
    out = rows.groupBy(*by).agg(
        F.count_if(~F.col("kept")).alias("static_rows"), F.count_if("kept").alias("kept_rows"), F.sum(load).alias("total"),
        F.sum(F.when(weekend, load).otherwise(0.0)).alias("weekend"), F.sum(F.when(is_holiday(F.col(ts)), load).otherwise(0.0)).alias("holiday"),
    )
    out = out.withColumn("normal", F.col("total") - F.col("weekend"))
    out = out.withColumn("weekend_ratio", F.when(F.col("normal") > 0, F.col("weekend") / F.nullif("normal", F.lit(0.0))))
    static = F.col("static_rows") > cfg.static_days * F.col("kept_rows")
    label = F.when(F.col("normal") > 0, static | (F.col("weekend_ratio") > cfg.weekend_ratio)).otherwise(F.lit(False))
    return out.withColumn("summerhouse", label).withColumn("holiday_share", F.when(F.col("total") > 0, F.col("holiday") / F.nullif("total", F.lit(0.0))).otherwise(0.0))


def with_weather(hourly: DataFrame, weather: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hourly load with the hour's temperature; rows whose phases are all 0 go (a null phase isn't 0).

    Weather has one row for each hour: 8,760 a year, whatever the number of meters, so it is broadcast.
    """
    zero = F.lit(True)
    for p in PHASES:
        zero = zero & F.col(p).eqNullSafe(F.lit(0.0))
    return hourly.join(F.broadcast(weather.select(ts, "T")), ts, "left").where(~zero)


def quantile_bins(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Number of the quantile bin of each value, from 0: right-closed, the lowest value included, edges interpolated.

    Quantiles are taken by way of percent, as the usual libraries do; so a value on an inner edge counts as above it where
    the percentage has no exact form.
    """
    edges = df.groupBy(*by).agg(F.percentile(column, F.array(*(F.lit(i / bins * 100 / 100) for i in range(bins + 1)))).alias("_e"))
    out = df.join(edges, list(by)) if by else df.crossJoin(F.broadcast(edges))
    inner = F.slice("_e", 2, bins - 1) if bins > 1 else F.array().cast("array<double>")
    return out.withColumn("bin", F.when(F.col(column).isNotNull(), F.size(F.filter(inner, lambda e: e < F.col(column))))).drop("_e")


def coldest_bins(binned: DataFrame, by: Sequence[str] = ("meter_number",), ts: str = "timestamp") -> DataFrame:
    """For each key and phase the bin with the smallest mean load (first of equal ones), and whether it has all hours."""
    long = binned.select(*by, ts, "bin", F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.col(p).alias("load")) for p in PHASES))).alias("_p")).select(*by, ts, "bin", "_p.*")
    means = long.where("bin is not null and load is not null").groupBy(*by, "phase", "bin").agg(F.avg("load").alias("mean"), F.countDistinct(F.hour(ts)).alias("hours"))
    best = means.groupBy(*by, "phase").agg(F.min(F.struct("mean", "bin", "hours")).alias("_b"))
    return best.select(*by, "phase", F.col("_b.bin").alias("bin"), F.col("_b.mean").alias("mean"), (F.col("_b.hours") == 24).alias("all_hours"))


def search_bins(hourly: DataFrame, cfg: LabelConfig = LabelConfig(), by: Sequence[str] = ("meter_number",), ts: str = "timestamp") -> DataFrame:
    """The largest number of quantile bins of temperature for which the coldest-load bin of every phase covers all hours of the day.

    All numbers are tried at once: one aggregation finds the edges of all, each row is placed in every division, and the
    divisions are judged by aggregates. A division whose edges coincide doesn't count; where none is left there is one bin, whatever hours it
    covers. Rows without a temperature have no bin; a missing load counts as 0.

    Returns for each key and phase ``n_bins`` and the number of its ``bin``.
    """
    numbers = range(cfg.max_bins, max(cfg.min_bins, 1) - 1, -1)
    rows = hourly.where("T is not null").select(*by, F.hour(ts).alias("_h"), "T", *(F.coalesce(F.col(p), F.lit(0.0)).alias(p) for p in PHASES))
    edges = rows.groupBy(*by).agg(*(F.percentile("T", F.array(*(F.lit(i / n) for i in range(n + 1)))).alias(f"_e{n}") for n in numbers))
    tried = [F.struct(F.lit(n).alias("n"), F.col(f"_e{n}").alias("e")) for n in numbers]
    edges = edges.select(*by, F.array(*tried).alias("_tried")).select(*by, F.filter("_tried", lambda t: F.size(F.array_distinct(t["e"])) == t["n"] + 1).alias("_tried"))
    placed = rows.join(edges, list(by)).withColumn("_d", F.explode("_tried"))
    inner = F.slice("_d.e", 2, F.col("_d.n") - 1)
    placed = placed.select(*by, "_h", *PHASES, F.col("_d.n").alias("n_bins"), F.when(F.col("_d.n") > 1, F.size(F.filter(inner, lambda e: e < F.col("T")))).otherwise(0).alias("bin"))
    bins = placed.groupBy(*by, "n_bins", "bin").agg(F.countDistinct("_h").alias("hours"), *(F.avg(p).alias(p) for p in PHASES))
    cold = bins.groupBy(*by, "n_bins").agg(*(F.min(F.struct(p, "bin", "hours")).alias(p) for p in PHASES))
    whole = F.greatest(*(F.col(f"{p}.hours") < 24 for p in PHASES)) == F.lit(False)
    best = cold.groupBy(*by).agg(F.max(F.when(whole, F.struct("n_bins", *(F.col(f"{p}.bin").alias(p) for p in PHASES)))).alias("_b"))
    best = rows.select(*by).distinct().join(best, list(by), "left")
    phases = F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.coalesce(F.col(f"_b.{p}"), F.lit(0)).alias("bin")) for p in PHASES)))
    return best.select(*by, F.coalesce("_b.n_bins", F.lit(1)).alias("n_bins"), phases.alias("_p")).select(*by, "n_bins", "_p.*")


def temperature_slope(loads: DataFrame, by: Sequence[str] = ("meter_number", "phase"), load: str = "load", limit: int = 3) -> DataFrame:
    """Least-squares slope of load on the rounded temperature up to ``limit`` degrees, and the line's value at the lowest
    temperature of all rows. A phase without such rows has 0 for both."""
    rows = loads.withColumn("_t", F.bround("T", 0))
    cold, x = F.col("_t") <= limit, F.when(F.col("_t") <= limit, F.col("_t"))
    y = F.when(cold, F.col(load))
    out = rows.groupBy(*by).agg(F.regr_slope(y, x).alias("_s"), F.regr_intercept(y, x).alias("_i"), F.avg(y).alias("_m"), F.min("_t").alias("_low"))
    slope = F.when(F.col("_m").isNull(), F.lit(0.0)).otherwise(F.coalesce("_s", F.lit(0.0)))
    at_low = F.when(F.col("_m").isNull(), F.lit(0.0)).otherwise(F.coalesce("_i", "_m") + slope * F.col("_low"))
    return out.select(*by, slope.alias("slope"), at_low.alias("intercept"))


def heat_pump_phases(slopes: DataFrame, cfg: LabelConfig = LabelConfig(), by: Sequence[str] = ("meter_number",)) -> DataFrame:
    """Whether each phase's slope is under its threshold; where exactly two are, the third gets some leeway."""
    base = slopes.withColumn("threshold", F.lit(cfg.slope) * F.col("intercept")).withColumn("hit", F.col("slope") < F.col("threshold"))
    hits = F.sum(F.col("hit").cast("int")).over(Window.partitionBy(*by))
    eased = (hits == 2) & (F.col("slope") > F.col("threshold"))
    out = base.withColumn("threshold", F.when(eased, F.col("threshold") * cfg.leeway).otherwise(F.col("threshold")))
    out = out.withColumn("heat_pump", F.col("slope") < F.col("threshold")).drop("hit")
    return out.withColumn("indicators", F.sum(F.col("heat_pump").cast("int")).over(Window.partitionBy(*by)))


def absolute_error(df: DataFrame, predicted: str, actual: str, by: Sequence[str]) -> DataFrame:
    """Mean absolute error, and relative to the mean of the actual values."""
    out = df.groupBy(*by).agg(F.avg(F.abs(F.col(predicted) - F.col(actual))).alias("mae"), F.avg(actual).alias("_m"))
    return out.withColumn("mae_relative", F.try_divide("mae", "_m")).drop("_m")


def dead_phases(hourly: DataFrame, by: Sequence[str] = ("meter_number",)) -> DataFrame:
    """A phase whose sum is 0 or under 1 % of both others' is dead."""
    sums = hourly.groupBy(*by).agg(*(F.coalesce(F.sum(p), F.lit(0.0)).alias(p) for p in PHASES))
    dead = []
    for p in PHASES:
        a, b = (F.col(o) for o in PHASES if o != p)
        dead.append(((F.col(p) == 0) | ((F.col(p) < 0.01 * a) & (F.col(p) < 0.01 * b))).alias(f"{p}_dead"))
    return sums.select(*by, *dead)


# --- the sampled part, for one meter --------------------------------------------------------------------------------------


def seeded(seed: int, *key: object) -> np.random.Generator:
    digest = hashlib.sha256(repr((seed, *map(str, key))).encode()).digest()
    return np.random.default_rng(int.from_bytes(digest[:8], "little"))


@lru_cache(maxsize=1)
def _normal_table() -> tuple[np.ndarray, np.ndarray]:
    x = np.linspace(-9, 9, 18_001)
    return x, np.array([0.5 * (1 + erf(v / sqrt(2))) for v in x])


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Normal distribution function, interpolated between thousandths (error below 1e-7)."""
    return np.interp(x, *_normal_table(), left=0.0, right=1.0)


#: Equal parts of probability in which quantiles are tabulated.
QUANTILES = 1 << 16


@lru_cache(maxsize=1)
def _normal_quantiles() -> np.ndarray:
    """The normal quantile in the middle of each of ``QUANTILES`` equal parts of probability."""
    x, cdf = _normal_table()
    return np.interp((np.arange(QUANTILES) + 0.5) / QUANTILES, cdf, x)


def truncated_normal(rng: np.random.Generator, mean: np.ndarray, sd: np.ndarray, low: float, high: float, size: int) -> np.ndarray:
    """``size`` draws between two limits for each pair of parameters, by inverting the tabulated distribution function."""
    sd = np.maximum(sd, 1e-9)
    first, last = _normal_cdf((low - mean) / sd) * QUANTILES, _normal_cdf((high - mean) / sd) * QUANTILES
    place = rng.random((len(mean), size), np.float32) * (last - first)[:, None].astype(np.float32) + first[:, None].astype(np.float32)
    out = _normal_quantiles()[np.minimum(place.astype(np.int32), QUANTILES - 1)]
    out *= sd[:, None]
    out += mean[:, None]
    return np.clip(out, low, high, out=out)


def _normal_cdf_even(x: np.ndarray) -> np.ndarray:
    """:func:`_normal_cdf` for many values: the table's places are even, so they are computed, not searched."""
    _, cdf = _normal_table()
    place = np.clip((x + 9) * 1000, 0, len(cdf) - 1.000001)
    low = place.astype(np.int32)
    first = cdf[low]
    return first + (place - low) * (cdf[low + 1] - first)


def _parts(x: np.ndarray, top: float, steps: int) -> np.ndarray:
    """In which of ``steps`` equal parts of 0 to ``top`` values lie; the last part is closed."""
    return np.minimum(np.searchsorted(np.linspace(0, top, steps + 1), x, "right") - 1, steps - 1)


#: Values of the distribution function that are held at once.
HELD = 1 << 20


def load_shares(mean: np.ndarray, sd: np.ndarray, pools: Sequence[np.ndarray], top: float, steps: int) -> np.ndarray:
    """Probability of each of ``steps`` equal parts of 0 to ``top`` for a truncated normal draw plus a draw from a pool (an empty one adds
    nothing). mean, sd: a row of parameters for each pool. Returns pools, parameters, parts; one more part is what lies outside."""
    values = np.concatenate([p if len(p) else np.zeros(1) for p in pools])
    sizes = np.array([max(1, len(p)) for p in pools])
    owner, starts = np.repeat(np.arange(len(pools)), sizes), np.concatenate([[0], sizes.cumsum()[:-1]])
    sd = np.maximum(sd, 1e-9)
    edges = np.clip(np.linspace(0, top, steps + 1)[None, :] - values[:, None], 0, top)
    below = _normal_cdf_even((edges[:, None, :] - mean[owner][:, :, None]) / sd[owner][:, :, None])
    below = np.add.reduceat(below, starts, 0) / sizes[:, None, None]
    mass = _normal_cdf_even((top - mean) / sd) - _normal_cdf_even(-mean / sd)
    share = np.maximum(np.diff(below, axis=2) / mass[:, :, None], 0)
    share = np.concatenate([share, np.maximum(1 - share.sum(2, keepdims=True), 0)], 2)
    return share / share.sum(2, keepdims=True)


def load_counts(rng: np.random.Generator, mean: np.ndarray, sd: np.ndarray, pools: Sequence[np.ndarray], top: float, steps: int, samples: int) -> np.ndarray:
    """How many of ``samples`` sums of a truncated normal draw and a draw from a pool fall in each of ``steps`` parts of 0 to ``top``: pools,
    parameters, parts. Such counts are multinomial, so they are drawn as that; where a pool is so large that the sums cost less, these are drawn."""
    out = np.empty((*mean.shape, steps), int)
    cost = np.array([(steps + 1) * max(1, len(p)) for p in pools])
    few = np.flatnonzero(cost <= samples)
    chunk = (cost[few].cumsum() * mean.shape[1]) // HELD
    for c in np.unique(chunk):
        at = few[chunk == c]
        out[at] = rng.multinomial(samples, load_shares(mean[at], sd[at], [pools[i] for i in at], top, steps))[:, :, :-1]
    for i in np.flatnonzero(cost > samples):
        total = truncated_normal(rng, mean[i], sd[i], 0, top, samples)
        if len(pools[i]):
            total += pools[i][rng.integers(0, len(pools[i]), total.shape, np.uint32)]
        place = np.minimum((total / top * steps).astype(int), steps - 1) + np.arange(mean.shape[1])[:, None] * steps
        out[i] = np.bincount(place[(total >= 0) & (total <= top)], minlength=mean.shape[1] * steps).reshape(-1, steps)
    return out


def thermal_prior(load: np.ndarray, hour: np.ndarray, bins: np.ndarray, cold: int, n_bins: int, top: float, steps: int, cfg: LabelConfig, rng: np.random.Generator) -> np.ndarray:
    """Prior of the thermal load (steps, 24, bins) by rejection: of ``draws`` parameter pairs the closest hundredth, at
    least one, to the observed histogram in Kullback-Leibler distance. Hours and bins without rows stay even: no row asks for
    them."""
    centre = np.linspace(0, top, steps, endpoint=False)
    out = np.full((steps, 24, n_bins), 1e-6)
    cells, of = np.unique(hour * n_bins + bins, return_inverse=True)
    inside = (load >= 0) & (load <= top)
    seen = np.bincount(of[inside] * steps + _parts(load[inside], top, steps), minlength=len(cells) * steps).reshape(-1, steps) + 1e-6
    seen /= seen.sum(1, keepdims=True)
    base = [load[(hour == h) & (bins == cold)] for h in range(24)]
    mean, sd = rng.uniform(0, top, (len(cells), cfg.draws)), rng.uniform(0, top / 4, (len(cells), cfg.draws))
    guess = load_counts(rng, mean, sd, [base[c // n_bins] for c in cells], top, steps, cfg.samples) + 1e-6
    guess /= guess.sum(2, keepdims=True)
    distance = (seen * np.log(seen)).sum(1)[:, None] - (seen[:, None] * np.log(guess)).sum(2)
    best = np.argsort(distance, 1, kind="stable")[:, : max(1, cfg.draws // 100)]
    m, s = (np.take_along_axis(x, best, 1).mean(1) for x in (mean, sd))
    s = np.maximum(s, 1e-9)
    density = np.exp(-0.5 * ((centre[:, None] - m) / s) ** 2) / s
    mass = _normal_cdf((top - m) / s) - _normal_cdf(-m / s)
    out[:, cells // n_bins, cells % n_bins] += density / np.maximum(mass, 1e-12) / np.sqrt(2 * np.pi)
    return out / out.sum(0)


def thermal_posterior(prior: np.ndarray, load: np.ndarray, hour: np.ndarray, bins: np.ndarray, cold: int, top: float, steps: int) -> np.ndarray:
    """Posterior (thermal step, load step, 24, bins): the likelihood of a load given a thermal step is the histogram of the
    base load at their difference. Columns sum to 1."""
    place = np.linspace(0, top, steps, endpoint=False)
    shift = np.clip(((place[None, :] - place[:, None]) / 100).astype(int), 0, steps - 1)  # thermal, load
    pool = (bins == cold) & (load >= 0) & (load <= top)
    base = np.bincount(hour[pool] * steps + _parts(load[pool], top, steps), minlength=24 * steps).reshape(24, steps).astype(float)
    joint = np.moveaxis(base[:, shift], 0, 2)[:, :, :, None] * prior[:, None]
    evidence = joint.sum(0, keepdims=True)
    out = np.divide(joint, evidence, out=np.zeros_like(joint), where=evidence > 0)
    out += 1e-6
    return out / out.sum(0)


def base_load(load: np.ndarray, hour: np.ndarray, bins: np.ndarray, cold: int, rng: np.random.Generator) -> np.ndarray:
    """A draw for each row from the coldest-bin loads of its hour; hours without any are interpolated."""
    out = np.full(len(load), np.nan)
    for h in range(24):
        pool, at = load[(hour == h) & (bins == cold)], np.flatnonzero(hour == h)
        if len(pool) and len(at):
            out[at] = rng.choice(pool, len(at))
    known = np.flatnonzero(~np.isnan(out))
    return np.interp(np.arange(len(out)), known, out[known]) if len(known) else np.zeros(len(out))


def _bins_for(t: np.ndarray, n: int) -> np.ndarray:
    edges = np.quantile(t, np.linspace(0, 1, n + 1))
    if len(np.unique(edges)) < len(edges):
        raise ValueError("quantile edges coincide")
    return np.searchsorted(edges[1:-1], t, side="left")


def temperature_bins(t: np.ndarray, hour: np.ndarray, loads: list[np.ndarray], cfg: LabelConfig) -> tuple[np.ndarray, list[int], int]:
    """The largest number of bins for which each phase's coldest-load bin covers every hour, else one bin."""
    for n in range(cfg.max_bins, max(cfg.min_bins, 1) - 1, -1):
        try:
            bins = _bins_for(t, n)
        except ValueError:
            continue
        if np.bincount(bins).max(initial=0) < 24:  # no bin covers the day
            continue
        cold = [int(np.argmin([x[bins == b].mean() if (bins == b).any() else np.inf for b in range(n)])) for x in loads]
        if all(len(np.unique(hour[bins == c])) == 24 for c in cold):
            return bins, cold, n
    return np.zeros(len(t), int), [0] * len(loads), 1


def two_way_anova(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict[str, tuple[float, float, float, float]] | None:
    """Type II analysis of variance of y on two factors with interaction: sum of squares, freedom, F and p of each.

    None where a factor has one level. Each effect is the drop of the residual against the model without it that keeps
    the other factor; residuals come from least squares on indicator columns.
    """
    if len(np.unique(a)) < 2 or len(np.unique(b)) < 2:
        return None

    def indicators(x: np.ndarray) -> np.ndarray:
        levels = np.unique(x)[1:]
        return (x[:, None] == levels[None, :]).astype(float)

    one, ia, ib = np.ones((len(y), 1)), indicators(a), indicators(b)
    both = (ia[:, :, None] * ib[:, None, :]).reshape(len(y), -1)

    def residual(*parts: np.ndarray) -> tuple[float, int]:
        x = np.concatenate(parts, 1)
        beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
        return float(((y - x @ beta) ** 2).sum()), int(rank)

    full, main, only_a, only_b = residual(one, ia, ib, both), residual(one, ia, ib), residual(one, ia), residual(one, ib)
    free = len(y) - full[1]
    scale = full[0] / free if free > 0 else np.nan
    out = {}
    for name, less, more in (("a", only_b, main), ("b", only_a, main), ("interaction", main, full)):
        ss, df = less[0] - more[0], more[1] - less[1]
        f = ss / df / scale if df and scale else np.nan
        out[name] = (ss, df, f, f_survival(f, df, free))
    out["residual"] = (full[0], free, np.nan, np.nan)
    return out


def explained_by(c: np.ndarray, q: np.ndarray) -> tuple[float, int]:
    """q' times the solution of c x = q, and the rank of the positive semidefinite ``c``, by Cholesky factors with pivots."""
    c, q = np.array(c, float), np.array(q, float)
    least = 1e-10 * max(1.0, float(np.diag(c).max(initial=0.0)))
    out, rank = 0.0, 0
    left = list(range(len(q)))
    while left:
        k = max(left, key=lambda i: c[i, i])
        if c[k, k] <= least:
            break
        left.remove(k)
        out += q[k] ** 2 / c[k, k]
        rank += 1
        f = c[:, k] / c[k, k]
        q = q - f * q[k]
        c = c - np.outer(f, c[k])
    return float(out), rank


def anova(df: DataFrame, y: str, a: str, b: str, by: Sequence[str] = ("meter_number",)) -> DataFrame:
    """Type II analysis of variance with interaction for each key, from sufficient statistics.

    The rows give counts, sums and squares by cell of both factors, nothing else; any number of rows for a key is pre-aggregated
    before a shuffle. What the second factor adds to the first solves the normal equations that are left when the first is
    eliminated, one row and column for each level of the second. Rows with a null in y or a factor don't count; keys for
    which a factor has one level have no row.

    Returns sum of squares, freedom, F and p of ``a``, ``b`` and ``interaction`` (null where undefined), ``ss_residual`` and ``df_residual``.
    """
    keys = list(by)
    cells = df.where(F.col(y).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull()).select(*keys, F.col(a).alias("_a"), F.col(b).alias("_b"), F.col(y).cast("double").alias("_y"))
    cells = materialise(cells.groupBy(*keys, "_a", "_b").agg(F.count("*").alias("n"), F.sum("_y").alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("q")), "cells")
    square = (F.col("s") * F.col("s") / F.col("n")).alias("x")
    whole = cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("s").alias("s"), F.count("*").alias("cells"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("full"))
    first = cells.groupBy(*keys, "_a").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    second = cells.groupBy(*keys, "_b").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    sums = [x.select(*keys, square).groupBy(*keys).agg(F.sum("x").alias(f"by_{c}"), F.count("*").alias(f"levels_{c}")) for x, c in ((first, "a"), (second, "b"))]
    with_a = cells.select(*keys, "_a", "_b", F.col("n").alias("m")).join(first, [*keys, "_a"])
    lost = with_a.groupBy(*keys, "_b").agg(F.sum(F.col("m") * F.col("s") / F.col("n")).alias("lost"))
    right = second.join(lost, [*keys, "_b"]).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_b", (F.col("s") - F.col("lost")).alias("v")))).alias("right"))
    other = cells.select(*keys, "_a", F.col("_b").alias("_c"), F.col("n").alias("k"))
    shared = with_a.join(other, [*keys, "_a"]).groupBy(*keys, "_b", "_c").agg(F.sum(F.col("m") * F.col("k") / F.col("n")).alias("w"))
    left = shared.groupBy(*keys).agg(F.collect_list(F.struct("_b", "_c", "w")).alias("left"))
    own = second.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_b", "n"))).alias("own"))

    def solve(own: list, left: list, right: list) -> tuple[float, int]:
        at = {r[0]: i for i, r in enumerate(own)}
        c = np.diag([float(r[1]) for r in own])
        for x, z, w in left:
            c[at[x], at[z]] -= w
        return explained_by(c, np.array([r[1] for r in right]))

    def tail(f: float | None, d1: int, d2: int) -> float | None:
        return None if f is None else f_survival(f, d1, d2)

    solved = F.udf(solve, "added double, rank int")("own", "left", "right").alias("m")
    out = whole.join(sums[0], keys).join(sums[1], keys).join(own, keys).join(left, keys).join(right, keys).where("levels_a > 1 and levels_b > 1")
    out = out.select(*keys, "n", "q", "cells", "full", "by_a", "by_b", "levels_a", "levels_b", solved)
    main, rank = F.col("by_a") + F.col("m.added"), F.col("levels_a") + F.col("m.rank")
    residual, free = F.greatest(F.lit(0.0), F.col("q") - F.col("full")), F.col("n") - F.col("cells")
    scale = F.when((free > 0) & (residual > 0), residual / F.when(free > 0, free))
    parts = {"a": (main - F.col("by_b"), rank - F.col("levels_b")), "b": (F.col("m.added"), F.col("m.rank").cast("long")), "interaction": (F.col("full") - main, F.col("cells") - rank)}
    columns = []
    for name, (ss, df_) in parts.items():
        f = F.when(df_ > 0, ss / F.when(df_ > 0, df_) / scale)
        columns += [ss.alias(f"ss_{name}"), df_.alias(f"df_{name}"), f.alias(f"f_{name}"), F.udf(tail, "double")(f, df_, free).alias(f"p_{name}")]
    return out.select(*keys, *columns, residual.alias("ss_residual"), free.alias("df_residual"))


def f_survival(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution, by the incomplete beta function's continued fraction."""
    from math import exp, lgamma, log

    if not np.isfinite(f) or d1 <= 0 or d2 <= 0:
        return float("nan") if np.isnan(f) else 0.0
    if f <= 0:
        return 1.0

    def fraction(x: float, a: float, b: float) -> float:
        """Lentz's evaluation."""
        tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        out = d
        for m in range(1, 500):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 + num * d, 1 + num / c
                d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
                out *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        return out

    x, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(max(1 - x, 1e-300)))
    return front * fraction(x, a, b) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(1 - x, b, a) / b


def sample_meter(rows: pd.DataFrame, meter: str, cfg: LabelConfig) -> pd.DataFrame:
    """Base and thermal load of every hour and phase of one meter."""
    rows = rows.dropna(subset=["T"]).sort_values("timestamp", ignore_index=True)
    if not len(rows):
        return pd.DataFrame(columns=["meter_number", "timestamp", "phase", "T", "load", "base", "thermal", "dead"])
    hour, t = pd.to_datetime(rows["timestamp"]).dt.hour.to_numpy(), rows["T"].to_numpy(float)
    loads = [rows[p].fillna(0).to_numpy(float) for p in PHASES]
    bins, cold, n = temperature_bins(t, hour, loads, cfg)
    sums = [x.sum() for x in loads]
    parts = []
    for i, p in enumerate(PHASES):
        rng = seeded(cfg.seed, meter, p)
        base = base_load(loads[i], hour, bins, cold[i], rng)
        dead = sums[i] == 0 or all(sums[i] < 0.01 * s for j, s in enumerate(sums) if j != i)
        thermal = np.zeros(len(rows))
        top = float(np.ceil(loads[i].max() / 1000) * 1000)
        if not dead and top > 0:
            steps = max(1, int(top / 100))
            prior = thermal_prior(loads[i], hour, bins, cold[i], n, top, steps, cfg, rng)
            post = thermal_posterior(prior, loads[i], hour, bins, cold[i], top, steps)
            at = np.clip((loads[i] / 100).astype(int), 0, steps - 1)
            cumulative = post[:, at, hour, bins].cumsum(0)
            thermal = 100.0 * (rng.uniform(size=len(rows))[None, :] > cumulative / cumulative[-1]).sum(0)
        parts.append(pd.DataFrame({"meter_number": meter, "timestamp": rows["timestamp"], "phase": p, "T": t, "load": loads[i], "base": base, "thermal": thermal, "dead": dead}))
    return pd.concat(parts, ignore_index=True)


#: Rows that a task samples: a few seconds of work.
TASK_ROWS = 8192

SAMPLED = "meter_number string, timestamp timestamp, phase string, T double, load double, base double, thermal double, dead boolean"


def label_heat_pumps(hourly: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """Heat-pump labels of every meter and phase. hourly: meter_number, timestamp, l1, l2, l3, T (see :func:`with_weather`).

    A group is one meter's hours: 8,760 rows a year. Sampling takes long for few bytes, so rows go to as many tasks as they call for: by
    size they would be put together in a few.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return sample_meter(rows, key[0], cfg)

    rows = hourly.select(F.col("meter_number").cast("string").alias("meter_number"), F.col("timestamp").cast("timestamp").alias("timestamp"), *PHASES, "T")
    rows = materialise(rows, "hours")
    rows = rows.repartition(1 + rows.count() // TASK_ROWS, "meter_number")
    sampled = materialise(rows.groupBy("meter_number").applyInPandas(run, SAMPLED), "sampled")
    live = F.when(~F.col("dead"), F.col("thermal"))
    slopes = temperature_slope(sampled.withColumn("_live", live), load="_live", limit=cfg.filter_temp)
    errors = absolute_error(sampled.withColumn("_p", F.col("base") + F.col("thermal")), "_p", "load", ["meter_number", "phase"])
    cool = sampled.withColumn("_t", F.bround("T", 0)).where(F.col("_t") <= cfg.filter_temp)
    p = anova(cool, "thermal", "_t", "phase").select("meter_number", F.col("p_b").alias("p_phase"))
    out = heat_pump_phases(slopes, cfg).join(errors, ["meter_number", "phase"]).join(p, "meter_number", "left")
    # where phases don't differ, they are all labelled alike, by the number of indicators
    alike = F.coalesce(F.col("p_phase") > cfg.anova_p, F.lit(False))
    return out.withColumn("heat_pump", F.when(alike, F.col("indicators") >= 2).otherwise(F.col("heat_pump")))
