"""Queries that apply the engine's operators to whole tables, each with the SQL that states its result."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import clean, explorer, graph, labeler, levels, mapping, meta, phasemap, quality, records, resample, upsert
from ..operators import topology as topo
from ..schemas import METER_CABINET
from ..sources.scratch import folder, grown, materialise
from ..sources.store import Store
from . import grid as stored_topologies
from .frames import GRID_SQL, PHASE_OF, PHASE_SQL, PHASES_SQL, POWER_SQL, events, meter_places, meter_rows, phase_events, planted_voltages, power, recorded_places, table, topology
from .registry import QUERIES, SQL, query
from .registry import time_text as _time


def _r(c: str, digits: int = 6):
    return F.round(c, digits).alias(c)


def _f(c: str):
    """To single precision and back: drops noise without the ties that decimal rounding has."""
    return F.col(c).cast("float").cast("double").alias(c)


def _long(*columns: str):
    return [F.col(c).cast("long").alias(c) for c in columns]


# --- levels ---------------------------------------------------------------------------------------------------------------


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("meter_number", "event_id", "event_type", *(F.col("value").alias(f"voltage_{p}") if p == "l1" else (F.col("value") + i).alias(f"voltage_{p}") for i, p in enumerate(("l1", "l2", "l3"))))


def _flags(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    flag = F.when(v < 20, 3).when(v > 250, 4).otherwise(0).cast("tinyint")
    return events(spark, d).where("event_type != 'error'").select("event_id", flag.alias("voltage_l1_flag"), flag.alias("voltage_l2_flag"))


def _corrections(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).where("event_type in ('click', 'error')").select("event_id", (F.col("value") * 2).alias("voltage_l1"), F.lit(230.0).alias("voltage_l3"))


def _phase_map(spark: SparkSession, d: str) -> DataFrame:
    """Meters whose first value is under 50 have phases 1 and 2 swapped, those over 100 are turned, others have no row."""
    first = events(spark, d).groupBy("meter_number").agg(F.min_by("value", "event_id").alias("v"))
    to = [F.when(F.col("v") < 50, a).otherwise(b).alias(f"{p}_maps_to") for p, a, b in (("l1", "l2", "l3"), ("l2", "l1", "l1"), ("l3", "l3", "l2"))]
    return first.where("v < 50 or v > 100").select("meter_number", *to)


_LEVEL_SQL = """
raw as (select cast(user_id as varchar) as meter_number, event_id, event_type, value as v1, value + 1 as v2, value + 2 as v3 from events),
flags as (select event_id, case when value < 20 then 3 when value > 250 then 4 else 0 end as f from events where event_type <> 'error'),
corr as (select event_id, value * 2 as c1, cast(230 as double) as c3 from events where event_type in ('click', 'error')),
flagged as (select raw.meter_number, raw.event_id, raw.event_type, case when f = 0 then v1 end as v1, case when f = 0 then v2 end as v2, v3 from raw left join flags using (event_id)),
cleaned as (select flagged.meter_number, event_id, event_type, coalesce(v1, c1) as v1, v2, coalesce(v3, c3) as v3 from flagged left join corr using (event_id)),
pmap as (select * from (select cast(user_id as varchar) as meter_number, arg_min(value, event_id) as v from events group by 1) q where v < 50 or v > 100)
"""


@query("select event_id, cast(user_id as varchar) as meter_number, value from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' and event_type = 'click' and value is not null")
def ts_scan_filtered(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).where((F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("event_type") == "click"))
    return e.na.drop(subset=["value"]).select("event_id", "meter_number", "value")


@query(f"with {_LEVEL_SQL} select event_id, v1 as voltage_l1, v2 as voltage_l2, v3 as voltage_l3 from flagged")
def ts_apply_flags(spark: SparkSession, d: str) -> DataFrame:
    return levels.apply_quality_flags(_raw(spark, d), _flags(spark, d), ["event_id"]).drop("meter_number", "event_type")


@query(f"with {_LEVEL_SQL} select event_id, v1 as voltage_l1, v2 as voltage_l2, v3 as voltage_l3 from cleaned")
def ts_apply_corrections(spark: SparkSession, d: str) -> DataFrame:
    return levels.assemble("cleaned", _raw(spark, d), _flags(spark, d), _corrections(spark, d), keys=["event_id"]).drop("meter_number", "event_type")


@query(f"with {_LEVEL_SQL} select event_id, v1 as voltage_l1, v2 as voltage_l2, v3 as voltage_l3 from cleaned")
def ts_cleaned_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned series from layers that are stored in buckets of the same keys, so that they join without a shuffle."""
    store = Store(spark, folder(spark, "layers"))
    for name, rows in (("raw", _raw(spark, d)), ("flags", _flags(spark, d)), ("corrections", _corrections(spark, d))):
        store.write_bucketed(rows, name, by=["event_id"], buckets=16)
    layers = [store.bucketed(name) for name in ("raw", "flags", "corrections")]
    return levels.assemble("cleaned", *layers, keys=["event_id"]).drop("meter_number", "event_type")


@query(f"""with {_LEVEL_SQL} select event_id, case when v < 50 then v2 when v > 100 then v2 else v1 end as voltage_l1,
  case when v < 50 then v1 when v > 100 then v3 else v2 end as voltage_l2, case when v < 50 then v3 when v > 100 then v1 else v3 end as voltage_l3
  from cleaned left join pmap using (meter_number)""")
def ts_phase_corrected(spark: SparkSession, d: str) -> DataFrame:
    cleaned = levels.assemble("cleaned", _raw(spark, d), _flags(spark, d), _corrections(spark, d), keys=["event_id"])
    return levels.apply_phase_map(cleaned, _phase_map(spark, d)).drop("meter_number", "event_type")


# --- inventory ------------------------------------------------------------------------------------------------------------


_INVENTORY = "select cast(user_id as varchar) as meter_number, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen, count(*) as total_rows from events group by 1"


@query(_INVENTORY)
def meter_inventory(spark: SparkSession, d: str) -> DataFrame:
    return meta.meter_inventory(events(spark, d)).select("meter_number", _time("first_seen"), _time("last_seen"), "total_rows")


@query(_INVENTORY)
def inventory_incremental(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    day = F.lit("2024-01-15").cast("timestamp_ntz")
    parts = [meta.meter_inventory(e.where(c)) for c in (F.col("timestamp") < day, F.col("timestamp") >= day)]
    return upsert.merge_meter_stats(*parts).select("meter_number", _time("first_seen"), _time("last_seen"), "total_rows")


@query("select meter_number, total_rows, max_rows, round(cast(total_rows as double) / max_rows, 6) as relative_length from (select cast(user_id as varchar) as meter_number, count(*) as total_rows, max(count(*)) over () as max_rows from events group by 1) q")
def meter_relative_length(spark: SparkSession, d: str) -> DataFrame:
    out = meta.relative_length(meta.meter_inventory(events(spark, d)))
    return out.select("meter_number", "total_rows", "max_rows", _r("relative_length"))


@query("select strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen, string_agg(distinct cast(user_id as varchar), ',' order by cast(user_id as varchar)) as meter_ids from events")
def series_info(spark: SparkSession, d: str) -> DataFrame:
    return meta.series_info(meta.meter_inventory(events(spark, d))).select(_time("first_seen"), _time("last_seen"), F.array_join("meter_ids", ",").alias("meter_ids"))


@query("""with f as (select distinct strftime(ts, '%Y-%m-%d') as dt, event_type, cast(floor(value / 200) as integer) as shard from events),
known as (select dt, shard, count(*) as top from f where event_type in ('click', 'view') group by all)
select f.dt, f.shard, f.event_type, coalesce(top, 0) + row_number() over (partition by f.dt, f.shard order by f.event_type) as seq
from f left join known using (dt, shard) where event_type not in ('click', 'view')""")
def file_index_seq(spark: SparkSession, d: str) -> DataFrame:
    f = events(spark, d).select(F.date_format("timestamp", "yyyy-MM-dd").alias("dt"), "event_type", F.floor(F.col("value") / 200).cast("int").alias("shard")).distinct()
    known = f.where("event_type in ('click', 'view')")
    known = upsert.next_sequence(known, known.limit(0).withColumn("seq", F.lit(0)), ["dt", "shard"], ["event_type"])
    out = upsert.next_sequence(f.where("event_type not in ('click', 'view')"), known, ["dt", "shard"], ["event_type"])
    return out.select("dt", "shard", "event_type", *_long("seq"))


@query("select cast(user_id as varchar) as meter_number from events group by 1 having count(*) > 0")
def meters_available(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    return meta.available(e.select("meter_number").distinct(), meta.meter_inventory(e))


@query("select cast(c_custkey as varchar) as meter_number from customer where c_custkey not in (select user_id from events)")
def meters_missing(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("meter_number"))
    return meta.available(ids, meta.meter_inventory(events(spark, d)), missing=True)


# --- resampling -------------------------------------------------------------------------------------------------------------


@query("""with m as (select cast(user_id as varchar) as meter_number, time_bucket(interval '15 minutes', ts) as b, avg(value) as v from events group by all),
g as (select unnest(generate_series(time_bucket(interval '15 minutes', (select min(ts) from events)), (select max(ts) from events), interval '15 minutes')) as b),
k as (select distinct meter_number from m)
select k.meter_number, count(*) as bins, count(v) as filled, round(sum(v), 4) as total from k cross join g left join m on m.meter_number = k.meter_number and m.b = g.b group by 1""")
def resample_15min_grid(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    out = resample.on_grid(resample.resample_mean(e, ["value"]), resample.time_grid(resample.time_bounds(e)))
    return out.groupBy("meter_number").agg(F.count("*").alias("bins"), F.count("value").alias("filled"), F.round(F.sum("value"), 4).alias("total"))


def _resampled(unit: str) -> str:
    return f"select cast(user_id as varchar) as meter_number, strftime(date_trunc('{unit}', ts), '%Y-%m-%d %H:%M:%S') as \"timestamp\", round(avg(value), 6) as value from events group by all"


@query(_resampled("hour"))
def resample_hourly(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample_mean(events(spark, d), ["value"], unit="hour").select("meter_number", _time(), _r("value"))


@query(_resampled("week"))
def resample_weekly(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample_mean(events(spark, d), ["value"], unit="week").select("meter_number", _time(), _r("value"))


_TYPES = ("click", "error", "purchase", "signup", "view")


@query("""select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as "timestamp", """ + ", ".join(f"round(avg(value) filter (event_type = '{t}'), 6) as value_{t}" for t in _TYPES) + " from events group by 1")
def wide_pivot(spark: SparkSession, d: str) -> DataFrame:
    long = resample.resample_mean(events(spark, d), ["value"], by=["event_type"], unit="hour")
    return resample.wide_frame(long, _TYPES, ["value"], key="event_type").select(_time(), *(_r(f"value_{t}") for t in _TYPES))


def _hourly_wide(spark: SparkSession, d: str) -> DataFrame:
    long = resample.resample_mean(events(spark, d), ["value"], by=["event_type"], unit="hour")
    w = resample.wide_frame(long, _TYPES, ["value"], key="event_type")
    out = w.select("timestamp", *(F.col(f"value_{t}").alias(f"voltage_{p}") for t, p in PHASE_OF.items()), "value_signup", "value_error")
    return out.withColumns({f"active_power_p14_{p}": F.col("value_signup") for p in PHASE_OF.values()} | {f"active_power_p23_{p}": F.col("value_error") for p in PHASE_OF.values()})


_HOURLY_SQL = "w as (select date_trunc('hour', ts) as t, avg(value) filter (event_type = 'click') as v1, avg(value) filter (event_type = 'view') as v2, avg(value) filter (event_type = 'purchase') as v3, avg(value) filter (event_type = 'signup') - avg(value) filter (event_type = 'error') as p from events group by 1)"


@query(f"""with {_HOURLY_SQL} select strftime(t, '%Y-%m-%d %H:%M:%S') as "timestamp", round(p / nullif(v1, 0), 5) as current_l1, round(p / nullif(v2, 0), 5) as current_l2, round(p / nullif(v3, 0), 5) as current_l3 from w""")
def enrich_current(spark: SparkSession, d: str) -> DataFrame:
    out = resample.add_current(_hourly_wide(spark, d))
    return out.select(_time(), *(_r(f"current_{p}", 5) for p in PHASE_OF.values()))


@query(f"""with {_HOURLY_SQL}, x as (select t, v1, v2, v3, list_avg(list_filter([v1, v2, v3], lambda z: z is not null)) as m, p / nullif(v1, 0) as i1, p / nullif(v2, 0) as i2, p / nullif(v3, 0) as i3 from w),
y as (select *, list_avg(list_filter([i1, i2, i3], lambda z: z is not null)) as n from x)
select strftime(t, '%Y-%m-%d %H:%M:%S') as "timestamp", round(greatest(abs((v1 - m) / nullif(m, 0)), abs((v2 - m) / nullif(m, 0)), abs((v3 - m) / nullif(m, 0))), 5) as v_unbalance,
  round(greatest(abs(i1 - n), abs(i2 - n), abs(i3 - n)), 5) as i_unbalance from y""")
def enrich_unbalance(spark: SparkSession, d: str) -> DataFrame:
    out = resample.add_phase_imbalance(_hourly_wide(spark, d))
    return out.select(_time(), _r("v_unbalance", 5), _r("i_unbalance", 5))


# --- quality ----------------------------------------------------------------------------------------------------------------

_CFG = quality.QualityConfig(voltage_limit=20.0, frozen=2, run=5, no_data=0.1, good=0.3, medium=0.5, offset=0.1)


def _coarse(spark: SparkSession, d: str) -> DataFrame:
    """Phase rows whose voltages are rounded down to tens, so that runs and zeros occur."""
    p = phase_events(spark, d).withColumn("v", F.floor(F.col("v") / 10) * 10.0)
    return p.withColumn("timestamp", F.struct("timestamp", "event_id"))


_STATES_SQL = f"""ph as (select meter_number, phase, "timestamp", event_id, p14, floor(v / 10) * 10 as v from ({PHASE_SQL}) q),
st as (select *, v is null as is_null, coalesce(v = 0, false) as is_zero, coalesce(v < 20, false) as is_low,
  coalesce(v = lag(v) over (partition by meter_number, phase order by "timestamp", event_id), false) as is_frozen from ph),
s as (select *, is_null or is_zero or is_low or is_frozen as is_corrupt, not is_null and not is_zero and not is_frozen as has_data from st),
fr as (select meter_number, phase, count(*) as records, count(*) filter (has_data) as usable, avg(is_null::int) as null_frac, avg(is_zero::int) as zero_frac, avg(is_low::int) as low_frac, avg(is_frozen::int) as frozen_frac,
  avg(is_corrupt::int) as corrupt_frac, avg(has_data::int) as has_frac, avg((is_low and has_data)::int) as offset_frac, avg((p14 is null)::int) as p14_null_frac from s group by all)"""


@query(f"with {_STATES_SQL} select event_id, is_frozen from s")
def frozen_flags(spark: SparkSession, d: str) -> DataFrame:
    return quality.voltage_states(_coarse(spark, d), _CFG).select("event_id", "is_frozen")


@query(f"""with {_STATES_SQL}, c as (select *, sum(case when is_zero is not distinct from prev and rn > 1 then 0 else 1 end) over (partition by meter_number, phase order by "timestamp", event_id) as run from
(select *, lag(is_zero) over w as prev, row_number() over w as rn from s window w as (partition by meter_number, phase order by "timestamp", event_id)) q)
select meter_number, phase, cast(run as bigint) as run, any_value(is_zero) as is_zero, count(*) as length from c group by meter_number, phase, run""")
def run_lengths(spark: SparkSession, d: str) -> DataFrame:
    states = quality.voltage_states(_coarse(spark, d), _CFG)
    return quality.run_lengths(states, "is_zero", ["meter_number", "phase"], ["timestamp"]).select("meter_number", "phase", *_long("run"), "is_zero", "length")


_FRACTIONS = ("null_frac", "zero_frac", "low_frac", "frozen_frac", "corrupt_frac", "has_frac", "offset_frac", "p14_null_frac")


@query(f"with {_STATES_SQL} select meter_number, phase, records, usable, " + ", ".join(f"round({c}, 6) as {c}" for c in _FRACTIONS) + " from fr")
def quality_fractions(spark: SparkSession, d: str) -> DataFrame:
    out = quality.quality_fractions(quality.voltage_states(_coarse(spark, d), _CFG))
    return out.select("meter_number", "phase", "records", "usable", *(_r(c) for c in _FRACTIONS))


def _grade_sql(share: str) -> str:
    return f"case when usable < 0.1 * records then 'NaN' when {share} < 0.3 then 'Good' when {share} < 0.5 then 'Medium' else 'Bad' end"


@query(f"with {_STATES_SQL} select meter_number, phase, {_grade_sql('corrupt_frac')} as v_summary, {_grade_sql('p14_null_frac')} as p14_summary from fr")
def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    out = quality.quality_summary(quality.quality_fractions(quality.voltage_states(_coarse(spark, d), _CFG)), _CFG)
    return out.select("meter_number", "phase", "v_summary", "p14_summary")


_CONNECT_SQL = f"""{_STATES_SQL}, marks as (select *, row_number() over w - row_number() over (partition by meter_number, phase, has_data order by "timestamp", event_id) as g1,
  row_number() over w - row_number() over (partition by meter_number, phase, is_zero order by "timestamp", event_id) as g2 from s window w as (partition by meter_number, phase order by "timestamp", event_id)),
lon as (select meter_number, phase, max(n) as n_on from (select meter_number, phase, g1, count(*) as n from marks where has_data group by all) q group by all),
lof as (select meter_number, phase, max(n) as n_off from (select meter_number, phase, g2, count(*) as n from marks where is_zero group by all) q group by all),
con as (select fr.*, usable > 0.1 * records as connected, coalesce(usable > 0.1 * records and offset_frac / nullif(has_frac, 0) > 0.1, false) as connection_error,
  usable > 0.1 * records and coalesce(n_on, 0) >= 5 and coalesce(n_off, 0) >= 5 as switching from fr left join lon using (meter_number, phase) left join lof using (meter_number, phase))"""


@query(f"with {_CONNECT_SQL} select meter_number, phase, connected, connection_error, switching from con")
def connectivity(spark: SparkSession, d: str) -> DataFrame:
    states = quality.voltage_states(_coarse(spark, d), _CFG)
    out = quality.connectivity(states, quality.quality_fractions(states), _CFG)
    return out.select("meter_number", "phase", "connected", "connection_error", "switching")


_STATS = [f"{v}_{n}" for v in ("v", "p14") for n in ("min", "max", "mean", "std")]


@query(f"select meter_number, phase, " + ", ".join(f"round({f}({v}), 6) as {v}_{n}" for v in ("v", "p14") for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))) + f" from ({PHASE_SQL}) q group by all")
def phase_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.phase_statistics(phase_events(spark, d)).select("meter_number", "phase", *(_r(c) for c in _STATS))


@query(f"""with {_CONNECT_SQL}, g as (select *, {_grade_sql('corrupt_frac')} as v_summary from con),
m as (select meter_number, count(*) as n, count(*) filter (v_summary = 'Good') as good, count(*) filter (v_summary = 'Medium') as medium, count(*) filter (v_summary = 'Bad') as bad, count(*) filter (v_summary = 'NaN') as nan,
  count(*) filter (connected) as c, count(*) filter (connection_error) as e, count(*) filter (switching) as s from g group by 1)
select category, meters from (select count(*) filter (good = n) as all_good, count(*) filter (medium > 0) as any_medium, count(*) filter (bad > 0) as any_bad, count(*) filter (nan > 0) as any_no_data, count(*) filter (c = 1) as one_phase,
  count(*) filter (c = 2) as two_phases, count(*) filter (c = 3) as three_phases, count(*) filter (c = 0) as no_phase, count(*) filter (e > 0) as connection_error, count(*) filter (s > 0) as switching from m) q
unpivot (meters for category in (all_good, any_medium, any_bad, any_no_data, one_phase, two_phases, three_phases, no_phase, connection_error, switching))""")
def classifier_categories(spark: SparkSession, d: str) -> DataFrame:
    states = quality.voltage_states(_coarse(spark, d), _CFG)
    return explorer.classifier_categories(quality.connectivity(states, quality.quality_summary(quality.quality_fractions(states), _CFG), _CFG))


@query(f"""with {_STATES_SQL}, g as (select phase, {_grade_sql('corrupt_frac')} as v from fr)
select phase, count(*) filter (v = 'Good') as "Good", count(*) filter (v = 'Medium') as "Medium", count(*) filter (v = 'Bad') as "Bad", count(*) filter (v = 'NaN') as "NaN" from g group by 1""")
def quality_pivot(spark: SparkSession, d: str) -> DataFrame:
    out = quality.quality_summary(quality.quality_fractions(quality.voltage_states(_coarse(spark, d), _CFG)), _CFG)
    return explorer.quality_pivot(out.withColumnRenamed("v_summary", "summary"))


# --- labeler ----------------------------------------------------------------------------------------------------------------

_WEEKS_SQL = f"""pw as ({POWER_SQL}), wk as (select meter_number, date_trunc('week', "timestamp") as week, avg(l1) as l1, avg(l2) as l2, avg(l3) as l3 from pw group by all),
lg as (select *, lag(l1) over w as b1, lag(l2) over w as b2, lag(l3) over w as b3 from wk window w as (partition by meter_number order by week)),
ch as (select meter_number, week, """ + ", ".join(f"abs(case when b{i} <> 0 then l{i} / b{i} - 1 when b{i} = 0 and l{i} <> 0 then 'infinity'::double end) as c{i}" for i in (1, 2, 3)) + """ from lg),
weeks as (select meter_number, week, list_sum(list_filter([c1, c2, c3], lambda z: z is not null)) / nullif(len(list_filter([c1, c2, c3], lambda z: z is not null)), 0) as change from ch)"""


@query(f"""with {_WEEKS_SQL} select meter_number, strftime(week, '%Y-%m-%d') as week, case when isinf(change) then -1.0 else round(change, 5) end as change from weeks""")
def weekly_change_filter(spark: SparkSession, d: str) -> DataFrame:
    out = labeler.weekly_changes(power(spark, d))
    return out.select("meter_number", F.date_format("week", "yyyy-MM-dd").alias("week"), F.when(F.col("change") == float("inf"), -1.0).otherwise(F.round("change", 5)).alias("change"))


@query(f"""with {_WEEKS_SQL}, r as (select pw.*, coalesce(change, 0) > 0.01 as kept, l1 + l2 + l3 as load, isodow("timestamp") >= 6 as we,
  (month("timestamp") = 1 and day("timestamp") <= 3) or (month("timestamp") = 2 and day("timestamp") between 12 and 16) or (month("timestamp") = 3 and day("timestamp") between 25 and 29) or (month("timestamp") = 4 and day("timestamp") = 26)
  or (month("timestamp") = 10 and day("timestamp") between 16 and 20) or (month("timestamp") = 12 and (day("timestamp") between 18 and 23 or day("timestamp") between 25 and 29)) as hol
  from pw join weeks on pw.meter_number = weeks.meter_number and date_trunc('week', "timestamp") = week),
a as (select meter_number, count(*) filter (not kept) as static_rows, count(*) filter (kept) as kept_rows, sum(load) as total, sum(case when we then load else 0 end) as weekend, sum(case when hol then load else 0 end) as holiday from r group by 1)
select meter_number, static_rows, kept_rows, round(total, 4) as total, round(weekend, 4) as weekend, round(holiday, 4) as holiday,
  case when total - weekend > 0 then static_rows > 0.4 * kept_rows or weekend / (total - weekend) > 0.45 else false end as summerhouse from a""")
def summerhouse(spark: SparkSession, d: str) -> DataFrame:
    out = labeler.label_summerhouse(power(spark, d))
    return out.select("meter_number", "static_rows", "kept_rows", *(_r(c, 4) for c in ("total", "weekend", "holiday")), "summerhouse")


def _weather(spark: SparkSession, d: str) -> DataFrame:
    return resample.resample_mean(events(spark, d), ["value"], by=[], unit="hour").withColumnRenamed("value", "T").withColumn("T", F.col("T") / 10 - 5)


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    return labeler.with_weather(resample.resample_mean(power(spark, d), ["l1", "l2", "l3"], unit="hour"), _weather(spark, d))


_WEATHER_SQL = f"""pw as ({POWER_SQL}), hr as (select meter_number, date_trunc('hour', "timestamp") as t, avg(l1) as l1, avg(l2) as l2, avg(l3) as l3 from pw group by all),
we as (select date_trunc('hour', ts) as t, avg(value) / 10 - 5 as temp from events group by 1),
h as (select hr.*, temp from hr left join we using (t) where not (l1 = 0 and l2 = 0 and l3 = 0))"""


@query(f"""with {_WEATHER_SQL} select meter_number, strftime(t, '%Y-%m-%d %H:%M:%S') as "timestamp", round(l1, 6) as l1, round(l2, 6) as l2, round(l3, 6) as l3, round(temp, 6) as "T" from h""")
def weather_join(spark: SparkSession, d: str) -> DataFrame:
    return _hourly(spark, d).select("meter_number", _time(), *(_r(c) for c in ("l1", "l2", "l3", "T")))


_BINS_SQL = f"""{_WEATHER_SQL}, q as (select meter_number, quantile_cont(temp, 0.25) as e1, quantile_cont(temp, 0.5) as e2, quantile_cont(temp, 0.75) as e3 from h group by 1),
b as (select h.*, cast(temp > e1 as int) + cast(temp > e2 as int) + cast(temp > e3 as int) as bin from h join q using (meter_number))"""


@query(f"with {_BINS_SQL} select meter_number, cast(bin as integer) as bin, count(*) as hours, round(min(temp), 5) as low, round(max(temp), 5) as high from b group by all")
def temperature_bins(spark: SparkSession, d: str) -> DataFrame:
    out = labeler.quantile_bins(_hourly(spark, d), "T", 4, ["meter_number"])
    return out.groupBy("meter_number", "bin").agg(F.count("*").alias("hours"), F.round(F.min("T"), 5).alias("low"), F.round(F.max("T"), 5).alias("high"))


@query(f"""with {_BINS_SQL}, l as (select meter_number, t, bin, 'l1' as phase, l1 as load from b union all select meter_number, t, bin, 'l2', l2 from b union all select meter_number, t, bin, 'l3', l3 from b),
m as (select meter_number, phase, bin, avg(load) as mean, count(distinct hour(t)) as hours from l group by all),
r as (select *, row_number() over (partition by meter_number, phase order by mean, bin) as rn from m)
select meter_number, phase, round(mean, 6) as mean, hours = 24 as all_hours from r where rn = 1""")
def coldest_bin(spark: SparkSession, d: str) -> DataFrame:
    out = labeler.coldest_bins(labeler.quantile_bins(_hourly(spark, d), "T", 4, ["meter_number"]))
    return out.select("meter_number", "phase", _r("mean"), "all_hours")


def _grouped_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hours of eight groups of meters, each long enough for several bins that cover the day."""
    p = power(spark, d).withColumn("meter_number", (F.col("meter_number").cast("long") % 8).cast("string"))
    return labeler.with_weather(resample.resample_mean(p, ["l1", "l2", "l3"], unit="hour"), _weather(spark, d))


_SEARCH_SQL = f"""pw as ({POWER_SQL}), hr as (select cast(cast(meter_number as bigint) % 8 as varchar) as meter_number, date_trunc('hour', "timestamp") as t, avg(l1) as l1, avg(l2) as l2, avg(l3) as l3 from pw group by all),
we as (select date_trunc('hour', ts) as t, avg(value) / 10 - 5 as temp from events group by 1),
h as (select hr.*, hour(t) as hh, temp from hr join we using (t) where not (l1 = 0 and l2 = 0 and l3 = 0)),
""" + ", ".join(f"e{n} as (select meter_number, {n} as n, quantile_cont(temp, [{', '.join(f'{i} / {n}.0' for i in range(n + 1))}]) as e from h group by 1)" for n in range(12, 0, -1)) + """,
e as (""" + " union all ".join(f"select * from e{n}" for n in range(12, 0, -1)) + """),
p as (select h.meter_number, n, hh, l1, l2, l3, len(list_filter(e[2:n], lambda x: x < temp)) as bin from h join e using (meter_number) where len(list_distinct(e)) = n + 1),
l as (select meter_number, n, hh, bin, unnest(['l1', 'l2', 'l3']) as phase, unnest([l1, l2, l3]) as load from p),
m as (select meter_number, n, phase, bin, avg(load) as mean, count(distinct hh) as hours from l group by all),
c as (select * from m qualify row_number() over (partition by meter_number, n, phase order by mean, bin) = 1),
w as (select meter_number, max(n) as n from (select meter_number, n from c group by all having min(hours) = 24) q group by 1)
select meter_number, c.phase, cast(coalesce(w.n, 1) as integer) as n_bins, cast(coalesce(c.bin, 0) as integer) as bin
from (select distinct meter_number, unnest(['l1', 'l2', 'l3']) as phase from h) k left join w using (meter_number) left join c using (meter_number, n, phase)"""


@query("with " + _SEARCH_SQL.replace("c.phase", "k.phase"))
def temperature_bin_search(spark: SparkSession, d: str) -> DataFrame:
    return labeler.search_bins(_grouped_hourly(spark, d)).select("meter_number", "phase", "n_bins", "bin")


@query(f"""with r as (select meter_number, isodow("timestamp") as a, phase as b, p14 as y from ({PHASE_SQL}) q),
cells as (select meter_number as k, a, b, count(*) as n, sum(y) as s, sum(y * y) as q from r group by all),
fa as (select k, a, sum(n) as n, sum(s) as s from cells group by all), fb as (select k, b, sum(n) as n, sum(s) as s from cells group by all),
tot as (select k, sum(n) as n, sum(q) as q, count(*) as cells, sum(s * s / n) as full_ from cells group by k),
xa as (select k, sum(s * s / n) as xa, count(*) as la from fa group by k), xb as (select k, sum(s * s / n) as xb, count(*) as lb from fb group by k),
lost as (select c.k, c.b, sum(c.n * fa.s / fa.n) as lost from cells c join fa using (k, a) group by all),
rhs as (select k, b, s - lost as v from fb join lost using (k, b)),
wt as (select c.k, c.b, d.b as c, sum(c.n * d.n / fa.n) as w from cells c join cells d using (k, a) join fa using (k, a) group by all),
co as (select fb.k, max(case when b = 'l1' then n end) - max(case when b = 'l1' then w11 end) as c11, max(case when b = 'l2' then n end) - max(case when b = 'l2' then w22 end) as c22, -max(w12) as c12 from fb
  join (select k, max(w) filter (b = 'l1' and c = 'l1') as w11, max(w) filter (b = 'l2' and c = 'l2') as w22, coalesce(max(w) filter (b = 'l1' and c = 'l2'), 0) as w12 from wt group by k) z using (k) group by fb.k),
qs as (select k, max(v) filter (b = 'l1') as q1, max(v) filter (b = 'l2') as q2 from rhs group by k),
m as (select k, (q1 * q1 * c22 - 2 * q1 * q2 * c12 + q2 * q2 * c11) / (c11 * c22 - c12 * c12) as added from co join qs using (k)),
o as (select tot.k, q - full_ as rss, n - cells as free, xa + added - xb as ss_a, la - 1 as df_a, added as ss_b, 2 as df_b, full_ - xa - added as ss_i, cells - la - 2 as df_i from tot join xa using (k) join xb using (k) join m using (k) where la > 1 and lb = 3)
select k as meter_number, cast(cast(ss_a as real) as double) as ss_a, cast(df_a as bigint) as df_a, round(ss_a / df_a / (rss / free), 5) as f_a, cast(cast(ss_b as real) as double) as ss_b, cast(df_b as bigint) as df_b, round(ss_b / df_b / (rss / free), 5) as f_b,
  cast(cast(ss_i as real) as double) as ss_interaction, cast(df_i as bigint) as df_interaction, round(ss_i / df_i / (rss / free), 5) as f_interaction, cast(cast(rss as real) as double) as ss_residual, cast(free as bigint) as df_residual from o""")
def anova_type2(spark: SparkSession, d: str) -> DataFrame:
    """Variance of the loads of each meter by weekday and phase."""
    rows = phase_events(spark, d).withColumn("weekday", F.weekday("timestamp"))
    out = labeler.anova(rows, "p14", "weekday", "phase")
    parts = ("a", "b", "interaction")
    return out.select("meter_number", *(_f(f"ss_{x}") for x in (*parts, "residual")), *_long(*(f"df_{x}" for x in (*parts, "residual"))), *(_r(f"f_{x}", 5) for x in parts))


def _phase_loads(spark: SparkSession, d: str) -> DataFrame:
    h = _hourly(spark, d)
    rows = F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.col(p).alias("load")) for p in ("l1", "l2", "l3"))))
    return h.select("meter_number", "timestamp", "T", rows.alias("_p")).select("meter_number", "timestamp", "T", "_p.*")


_SLOPE_SQL = f"""{_WEATHER_SQL}, l as (select meter_number, t, temp, 'l1' as phase, l1 as load from h union all select meter_number, t, temp, 'l2', l2 from h union all select meter_number, t, temp, 'l3', l3 from h),
x as (select *, round_even(temp, 0) as rt from l),
sl as (select meter_number, phase, min(rt) as low, avg(load) filter (rt <= 3) as m, regr_slope(case when rt <= 3 then load end, case when rt <= 3 then rt end) as s, regr_intercept(case when rt <= 3 then load end, case when rt <= 3 then rt end) as i from x group by all),
slopes as (select meter_number, phase, case when m is null or s is null or isnan(s) then 0 else s end as slope, case when m is null then 0 when s is null or isnan(s) then m else i + s * low end as intercept from sl)"""


@query(f"with {_SLOPE_SQL} select meter_number, phase, cast(cast(slope as real) as double) as slope, cast(cast(intercept as real) as double) as intercept from slopes")
def temperature_slope(spark: SparkSession, d: str) -> DataFrame:
    return labeler.temperature_slope(_phase_loads(spark, d)).select("meter_number", "phase", _f("slope"), _f("intercept"))


@query(f"""with {_SLOPE_SQL}, b as (select *, -0.027 * intercept as th from slopes), c as (select *, count(*) filter (slope < th) over (partition by meter_number) as n from b),
e as (select meter_number, phase, slope, case when n = 2 and slope > th then th * 0.75 else th end as th from c)
select meter_number, phase, cast(cast(th as real) as double) as threshold, slope < th as heat_pump from e""")
def heat_pump_phases(spark: SparkSession, d: str) -> DataFrame:
    out = labeler.heat_pump_phases(labeler.temperature_slope(_phase_loads(spark, d)))
    return out.select("meter_number", "phase", _f("threshold"), "heat_pump")


@query("select cast(user_id as varchar) as meter_number, round(avg(abs(value - 50)), 6) as mae, round(avg(abs(value - 50)) / avg(value), 6) as mae_relative from events group by 1")
def mae_relative(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("guess", F.lit(50.0))
    return labeler.absolute_error(e, "guess", "value", ["meter_number"]).select("meter_number", _r("mae"), _r("mae_relative"))


@query(f"""select meter_number, l1 = 0 or (l1 < 0.01 * l2 and l1 < 0.01 * l3) as l1_dead, l2 = 0 or (l2 < 0.01 * l1 and l2 < 0.01 * l3) as l2_dead, l3 = 0 or (l3 < 0.01 * l1 and l3 < 0.01 * l2) as l3_dead
from (select meter_number, sum(l1) as l1, sum(l2) as l2, sum(l3) as l3 from ({POWER_SQL}) q group by 1) s""")
def dead_phases(spark: SparkSession, d: str) -> DataFrame:
    return labeler.dead_phases(power(spark, d))


# --- phase mapper -----------------------------------------------------------------------------------------------------------

_DAILY_SQL = "dd as (select event_type as phase, date_trunc('hour', ts) as t, avg(value) as v from events group by all), un as (select count(distinct phase) as k from dd)"


def _unit(spark: SparkSession, d: str) -> DataFrame:
    """Hourly means of the event types as the phases of one unit."""
    return resample.resample_mean(events(spark, d), ["value"], by=["event_type"], unit="hour").select(F.lit("all").alias("unit"), F.col("event_type").alias("phase"), "timestamp", F.col("value").alias("v"))


@query(f"""with {_DAILY_SQL}, j as (select *, abs(v - lag(v) over (partition by phase order by t)) > 60 as jump from dd),
r as (select t, bool_or(v < 12) as bad, bool_or(coalesce(jump, false)) as jmp from j group by 1),
w as (select *, row_number() over (order by t) as i, count(*) over () as n from r),
s as (select t, i, i <= n - 2 and (max(bad::int) over (order by i rows between current row and 2 following) = 1 or max(jmp::int) over (order by i rows between 1 following and 2 following) = 1) as st from w)
select strftime(t, '%Y-%m-%d %H:%M:%S') as "timestamp", max(coalesce(st, false)::int) over (order by i rows between 2 preceding and current row) = 1 as masked from s""")
def corruption_mask(spark: SparkSession, d: str) -> DataFrame:
    return phasemap.corruption_mask(_unit(spark, d), window=3, low=12.0, step=60.0).select(_time(), "masked")


@query(f"""with {_DAILY_SQL}, x as (select phase, t, v - lag(v) over (partition by phase order by t) as df from dd), y as (select * from x where df is not null)
select phase, strftime(t, '%Y-%m-%d %H:%M:%S') as "timestamp", round((df - avg(df) over (partition by phase)) / stddev_pop(df) over (partition by phase), 5) as z from y""")
def diff_zscore(spark: SparkSession, d: str) -> DataFrame:
    return phasemap.difference_scaled(_unit(spark, d), ["unit", "phase"]).select("phase", _time(), _r("z", 5))


@query(f"""with {_DAILY_SQL}, c as (select *, count(*) over (partition by t) as n from dd), f as (select phase, t, v from c, un where n = k),
r as (select phase, t, rank() over (partition by phase order by v) + (count(*) over (partition by phase, v) - 1) / 2.0 as r from f)
select a.phase as a, b.phase as b, round(1 - corr(a.r, b.r), 6) + 0.0 as distance from r a join r b using (t) where a.phase <= b.phase group by all""")
def spearman_distance(spark: SparkSession, d: str) -> DataFrame:
    return phasemap.spearman(_unit(spark, d), "phase", "timestamp", "v").select("a", "b", (F.round("distance", 6) + F.lit(0.0)).alias("distance"))


@query("""with c as (select cast(user_id as varchar) as meter_number, event_type, count(*) as n, min(event_id) as f from events group by all), r as (select *, sum(n) over (partition by meter_number) as k, row_number() over (partition by meter_number order by n desc, f) as rn from c)
select meter_number, case when n >= 0.25 * k then event_type end as event_type from r where rn = 1""")
def majority_phase(spark: SparkSession, d: str) -> DataFrame:
    return phasemap.majority(events(spark, d), "event_type", 0.25, ["meter_number"], "event_id")


@query(PHASES_SQL)
def phase_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Phase identification over all meters with the mapper's own limits, but for the rows asked for: the tables hold 30 days of hours."""
    off = meter_places(spark, d).where("kind = 'unconnected'").select(F.col("meter").alias("meter_number"), F.lit("L2").alias("phase"))
    return phasemap.identify_phases(planted_voltages(spark, d), recorded_places(spark, d), off, phasemap.PhaseConfig(rows=500))


@query(f"""select cast(meter_id as bigint) as meter_id, upper(sm_phase) as sm_phase, try_cast(true_feeder_id as bigint) as feeder_id, nullif(upper(feeder_phase), 'NAN') as feeder_phase, try_cast(true_transformer_id as bigint) as transformer_id,
  nullif(upper(transformer_phase), 'NAN') as transformer_phase, try_cast(likely_cabinet_id as bigint) as likely_cabinet_id from ({PHASES_SQL}) q
union all select -1, 'L1', 7, 'L1', null, null, null""")
def mapped_phases(spark: SparkSession, d: str) -> DataFrame:
    """The mapper's rows in the table of phase mappings, after rows of an earlier run of all meters and of one that is gone."""
    held = materialise(phase_clusters(spark, d), "mapped")
    none = {c: F.lit(None).cast(k) for c, k in (("transformer_id", "long"), ("transformer_phase", "string"), ("likely_cabinet_id", "long"))}
    old = held.select(F.col("meter_id").cast("long").alias("meter_id"), F.lit("L1").alias("sm_phase")).distinct().unionByName(spark.range(1).select((F.col("id") - 1).alias("meter_id"), F.lit("L1").alias("sm_phase")))
    old = old.select("meter_id", "sm_phase", F.lit(7).cast("long").alias("feeder_id"), F.lit("L1").alias("feeder_phase")).withColumns(none)
    return meta.store_phase_results(old, held)


@query(f"""with {_STATES_SQL} select meter_number, phase, {_grade_sql('corrupt_frac')} as v_summary, case when phase = 'l1' and c_acctbal < 0 then 'Bad' else {_grade_sql('p14_null_frac')} end as p14_summary, c_name as name
from fr join customer on cast(c_custkey as varchar) = meter_number""")
def classifier_records(spark: SparkSession, d: str) -> DataFrame:
    """Grades of the classifier in nested records of meters, written again, one path of some changed, and read back as rows."""
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("meter_number"), F.col("c_name"), F.col("c_acctbal"))
    meters = c.select("meter_number", F.to_variant_object(F.struct(F.col("c_name").alias("name"))).alias("record"))
    grades = records.nest(quality_summary(spark, d), "meter_number", "phase", ["v_summary", "p14_summary"])
    for _ in range(2):
        meters = records.write_records(meters, grades, "meter_number", ["classifier", "summary"])
    l1 = ["classifier", "summary", "l1"]
    poor = meters.where(records.get_path(F.col("record"), l1).isNotNull()).join(c.where("c_acctbal < 0"), "meter_number", "left_semi")
    poor = poor.select("meter_number", F.parse_json(F.lit('"Bad"')).alias("value"))
    meters = materialise(records.write_records(meters, poor, "meter_number", [*l1, "p14_summary"]), "records")
    out = records.read_records(meters, "meter_number", ["classifier", "summary"], "phase", {"v_summary": "string", "p14_summary": "string"})
    return out.join(meters.select("meter_number", records.get_path(F.col("record"), ["name"], "string").alias("name")), "meter_number")


@query()
def thermal_labels(spark: SparkSession, d: str) -> DataFrame:
    """Heat-pump labels of all meters by seeded sampling. Not expressible in SQL."""
    return labeler.label_heat_pumps(_hourly(spark, d), labeler.LabelConfig())


# --- topology ---------------------------------------------------------------------------------------------------------------


@query(f"with {GRID_SQL} select code, node_type, asset_id from nodes")
def nodes_extracted(spark: SparkSession, d: str) -> DataFrame:
    t, m = topology(spark, d), meter_rows(spark, d)
    return topo.existing_nodes(topo.node_codes(t, m), topo.assets(t, m)).select("code", "node_type", "asset_id")


@query(f"with {GRID_SQL} select n1_code, n2_code, cable_ids from grouped")
def edges_grouped(spark: SparkSession, d: str) -> DataFrame:
    return topo.grouped_edges(topology(spark, d), meter_rows(spark, d))


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    t, m = topology(spark, d), meter_rows(spark, d)
    return topo.existing_nodes(topo.node_codes(t, m), topo.assets(t, m)).withColumn("id", F.xxhash64("code"))


@query(f"with {GRID_SQL} select n1_code, n2_code, cable_ids from edges")
def edges_resolved(spark: SparkSession, d: str) -> DataFrame:
    return topo.resolved_edges(topo.grouped_edges(topology(spark, d), meter_rows(spark, d)), _nodes(spark, d)).select("n1_code", "n2_code", "cable_ids")


@query(f"""with {GRID_SQL}, k as (select split_part(n1_code, '.', 1) as a, split_part(n2_code, '.', 1) as b, cable_ids from grouped)
select count(*) as edges, count(cable_ids) as with_cable, count(*) filter (cable_ids is null) as without_cable, count(*) filter ('DeliveryPoint' in (a, b)) as to_delivery_point,
  count(*) filter ('DeliveryPoint' in (a, b) and 'LvFeeder' in (a, b)) as feeder_point, count(*) filter ('DeliveryPoint' in (a, b) and 'Cabinet' in (a, b)) as cabinet_point,
  count(*) filter (a = 'Cabinet' and b = 'Cabinet') as cabinet_cabinet, count(*) filter ('Cabinet' in (a, b) and 'LvFeeder' in (a, b)) as cabinet_feeder from k""")
def edge_kinds(spark: SparkSession, d: str) -> DataFrame:
    return topo.edge_kinds(topo.grouped_edges(topology(spark, d), meter_rows(spark, d)))


@query(f"""with {GRID_SQL}, k as (select n1_code in (select code from nodes) as x, n2_code in (select code from nodes) as y from grouped)
select count(*) as edges, count(*) filter (x and y) as resolvable, count(*) filter (not (x and y)) as dropped, count(*) filter (not x and y) as missing_1, count(*) filter (x and not y) as missing_2, count(*) filter (not x and not y) as missing_both from k""")
def edge_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return topo.edge_resolution(topo.grouped_edges(topology(spark, d), meter_rows(spark, d)), _nodes(spark, d))


@query(f"with {GRID_SQL} select code, count(*) as edges from (select n1_code as code from grouped union all select n2_code from grouped) q where code not in (select code from nodes) group by 1")
def edge_missing_ends(spark: SparkSession, d: str) -> DataFrame:
    return topo.missing_ends(topo.grouped_edges(topology(spark, d), meter_rows(spark, d)), _nodes(spark, d))


@query("""with l as (select 'LvFeeder.' || l_suppkey as node1, 'Cabinet.' || l_partkey as node2, 'LvCable.' || l_orderkey as c from lineitem),
g as (select least(node1, node2) as n1_code, greatest(node1, node2) as n2_code, list(c order by c) as cs from l group by all),
u as (select n1_code, n2_code, unnest(cs) as code, generate_subscripts(cs, 1) as seq_no from g)
select n1_code, n2_code, code, cast(seq_no as integer) as seq_no, cast(split_part(code, '.', 2) as bigint) as cable_id from u""")
def edge_cables(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    text = lambda prefix, c: F.concat(F.lit(prefix + "."), F.col(c).cast("string"))
    rows = li.select(text("LvFeeder", "l_suppkey").alias("node1"), text("Cabinet", "l_partkey").alias("node2"), text("LvCable", "l_orderkey").alias("cable_id"))
    no_meters = spark.createDataFrame([], METER_CABINET)  # their edges have no cables
    edges = topo.grouped_edges(rows, no_meters).withColumn("id", F.struct("n1_code", "n2_code"))
    return topo.edge_cables(edges).select("edge_id.n1_code", "edge_id.n2_code", "code", "cable_id", F.col("seq_no").cast("int").alias("seq_no"))


@query("""select c_custkey as id, case when c_mktsegment = 'BUILDING' then 'new' else c_name end as name, case when c_mktsegment = 'BUILDING' then 0 else c_acctbal end as balance from customer
union all select s_suppkey + 10000000, s_name, s_acctbal from supplier""")
def asset_upsert(spark: SparkSession, d: str) -> DataFrame:
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    old = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.lit("new").alias("name"), F.lit(0.0).alias("balance"))
    new = new.unionByName(s.select((F.col("s_suppkey") + 10000000).alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")))
    return upsert.merge(old, new, ["id"])


@query("""select c_custkey as id, c_name as name from customer where c_acctbal >= 0
union all select c_custkey, 'added' from customer where c_acctbal < 0""")
def asset_insert_missing(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    old = c.where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return upsert.insert_missing(old, c.select(F.col("c_custkey").alias("id"), F.lit("added").alias("name")), ["id"])


@query("select c_custkey as id, c_nationkey as nation from customer where c_nationkey not in (select s_nationkey from supplier where s_acctbal < 0)")
def phase_mapping_delete(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    gone = table(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("nation"))
    return upsert.delete(c, gone, ["nation"]).select("id", "nation")


@query("select cast(r_regionkey + 1 as integer) as version, case when r_regionkey < 3 then 'raw' else 'cleaned' end as processing_level, r_regionkey + 1 = (select max(r_regionkey) + 1 from region where r_regionkey < 3) as is_current from region order by version desc")
def topology_versions(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "region").select((F.col("r_regionkey") + 1).cast("int").alias("version"), F.when(F.col("r_regionkey") < 3, "raw").otherwise("cleaned").alias("processing_level"), F.lit(False).alias("is_current"))
    return explorer.versions_newest_first(upsert.make_current(v, upsert.latest_version(v, "raw")))


_STORES: dict[tuple[str, str], Store] = {}


def _stored(spark: SparkSession, d: str) -> Store:
    """A store in the shared folder with the tables' grid. It is written once for a session, by the first query that asks for it."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORES or not _STORES[key].exists("_commits"):
        _STORES[key] = Store(spark, folder(spark, "grid"))
        stored_topologies.ingest_topology(_STORES[key], topology(spark, d), meter_rows(spark, d))
    return _STORES[key]


def _grid(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    return stored_topologies.grid_at(_stored(spark, d))


#: Every meter of every feeder: component labels of the symmetric edges, by recursion over the forest.
_REACH_SQL = f"""{GRID_SQL}, walk as (select code as seed, code as node from nodes where node_type = 'LvFeeder' union select walk.seed, sym.dst from walk join sym on sym.src = walk.node),
fm as (select cast(split_part(seed, '.', 2) as bigint) as feeder_id, cast(split_part(node, '.', 2) as bigint) as meter_id, node from walk where node like 'DeliveryPoint.%')"""
_REACH_SQL = "recursive " + _REACH_SQL.lstrip()


@query(f"with {_REACH_SQL} select feeder_id, meter_id from fm")
def meters_by_feeder(spark: SparkSession, d: str) -> DataFrame:
    return stored_topologies.feeder_meters(_stored(spark, d)).select("feeder_id", "meter_id")


def _under(where: str) -> str:
    return f"with {_REACH_SQL} select distinct meter_id as id from fm join nation on n_nationkey = feeder_id where {where}"


@query(_under("n_nationkey = 3"))
def meters_for_feeder(spark: SparkSession, d: str) -> DataFrame:
    return stored_topologies.meters_for(_stored(spark, d), "feeder", 3).select("id")


@query(_under("n_nationkey = 7"))
def meters_for_transformer(spark: SparkSession, d: str) -> DataFrame:
    return stored_topologies.meters_for(_stored(spark, d), "transformer", 7).select("id")


@query(_under("n_regionkey = 2"))
def meters_for_substation(spark: SparkSession, d: str) -> DataFrame:
    return stored_topologies.meters_for(_stored(spark, d), "secondary_substation", 2).select("id")


@query("select c_custkey as id from customer where c_nationkey = 4 and c_acctbal >= 0")
def meters_for_cabinet(spark: SparkSession, d: str) -> DataFrame:
    return stored_topologies.meters_for(_stored(spark, d), "cabinet", 4).select("id")


@query("select c_custkey as id from customer where c_custkey = 17")
def meters_for_delivery_point(spark: SparkSession, d: str) -> DataFrame:
    return stored_topologies.meters_for(_stored(spark, d), "delivery_point", 17).select("id")


_REACHED = "select {} as version, feeder_id, count(*) as meters from (with " + _REACH_SQL + " select distinct feeder_id, meter_id from fm) q group by feeder_id"


@query(f"""select cast(version as integer) as version, feeder_id, meters from ({_REACHED.format(1)} union all
  {_REACHED.format(2).replace("from supplier join nation on s_nationkey = n_nationkey", "from supplier join nation on s_nationkey = n_nationkey where s_acctbal < 0").replace("code in (select lv_feeder from topo)", "code in (select 'LvFeeder.' || s_nationkey from supplier)")}) v""")
def meters_by_version(spark: SparkSession, d: str) -> DataFrame:
    """Meters that each feeder reaches in two versions of the grid, both read from one store after the second was added. Feeders of
    the first stay known, so the second has nodes for those of its meters."""
    store = Store(spark, folder(spark, "versions"))
    rows, meters = topology(spark, d), meter_rows(spark, d)
    for part in (rows, rows.where("cable_length < 0")):
        stored_topologies.ingest_topology(store, part, meters)
    parts = [stored_topologies.feeder_meters(store, v).groupBy("feeder_id").agg(F.count("*").alias("meters")).withColumn("version", F.lit(v)) for v in (1, 2)]
    return parts[0].unionByName(parts[1]).select("version", "feeder_id", "meters")


@query("select c_custkey as id from customer where c_mktsegment = 'BUILDING'")
def attribute_filter(spark: SparkSession, d: str) -> DataFrame:
    m = topo.assets(topology(spark, d), meter_rows(spark, d))["meter"]
    return meta.attribute_filter(m, has_heat_pump=True, has_solar_panel=False).select("id")


_CHAIN_SQL = f"""recursive {GRID_SQL.strip()}, w as (select code as seed, code as node, [code] as path, cast(null as varchar) as cab, 0 as depth from nodes where node_type = 'DeliveryPoint'
union all select w.seed, sym.dst, list_append(w.path, sym.dst), coalesce(w.cab, case when sym.dst like 'Cabinet.%' then sym.dst end), w.depth + 1 from w join sym on sym.src = w.node where not list_contains(w.path, sym.dst)),
chain as (select distinct cast(split_part(seed, '.', 2) as bigint) as meter_id, cast(split_part(node, '.', 2) as bigint) as feeder_id, cast(split_part(cab, '.', 2) as bigint) as cabinet_id, depth from w where node like 'LvFeeder.%')"""


@query(f"with {_CHAIN_SQL} select meter_id, cast(n_regionkey as bigint) as secondary_substation_id, feeder_id as transformer_id, feeder_id, cabinet_id, cast(depth as integer) as depth from chain join nation on n_nationkey = feeder_id")
def topology_chain(spark: SparkSession, d: str) -> DataFrame:
    assets, g = _grid(spark, d)
    return graph.topology_chain(assets["meter"].select(F.col("id").alias("meter_id")), g, assets).drop("delivery_point_id")


@query(f"""with {_CHAIN_SQL}, f as (select *, row_number() over (partition by meter_id order by depth, feeder_id, cabinet_id nulls first) as rn from chain)
select c_custkey as meter_id, feeder_id as transformer_id, feeder_id, cabinet_id, cast(n_regionkey as bigint) as secondary_substation_id, cast(n_regionkey + 2000 as varchar) as zip_code, c_custkey in (select user_id from events) as has_data
from customer left join f on f.meter_id = c_custkey and rn = 1 left join nation on n_nationkey = feeder_id""")
def topology_map(spark: SparkSession, d: str) -> DataFrame:
    assets, g = _grid(spark, d)
    ids = assets["meter"].select(F.col("id").alias("meter_id"))
    have = events(spark, d).select(F.col("meter_number").cast("bigint").alias("meter_id")).distinct()
    return graph.topology_map(ids, graph.nearest_chains(ids, g, assets), assets["secondary_substation"], have)


@query("""with e as (select distinct l_partkey as p, l_suppkey as s from lineitem), s1 as (select s_suppkey as s, s_nationkey as f from supplier where s_acctbal < 0),
p2 as (select * from (select p, f, s as cab, row_number() over (partition by p order by f, s) as rn from e join s1 using (s)) q where rn = 1),
s3 as (select s, min(f) as f from e join p2 using (p) where s not in (select s from s1) group by 1),
p4 as (select * from (select p, f, s as cab, row_number() over (partition by p order by f, s) as rn from e join s3 using (s) where p not in (select p from p2)) q where rn = 1),
s5 as (select s, min(f) as f from e join p4 using (p) where s not in (select s from s1 union all select s from s3) group by 1),
p6 as (select * from (select p, f, s as cab, row_number() over (partition by p order by f, s) as rn from e join s5 using (s) where p not in (select p from p2 union all select p from p4)) q where rn = 1)
select p as meter_id, f as feeder_id, cab as cabinet_id, 2 as depth from p2 union all select p, f, cab, 4 from p4 union all select p, f, cab, 6 from p6""")
def nearest_feeders_meshed(spark: SparkSession, d: str) -> DataFrame:
    """First chains on a meshed graph: parts are delivery points, suppliers cabinets, line items lines between them; suppliers in
    debt stand at the feeder of their nation."""
    part, s, n = (table(spark, d, t) for t in ("part", "supplier", "nation"))
    no = F.lit(None).cast("long")
    point, cabinet, feeder = F.col("p_partkey").cast("long"), F.col("s_suppkey").cast("long"), F.col("n_nationkey").cast("long")

    def node(rows: DataFrame, kind: str, code: int, f, c, p) -> DataFrame:
        key = next(x for x in (f, c, p) if x is not no)
        return rows.select((key * 4 + code).alias("id"), F.lit(kind).alias("node_type"), f.alias("feeder_id"), c.alias("cabinet_id"), p.alias("delivery_point_id"))

    nodes = node(part, "DeliveryPoint", 0, no, no, point).unionByName(node(s, "Cabinet", 1, no, cabinet, no)).unionByName(node(n, "LvFeeder", 2, feeder, no, no))
    lines = table(spark, d, "lineitem").select((F.col("l_partkey").cast("long") * 4).alias("node1_id"), (F.col("l_suppkey").cast("long") * 4 + 1).alias("node2_id"))
    edges = lines.unionByName(s.where("s_acctbal < 0").select((cabinet * 4 + 1).alias("node1_id"), (F.col("s_nationkey").cast("long") * 4 + 2).alias("node2_id")))
    assets = {
        "meter": part.select(point.alias("id"), point.alias("delivery_point_id")), "feeder": n.select(feeder.alias("id"), feeder.alias("transformer_id")),
        "transformer": n.select(feeder.alias("id"), F.col("n_regionkey").alias("substation_id")),
    }
    out = graph.nearest_chains(part.select(point.alias("meter_id")), {"node": nodes, "edge": edges}, assets)
    return out.select("meter_id", "feeder_id", "cabinet_id", "depth")


_EXPORT_SQL = f"""{_REACH_SQL}, nf as (select distinct node, seed as feeder from walk)
, ex as (select e.n1_code, e.n2_code, unnest(case when cable_ids is null then [null] else string_split(cable_ids, '||') end) as cable_id, a.feeder as f1, b.feeder as f2 from edges e left join nf a on a.node = e.n1_code left join nf b on b.node = e.n2_code)"""


@query(f"""with {_EXPORT_SQL}, l as (select coalesce(f1, f2) as lv_feeder, n1_code, n2_code, cable_id from ex)
select lv_feeder, 'Transformer.' || n_nationkey as transformer, 'SecondarySubstation.' || n_regionkey as secondary_substation, least(n1_code, n2_code) as a, greatest(n1_code, n2_code) as b, cable_id
from l left join nation on 'LvFeeder.' || n_nationkey = lv_feeder""")
def export_topology(spark: SparkSession, d: str) -> DataFrame:
    """All exported rows. The export names a delivery point's node by its number, which ingestion gives; here by its point."""
    assets, g = _grid(spark, d)
    rows = graph.export_topology(g, assets)
    points = g["node"].where("node_type = 'DeliveryPoint'").select(F.concat(F.lit("DeliveryPoint."), F.col("id").cast("string")).alias("node"), F.concat(F.lit("DeliveryPoint."), F.col("delivery_point_id").cast("string")).alias("point"))
    for end in ("node1", "node2"):
        rows = rows.join(grown(points.select(F.col("node").alias(end), F.col("point").alias(f"{end}_point"))), end, "left").withColumn(end, F.coalesce(f"{end}_point", end))
    return rows.select("lv_feeder", "transformer", "secondary_substation", F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b"), "cable_id")


@query()
def export_topology_edges(spark: SparkSession, d: str) -> DataFrame:
    """All exported rows, those at delivery points too. Delivery points' codes have node numbers, which SQL can't give: no SQL."""
    assets, g = _grid(spark, d)
    return graph.export_topology(g, assets).select("lv_feeder", "transformer", "secondary_substation", F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b"), "cable_id")


@query(f"with {_REACH_SQL} select c_custkey as meter_number, 'Cabinet.' || c_nationkey as cabinet, 'LvFeeder.' || feeder_id as lv_feeder, c_mktsegment = 'BUILDING' as has_heat_pump from customer left join fm on meter_id = c_custkey where c_acctbal >= 0")
def export_sm_cabinet(spark: SparkSession, d: str) -> DataFrame:
    assets, g = _grid(spark, d)
    return graph.export_meter_cabinet(g, assets, stored_topologies.feeder_meters(_stored(spark, d))).select("meter_number", "cabinet", "lv_feeder", "has_heat_pump")


@query(f"""with {GRID_SQL} select count(distinct n_regionkey) as substations, count(distinct n_nationkey) as transformers, count(distinct n_nationkey) as feeders, (select count(*) from nodes where node_type = 'Cabinet') as cabinets,
  (select count(*) from nodes where node_type = 'DeliveryPoint') as delivery_points, (select count(*) from nodes) as nodes, (select count(*) from edges) as edges, (select count(*) from topo) as cables from topo""")
def topology_inventory(spark: SparkSession, d: str) -> DataFrame:
    return explorer.topology_inventory(*_grid(spark, d))


# --- cleaning ---------------------------------------------------------------------------------------------------------------


def _lines(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    text = lambda prefix, c: F.concat(F.lit(prefix + "."), F.col(c).cast("string"))
    return li.select(
        F.when(F.col("l_tax") < 0.08, F.concat(F.lit("SecondarySubstation."), "l_linenumber")).alias("secondary_substation"), text("LvFeeder", "l_suppkey").alias("node1"), text("Cabinet", "l_partkey").alias("node2"),
        F.format_string("LvCable.%010d.%d", "l_orderkey", "l_linenumber").alias("cable_id"), F.when(F.col("l_returnflag") != "N", F.when(F.col("l_returnflag") == "A", "AL").otherwise("CU")).alias("phase_material"),
        F.when(F.col("l_linestatus") == "O", "PEX").otherwise("bad").alias("cable_type"), F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).alias("cable_capacity"), F.when(F.col("l_discount") < 0.05, F.col("l_extendedprice")).alias("cable_length"),
    )


_LINES_SQL = """li as (select case when l_tax < 0.08 then l_linenumber end as sub, 'LvFeeder.' || l_suppkey as node1, 'Cabinet.' || l_partkey as node2, printf('LvCable.%010d.%d', l_orderkey, l_linenumber) as cable_id,
  case l_returnflag when 'A' then 'AL' when 'N' then null else 'CU' end as phase_material, case when l_linestatus = 'O' then 'PEX' end as cable_type,
  case when l_discount > 0.02 then l_quantity end as cable_capacity, case when l_discount < 0.05 then l_extendedprice end as cable_length from lineitem),
gm as (select sub, round_even(avg(cable_capacity), 0) as mc, round_even(avg(cable_length), 0) as ml from li where sub is not null group by 1),
am as (select round_even(avg(cable_capacity), 0) as ac, round_even(avg(cable_length), 0) as al from li),
num as (select li.* replace (coalesce(cable_capacity, mc, ac) as cable_capacity, coalesce(cable_length, ml, al) as cable_length) from li left join gm using (sub) cross join am)"""


@query(f"with {_LINES_SQL} select cable_id, node1, node2, cable_capacity, cable_length from num")
def clean_numeric(spark: SparkSession, d: str) -> DataFrame:
    return clean.fill_numbers(_lines(spark, d), ["cable_capacity", "cable_length"], "secondary_substation").select("cable_id", "node1", "node2", "cable_capacity", "cable_length")


_CATEGORY_SQL = f"""{_LINES_SQL}, mm as (select sub, phase_material as m from (select sub, phase_material, row_number() over (partition by sub order by count(*) desc, phase_material) as rn from li where phase_material is not null and sub is not null group by sub, phase_material) q where rn = 1),
c1 as (select num.* replace (coalesce(phase_material, m) as phase_material) from num left join mm using (sub)),
ov as (select phase_material as o from c1 where phase_material is not null group by 1 order by count(*) desc, 1 limit 1),
cat as (select c1.* replace (coalesce(phase_material, (select o from ov)) as phase_material, 'PEX' as cable_type) from c1)"""


@query(f"with {_CATEGORY_SQL} select cable_id, node1, node2, phase_material, cable_type from cat")
def clean_categorical(spark: SparkSession, d: str) -> DataFrame:
    return clean.fill_categories(_lines(spark, d), clean.CATEGORIES, "secondary_substation").select("cable_id", "node1", "node2", "phase_material", "cable_type")


@query(f"""with {_CATEGORY_SQL}, r as (select *, row_number() over (partition by split_part(node1, '.', 2), split_part(node2, '.', 2) order by cable_capacity desc, cable_id) as rn from cat)
select node1, node2, cable_id, cable_capacity, cable_length, phase_material, cable_type from r where rn = 1""")
def clean_topology(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_topology(_lines(spark, d)).select("node1", "node2", "cable_id", "cable_capacity", "cable_length", "phase_material", "cable_type")


@query("select c_custkey as meter_number, c_acctbal as balance from customer where c_acctbal >= 0")
def clean_sm_cabinet(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("meter_number"), F.col("c_acctbal").alias("balance"))
    return clean.clean_meter_cabinet(c)


# --- mappings and extraction ------------------------------------------------------------------------------------------------


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    return meta.meter_inventory(events(spark, d))


@query("""select cast(c_nationkey as varchar) as cabinet, string_agg(cast(c_custkey as varchar), ',' order by cast(c_custkey as varchar)) as meters,
  coalesce(string_agg(cast(c_custkey as varchar), ',' order by cast(c_custkey as varchar)) filter (c_custkey in (select user_id from events)), '') as available,
  coalesce(string_agg(cast(c_custkey as varchar), ',' order by cast(c_custkey as varchar)) filter (c_custkey not in (select user_id from events)), '') as missing from customer where c_acctbal >= 0 group by 1""")
def cabinet_mapping(spark: SparkSession, d: str) -> DataFrame:
    out = mapping.cabinet_mapping(meter_rows(spark, d), _inventory(spark, d))
    return out.select("cabinet", *(F.array_join(c, ",").alias(c) for c in ("meters", "available", "missing")))


_PLACES_SQL = f"""{GRID_SQL}, pl as (select distinct zip_code, cast(n_regionkey as varchar) as secondary_substation, cast(n_nationkey as varchar) as transformer, cast(s_suppkey as varchar) as cabinet from topo),
lo as (select pl.*, cast(meter_number as varchar) as meter_number from pl left join mrows on mrows.cabinet = 'Cabinet.' || pl.cabinet)"""


@query(f"with {_PLACES_SQL} select zip_code, coalesce(string_agg(distinct meter_number, ',' order by meter_number), '') as meters from lo group by 1")
def hierarchy_lists(spark: SparkSession, d: str) -> DataFrame:
    out = mapping.lists_by_level(mapping.hierarchy(topology(spark, d), meter_rows(spark, d)), "zip")
    return out.select("zip_code", F.array_join("meters", ",").alias("meters"))


@query(f"with {_PLACES_SQL} select meter_number, zip_code, secondary_substation, transformer, cabinet from lo where meter_number is not null")
def reverse_mapping(spark: SparkSession, d: str) -> DataFrame:
    return mapping.reverse_mapping(mapping.hierarchy(topology(spark, d), meter_rows(spark, d))).drop("lv_feeder")


@query(f"""with {_PLACES_SQL}, me as (select distinct meter_number from lo where zip_code = '2001' and meter_number in (select cast(user_id as varchar) from events)),
m as (select cast(user_id as varchar) as meter_number, time_bucket(interval '15 minutes', ts) as b, avg(value) as v from events group by all),
g as (select unnest(generate_series(time_bucket(interval '15 minutes', (select min(ts) from events)), (select max(ts) from events), interval '15 minutes')) as b)
select me.meter_number, count(*) as bins, count(v) as filled, round(coalesce(sum(v), 0), 4) as total from me cross join g left join m on m.meter_number = me.meter_number and m.b = g.b group by 1
having count(v) > 0""")
def extract_entity(spark: SparkSession, d: str) -> DataFrame:
    long = mapping.hierarchy(topology(spark, d), meter_rows(spark, d))
    ids = mapping.entity_meters(long, _inventory(spark, d), "zip", "2001")
    out = mapping.extract(events(spark, d), ids, ["value"], _inventory(spark, d))
    return out.groupBy("meter_number").agg(F.count("*").alias("bins"), F.count("value").alias("filled"), F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 4).alias("total"))


@query("""select cast(user_id as varchar) as meter_number, round(sum(v), 4) as total from (select user_id, time_bucket(interval '15 minutes', ts) as b, avg(value) as v from events group by all) q
join customer on c_custkey = user_id where c_mktsegment = 'BUILDING' group by 1""")
def extract_attribute(spark: SparkSession, d: str) -> DataFrame:
    out = mapping.extract_attribute(events(spark, d), meter_rows(spark, d), _inventory(spark, d), ["value"], has_heat_pump=True)
    return out.groupBy("meter_number").agg(F.round(F.sum("value"), 4).alias("total"))


@query("select distinct cast(n_nationkey as varchar) as transformer from supplier join nation on s_nationkey = n_nationkey")
def transformer_list(spark: SparkSession, d: str) -> DataFrame:
    return mapping.transformer_ids(topology(spark, d))


@query(f"""with {_CONNECT_SQL.replace("usable > 0.1 * records", "usable > 0.6 * records")}, m as (select distinct meter_number from con), p as (select meter_number, phase from m cross join (values ('l1'), ('l2'), ('l3')) t(phase))
select p.meter_number, 'voltage_' || p.phase || '_' || p.meter_number || '_nan_' || c_nationkey as label from p left join con using (meter_number, phase) join customer on cast(c_custkey as varchar) = p.meter_number where not coalesce(connected, false)""")
def unconnected_phases(spark: SparkSession, d: str) -> DataFrame:
    """Phases with usable rows in six tenths of their rows at most."""
    states = quality.voltage_states(_coarse(spark, d), _CFG)
    con = quality.connectivity(states, quality.quality_fractions(states), replace(_CFG, no_data=0.6))
    lists = con.groupBy("meter_number").agg(F.collect_list(F.when(F.col("connected"), F.upper("phase"))).alias("connected_phases"))
    place = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("meter_number"), F.lit(None).cast("string").alias("cabinet_id"), F.col("c_nationkey").alias("feeder_id"))
    return mapping.unconnected_phases(lists.join(place, "meter_number"))


# --- results and explorer ---------------------------------------------------------------------------------------------------


def _results(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("meter_number"), F.col("o_orderpriority").alias("dag"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))


@query("select o_orderkey as id, o_custkey as meter_number from orders where o_orderpriority = '1-URGENT' and o_orderstatus in ('F', 'O') order by o_totalprice desc, o_orderkey limit 50 offset 10")
def run_results_query(spark: SparkSession, d: str) -> DataFrame:
    """A page of results: 50 rows after the first 10."""
    out = meta.query_results(_results(spark, d), {"dag": "1-URGENT", "status": ["F", "O"], "run_id": None}, order_by="price", descending=True, offset=10, limit=50)
    return out.select("id", "meter_number")


@query("select o_orderkey as id, o_custkey as meter_number, o_orderpriority as dag from (select *, row_number() over (partition by o_custkey, o_orderpriority order by o_orderdate desc, o_orderkey desc) as rn from orders) q where rn = 1")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return meta.latest_run(_results(spark, d), ["meter_number", "dag"]).select("id", "meter_number", "dag")


@query("select event_type as workflow, count(*) as n from events where event_type <> 'error' group by 1")
def labels_not_yet(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumnRenamed("event_type", "workflow")
    return meta.not_yet(e, e.where("workflow = 'error'"), "workflow").groupBy("workflow").agg(F.count("*").alias("n"))


def _meters(spark: SparkSession, d: str) -> DataFrame:
    """The meter table: customers with their events' statistics; quality results where the balance is positive."""
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("meter_number"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("data_quality"))
    return c.join(_inventory(spark, d), "meter_number", "left").withColumn("total_rows", F.coalesce("total_rows", F.lit(0)))


@query("""select (select count(*) from customer) as total_meters, (select count(*) from customer where c_custkey in (select user_id from events)) as meters_with_rows, (select count(*) from customer where c_acctbal > 0) as meters_with_data_quality,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen from events""")
def inventory_overview(spark: SparkSession, d: str) -> DataFrame:
    out = explorer.inventory_overview(_meters(spark, d))
    return out.select("total_meters", "meters_with_rows", "meters_with_data_quality", _time("first_seen"), _time("last_seen"))


@query("select cast(c_custkey as varchar) as meter_number, coalesce(n, 0) as total_rows from customer left join (select user_id, count(*) as n from events group by 1) q on user_id = c_custkey order by 2 desc, 1 limit 2000")
def inventory_preview(spark: SparkSession, d: str) -> DataFrame:
    return explorer.inventory_preview(_meters(spark, d)).select("meter_number", "total_rows")


@query("select strftime(ts, '%Y-%m-%d') as dt, cast(floor(value / 200) as integer) as shard, count(*) as files from events group by all")
def parquet_inventory(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("raw/dt="), F.date_format("timestamp", "yyyy-MM-dd"), F.lit("/shard="), F.floor(F.col("value") / 200).cast("string"), F.lit("/part.parquet"))
    return explorer.file_inventory(events(spark, d).select(path.alias("path")))


@query("select strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as latest from orders where o_orderstatus = 'F'")
def latest_ready(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "ready").otherwise("staged").alias("status"), F.col("o_orderdate").alias("committed_at"))
    return explorer.latest_ready(files).select(_time("latest"))


@query("select 'LvFeeder' as source_type, 'Cabinet' as target_type, count(*) as connections from supplier join nation on s_nationkey = n_nationkey")
def connection_types(spark: SparkSession, d: str) -> DataFrame:
    return explorer.connection_types(topology(spark, d))


@query(f"""with {GRID_SQL} select 'SecondarySubstation' as component_type, count(distinct secondary_substation) as count from topo union all select 'Transformer', count(distinct transformer) from topo
union all select 'LvFeeder', count(distinct lv_feeder) + count(*) from topo union all select 'Cabinet', count(*) from topo""")
def component_counts(spark: SparkSession, d: str) -> DataFrame:
    return explorer.component_counts(topology(spark, d))


@query(f"""with {GRID_SQL}, c as (select 'Transformer' as component_type, count(distinct transformer) as n, (select count(*) from nation) as total from topo union all select 'Cabinet', count(*), (select count(*) from part) from topo)
select component_type, least(n, total) as connected, greatest(total - n, 0) as unconnected from c""")
def connected_balance(spark: SparkSession, d: str) -> DataFrame:
    totals = table(spark, d, "nation").agg(F.count("*").alias("total")).select(F.lit("Transformer").alias("component_type"), "total")
    totals = totals.unionByName(table(spark, d, "part").agg(F.count("*").alias("total")).select(F.lit("Cabinet").alias("component_type"), "total"))
    return explorer.connected_balance(explorer.component_counts(topology(spark, d)), totals)


@query("select 'LvFeeder.' || c_nationkey as node, count(*) as meters, count(*) filter (c_custkey in (select user_id from events)) as with_series, count(*) filter (c_acctbal > 0) as with_quality from customer group by 1")
def meter_overlay(spark: SparkSession, d: str) -> DataFrame:
    return explorer.meter_overlay(meter_rows(spark, d), _meters(spark, d), "lv_feeder")


@query(f"with {GRID_SQL} select node1, node2, cable_id from topo where transformer = 'Transformer.5'")
def scope_filter(spark: SparkSession, d: str) -> DataFrame:
    return explorer.scope_filter(topology(spark, d), "transformer", "Transformer.5").select("node1", "node2", "cable_id")


@query("select 'Cabinet.' || c_nationkey as node, count(*) as meters from customer where c_acctbal >= 0 and c_nationkey in (select s_suppkey from supplier join nation on s_nationkey = n_nationkey where n_regionkey = 1) group by 1")
def overlay_scope(spark: SparkSession, d: str) -> DataFrame:
    overlay = explorer.meter_overlay(meter_rows(spark, d), _meters(spark, d), "cabinet")
    return explorer.overlay_in_scope(overlay, explorer.scope_filter(topology(spark, d), "substation", "SecondarySubstation.1")).select("node", "meters")


@query(f"with {GRID_SQL} select distinct node1, node2 from topo order by 1, 2 limit 80")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return explorer.graph_edges(topology(spark, d))


def _labels(spark: SparkSession, d: str) -> DataFrame:
    top = events(spark, d).groupBy("meter_number").agg(*(F.max(F.when(F.col("event_type") == t, F.col("value"))).alias(p) for t, p in PHASE_OF.items()))
    return top.select("meter_number", *(F.coalesce(F.col(p) > 150, F.lit(False)).alias(p) for p in PHASE_OF.values()))


_LABEL_SQL = "lb as (select user_id, " + ", ".join(f"coalesce(max(value) filter (event_type = '{t}') > 150, false) as {p}" for t, p in PHASE_OF.items()) + " from events group by 1)"


@query(f"with {_LABEL_SQL} select coalesce(nullif(concat_ws(',', case when l1 then 'L1' end, case when l2 then 'L2' end, case when l3 then 'L3' end), ''), 'none') as phases, count(*) as meters from lb group by 1")
def phase_combos(spark: SparkSession, d: str) -> DataFrame:
    return explorer.phase_combinations(_labels(spark, d))


@query(f"with {_LABEL_SQL} select x.p as phase_x, y.p as phase_y, count(*) filter ((case x.p when 'l1' then l1 when 'l2' then l2 else l3 end) and (case y.p when 'l1' then l1 when 'l2' then l2 else l3 end)) as meters, round(count(*) filter ((case x.p when 'l1' then l1 when 'l2' then l2 else l3 end) and (case y.p when 'l1' then l1 when 'l2' then l2 else l3 end)) / count(*), 6) as share from lb cross join (values ('l1'), ('l2'), ('l3')) x(p) cross join (values ('l1'), ('l2'), ('l3')) y(p) group by all")
def codetection(spark: SparkSession, d: str) -> DataFrame:
    return explorer.codetection(_labels(spark, d)).select("phase_x", "phase_y", "meters", _r("share"))


@query(f"with {_SLOPE_SQL} select phase, count(*) as meters, cast(cast(avg(slope) as real) as double) as slope, cast(cast(avg(-0.027 * intercept - slope) as real) as double) as margin from slopes group by 1")
def slope_margin(spark: SparkSession, d: str) -> DataFrame:
    slopes = labeler.temperature_slope(_phase_loads(spark, d))
    margins = explorer.slope_margins(slopes.select("meter_number", "phase", "slope"), slopes.select("meter_number", "phase", (F.col("intercept") * -0.027).alias("threshold")))
    return explorer.margin_by_phase(margins).select("phase", "meters", _f("slope"), _f("margin"))


@query(f"with {_SLOPE_SQL} select meter_number, " + ", ".join(f"cast(cast(max(slope) filter (phase = '{p}') as real) as double) as {p}" for p in ("l1", "l2", "l3")) + " from slopes group by 1")
def slope_pivot(spark: SparkSession, d: str) -> DataFrame:
    return explorer.slope_pivot(labeler.temperature_slope(_phase_loads(spark, d))).select("meter_number", *(_f(p) for p in ("l1", "l2", "l3")))


@query("select event_id, cast(regexp_extract(props, '-?[0-9]+') as double) as number, split_part(event_type || '_x', '_', 1) as feature from events")
def scalar_parsing(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", scalar.first_number(F.col("props")).alias("number"), scalar.feature_name(F.concat("event_type", F.lit("_x"))).alias("feature"))


from . import stored  # noqa: E402, F401  registers the queries over files and states
