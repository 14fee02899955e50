"""Engine-shaped frames made from generic tables, for queries and tests.

``events`` plays the series (a user is a meter, event types are phases and quantities), nations and suppliers the grid,
customers the meters, orders the results, line items the cables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise

#: Event types in the roles of phases.
PHASE_OF = {"click": "l1", "view": "l2", "purchase": "l3"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").cast("string").alias("meter_number"), F.col("ts").alias("timestamp"), "event_type", "value", "props")


def phase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each event of a phase: meter_number, phase, timestamp, event_id, v (null above 300)."""
    phase = F.create_map(*(F.lit(x) for pair in PHASE_OF.items() for x in pair))[F.col("event_type")]
    e = events(spark, sf_dir).withColumn("phase", phase).where("phase is not null")
    return e.select("meter_number", "phase", "timestamp", "event_id", F.when(F.col("value") <= 300, F.col("value")).alias("v"), F.col("value").alias("p14"))


PHASE_SQL = """
select cast(user_id as varchar) as meter_number, ts as "timestamp", event_id, value as p14, case when value <= 300 then value end as v,
       case event_type when 'click' then 'l1' when 'view' then 'l2' else 'l3' end as phase
from events where event_type in ('click', 'view', 'purchase')
"""


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as power rows: the phase's column has the value, the others 0."""
    e = events(spark, sf_dir)
    return e.select("meter_number", "timestamp", "event_id", *(F.when(F.col("event_type") == t, F.col("value")).otherwise(0.0).alias(p) for t, p in PHASE_OF.items()))


POWER_SQL = """
select cast(user_id as varchar) as meter_number, ts as "timestamp", event_id, case when event_type = 'click' then value else 0 end as l1,
       case when event_type = 'view' then value else 0 end as l2, case when event_type = 'purchase' then value else 0 end as l3
from events
"""


def topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat topology rows: a nation is a transformer with one feeder, a supplier a cabinet on it."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    text = lambda prefix, c: F.concat(F.lit(prefix + "."), F.col(c).cast("string"))
    return rows.select(
        text("SecondarySubstation", "n_regionkey").alias("secondary_substation"), (F.col("n_regionkey") + 2000).cast("string").alias("zip_code_secondary_substation"),
        text("Transformer", "n_nationkey").alias("transformer"), (F.col("n_nationkey") * 10).cast("long").alias("transformer_capacity"),
        text("LvFeeder", "n_nationkey").alias("lv_feeder"), (F.col("n_nationkey") + 63).cast("long").alias("lv_feeder_fuse_size"),
        text("LvFeeder", "n_nationkey").alias("node1"), text("Cabinet", "s_suppkey").alias("node2"), text("LvCable", "s_suppkey").alias("cable_id"),
        F.lit("PEX").alias("cable_type"), F.col("s_acctbal").alias("cable_length"), F.lit(50).cast("long").alias("phase_size"), F.lit("AL").alias("phase_material"),
        F.floor("s_acctbal").cast("long").alias("cable_capacity"), F.lit(0.5).alias("resistance"), F.lit(0.1).alias("reactance"),
    )


def meter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat meter rows: a customer is a meter at a delivery point of its own, on the cabinet numbered as its nation; without
    a cabinet, on the nation's feeder, where the balance is negative."""
    c = table(spark, sf_dir, "customer")
    n = F.col("c_nationkey").cast("string")
    return c.select(
        F.col("c_custkey").alias("meter_number"), F.col("c_custkey").alias("delivery_point_id"), F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("Cabinet."), n)).alias("cabinet"),
        F.concat(F.lit("LvFeeder."), n).alias("lv_feeder"), (F.col("c_mktsegment") == "BUILDING").alias("has_heat_pump"), (F.col("c_mktsegment") == "MACHINERY").alias("has_solar_panel"),
        F.col("c_acctbal").alias("capacity_solar_panel"), F.lit(25).cast("long").alias("service_fuse_size"),
    )


GRID_SQL = """
topo as (
  select 'SecondarySubstation.' || n_regionkey as secondary_substation, cast(n_regionkey + 2000 as varchar) as zip_code, 'Transformer.' || n_nationkey as transformer,
         'LvFeeder.' || n_nationkey as lv_feeder, 'LvFeeder.' || n_nationkey as node1, 'Cabinet.' || s_suppkey as node2, 'LvCable.' || s_suppkey as cable_id,
         s_acctbal, n_regionkey, n_nationkey, s_suppkey
  from supplier join nation on s_nationkey = n_nationkey
), mrows as (
  select c_custkey as meter_number, c_custkey as delivery_point_id, case when c_acctbal >= 0 then 'Cabinet.' || c_nationkey end as cabinet, 'LvFeeder.' || c_nationkey as lv_feeder,
         c_mktsegment = 'BUILDING' as has_heat_pump, c_mktsegment = 'MACHINERY' as has_solar_panel, c_acctbal, c_nationkey
  from customer
), alledges as (
  select node1 as a, node2 as b, cable_id from topo where node1 <> node2
  union all select lv_feeder, 'DeliveryPoint.' || delivery_point_id, null from mrows where cabinet is null
  union all select cabinet, 'DeliveryPoint.' || delivery_point_id, null from mrows where cabinet is not null
), grouped as (
  select least(a, b) as n1_code, greatest(a, b) as n2_code, string_agg(cable_id, '||' order by cable_id) as cable_ids from alledges group by 1, 2
), codes as (
  select distinct code from (select node1 as code from topo union all select node2 from topo union all select 'DeliveryPoint.' || delivery_point_id from mrows
                             union all select cabinet from mrows where cabinet is not null union all select lv_feeder from mrows) q
), nodes as (
  select code, split_part(code, '.', 1) as node_type, cast(split_part(code, '.', 2) as bigint) as asset_id from codes
  where (split_part(code, '.', 1) = 'LvFeeder' and code in (select lv_feeder from topo))
     or (split_part(code, '.', 1) = 'Cabinet' and code in (select cabinet from mrows where cabinet is not null))
     or split_part(code, '.', 1) = 'DeliveryPoint'
), edges as (
  select g.* from grouped g join nodes x on g.n1_code = x.code join nodes y on g.n2_code = y.code
), sym as (select n1_code as src, n2_code as dst from edges union select n2_code, n1_code from edges)
"""


# --- voltages with planted connections --------------------------------------------------------------------------------------

#: What is planted at a meter: one of these at most, by its number; the first that holds counts.
PLANTED = {"foreign": "m % 60 = 15", "twisted": "m % 13 = 4", "wrong_feeder": "m % 17 = 6 and unit % 5 <> 2", "missing": "m % 19 = 7", "unconnected": "m % 23 = 9"}
_KIND = "case " + " ".join(f"when {rule} then '{kind}'" for kind, rule in PLANTED.items()) + " else 'sound' end"

#: Meters with where they really are (unit, feeder, cabinet) and what is planted. A user of ``events`` is a meter; a unit has three feeders, a feeder
#: twenty meters, a cabinet five. Feeder 1 of every fifth unit is connected to the transformer with its phases turned by one.
PLACES_SQL = f"""
select *, {_KIND} as kind from (
  select m, cast(m as varchar) as meter, m // 60 as unit, (m // 20) % 3 as feeder, ((m // 20) % 3) * 1000 + (m % 20) // 5 as cabinet from (select distinct user_id as m from events) e
) q
"""


def meter_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "events").select(F.col("user_id").alias("m")).distinct()
    rows = m.select("m", F.col("m").cast("string").alias("meter"), F.expr("m div 60").alias("unit"), F.expr("m div 20 % 3").alias("feeder"), F.expr("(m div 20 % 3) * 1000 + m % 20 div 5").alias("cabinet"))
    return rows.withColumn("kind", F.expr(_KIND))


def recorded_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the records say that meters are: wrong for feeders of some."""
    feeder = F.when(F.col("kind") == "wrong_feeder", (F.col("feeder") + 1) % 3).otherwise(F.col("feeder"))
    rows = meter_places(spark, sf_dir).withColumn("at", feeder)
    return rows.select(F.col("unit").alias("transformer_id"), F.col("meter").alias("meter_number"), F.col("at").alias("feeder_id"), (F.col("at") * 1000 + F.col("cabinet") % 1000).alias("cabinet_id"))


#: Meters whose voltages one task makes: 720 rows each.
METERS_OF_A_TASK = 256


def planted_voltages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly voltages of all meters over the hours of ``events``: 230 volts, a term of the transformer phase, one of the feeder phase,
    one of the cabinet, and noise. Terms are hashes of what they belong to and of the hour's events; those of a transformer's
    phases add up to nothing, as loads of one phase pull the others up. Twice the first meter of a unit falls to 100 volts.
    """
    hours = events(spark, sf_dir).groupBy(F.date_trunc("hour", "timestamp").alias("hour")).agg(F.sum("event_id").alias("seed"))
    ends = hours.agg(F.min("hour").alias("a"), F.max("hour").alias("z")).select(F.explode(F.sequence("a", "z", F.expr("interval 1 hour"))).alias("timestamp"))
    hours = ends.join(hours, F.col("timestamp") == F.col("hour"), "left").select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.coalesce("seed", F.lit(0)).alias("seed"))
    hours = hours.withColumn("nth", F.row_number().over(Window.orderBy("timestamp")))  # a calendar: one row an hour

    def term(*of) -> Column:
        return F.pmod(F.xxhash64("timestamp", "seed", *of), F.lit(100_001)) / 50_000 - 1

    meters = meter_places(spark, sf_dir)
    turned = (F.col("unit") % 5 == 2) & (F.col("feeder") == 1)
    for p in range(3):  # the feeder phase and the transformer phase that each of a meter's phases is connected to
        meters = meters.withColumn(f"f{p}", F.when(F.col("kind") == "twisted", (1, 0, 2)[p]).otherwise(p))
        meters = meters.withColumn(f"t{p}", F.when(turned, (F.col(f"f{p}") + 1) % 3).otherwise(F.col(f"f{p}")))
    meters = materialise(meters, "places")
    meters = meters.repartition(1 + meters.count() // METERS_OF_A_TASK, "meter")  # by size, few tasks would make all rows; who groups them by meter needn't shuffle
    rows = meters.crossJoin(F.broadcast(hours))
    rows = rows.withColumn("mean", (term(F.lit("t"), "unit", F.lit(0)) + term(F.lit("t"), "unit", F.lit(1)) + term(F.lit("t"), "unit", F.lit(2))) / 3)
    foreign, fallen = F.col("kind") == "foreign", (F.col("m") % 60 == 0) & F.col("nth").isin(100, 300)
    known = (F.lit(True), F.col("kind") != "unconnected", (F.col("kind") != "missing") | (F.col("nth") % 20 == 0))

    def voltage(p: int) -> Column:
        own = 2 * (term(F.lit("t"), "unit", f"t{p}") - F.col("mean")) + 0.8 * term(F.lit("f"), "unit", "feeder", f"f{p}") + 0.4 * term(F.lit("c"), "unit", "cabinet", f"f{p}")
        v = 230 + F.when(foreign, 2 * term(F.lit("o"), "m")).otherwise(own) + 0.1 * term(F.lit("m"), "m", F.lit(p))
        return F.when(known[p], F.when(fallen, 100.0).otherwise(v)).alias(f"voltage_l{p + 1}")

    return rows.select(F.col("meter").alias("meter_number"), "timestamp", *map(voltage, range(3)))


#: The mapper's result that the planted connections call for.
PHASES_SQL = f"""
with p as ({PLACES_SQL}),
r as (select *, cast(case when kind = 'wrong_feeder' then (feeder + 1) % 3 else feeder end as bigint) as seen, unnest([1, 2, 3]) as ph from p),
s as (select *, case when kind = 'foreign' then 'foreign' when kind = 'unconnected' and ph = 2 then 'unconnected' when kind = 'missing' and ph = 3 then 'missing' else 'known' end as state,
  case when kind = 'twisted' and ph < 3 then 3 - ph else ph end as fp from r),
t as (select *, case when unit % 5 = 2 and feeder = 1 then fp % 3 + 1 else fp end as tp from s)
select cast(unit as varchar) as transformer_id, cast(seen as varchar) as feeder_id, cast(cast(seen * 1000 + cabinet % 1000 as bigint) as varchar) as cabinet_id, meter as meter_id, 'l' || ph as sm_phase,
  case when state = 'known' then 'l' || fp else 'nan' end as feeder_phase, case when state = 'known' then 'l' || tp else 'nan' end as transformer_phase,
  case when state in ('known', 'unconnected') then cast(cast(feeder as bigint) as varchar) else 'nan' end as true_feeder_id,
  case when state = 'foreign' then 'other' when state = 'missing' then 'nan' else cast(unit as varchar) end as true_transformer_id,
  case when kind = 'wrong_feeder' then cast(cast(cabinet as bigint) as varchar) end as likely_cabinet_id,
  case state when 'foreign' then 'Wrong Trafo' when 'unconnected' then 'SM Phase Unconnected' when 'missing' then 'SM Phase Insufficient Data' else
    coalesce(nullif(concat_ws(' / ', case when kind = 'twisted' and ph < 3 then 'SM Phase Twist' end, case when tp <> fp then 'Feeder Phase Twist' end, case when kind = 'wrong_feeder' then 'Wrong Feeder' end), ''), 'Normal') end as status
from t
"""
