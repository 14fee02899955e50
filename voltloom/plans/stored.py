"""Queries that write files, layers, snapshots and states and read them again, and lookups in what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explorer, graph, meta, quality, resample, upsert
from ..sources.scratch import folder
from ..sources.store import Store, month_order, scan_measurements, with_partitions
from . import ingest
from .frames import GRID_SQL, events, meter_rows, table, topology
from .queries import _CHAIN_SQL, _grid
from .registry import query, time_text

_DAY = "2024-01-16"


def _store(spark: SparkSession) -> Store:
    return Store(spark, folder(spark, "files"))


def _csv(df: DataFrame, store: Store, name: str) -> str:
    df.write.option("header", True).csv(store.path(name))
    return store.path(name)


def _measurement_files(spark: SparkSession, d: str) -> Store:
    """Events as two measurement files; those of errors have bad times."""
    store, e = _store(spark), events(spark, d)
    text = F.when(F.col("event_type") == "error", "bad").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    rows = e.select(text.alias("timestamp_dst"), F.concat(F.lit(" "), "meter_number").alias("meter_number"), F.col("value").alias("voltage_l1"), (F.col("timestamp") < F.lit(_DAY).cast("timestamp_ntz")).alias("first"))
    _csv(rows.where("first").drop("first"), store, "in/data_2024_2.csv")
    _csv(rows.where("not first").drop("first"), store, "in/data_2024_10.csv")
    return store


_GOOD = "select cast(user_id as varchar) as meter_number, date_trunc('second', ts) as ts, value from events where event_type <> 'error'"


@query(f"select meter_number, strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp, value as voltage_l1 from ({_GOOD}) q")
def csv_measurements(spark: SparkSession, d: str) -> DataFrame:
    store = _measurement_files(spark, d)
    parts = [scan_measurements(spark, p) for p in month_order(store.glob("in/*.csv"))]
    return parts[0].unionByName(parts[1]).select("meter_number", time_text(), "voltage_l1")


@query(f"select meter_number, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen, count(*) as total_rows from ({_GOOD}) q group by 1")
def ingested_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics after both files are ingested, and asked for again."""
    store = _measurement_files(spark, d)
    for _ in range(2):
        out = ingest.ingest_files(store, "in/*.csv")
    return out["meters"].select("meter_number", time_text("first_seen"), time_text("last_seen"), "total_rows")


@query(f"select strftime(ts, '%Y-%m-%d') as dt, count(*) as n_rows, 'ready' as status, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_seen from ({_GOOD}) q group by 1")
def ingested_files(spark: SparkSession, d: str) -> DataFrame:
    """The file index by date, and the state of its files."""
    index = ingest.ingest_files(_measurement_files(spark, d), "in/*.csv")["index"]
    out = index.groupBy("dt").agg(F.sum("rows").alias("n_rows"), F.min("status").alias("status"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return out.select("dt", "n_rows", "status", time_text("first_seen"), time_text("last_seen"))


@query(f"select meter_number, strftime(ts, '%Y-%m-%d %H:%M:%S') as timestamp, value as voltage_l1 from ({_GOOD}) q where meter_number in ('3', '12', '13') and ts >= timestamp '2024-01-05' and ts <= timestamp '2024-01-20'")
def ingested_series(spark: SparkSession, d: str) -> DataFrame:
    """Series of some meters in a range of time, from the store."""
    store = _measurement_files(spark, d)
    ingest.ingest_files(store, "in/*.csv")
    return store.series(["3", "12", "13"], "2024-01-05 00:00:00", "2024-01-20 00:00:00").select("meter_number", time_text(), "voltage_l1")


@query(f"with {GRID_SQL} select secondary_substation, zip_code as zip_code_secondary_substation, transformer, lv_feeder, node1, node2, cable_id, s_acctbal as cable_length, cast(n_nationkey * 10 as bigint) as transformer_capacity from topo")
def csv_topology(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark)
    _csv(topology(spark, d), store, "topology.csv")
    return store.topology_csv("topology.csv").select("secondary_substation", "zip_code_secondary_substation", "transformer", "lv_feeder", "node1", "node2", "cable_id", "cable_length", "transformer_capacity")


@query(f"with {GRID_SQL} select meter_number, delivery_point_id, cabinet, lv_feeder, has_heat_pump, has_solar_panel, c_acctbal as capacity_solar_panel from mrows")
def csv_meter_cabinet(spark: SparkSession, d: str) -> DataFrame:
    """Flags are written as True, true and TRUE, whole numbers with a point."""
    store, rows = _store(spark), meter_rows(spark, d)
    flag = F.initcap(F.col("has_heat_pump").cast("string"))
    rows = rows.withColumns({"has_heat_pump": flag, "has_solar_panel": F.upper(F.col("has_solar_panel").cast("string")), "delivery_point_id": F.concat(F.col("delivery_point_id").cast("string"), F.lit(".0"))})
    _csv(rows, store, "meters.csv")
    return store.meter_cabinet_csv("meters.csv").select("meter_number", "delivery_point_id", "cabinet", "lv_feeder", "has_heat_pump", "has_solar_panel", "capacity_solar_panel")


@query("select strftime(ts, '%Y-%m-%d %H:%M:00') as timestamp, value as \"T\" from events")
def csv_weather(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark)
    _csv(events(spark, d).select(F.date_format("timestamp", "dd/MM/yyyy HH:mm").alias("DateTime"), F.col("value").alias("T")), store, "weather.csv")
    return store.weather_csv("weather.csv").select(time_text(), "T")


@query("select event_id, cast(case when value < 20 then 3 else 0 end as integer) as flag, strftime(ts, '%Y-%m-%d') as dt, cast(floor(value / 200) as integer) as shard from events")
def flags_layer(spark: SparkSession, d: str) -> DataFrame:
    """A layer that was written twice."""
    store = _store(spark)
    rows = events(spark, d).select("event_id", F.when(F.col("value") < 20, 3).otherwise(0).alias("flag"), F.date_format("timestamp", "yyyy-MM-dd").alias("dt"), F.floor(F.col("value") / 200).cast("int").alias("shard"))
    for _ in range(2):
        store.write_layer(rows, "flags")
    return store.layer("flags").select("event_id", "flag", F.date_format("dt", "yyyy-MM-dd").alias("dt"), F.col("shard").cast("int").alias("shard"))


@query("select s_suppkey as id, s_name as name, 'a' as run from supplier union all select s_suppkey, s_name, 'b' from supplier where s_acctbal < 0")
def appended_results(spark: SparkSession, d: str) -> DataFrame:
    store, s = _store(spark), table(spark, d, "supplier")
    for run, rows in (("a", s), ("b", s.where("s_acctbal < 0"))):
        store.write_parquet(rows.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit(run).alias("run")), "results", mode="append", by=["run"])
    return store.parquet("results").select("id", "name", "run")


_FILES = "select strftime(ts, '%Y-%m-%d') as dt, count(*) as n_rows, strftime(min(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') as first_seen, strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') as last_seen from events group by 1"


@query(_FILES)
def file_footers(spark: SparkSession, d: str) -> DataFrame:
    """What the footers of a layer's files tell, by date."""
    store = _store(spark)
    rows = events(spark, d).select("meter_number", F.date_trunc("second", F.col("timestamp").cast("timestamp")).alias("timestamp"), F.col("value").alias("voltage_l1"))
    store.write_series(with_partitions(rows), "raw")
    out = store.file_stats("raw").groupBy("dt").agg(F.sum("rows").alias("n_rows"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return out.select("dt", "n_rows", time_text("first_seen"), time_text("last_seen"))


# --- states -----------------------------------------------------------------------------------------------------------------


@query("""select o_orderpriority as batch_id, case when o_orderpriority = '1-URGENT' or o_orderstatus <> 'F' then 'ready' else 'staged' end as status, case when o_orderpriority = '1-URGENT' then 'processed' else 'in_progress' end as batch_status,
  count(*) as files from orders group by all""")
def batch_promotion(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderpriority").alias("batch_id"), F.when(F.col("o_orderstatus") == "F", "staged").otherwise("ready").alias("status"))
    batches = files.select("batch_id").distinct().withColumn("status", F.lit("in_progress"))
    files, batches = meta.promote_batch(files, batches, "1-URGENT")
    return files.groupBy("batch_id", "status").agg(F.count("*").alias("files")).join(batches.withColumnRenamed("status", "batch_status"), "batch_id")


_STEPS = "select distinct o_orderpriority as mode, o_orderstatus as flag from orders"


@query(f"""select 'ship:' || substr(sha256('{{"flag": "' || flag || '", "mode": "' || mode || '"}}'), 1, 12) as workflow, flag <> 'P' as completed, flag <> 'P' or mode = '1-URGENT' as skipped from ({_STEPS}) q""")
def workflow_marks(spark: SparkSession, d: str) -> DataFrame:
    """States of all steps of a table, by the hash of what they work on: completed ones stay so when they are marked again, and a step is
    skipped if it, or the whole workflow under its bare name, is completed."""
    steps = table(spark, d, "orders").select(F.col("o_orderpriority").alias("mode"), F.col("o_orderstatus").alias("flag")).distinct()
    states = spark.createDataFrame([], ingest.STATES)
    states = meta.mark_workflows(states, "ship", steps, completed=False)
    for _ in range(2):
        states = meta.mark_workflows(states, "ship", steps.where("flag != 'P'"))
    done = meta.mark_workflows(states, "ship", steps.where("mode = '1-URGENT'"))
    skipped = meta.completed_workflows(done, "ship", steps).select("workflow", F.col("completed").alias("skipped"))
    return states.join(skipped, "workflow").select("workflow", "completed", "skipped")


@query("select c_custkey as id, case when c_acctbal < 0 then '{\"balance\": 0}' else c_name end as detail from customer")
def meter_update(spark: SparkSession, d: str) -> DataFrame:
    """New details of known meters; unknown ones are not added."""
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    old = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("detail"))
    new = c.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.lit('{"balance": 0}').alias("detail"))
    new = new.unionByName(s.select((F.col("s_suppkey") + 10000000).alias("id"), F.col("s_name").alias("detail")))
    return upsert.merge(old, new, ["id"], insert=False)


@query("""select c_custkey as meter_id, 'L1' as sm_phase, cast(case when c_acctbal < 0 then c_nationkey + 200 else c_nationkey end as bigint) as feeder_id, case when c_acctbal < 0 then 'L2' else 'L1' end as feeder_phase from customer
union all select c_custkey, 'L3', cast(null as bigint), cast(null as varchar) from customer where c_acctbal < 0""")
def phase_mapping_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Of two rows for one meter phase in a batch the last counts; missing values are written in several ways."""
    c = table(spark, d, "customer")
    none = [F.lit(None).cast(k).alias(n) for n, k in (("transformer_id", "long"), ("transformer_phase", "string"))]
    old = c.select(F.col("c_custkey").alias("meter_id"), F.lit("L1").alias("sm_phase"), F.col("c_nationkey").cast("long").alias("feeder_id"), F.lit("L1").alias("feeder_phase"), *none)
    some, text = c.where("c_acctbal < 0"), F.col("c_custkey").cast("string")

    def said(meter, phase: str, feeder, feeder_phase: str, order: int) -> DataFrame:
        return some.select(meter.alias("meter_id"), F.lit(phase).alias("sm_phase"), feeder.alias("feeder_id"), F.lit(feeder_phase).alias("feeder_phase"), F.lit("nan").alias("transformer_id"), F.lit("None").alias("transformer_phase"), F.lit(order).alias("i"))

    batch = said(text, "l1", F.lit("7"), "l3", 1).unionByName(said(F.concat(text, F.lit(".0")), "L1", (F.col("c_nationkey") + 200).cast("string"), "l2", 2)).unionByName(said(text, "l3", F.lit("other"), "", 3))
    return meta.upsert_phase_mappings(old, batch, "i").select("meter_id", "sm_phase", "feeder_id", "feeder_phase")


@query("select c_custkey as id, case when c_mktsegment = 'BUILDING' then 'earlier' else 'new' end as label from customer")
def labels_merged(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    loaded = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.lit("earlier").alias("label"))
    return meta.merge_labels(loaded, c.select(F.col("c_custkey").alias("id"), F.lit("new").alias("label")), "id")


# --- lookups ----------------------------------------------------------------------------------------------------------------


@query("select cast(user_id as varchar) as meter_number from events group by 1")
def meters_with_rows(spark: SparkSession, d: str) -> DataFrame:
    inventory = meta.meter_inventory(events(spark, d))
    ids = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("meter_number"))
    return graph.with_data(inventory, ids.unionByName(meta.with_rows(inventory)))


@query("select distinct cast(n_regionkey as bigint) as id, cast(n_regionkey + 2000 as varchar) as zip_code from supplier join nation on s_nationkey = n_nationkey where n_regionkey <> 1")
def substation_zip_codes(spark: SparkSession, d: str) -> DataFrame:
    assets, _ = _grid(spark, d)
    ids = assets["secondary_substation"].where("id != 1").select("id")
    return graph.zip_codes(assets["secondary_substation"], ids.unionByName(ids))


@query(f"""with {_CHAIN_SQL}, f as (select *, row_number() over (partition by meter_id order by depth, feeder_id, cabinet_id nulls first) as rn, count(*) over (partition by meter_id) as n from chain)
select c_custkey as meter_id, feeder_id, cabinet_id, feeder_id as transformer_id, cast(n_regionkey as bigint) as secondary_substation_id, n - 1 as further, (select count(*) from events where user_id = c_custkey) as n_rows, c_mktsegment = 'BUILDING' as has_heat_pump
from customer left join f on f.meter_id = c_custkey and rn = 1 left join nation on n_nationkey = feeder_id""")
def meter_characterisation(spark: SparkSession, d: str) -> DataFrame:
    assets, g = _grid(spark, d)
    ids = assets["meter"].select(F.col("id").alias("meter_id"))
    inventory = meta.meter_inventory(events(spark, d)).select(F.col("meter_number").cast("bigint").alias("meter_id"), "total_rows")
    records = assets["meter"].select(F.col("id").alias("meter_id"), "has_heat_pump")
    out = graph.characterisation(ids, graph.topology_chain(ids, g, assets), inventory, records)
    further = F.when(F.col("additional_feeder_ids").isNotNull(), F.size("additional_feeder_ids")).cast("long").alias("further")
    return out.select("meter_id", "feeder_id", "cabinet_id", "transformer_id", "secondary_substation_id", further, F.coalesce("total_rows", F.lit(0)).alias("n_rows"), "has_heat_pump")


# --- series -----------------------------------------------------------------------------------------------------------------


@query("""with e as (select cast(user_id as varchar) as meter_number, ts, case when event_type = 'purchase' then value else 0 end as p, event_id from events),
b as (select meter_number, min(ts) as a, max(ts) as z from e where p <> 0 group by 1)
select meter_number, event_id, p from e join b using (meter_number) where ts between a and z""")
def trimmed_series(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0))
    return quality.trim(e, ["p"]).select("meter_number", "event_id", "p")


@query("""with m as (select cast(user_id as varchar) as meter_number, date_trunc('day', ts) as b, avg(value) as v from events group by all),
g as (select unnest(generate_series((select min(b) from m), (select max(b) from m), interval '1 day')) as b),
k as (select distinct meter_number from m),
f as (select k.meter_number, g.b, v, row_number() over (partition by k.meter_number order by g.b) as i from k cross join g left join m on m.meter_number = k.meter_number and m.b = g.b),
n as (select *, max(case when v is not null then i end) over (partition by meter_number order by i rows unbounded preceding) as ai, min(case when v is not null then i end) over (partition by meter_number order by i rows between current row and unbounded following) as bi from f)
select n.meter_number, strftime(n.b, '%Y-%m-%d') as day, cast(cast(case when n.v is not null then n.v when pa.v is not null and pb.v is not null then pa.v + (pb.v - pa.v) * (n.i - ai) / (bi - ai) else coalesce(pb.v, pa.v) end as float) as double) as value
from n left join f pa on pa.meter_number = n.meter_number and pa.i = ai left join f pb on pb.meter_number = n.meter_number and pb.i = bi""")
def interpolated_days(spark: SparkSession, d: str) -> DataFrame:
    """Daily means of every meter on all days, gaps filled between neighbours and at the ends."""
    means = resample.resample_mean(events(spark, d), ["value"], unit="day")
    days = means.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("z")).select(F.explode(F.sequence("a", "z", F.expr("interval 1 day"))).alias("timestamp"))
    rows = means.select("meter_number").distinct().crossJoin(F.broadcast(days)).join(means, ["meter_number", "timestamp"], "left")
    out = resample.interpolate(rows, "value", ["meter_number"], "timestamp")
    return out.select("meter_number", F.date_format("timestamp", "yyyy-MM-dd").alias("day"), F.col("value").cast("float").cast("double").alias("value"))


@query("select c_custkey as id, case when c_acctbal > 0 then strftime(date '2024-01-01' + cast(c_nationkey as integer), '%Y-%m-%d') end as updated from customer order by updated desc nulls last, id limit 500")
def snapshot_preview(spark: SparkSession, d: str) -> DataFrame:
    """The newest 500 classifier results, a top-k report."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey").cast("int"))).alias("updated_at"))
    return explorer.snapshot_preview(rows, 500, "id").select("id", F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))
