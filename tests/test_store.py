"""Storage, batch and streaming ingestion on a temporary folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltloom.plans import ingest
from voltloom.plans.ingest import ingest_files
from voltloom.sources.store import Store, month_order, resolve_backend, with_partitions
from voltloom.streaming.ingest import ingest_stream, measurement_stream, streaming_means

CSV = "timestamp_dst,meter_number,voltage_l1\n2024-01-01 00:00:00,100025,230\n2024-01-01 00:15:00,17,231\nbad,17,1\n2024-01-02 00:00:00,,1\n2024-01-02 00:00:00,100025,NaN\n"


@pytest.fixture
def store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/data_2024_1.csv").write_text(CSV)
    return Store(spark, f"file://{tmp_path}")


def test_backends(monkeypatch):
    monkeypatch.delenv("STORAGE_BACKEND", raising=False)
    assert resolve_backend() == "s3a" and resolve_backend("azure") == "abfss"
    monkeypatch.setenv("STORAGE_BACKEND", "az")
    assert resolve_backend() == "abfss" and resolve_backend("s3") == "s3a"
    with pytest.raises(ValueError):
        resolve_backend("gcs")


def test_month_order():
    assert month_order(["x.csv", "a_2024_10.csv", "b_2024_9.csv"]) == ["b_2024_9.csv", "a_2024_10.csv", "x.csv"]


def test_ingest(spark, store):
    out = ingest_files(store, "in/*.csv")
    assert len(out["files"]) == 1
    assert {r.meter_number: r.total_rows for r in out["meters"].collect()} == {"100025": 2, "17": 1}
    assert out["index"].where("status = 'ready'").count() == 3 and {r.seq for r in out["index"].collect()} == {1}
    raw = store.layer("raw")
    assert raw.count() == 3 and raw.where(F.isnan("voltage_l1")).count() == 0
    assert store.series(["100025"]).count() == 2 and store.series(spark.createDataFrame([("17",)], "meter_number string")).count() == 1
    assert not store.glob("staging/*")
    assert ingest_files(store, "in/*.csv")["files"] == []
    assert store.files("raw").count() == 3
    assert store.file_stats("raw").agg(F.sum("rows")).first()[0] == 3


def test_json(store):
    assert store.json("none.json") is None
    store.write_json({"a": 1}, "x.json")
    assert store.json("x.json") == {"a": 1}


def test_typed_csv(spark, store, tmp_path):
    (tmp_path / "m.csv").write_text("meter_number,delivery_point_id,cabinet,has_heat_pump\n1,2.0,Cabinet.1,True\n3,,Cabinet.2,\n")
    rows = store.meter_cabinet_csv("m.csv").orderBy("meter_number").collect()
    assert [(r.meter_number, r.delivery_point_id, r.has_heat_pump, r.lv_feeder) for r in rows] == [(1, 2, True, None), (3, None, None, None)]
    (tmp_path / "w.csv").write_text("DateTime,T\n31/01/2024 13:00,-2.5\n")
    assert store.weather_csv("w.csv").first().timestamp.day == 31


def test_streams(spark, store, tmp_path):
    rows = measurement_stream(spark, f"file://{tmp_path}/in", ["timestamp_dst", "meter_number", "voltage_l1"])
    ingest_stream(rows, store, f"file://{tmp_path}/check").awaitTermination(120)
    assert spark.read.parquet(store.path("stream_stats", "batch=0")).agg(F.sum("total_rows")).first()[0] == 3
    q = streaming_means(measurement_stream(spark, f"file://{tmp_path}/in", ["timestamp_dst", "meter_number", "voltage_l1"]), ["voltage_l1"]).writeStream.outputMode("complete").format("memory").queryName("means").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("means").count() == 3


class Crash(BaseException):
    """The process ends here; no handler of the program runs."""


STEPS = ["write_series", "glob", "promote", "delete", "commit", "_beside", "snapshot", "exists"]


@pytest.mark.parametrize("name", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_lost_batch_is_replayed_without_counting_twice(spark, store, monkeypatch, name, after):
    """Whatever call the process is lost in, before or after its work: the next try ends with each row counted once."""
    own = getattr(Store, name)
    for nth in (1, 2, 3):
        calls = [0]

        def crash(self, *args, **kwargs):
            calls[0] += 1
            if calls[0] == nth and not after:  # noqa: B023
                raise Crash
            out = own(self, *args, **kwargs)
            if calls[0] == nth and after:  # noqa: B023
                raise Crash
            return out

        with monkeypatch.context() as m:
            m.setattr(Store, name, crash)
            try:
                ingest_files(store, "in/*.csv")
            except Crash:
                pass
    ingest_files(store, "in/*.csv")
    assert {r.meter_number: r.total_rows for r in store.snapshot("meter_stats").collect()} == {"100025": 2, "17": 1}
    index = store.snapshot("file_index")
    assert index.where("status = 'ready'").count() == 3 == index.count()
    assert store.layer("raw").count() == 3 and not store.glob("staging/*")
    assert {r.path.split(":")[-1] for r in index.collect()} == {p.split(":")[-1] for p in store.glob("raw/dt=*/shard=*/*.parquet")}
    assert store.snapshot("ingest_batches").where("status = 'processed'").count() == 1
    assert ingest_files(store, "in/*.csv")["files"] == []


def test_a_failed_batch_is_recorded(spark, store, monkeypatch):
    def fail(*args):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(Store, "promote", fail)
        with pytest.raises(OSError):
            ingest_files(store, "in/*.csv")
    batch = store.snapshot("ingest_batches").first()
    assert (batch.status, batch.error_log, batch.source) == ("failed", "disk full", "data_2024_1.csv")
    assert not store.glob("staging/*") and store.snapshot("file_index") is None
    assert len(ingest_files(store, "in/*.csv")["files"]) == 1
    assert sorted(r.status for r in store.snapshot("ingest_batches").collect()) == ["failed", "processed"]


def test_a_broken_pointer_is_an_error(spark, store, tmp_path):
    assert store.snapshot("t") is None
    store.write_snapshot(spark.range(3), "t", "a")
    assert store.snapshot("t").count() == 3
    store.commit({"t": spark.range(4), "u": spark.range(1)}, "b")
    assert (store.snapshot("t").count(), store.snapshot("u").count(), len(store.commits())) == (4, 1, 2)
    (tmp_path / "_commits/00000000000000000003.json").write_text('{"tables": {"t"')
    with pytest.raises(ValueError):
        store.snapshot("t")
    (tmp_path / "broken.json").write_text("{")
    assert store.json("broken.json") is None


def test_two_writers_dont_both_commit(spark, store, monkeypatch):
    store.write_snapshot(spark.range(3), "t", "a")
    log = store.commits()
    store.write_snapshot(spark.range(3), "t", "b")
    monkeypatch.setattr(Store, "commits", lambda self: log)
    with pytest.raises(RuntimeError):
        store.write_snapshot(spark.range(3), "t", "c")


def test_a_file_without_rows(spark, store, tmp_path):
    (tmp_path / "in/data_2023_1.csv").write_text(CSV.split("\n")[0] + "\n")
    assert len(ingest_files(store, "in/*.csv")["files"]) == 2
    assert store.snapshot("meter_stats").agg(F.sum("total_rows")).first()[0] == 3


def test_layers_and_lists(spark, store, tmp_path):
    flags = spark.createDataFrame([("1", dt.datetime(2024, 1, 1), 0, "2024-01-01", 1)], "meter_number string, timestamp timestamp, voltage_l1_flag int, dt string, shard int")
    store.write_layer(flags, "flags")
    store.write_layer(flags, "flags")
    assert store.layer("flags").count() == 1 and store.glob("flags/shard=1/dt=2024-01-01/*.parquet")
    with pytest.raises(ValueError):
        store.layer("other")
    spark.range(1).write.parquet(store.path("old/meter_number=17"))
    spark.range(1).write.parquet(store.path("old/meter_number=5"))
    assert [r.meter_number for r in store.meters_by_folder("old").collect()] == ["17", "5"]
    (tmp_path / "topo.csv").write_text("node1,node2,cable_id,cable_length\nLvFeeder.1,Cabinet.2,LvCable.3,4.5\n")
    row = store.topology_csv("topo.csv").first()
    assert (row.node1, row.node2, row.cable_id, float(row.cable_length), row.transformer) == ("LvFeeder.1", "Cabinet.2", "LvCable.3", 4.5, None)
    store.copy(store.path("topo.csv"), store.path("copied.csv"))
    assert store.exists("copied.csv") and store.delete("copied.csv") and not store.exists("copied.csv")


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from voltloom.sources import scratch

    class Away:
        master = "spark://host:7077"

    class Session:
        sparkContext = Away()
        conf = type("C", (), {"get": lambda self, key, default: default})()

    with pytest.raises(RuntimeError):
        scratch.shared_dir(Session())
    assert scratch.materialise(spark.range(5), "t").count() == 5


def test_commits_cost_what_they_add(spark, store, monkeypatch):
    """Parts are added, merged when they are read, put together now and then; old entries go, and no entry names more than it must."""
    from voltloom.sources import store as module

    monkeypatch.setattr(module, "COMPACT", 4)
    monkeypatch.setitem(module.RULES, "kept", lambda rows: rows.groupBy("k").agg(F.max_by("v", "_part").alias("v")))
    read = []
    entry = Store._entry
    monkeypatch.setattr(Store, "_entry", lambda self, path: (read.append(path), entry(self, path))[1])
    for i in range(11):
        store.commit({}, f"c{i}", {"kept": spark.createDataFrame([(i % 3, i)], "k int, v int"), "all": spark.range(i, i + 1)})
        read.clear()
        assert {r.k: r.v for r in store.snapshot("kept").collect()} == {k: max(j for j in range(i + 1) if j % 3 == k) for k in range(min(i + 1, 3))}
        assert len(read) <= 4
        assert sorted(r.id for r in store.snapshot("all").collect()) == list(range(i + 1))
        assert len(store.commits()) <= 8 and len(store.current()["all"]) <= 4
    store.commit({"all": spark.range(2)}, "replaced")
    assert store.snapshot("all").count() == 2


def test_two_writers_on_a_store_that_moves_over_files(spark, store, monkeypatch):
    """Both see no entry, and moving refuses nothing: the claim lets one of them through."""

    class Careless:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def exists(self, p):
            return False if p.getName().endswith(".json") else self.fs.exists(p)

        def rename(self, a, b):
            self.fs.delete(b, False)
            return self.fs.rename(a, b)

    hadoop = Store._hadoop
    monkeypatch.setattr(Store, "_hadoop", lambda self, path: (Careless(hadoop(self, path)[0]), hadoop(self, path)[1]))
    log = store.commits()
    store.write_snapshot(spark.range(3), "t", "a")
    monkeypatch.setattr(Store, "commits", lambda self: log)
    with pytest.raises(RuntimeError):
        store.write_snapshot(spark.range(5), "t", "b")
    monkeypatch.undo()
    assert store.snapshot("t").count() == 3


def test_a_claim_that_was_left_is_followed_by_the_next(spark, store, monkeypatch):
    from voltloom.sources import store as module

    fs, p = store._hadoop(store.path("_commits", f"{1:020d}.json"))
    assert store._claim(fs, p) and not store._claim(fs, p)
    with pytest.raises(RuntimeError):
        store.write_snapshot(spark.range(3), "t", "a")
    monkeypatch.setattr(module, "CLAIM", 0)
    store.write_snapshot(spark.range(3), "t", "b")
    assert store.snapshot("t").count() == 3


def test_many_files_are_one_batch(spark, store, tmp_path):
    (tmp_path / "in/data_2024_2.csv").write_text(CSV.replace("100025", "8"))
    out = ingest_files(store, "in/*.csv", together=True)
    assert len(out["files"]) == 2 and ingest_files(store, "in/*.csv")["files"] == []
    assert {r.meter_number: r.total_rows for r in out["meters"].collect()} == {"100025": 2, "17": 2, "8": 2}
    assert [(r.status, r.source) for r in store.snapshot("ingest_batches").collect()] == [("processed", "data_2024_1.csv,data_2024_2.csv")]


def test_large_days_are_written_by_several_tasks(spark, store):
    rows = spark.range(200_000).select(F.lit("2024-01-01").alias("dt"), F.lit(0).alias("shard"), F.xxhash64("id").cast("string").alias("meter_number"), F.lit(dt.datetime(2024, 1, 1)).alias("timestamp"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        store.write_series(rows.repartition(8), "big")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(store.glob("big/dt=*/shard=*/*.parquet")) > 1
    one = spark.read.parquet(store.glob("big/dt=*/shard=*/*.parquet")[0])
    ids = [r.meter_number for r in one.collect()]
    assert ids == sorted(ids) and store.parquet("big").count() == 200_000


def test_a_document_survives_a_lost_writer(store, monkeypatch):
    store.write_json({"a": 1}, "x.json")
    fs, p = store._hadoop(store.path("x.json"))
    fs.rename(p, store._hadoop(store.path("x.json.old"))[1])
    assert store.json("x.json") == {"a": 1}
    store.write_json({"a": 2}, "x.json")
    assert store.json("x.json") == {"a": 2} and not store.exists("x.json.old")


def test_footers_tell_what_a_scan_tells(spark, tmp_path):
    from voltloom.sources.footers import read_footers

    store = Store(spark, f"file://{tmp_path}/lake")
    rows = spark.sql("select cast(id % 7 as string) as meter_number, timestamp_seconds(1704067200 + id * 3600) as timestamp, cast(id as double) as voltage_l1 from range(200)")
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    store.write_series(with_partitions(rows), "raw")
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
    scan = spark.read.parquet(store.path("raw")).groupBy(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    want = {tuple(r) for r in scan.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).collect()}
    got = store.file_stats("raw")
    assert {tuple(r)[:5] for r in got.collect()} == want
    assert got.where("dt is null or shard is null").isEmpty() and got.agg(F.sum("rows")).first()[0] == 200
    assert "FileScan" not in read_footers(spark, store.path("raw"), "timestamp")._jdf.queryExecution().toString()
    for tasks in (1, 2, 1000):  # folders of few or many tasks
        spread = spark.read.format("parquet_footers").option("path", store.path("raw")).option("tasks", tasks).load()
        assert {r.path for r in spread.collect()} == {w[0] for w in want}
        assert spread.where("known").isEmpty()  # no column was asked for


def test_files_without_statistics_of_times_are_scanned(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/old")
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    rows = spark.sql("select timestamp_seconds(id) as timestamp, id from range(10)")
    rows.repartition(2).write.parquet(store.path("raw"))
    rows.where("id < 0").coalesce(1).write.mode("append").parquet(store.path("raw"))
    spark.sql("select cast(null as timestamp) as timestamp, 1L as id").write.mode("append").parquet(store.path("raw"))
    stats = store.file_stats("raw")
    first, last, n = stats.agg(F.min(F.unix_seconds("first_seen")), F.max(F.unix_seconds("last_seen")), F.sum("rows")).first()
    assert (first, last, n) == (0, 9, 11)
    spark.range(0).write.parquet(store.path("none"))
    store.at(store.path("none")).delete("part-*")
    assert store.file_stats("none", ts="id").agg(F.sum("rows")).first()[0] in (0, None)
