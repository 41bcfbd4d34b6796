"""The format "stratakey": reads, writes, streams, pushed filters, and reads that go on when a root is gone."""

import datetime as dt
import shutil

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratakey.functions import local, partition
from stratakey.functions.shard import key_hash
from stratakey.schema import TableSchema
from stratakey.sources.files import ArrowFiles, JvmFiles
from stratakey.sources.format import register
from stratakey.sources.log import Conflict, VersionLog
from stratakey.sources.table import KeyedTable, NotMounted, Partitioning, TablePath

SCHEMA = TableSchema.parse("<strict=%true;unique_keys=%true>[{name=id;type=int64;sort_order=ascending};{name=ts;type=timestamp};{name=v;type=string}]")
STRUCT = "id long, ts timestamp_ntz, v string"


@pytest.fixture
def where(tmp_path, spark):
    register(spark)
    return f"file://{tmp_path}"


def frame(spark, rows):
    return spark.createDataFrame([(i, t and dt.datetime.fromisoformat(t), v) for i, t, v in rows], STRUCT)


def table(spark, base, **options):
    t = KeyedTable(spark, TablePath(base))
    t.create(SCHEMA, **options)
    return t


def loaded(spark, base, **options):
    return spark.read.format("stratakey").options(**{k.replace("_", "-"): v for k, v in options.items()}).load(base)


def content(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hashes_and_partition_names_are_sparks_own(spark):
    struct = "b boolean, y tinyint, s smallint, i int, l long, f float, d double, t string, x binary, dd date, ts timestamp_ntz, u decimal(20,0)"
    rows = [
        (True, -1, 300, -5, 2**63 - 1, 1.5, -0.0, "é", b"\x00\xff", dt.date(1969, 12, 31), dt.datetime(1999, 12, 31, 23, 59, 59, 1), 2**64 - 1),
        (False, 0, 0, 0, -(2**63), -0.0, 2.5, "", b"", dt.date(2024, 2, 29), dt.datetime(2024, 2, 29), 0),
        (None,) * 12,
        (True, 1, 1, 2**31 - 1, 128, 3.25, 1e300, "x" * 100, b"y" * 33, dt.date(2100, 1, 1), dt.datetime(1960, 1, 1, 1), 128),
    ]
    df = spark.createDataFrame([(*r[:-1], r[-1] if r[-1] is None else __import__("decimal").Decimal(r[-1])) for r in rows], struct)
    arrow = df.toArrow()
    for c in df.columns:
        assert [r[0] for r in df.select(key_hash(F.col(c))).collect()] == local.key_hash([arrow[c]]), c
    assert [r[0] for r in df.select(key_hash(*map(F.col, df.columns))).collect()] == local.key_hash([arrow[c] for c in df.columns])
    times = spark.createDataFrame([(dt.datetime(*t),) for t in ((2024, 2, 29, 23, 59, 59, 999999), (1969, 12, 31, 0, 0, 1), (2023, 1, 1), (2024, 12, 30, 12))], "ts timestamp_ntz")
    for scale in partition.SCALES:
        want = [r[0] for r in times.select(partition.name(F.col("ts"), scale)).collect()]
        assert local.partition_names(times.toArrow()["ts"], scale).to_pylist() == want
        for name in want:
            start, end = times.select(partition.parse(F.lit(name), scale).alias("s"), partition.end(partition.parse(F.lit(name), scale), scale).alias("e")).first()
            assert local.bounds(name, scale) == (start, end)
    with pytest.raises(ValueError, match="null"):
        local.partition_names(pa.chunked_array([pa.array([None], pa.timestamp("us"))]), "DAY")


@pytest.mark.parametrize("kind", ["jvm", "arrow"])
def test_files_publish_once(kind, spark, where):
    files = JvmFiles(spark) if kind == "jvm" else ArrowFiles()
    files.publish(f"{where}/a/x.json", "é1")
    with pytest.raises(FileExistsError):
        files.publish(f"{where}/a/x.json", "2")
    assert files.read(f"{where}/a/x.json") == "é1" and "x.json" in files.names(f"{where}/a") and files.names(f"{where}/no") == []
    files.delete(f"{where}/a")
    assert files.names(f"{where}/a") == []


def test_log_writes_changes_and_starts_from_checkpoints(spark, where, monkeypatch):
    monkeypatch.setattr("stratakey.sources.log.CHECKPOINT", 4)
    a, b = VersionLog(spark, f"{where}/log"), VersionLog(ArrowFiles(), f"{where}/log")
    a.commit(0, {"schema": "s", "partitions": {str(i): {"rows": i} for i in range(1_000)}, "batches": {}, "open": {}})
    states = {1: a.read()}
    for v in range(1, 11):
        log = (a, b)[v % 2]
        log.commit(v, {"partitions": {str(v): None, f"n{v}": {"rows": v}}, "batches": {"w": v}})
        states[v + 1] = log.read()
    assert all(VersionLog(ArrowFiles(), f"{where}/log").read(v) == states[v] == a.read(v) for v in states)
    last = a.read()[1]
    assert "5" not in last["partitions"] and last["partitions"]["n10"] == {"rows": 10} and last["batches"] == {"w": 10} and last["schema"] == "s"
    assert len(a.files.read(f"{where}/log/v{11:09d}.json")) < 100
    with pytest.raises(Conflict):
        b.commit(5, {})
    a.prune()
    assert a.versions() == [8, 9, 10, 11] and VersionLog(spark, f"{where}/log").read() == (11, last)


def test_read_prunes_partitions_shards_and_columns(spark, where):
    t = table(spark, f"{where}/t", partitioning=Partitioning("ts", "DAY"), shards=4)
    t.upsert(frame(spark, [(i, f"2024-01-0{1 + i % 3}T05:00:00", f"v{i}") for i in range(60)]))
    t.upsert(frame(spark, [(0, "2024-01-01T06:00:00", "new"), (61, "2024-01-03T06:00:00", None)]))
    df = loaded(spark, f"{where}/t")
    assert df.schema.simpleString() == "struct<id:bigint,ts:timestamp_ntz,v:string>" and content(df) == content(t.scan())
    pushed = lambda: loaded(spark, f"{where}/t", filters="pushed")
    one = pushed().where("id = 0")
    # what is pushed leaves the plan; a comparison that isn't stays in it
    assert "Filter" not in plan(one).replace("RuntimeFilters", "") and " Filter EndsWith(v" in plan(pushed().where("v like '%1'"))
    assert content(one) == [(0, "new")] and one.rdd.getNumPartitions() <= 3
    for cond in ("id in (1, 2, 61)", "id > 57", "ts >= timestamp_ntz'2024-01-02 00:00:00' and ts < timestamp_ntz'2024-01-03 05:30:00'", "v = 'v7'", "v is null", "v is not null and id <= 2", "id = 5 or v = 'v6'", "v like 'v1%' and id >= 10", "ts = timestamp_ntz'2024-01-01 06:00:00'", "id <=> 3", "id = 1 and id = 2", "id = 99"):
        assert content(pushed().where(cond)) == content(df.where(cond)) == content(t.scan().where(cond)), cond
    assert "Filter" in plan(df.where("id = 0")) and df.where("id = 1").count() == 1 and df.count() == 61 == df.alias("a").join(df.where("id >= 0").alias("b"), "id").count()
    assert content(loaded(spark, f"{where}/t", **{"key.id": 0})) == [(0, "new")] and content(loaded(spark, f"{where}/t", **{"key.id": 99})) == []
    days = loaded(spark, f"{where}/t", between="2024-01-02 00:00:00,2024-01-03 05:30:00")
    assert content(days) == content(t.scan(between=("2024-01-02 00:00:00", "2024-01-03 05:30:00")))
    narrow = spark.read.format("stratakey").schema("v string").load(f"{where}/t")
    assert sorted(str(r.v) for r in narrow.collect()) == sorted(str(v) for _, v in content(t.scan()))
    with pytest.raises(Exception, match="no column"):
        spark.read.format("stratakey").schema("v long").load(f"{where}/t").collect()
    with pytest.raises(Exception, match="there is no table"):
        loaded(spark, f"{where}/nothing")


def test_point_lookup_reads_one_file(spark, where):
    t = table(spark, f"{where}/t", shards=64)
    t.upsert(spark.range(5_000).select("id", F.lit(None).cast("timestamp_ntz").alias("ts"), F.col("id").cast("string").alias("v")))
    assert len(t.scan().inputFiles()) == 64
    point = t.point({"id": 77})
    assert len(point.inputFiles()) == 1 and content(point) == [(77, "77")] and t.point({"id": -1}, ["v"]).collect() == []
    t.upsert(frame(spark, [(77, None, "again")]))
    assert len(t.point({"id": 77}).inputFiles()) == 2 and content(t.point({"id": 77})) == [(77, "again")]
    assert len(t.point({"id": 78}).inputFiles()) <= 2
    with pytest.raises(ValueError, match="key columns id"):
        t.point({"v": "x"})
    by_format = loaded(spark, f"{where}/t", filters="pushed").where("id = 77")
    assert content(by_format) == [(77, "again")] and by_format.rdd.getNumPartitions() == 1


def test_shards_double_and_stay_aligned(spark, where, monkeypatch):
    monkeypatch.setattr("stratakey.sources.table.SHARD_ROWS", 10)
    t = table(spark, f"{where}/t", shards=1)
    for lo, hi in ((0, 8), (8, 16), (16, 70)):
        t.upsert(frame(spark, [(i, None, f"v{i}") for i in range(lo, hi)]))
        p = t.state()[1]["partitions"]["all"]
        assert p["shards"] >= -(-hi // 10) and p["shards"] in (1, 2, 8)
        assert [len(t.point({"id": i}).collect()) for i in (0, hi - 1, hi)] == [1, 1, 0]
    assert content(loaded(spark, f"{where}/t")) == content(t.scan()) and t.scan().count() == 70


def test_write_by_format(spark, where):
    rows = frame(spark, [(i, f"2024-01-0{1 + i % 3}T05:00:00", f"v{i}") for i in range(50)] + [(7, "2024-01-02T09:00:00", "later")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    rows.repartition(3).write.format("stratakey").mode("append").options(**{"schema": SCHEMA.dump(), "partition-key": "ts", "partition-scale": "DAY", "reshard.strategy": "FIXED", "reshard.tablet-count": "3", "reshard.uniform": "true", "order-by": "ts"}).save(f"{where}/t")
    t = KeyedTable(spark, TablePath(f"{where}/t"))
    want = sorted([(i, f"v{i}") for i in range(50) if i != 7] + [(7, "later")])
    assert content(t.scan()) == content(loaded(spark, f"{where}/t")) == want and t.log.versions() == [1, 2]
    assert content(t.point({"id": 7})) == content(loaded(spark, f"{where}/t").where("id = 7")) == [(7, "later")]
    t.arranged(frame(spark, [(7, "2024-01-02T01:00:00", "last write"), (99, "2024-02-01T00:00:00", "x")])).write.format("stratakey").mode("append").option("order-by", "ts").save(f"{where}/t")
    want = sorted([w for w in want if w[0] != 7] + [(7, "last write"), (99, "x")])
    assert content(t.scan()) == content(loaded(spark, f"{where}/t")) == want
    t.compact()
    assert content(t.scan()) == content(loaded(spark, f"{where}/t")) == want and not any("loose" in p for p in t.state()[1]["partitions"].values())
    t.upsert(frame(spark, [(99, "2024-02-01T00:00:01", "y")]))
    assert content(loaded(spark, f"{where}/t").where("id = 99")) == [(99, "y")]
    for bad, word in ((lambda w: w.mode("overwrite"), "overwrite"), (lambda w: w.mode("append").option("order-by", "v"), "ordered by ts")):
        with pytest.raises(Exception, match=word):
            bad(rows.write.format("stratakey")).save(f"{where}/t")
    with pytest.raises(Exception, match="not in the table schema"):
        rows.withColumn("strange", F.lit(1)).write.format("stratakey").mode("append").save(f"{where}/t")
    versions = t.log.versions()
    with pytest.raises(Exception, match="partition key is null"):
        frame(spark, [(1, None, "a")]).write.format("stratakey").mode("append").option("order-by", "ts").save(f"{where}/t")
    assert t.log.versions() == versions
    t.unmount()
    with pytest.raises(Exception, match="unmounted"):
        rows.write.format("stratakey").mode("append").option("order-by", "ts").save(f"{where}/t")
    with pytest.raises(NotMounted):
        t.upsert(rows)


def test_streams_by_format(spark, where, tmp_path):
    source, t = table(spark, f"{where}/source"), table(spark, f"{where}/target")
    for i in range(3):
        source.upsert(frame(spark, [(j, None, f"{i}") for j in range(i, i + 2)]))

    def run():
        stream = spark.readStream.format("stratakey").load(f"{where}/source")
        stream.writeStream.format("stratakey").outputMode("append").options(**{"writer": "w", "order-by": "v", "checkpointLocation": f"{where}/check"}).trigger(availableNow=True).start(f"{where}/target").awaitTermination()

    run()
    assert content(t.scan()) == content(source.scan()) == [(0, "0"), (1, "1"), (2, "2"), (3, "2")]
    source.upsert(frame(spark, [(0, None, "9")]))
    run()
    assert content(loaded(spark, f"{where}/target")) == [(0, "9"), (1, "1"), (2, "2"), (3, "2")]
    versions = t.log.versions()
    shutil.rmtree(tmp_path / "check")
    run()  # the batch number is known: nothing is written twice
    assert t.log.versions() == versions
    history = [(r.rows, r.writer, r.batch) for r in t.history().collect()]
    assert history == [(6, "w", 0), (1, "w", 1)]


def test_reads_go_on_under_the_next_root(spark, where, tmp_path):
    for root in ("near", "far"):
        table(spark, f"{where}/{root}", shards=2).upsert(frame(spark, [(i, None, f"v{i}") for i in range(20)]), batch=("w", 0))
    df = spark.read.format("stratakey").option("path-map", f"near:{where}/near,far:{where}/far").load()
    other = spark.read.format("stratakey").option("path-map", f"near:{where}/near,far:{where}/far").option("cluster-pick-strategy.firstAvailable.priorities", "FAR;NEAR").load()
    assert df.count() == other.count() == 20
    planned = df.where("id < 5")
    parts = planned.rdd.getNumPartitions()
    shutil.rmtree(tmp_path / "near" / "near" / "data")  # the log is there, files are not: the tasks change roots
    assert parts and content(planned) == [(i, f"v{i}") for i in range(5)] and df.count() == 20
    shutil.rmtree(tmp_path / "near")
    assert df.count() == 20 and content(df.where("id = 3")) == [(3, "v3")] and other.count() == 20
    shutil.rmtree(tmp_path / "far")
    with pytest.raises(Exception, match="FileNotFoundError"):
        df.where("id > 1").count()
    with pytest.raises(Exception, match="there is no table"):
        spark.read.format("stratakey").option("path-map", f"near:{where}/near,far:{where}/far").load()
