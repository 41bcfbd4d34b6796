import datetime as dt
import random
import shutil
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakey.config import credentials
from stratakey.config.options import TableOptions
from stratakey.locks import FileLocks, LockError, Mode, NoLocks, choose, do_unless, locked
from stratakey.operators import batches, lookup, metrics
from stratakey.schema import TableSchema
from stratakey.sources import generate
from stratakey.sources.configured import ConfiguredTable
from stratakey.sources.files import JvmFiles
from stratakey.sources.log import Conflict, VersionLog
from stratakey.sources.roots import FirstAvailable, NoRoot
from stratakey.sources.table import KeyedTable, NotMounted, Partitioning, TablePath, escaped, last_rows
from stratakey.streaming import sink

SCHEMA = TableSchema.parse("<strict=%true;unique_keys=%true>[{name=id;type=int64;sort_order=ascending};{name=ts;type=timestamp};{name=v;type=string}]")

PLAIN = TableSchema.parse("[{name=id;type=int64};{name=ts;type=timestamp};{name=v;type=string}]")


@pytest.fixture
def where(tmp_path):
    return f"file://{tmp_path}"


def frame(spark, rows):
    data = [(i, t and dt.datetime.fromisoformat(t), v) for i, t, v in rows]
    return spark.createDataFrame(data, T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.StringType())]))


def content(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_paths():
    assert TablePath("/a/b").full == "/a/b/b"
    assert TablePath("/a/b/", "2024-01-01").full == "/a/b/2024-01-01"


def test_upsert_replaces_by_key(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    assert t.create(SCHEMA, shards=3) and not t.create(SCHEMA)
    t.upsert(frame(spark, [(1, None, "a"), (2, None, "b"), (1, None, "c")]), ["v"])
    t.upsert(frame(spark, [(2, None, "d"), (3, None, None)]))
    assert content(t.scan()) == [(1, "c"), (2, "d"), (3, None)]
    assert content(t.scan(version=2)) == [(1, "c"), (2, "b")]
    assert t.scan(["v"], limit=2).count() == 2 and t.scan(limit=0).count() == 0
    assert t.vacuum() == 0 and len(t.state()[1]["partitions"]["all"]["paths"]) == 2
    t.compact()
    assert len(t.state()[1]["partitions"]["all"]["paths"]) == 1
    assert t.vacuum() == 2 and content(t.scan()) == [(1, "c"), (2, "d"), (3, None)]


def test_a_write_adds_its_own_rows_and_merges_now_and_then(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA)
    for i in range(10):
        t.upsert(frame(spark, [(i % 3, None, f"v{i}"), (100 + i, None, "own")]))
        paths = t.state()[1]["partitions"]["all"]["paths"]
        assert len(paths) == (i + 1 if i < 8 else i - 7)
        assert i >= 8 or spark.read.parquet(paths[-1]).count() == 2
    assert content(t.scan()) == [(0, "v9"), (1, "v7"), (2, "v8")] + [(100 + i, "own") for i in range(10)]
    assert sorted(r["v"] for r in t.scan(["v"]).collect()) == sorted(v for _, v in content(t.scan()))


def test_tables_without_keys_only_grow(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(TableSchema.parse("[{name=id;type=int64};{name=ts;type=timestamp};{name=v;type=string}]"))
    for _ in range(2):
        t.upsert(frame(spark, [(1, None, "a"), (1, None, "a")]))
    assert content(t.scan()) == [(1, "a")] * 4 and "Exchange" not in t.scan()._jdf.queryExecution().executedPlan().toString()


def test_shards_follow_rows_and_the_last_partitions(spark, where, monkeypatch):
    monkeypatch.setattr("stratakey.sources.table.SHARD_ROWS", 10)
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY"), shards=2, last_partitions=3)
    day = lambda d, n: frame(spark, [(i, f"2024-01-0{d}T00:00:00", "x") for i in range(n)])
    for d, n in ((1, 65), (2, 5), (3, 200)):
        t.upsert(day(d, n))
    shards = {r.partition: r.n for r in t.partition_table().collect()}
    assert shards == {"2024-01-01": 7, "2024-01-02": 7, "2024-01-03": 20}
    assert t.scan().count() == 270


def test_partitioned_upsert_and_pruned_scan(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "HOUR"))
    t.upsert(frame(spark, [(1, "2024-01-01T10:30:00", "a"), (1, "2024-01-01T11:30:00", "b"), (2, "2024-01-02T00:00:00", "c")]))
    assert t.partitions() == ["2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-02 00:00:00"]
    assert content(t.scan()) == [(1, "a"), (1, "b"), (2, "c")]
    part = t.scan(between=("2024-01-01T11:00:00", "2024-01-02T00:00:00"))
    assert content(part) == [(1, "b")]
    assert len(part.inputFiles()) == 1
    with pytest.raises(NotImplementedError):
        t.scan(strict=True)
    before = {n: p["paths"] for n, p in t.state()[1]["partitions"].items()}
    t.upsert(frame(spark, [(2, "2024-01-02T00:10:00", "d")]))
    after = {n: p["paths"] for n, p in t.state()[1]["partitions"].items()}
    assert content(t.scan()) == [(1, "a"), (1, "b"), (2, "d")]
    assert [n for n in before if before[n] != after[n]] == ["2024-01-02 00:00:00"]


def test_null_partition_key_and_missing_columns(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY"))
    with pytest.raises(Exception, match="partition key is null"):
        t.upsert(frame(spark, [(1, None, "a")]))
    with pytest.raises(ValueError, match="strange"):
        t.upsert(frame(spark, [(1, "2024-01-01", "a")]).withColumn("strange", F.lit(1)))
    assert t.scan().count() == 0


def test_a_batch_commits_once(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA)
    assert t.upsert(frame(spark, [(1, None, "a")]), batch=("w", 0)).fresh
    assert not t.upsert(frame(spark, [(1, None, "b")]), batch=("w", 0)).fresh
    assert t.upsert(frame(spark, [(1, None, "c")]), batch=("other", 0)).fresh
    assert content(t.scan()) == [(1, "c")]


def test_random_commit_failures_lose_nothing(spark, where, monkeypatch):
    """Committed rows equal written rows, whatever commits fail between writing data and publishing it."""
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY"))
    real, dice, failures = VersionLog.commit, random.Random(42), []

    def shaky(self, after, state):
        if self.folder == t.log.folder and len(failures) % 4 != 3 and dice.random() < 0.6:
            failures.append(after)
            raise OSError("no commit")
        failures.append(None) if failures and failures[-1] is not None else None
        return real(self, after, state)

    monkeypatch.setattr(VersionLog, "commit", shaky)
    write = sink.upsert_batches(t, "w")
    for n in range(4):
        rows = frame(spark, [(n * 10 + i, f"2024-01-0{1 + i % 3}T00:00:00", "x") for i in range(10)])
        for _ in range(12):
            try:
                write(rows, n)
                break
            except OSError:
                continue
    monkeypatch.undo()
    assert any(f is not None for f in failures)
    assert [i for i, _ in content(t.scan())] == list(range(40))


def test_conflicting_writers(spark, where, monkeypatch):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA)
    real, first = VersionLog.commit, [True]

    def interrupted(self, after, state):
        if first.pop() if first else False:
            KeyedTable(spark, t.path).upsert(frame(spark, [(9, None, "other")]))
        return real(self, after, state)

    monkeypatch.setattr(VersionLog, "commit", interrupted)
    t.upsert(frame(spark, [(1, None, "mine")]))
    assert content(t.scan()) == [(1, "mine"), (9, "other")]
    with pytest.raises(Conflict):
        real(t.log, 1, {})


def test_expiry_and_attributes(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY", ttl_days=1, min_ttl_days=7), {"optimize_for": "scan"})
    t.upsert(frame(spark, [(1, "2014-10-10T10:10:10", "a"), (2, "2030-01-01T00:00:00", "b")]), now="2024-10-10 10:10:10")
    expires = {r.partition: r.expires for r in t.partition_table().collect()}
    assert expires == {"2014-10-10": "2024-10-17 10:10:10+00:00", "2030-01-01": "2030-01-03 00:00:00+00:00"}
    assert t.drop_expired("2024-10-17 10:10:10+00:00") == ["2014-10-10"] and t.partitions() == ["2030-01-01"]
    assert t.attributes() == {"dynamic": True, "optimize_for": "scan"}


def test_no_table(spark, where):
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, f"{where}/nothing").scan()


def test_escaped_partition_folders():
    assert escaped("2024-01-01 10:00:00") == "2024-01-01 10%3A00%3A00"


def test_last_rows_is_decided_by_the_whole_row(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (None, 1, "n")], "k int, o int, v string")
    assert sorted((r.k or 0, r.v) for r in last_rows(df, ["k"], ["o"]).collect()) == [(0, "n"), (1, "b")]


# lookups


def test_lookup_rules(spark):
    dim = spark.createDataFrame([(1, "x", (1,))], "id int, name string, s struct<a:int>")
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert sorted((r.k or 0, r.name) for r in lookup.lookup_join(left, dim, {"k": "id"}, columns=["name"]).collect()) == [(0, None), (1, "x"), (2, None)]
    assert lookup.lookup_join(left, dim, {"k": "id"}, "inner").count() == 1
    for on, args, word in (({"k": "s"}, {}, "nested"), ({"k": "no"}, {}, "no column"), ({"k": "a b"}, {}, "plain"), ({}, {}, "key"), ({"k": "name"}, {"declared_keys": ["id"]}, "SELECT"), ({"k": "id"}, {"how": "outer"}, "left or inner")):
        with pytest.raises(ValueError, match=word):
            lookup.lookup_join(left, dim, on, **args)
    assert lookup.lookup_join(left, dim, {"k": "id"}, columns=["name"], prefix="d_").columns == ["k", "d_name"]


def test_a_key_in_two_partitions_is_an_error_only_if_asked_for(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY"))
    t.upsert(frame(spark, [(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (2, "2024-01-02", "c")]))
    ask = lambda *ids: spark.createDataFrame([(i,) for i in ids], "k long")
    assert [r.v for r in lookup.partitioned_lookup(ask(2), t, {"k": "id"}, columns=["v"]).collect()] == ["c"]
    with pytest.raises(Exception, match="duplicate key in different partitions: 1"):
        lookup.partitioned_lookup(ask(1, 2), t, {"k": "id"}, columns=["v"]).collect()
    assert lookup.partitioned_lookup(ask(1), t, {"k": "id"}, columns=["v"], method="SELECT").count() == 2


def test_caches(spark):
    now, loads = [1_000_000.0], []

    def load():
        loads.append(1)
        return spark.createDataFrame([(len(loads),)], "n int")

    cached = lookup.DimensionCache(load, "FULL", "PERIODIC", dt.timedelta(seconds=10), clock=lambda: now[0])
    assert [cached.get().first()[0], cached.get().first()[0]] == [1, 1]
    now[0] += 10
    assert cached.get().first()[0] == 2
    timed = lookup.DimensionCache(load, "FULL", "TIMED", at="03:00", clock=lambda: now[0])
    timed.get()
    now[0] += 86_400
    assert timed.get().first()[0] == 4
    for bad in (("FULL", None), ("OTHER", None)):
        with pytest.raises(ValueError):
            lookup.DimensionCache(load, *bad)


def asked(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "id long")


def test_partial_cache_looks_up_what_it_has_not(spark):
    now, dim = [1000.0], {1: "a", 2: "b", 3: "c"}
    load = lambda: spark.createDataFrame(list(dim.items()), "id long, v string")
    cache = lookup.DimensionCache(load, "PARTIAL", expire_after_write=dt.timedelta(seconds=100), expire_after_access=dt.timedelta(seconds=40), clock=lambda: now[0])
    get = lambda *keys: content(cache.get(asked(spark, *keys)))
    state = lambda: (cache.loads, cache.looked_up, cache.hits)
    assert get(1, 1, 9, None) == [(1, "a")] and state() == (1, 2, 0)
    dim[1] = "new"
    now[0] += 10
    assert get(1, 9) == [(1, "a")] and state() == (1, 2, 2)  # the row and the miss were kept
    assert get(1, 2) == [(1, "a"), (2, "b")] and state()[:2] == (2, 3)
    now[0] += 39
    assert get(1) == [(1, "a")]
    now[0] += 39
    assert get(1, 2) == [(1, "a"), (2, "b")] and state()[:2] == (3, 4)  # 2 was unused too long
    now[0] += 20
    assert get(1) == [(1, "new")] and state()[:2] == (4, 5)  # 1 was read too long ago
    dim[9] = "late"
    assert get(9) == [(9, "late")]
    assert get() == [] and cache.get(asked(spark)).columns == ["id", "v"]
    cache.clear()
    with pytest.raises(ValueError, match="keys"):
        cache.get()


def test_partial_cache_is_bounded_and_may_forget_misses(spark):
    now = [0.0]
    load = lambda: spark.range(100).select("id", F.col("id").cast("string").alias("v"))
    cache = lookup.DimensionCache(load, "PARTIAL", max_rows=3, missing=False, clock=lambda: now[0])
    get = lambda *keys: [i for i, _ in content(cache.get(asked(spark, *keys)))]
    assert get(1, 2, 3, 4, 5) == [1, 2, 3, 4, 5] and cache._held.count() == 3  # whole results, however small the cache
    now[0] += 1
    assert get(1, 500) == [1] and get(500) == [] and cache.looked_up == 7
    now[0] += 1
    assert get(7) == [7] and {r.id for r in cache._held.collect()} >= {1, 7}
    assert cache._held.count() == 3 and cache.loads == 4


def test_keys_read_their_shards_only(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY"), shards=16)
    t.upsert(frame(spark, [(i, f"2024-01-0{1 + i % 2}T00:00:00", f"v{i}") for i in range(200)]))
    t.upsert(frame(spark, [(3, "2024-01-02T01:00:00", "again")]))
    few = t.of_keys(asked(spark, 3, 4, 3, 999))
    assert content(few) == [(3, "again"), (4, "v4")] and len(few.inputFiles()) <= 8 < len(t.scan().inputFiles())
    assert t.of_keys(asked(spark)).count() == 0 and content(t.of_keys(t.scan(["id"]))) == content(t.scan())
    with pytest.raises(ValueError, match="key columns id"):
        t.of_keys(spark.createDataFrame([("x",)], "v string"))
    table = ConfiguredTable(spark, options_of(proxy="x", path=f"{where}/c", lookup__cache="PARTIAL", reshard__strategy="FIXED", reshard__tablet_count=8, reshard__uniform=True), registry=metrics.Registry())
    table.write(frame(spark, [(i, None, f"v{i}") for i in range(50)]))
    left = spark.createDataFrame([(7,), (8,), (70,)], "k long")
    for looked_up in (3, 3):
        got = table.lookup(left, {"k": "id"}, "left", ["v"]).collect()
        assert sorted((r.k, r.v) for r in got) == [(7, "v7"), (8, "v8"), (70, None)] and table.cache.looked_up == looked_up


def test_retries():
    waits, tries = [], []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "done"

    assert lookup.with_retries(work, sleep=waits.append) == "done" and waits == [10.0, 20.0]
    with pytest.raises(OSError):
        lookup.with_retries(lambda: (_ for _ in ()).throw(OSError()), give_up=lambda: True, sleep=waits.append)
    with pytest.raises(ValueError):  # trying again doesn't help
        lookup.with_retries(lambda: (_ for _ in ()).throw(ValueError()), sleep=waits.append)
    assert waits == [10.0, 20.0]


def test_roots():
    up, now = {"/a": False, "/b": True}, [0.0]
    pick = FirstAvailable({"A": "/a", "b": "/b"}, lambda r: up[r], ["a", "B"], clock=lambda: now[0])
    assert pick.pick() == "B"
    up["/a"] = True
    assert pick.pick() == "B"
    now[0] = 601
    assert pick.pick() == "A"

    def work(root):
        if root == "/a":
            up["/a"] = False
            raise OSError("gone")
        return root

    assert pick.run(work) == "/b"
    with pytest.raises(ValueError):
        pick.run(lambda root: (_ for _ in ()).throw(ValueError()))
    up["/b"] = False
    pick.refresh()
    with pytest.raises(NoRoot):
        pick.pick()
    for priorities in (["a", "A"], ["a"], ["a", "b", "c"]):
        with pytest.raises(ValueError):
            FirstAvailable({"a": "", "b": ""}, lambda r: True, priorities)


def options_of(**raw):
    return TableOptions.parse({"schema": SCHEMA.dump(), **{k.replace("__", ".").replace("_", "-"): v for k, v in raw.items()}})


def test_options_reach_the_table(spark, where):
    own, locks = metrics.Registry(), FileLocks(spark, f"{where}/locks")
    raw = dict(proxy="x", path=f"{where}/t", partition_key="ts", partition_scale="DAY", partition_ttl_day_cnt=100, reshard__strategy="FIXED", reshard__tablet_count=3, reshard__uniform=True, trackable_field="ts", optimize_for="scan")
    table = ConfiguredTable(spark, options_of(**raw), locks, own)
    (done,) = table.write(frame(spark, [(1, "2024-01-01T00:00:00", "a"), (2, "2024-01-02T00:00:00", "b")]), batch=("w", 0))
    assert done.fresh and not table.write(frame(spark, [(1, "2024-01-01T00:00:00", "z")]), batch=("w", 0))[0].fresh
    stored = KeyedTable(spark, TablePath(f"{where}/t"))
    assert content(table.scan()) == content(stored.scan()) == [(1, "a"), (2, "b")]
    assert {(r.n, r.expires[:4]) for r in stored.partition_table().collect()} <= {(3, str(y)) for y in range(2024, 2100)}
    assert stored.attributes()["optimize_for"] == "scan" and not locks.is_locked(stored.path)
    assert (own.table(stored.path).committed_rows, own.table(stored.path).max_tracked) == (2, 1704153600000)
    assert [r.v for r in table.lookup(spark.createDataFrame([(2,), (5,)], "k long"), {"k": "id"}, "inner", ["v"]).collect()] == ["b"]
    with pytest.raises(ValueError, match="SELECT"):
        table.lookup(spark.createDataFrame([("b",)], "k string"), {"k": "v"})


def test_retries_are_those_of_the_options(spark, where, monkeypatch):
    waits, calls = [], []

    def shaky(self, *args, **kwargs):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not now")
        return real(self, *args, **kwargs)

    real = KeyedTable.upsert
    monkeypatch.setattr(KeyedTable, "upsert", shaky)
    patient = ConfiguredTable(spark, options_of(proxy="x", path=f"{where}/a"), registry=metrics.Registry(), sleep=waits.append)
    patient.write(frame(spark, [(1, None, "a")]))
    assert waits == [10.0, 20.0] and content(patient.scan()) == [(1, "a")]
    calls.clear()
    with pytest.raises(OSError):
        ConfiguredTable(spark, options_of(proxy="x", path=f"{where}/b", retry_strategy="NO_RETRY"), registry=metrics.Registry()).write(frame(spark, [(1, None, "a")]))


def test_a_root_that_goes_is_left(spark, where):
    table = ConfiguredTable(spark, options_of(path_map=f"a:{where}/a,b:{where}/b", **{"cluster-pick-strategy.firstAvailable.priorities": "B;A"}), registry=metrics.Registry())
    table.write(frame(spark, [(1, None, "a")]))
    assert table.pick.pick() == "B"
    before = table.scan()
    assert content(before) == [(1, "a")]
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{where}/b")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    assert content(before) == [(1, "a")] and before.count() == 1  # planned for b, read from a
    table.pick.refresh()
    assert content(table.scan(["id", "v"])) == [(1, "a")] and table.pick.pick() == "A" and content(table.scan(limit=1)) == [(1, "a")]


def test_an_action_is_run_again_when_reading_fails(spark, where, tmp_path):
    waits = []
    table = ConfiguredTable(spark, options_of(path_map=f"a:{where}/a,b:{where}/b"), registry=metrics.Registry(), sleep=waits.append)
    table.write(frame(spark, [(1, None, "a"), (2, None, "b")]))
    seen = []

    def count(df):
        seen.append(df.inputFiles()[0])
        if len(seen) == 1:
            shutil.rmtree(tmp_path / "a")
        return df.count()

    assert table.act(count) == 2 and ["/a/" in f for f in seen] == [True, False] and waits == []
    calls = []
    with pytest.raises(ZeroDivisionError):
        table.act(lambda df: calls.append(1) or 1 / 0)
    assert calls == [1] and waits == []


def test_commits_of_so_many_rows(spark, where, monkeypatch):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA, Partitioning("ts", "DAY"), shards=2)
    rows = frame(spark, [(i, f"2024-01-0{1 + i % 2}T00:00:00", f"v{i}") for i in range(25)])
    done = t.upsert(rows, batch=("w", 0), rows_limit=10)
    assert (done.rows, done.version, done.partitions) == (25, 4, ["2024-01-01", "2024-01-02"])
    assert [(r.rows, r.piece, r.pieces, r.batch) for r in t.history().collect()] == [(10, 0, 3, 0), (10, 1, 3, 0), (5, 2, 3, 0)]
    assert t.scan().count() == 25 and [t.scan(version=v).count() for v in (1, 2, 3, 4)] == [0, 10, 20, 25]
    assert not t.upsert(rows, batch=("w", 0), rows_limit=10).fresh and len(t.log.versions()) == 4
    # a batch that failed after its first piece goes on with the second
    real, n = VersionLog.commit, []

    def failing(self, after, change):
        n.append(1)
        if len(n) == 2:
            raise OSError("no")
        return real(self, after, change)

    monkeypatch.setattr(VersionLog, "commit", failing)
    more = frame(spark, [(100 + i, "2024-01-03T00:00:00", "x") for i in range(20)])
    with pytest.raises(OSError) as e:
        t.upsert(more, batch=("w", 1), rows_limit=8)
    assert e.value.rows_seen == 20 and t.scan().count() == 33
    assert t.upsert(more, batch=("w", 1), rows_limit=8).fresh and t.scan().count() == 45
    assert [r.rows for r in t.history().collect()][3:] == [8, 8, 4]
    with pytest.raises(TimeoutError):
        t.upsert(more, timeout=-1)
    assert t.scan().count() == 45


def test_commits_name_the_modifications_of_their_rows(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(PLAIN, Partitioning("ts", "DAY"))
    rows = frame(spark, [(i, f"2024-01-0{1 + i % 2}T00:00:00", f"v{i}") for i in range(25)])
    t.upsert(rows, batch=("w", 0), rows_limit=10, modification_limit=4)
    t.upsert(rows, batch=("w", 1))
    t.upsert(rows.limit(5), batch=("w", 2), rows_limit=10, modification_limit=4)
    got = sorted((r.piece, r.modification, r.rows) for r in t.modifications().where("version < 6").collect())
    assert got == [(0, 0, 4), (0, 1, 4), (0, 2, 2), (1, 0, 4), (1, 1, 4), (1, 2, 2), (2, 0, 4), (2, 1, 1)]
    assert sorted((r.modification, r.rows) for r in t.modifications().where("version > 5").collect()) == [(0, 4), (1, 1)]
    t.vacuum()
    assert t.modifications().count() == 10 and t.scan().count() == 55
    table = ConfiguredTable(spark, options_of(proxy="x", path=f"{where}/o", rows_in_transaction_limit=4, rows_in_modification_limit=3), registry=metrics.Registry())
    table.write(frame(spark, [(i, None, "a") for i in range(9)]), batch=("w", 3))
    assert sorted((r.piece, r.modification, r.rows) for r in KeyedTable(spark, TablePath(f"{where}/o")).modifications().collect()) == [(0, 0, 3), (0, 1, 1), (1, 0, 3), (1, 1, 1), (2, 0, 1)]


def test_a_commit_costs_what_it_adds(spark, where, monkeypatch):
    real, listed = JvmFiles.names, []
    monkeypatch.setattr(JvmFiles, "names", lambda self, folder: listed.append(folder) or real(self, folder))
    monkeypatch.setattr(KeyedTable, "compact", lambda *_: 0)
    rows = [(i, None, f"v{i}") for i in range(200)]
    t = KeyedTable(spark, TablePath(where, "plain"))
    t.create(PLAIN, shards=8)
    listed.clear()
    t.upsert(frame(spark, rows), batch=("w", 0), rows_limit=5)
    assert len(listed) <= 3  # not one for each of 40 commits
    sizes = [len(t.files.read(f"{t.log.folder}/v{v:09d}.json")) for v in t.log.versions()]
    assert len(sizes) == 41 and sizes[-1] < 1.3 * sizes[2]
    state = t.state()[1]["partitions"]["all"]
    assert state["rows"] == 200 and len(state["paths"]) == len(state["holds"]) == 40
    assert state == KeyedTable(spark, TablePath(where, "plain")).state()[1]["partitions"]["all"]
    found = list(Path(t.path.removeprefix("file://")).glob("data/*/*/*/*/*.parquet"))
    assert len(found) <= 40 + 8  # not 40 times 8
    assert sorted(r.id for r in t.scan().collect()) == list(range(200))
    assert sorted(r.id for s in range(8) for r in t._rows(t.state()[1], ["all"], None, [s]).collect()) == list(range(200))
    # the pieces of one write share no key: they are read as one folder, without an aggregation
    k = KeyedTable(spark, TablePath(where, "keyed"))
    k.create(SCHEMA, shards=2)
    k.upsert(frame(spark, rows), batch=("w", 0), rows_limit=20)
    assert "Aggregate" not in k.scan()._jdf.queryExecution().executedPlan().toString() and k.scan().count() == 200
    k.upsert(frame(spark, [(i, None, "new") for i in range(50)]), batch=("w", 1), rows_limit=20)
    assert content(k.scan()) == sorted((i, "new" if i < 50 else f"v{i}") for i in range(200))


def test_option_limits_reach_commits(spark, where):
    own = metrics.Registry()
    table = ConfiguredTable(spark, options_of(proxy="x", path=f"{where}/t", rows_in_transaction_limit=4), registry=own)
    table.write(frame(spark, [(i, None, "a") for i in range(9)]), batch=("w", 3))
    stored = KeyedTable(spark, TablePath(f"{where}/t"))
    assert [r.rows for r in stored.history().collect()] == [4, 4, 1] and own.table(stored.path).committed_rows == 9
    with pytest.raises(TimeoutError):
        ConfiguredTable(spark, options_of(proxy="x", path=f"{where}/t", transaction_timeout="0 ms", retry_strategy="NO_RETRY"), registry=own).write(frame(spark, [(1, None, "b")]))
    assert (own.table(stored.path).committed_rows, own.table(stored.path).failed_rows) == (9, 1)


def test_conflicts_write_data_once(spark, where, monkeypatch, tmp_path):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(SCHEMA)
    real, left = VersionLog.commit, [3]

    def busy(self, after, change):
        if left[0] and change.get("commit", {}).get("batch") == ["w", 0]:
            left[0] -= 1
            real(self, after, {"partitions": {}})
        return real(self, after, change)

    monkeypatch.setattr(VersionLog, "commit", busy)
    assert t.upsert(frame(spark, [(1, None, "a")]), batch=("w", 0)).version == 5
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1 and content(t.scan()) == [(1, "a")]


def test_credentials_come_from_the_named_source(spark, where, monkeypatch):
    raw = {"proxy": "x", "path": f"{where}/t", "username": "u", "token": "t0", "properties.hadoop.fs.test.secret": "{username}:{token}"}
    conf = spark._jsc.hadoopConfiguration()
    ConfiguredTable(spark, options_of(**raw), registry=metrics.Registry())
    assert conf.get("fs.test.secret") is None
    ConfiguredTable(spark, options_of(**raw, credentials_source="OPTIONS"), registry=metrics.Registry())
    assert conf.get("fs.test.secret") == "u:t0"
    monkeypatch.setitem(credentials.SOURCES, "vault", lambda options: {"fs.test.secret": options["username"] + "-from-vault"})
    ConfiguredTable(spark, options_of(**raw, credentials_source="vault"), registry=metrics.Registry())
    assert conf.get("fs.test.secret") == "u-from-vault"
    conf.unset("fs.test.secret")
    with pytest.raises(ValueError, match="no credentials source 'nowhere'"):
        ConfiguredTable(spark, options_of(**raw, credentials_source="nowhere"), registry=metrics.Registry())


HASHED = TableSchema.parse('<strict=%true;unique_keys=%true>[{name=hash;type=uint64;sort_order=ascending;expression="farm_hash(id)"};{name=id;type=int64;sort_order=ascending};{name=ts;type=timestamp};{name=v;type=string}]')


def test_computed_columns_are_stored_and_sorted_by(spark, where):
    t = KeyedTable(spark, TablePath(where, "t"))
    t.create(HASHED, shards=2)
    t.upsert(frame(spark, [(i, None, f"v{i}") for i in range(50)]))
    t.upsert(frame(spark, [(7, None, "again")]))
    assert t.scan().columns == ["id", "ts", "v"] and dict(content(t.scan()))[7] == "again"
    rows = t.scan(["hash", "id"]).collect()
    want = {r.id: r.h % 2**64 for r in spark.range(50).select("id", F.xxhash64("id").alias("h")).collect()}
    assert {r["id"]: int(r["hash"]) for r in rows} == want
    for path in t.scan().inputFiles():
        hashes = [int(r[0]) for r in spark.read.parquet(path).select("hash").collect()]
        assert hashes == sorted(hashes)
    point = t.point({"id": 8})
    assert content(point) == [(8, "v8")] and f"EqualTo(hash,{want[8]})" in point._jdf.queryExecution().executedPlan().toString()


def test_mount_states(spark, where, monkeypatch):
    raw = dict(proxy="x", path=f"{where}/t")
    made = ConfiguredTable(spark, options_of(**raw, mount_mode="ON_CREATE"), registry=metrics.Registry())
    made.write(frame(spark, [(1, None, "a")]))  # whoever creates a table mounts it
    t = KeyedTable(spark, TablePath(f"{where}/t"))
    t.unmount()
    with pytest.raises(NotMounted):
        t.upsert(frame(spark, [(2, None, "b")]))
    assert content(t.scan()) == [(1, "a")]
    slept = []
    assert not t.wait_mounted(2, 1, slept.append) and slept == [1, 1]  # it only warns
    monkeypatch.setattr(KeyedTable, "wait_mounted", lambda self: slept.append("waited"))
    with pytest.raises(NotMounted):  # ON_CREATE doesn't mount what another has made
        ConfiguredTable(spark, options_of(**raw, mount_mode="ON_CREATE"), registry=metrics.Registry()).write(frame(spark, [(2, None, "b")]))
    assert slept[-1] == "waited"
    ConfiguredTable(spark, options_of(**raw), registry=metrics.Registry()).write(frame(spark, [(2, None, "b")]))
    assert t.mounted() == "mounted" and content(t.scan()) == [(1, "a"), (2, "b")]
    t.unmount()
    real = VersionLog.commit

    def taken(self, after, change):
        raise Conflict("taken")

    monkeypatch.setattr(VersionLog, "commit", taken)
    waits = []
    with pytest.raises(NotMounted, match="5 attempts"):
        t.mount(sleep=waits.append)
    assert waits == [5.0] * 5
    monkeypatch.setattr(VersionLog, "commit", real)
    t.mount()
    assert t.mounted() == "mounted"


# metrics, batches, locks, generators


def test_metrics_are_published_with_the_commit(spark):
    own = metrics.Registry()
    df = frame(spark, [(10, "2024-01-01T00:00:00.000999", "a"), (20, None, "b")])
    metrics.observed_write(df, lambda d: d.collect(), "t", "ts", {"event": "id"}, own)
    m = own.table("t")
    assert (m.committed_rows, m.max_tracked, m.maxima) == (2, 1704067200000, {"event": 20})
    metrics.observed_write(df.where("id = 10"), lambda d: d.collect(), "t", "ts", {"event": "id"}, own)
    assert (m.committed_rows, m.maxima) == (3, {"event": 10})
    with pytest.raises(OSError):
        metrics.observed_write(df, lambda d: (_ for _ in ()).throw(OSError()), "t", registry=own)
    assert (m.committed_rows, m.failed_rows) == (3, 2)
    with pytest.raises(ValueError):
        metrics.metric_columns(df, "v")
    with pytest.raises(ValueError):
        metrics.metric_columns(df, maxima={"x": "v"})


def test_rows_are_numbered_in_order(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k"), F.uuid().alias("more")).repartition(7)
    with batches.numbered(df, ["k"]) as rows:
        assert all(r.k == r.n for r in rows.collect())


def test_locks(spark, where):
    assert choose("unknown").name == "noop" and not NoLocks().is_locked("x")
    locks = FileLocks(spark, f"{where}/locks")
    with locked(locks, "/t", Mode.SHARED):
        with locked(locks, "/t", Mode.SHARED), pytest.raises(LockError):
            locks.acquire("/t", Mode.EXCLUSIVE)
        assert locks.is_locked("/t") and not locks.is_locked("/other")
    assert not locks.is_locked("/t")
    lock = locks.acquire("/t", Mode.EXCLUSIVE)
    locks.renew(lock)
    with pytest.raises(LockError):
        locks.acquire("/t", Mode.SHARED)
    with pytest.raises(LockError):
        do_unless(locks, "/t", lambda: False, lambda: None, attempts=2, wait=0)
    assert not do_unless(locks, "/t", lambda: True, lambda: None)
    locks.release(lock)
    done = []
    assert do_unless(locks, "/t", lambda: bool(done), lambda: done.append(1)) and not locks.is_locked("/t")
    with pytest.raises(ZeroDivisionError):
        do_unless(locks, "/t", lambda: False, lambda: 1 / 0)
    assert not locks.is_locked("/t")


def test_locks_made_at_once_see_each_other(spark, where, monkeypatch):
    """A shared lock that is made between an exclusive request's look and its file, and the other way round."""
    locks = FileLocks(spark, f"{where}/locks")
    real, met = FileLocks._made, []

    def meeting(self, name):
        if not met:
            met.append(name)
            # the other one comes first, after this one has looked
            met.append(locks.acquire("/t", Mode.SHARED if name.endswith(".x") else Mode.EXCLUSIVE))
        return real(self, name)

    monkeypatch.setattr(FileLocks, "_made", meeting)
    for mode in (Mode.EXCLUSIVE, Mode.SHARED):
        met.clear()
        with pytest.raises(LockError):
            locks.acquire("/t", mode)
        locks.release(met[1])
        assert not locks.is_locked("/t")


def test_a_lease_is_renewed_as_long_as_the_work_lasts(spark, where):
    locks = FileLocks(spark, f"{where}/locks", lease=1.0)
    with locked(locks, "/t", Mode.SHARED) as lock:
        time.sleep(2.5)
        with pytest.raises(LockError):
            locks.acquire("/t", Mode.EXCLUSIVE)
    assert not locks.is_locked("/t")
    with pytest.raises(LockError, match="lease"):
        locks.renew(lock)
    gone = locks.acquire("/t", Mode.EXCLUSIVE)
    time.sleep(1.2)
    assert locks.acquire("/t", Mode.SHARED) and gone  # an ended lease holds nobody up
    by_option = choose("file", spark, {"locks.file.folder": f"{where}/own", "locks.file.lease": "7", "locks.other.x": "1"})
    assert (by_option.folder, by_option.lease) == (f"{where}/own", 7.0)


def test_generated_rows_repeat(spark):
    s = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("ok", T.BooleanType())])
    fields = {"id": generate.Sequence(1, 3), "name": generate.Random(length=150), "x": generate.Random(5, 6)}
    a, b = (generate.rows(spark, s, fields, 10).collect() for _ in range(2))
    assert a == b and [r.id for r in a] == [1, 2, 3] * 3 + [1]
    assert all(len(r.name) == 150 and 5 <= r.x < 6 for r in a)


def test_generated_stream_into_a_table(spark, where):
    """A short run of the endless generator, then a running count of the table's stream of words."""
    s = generate.stream(spark, T.StructType([T.StructField("id", T.LongType())]), {"id": generate.Sequence()}, rows_per_second=100)
    name = f"made_{uuid.uuid4().hex}"
    q = s.writeStream.format("memory").queryName(name).start()
    q.awaitTermination(4)
    q.processAllAvailable()
    q.stop()
    got = sorted(r[0] for r in spark.table(name).collect())
    assert got and got == list(range(len(got)))
