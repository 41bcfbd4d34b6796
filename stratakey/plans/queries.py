"""One query for each operator, on the benchmark tables, with the SQL that must give the same rows.

A query is (Spark callable, SQL or None). The SQL is DuckDB's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config.options import TableOptions
from ..functions import codecs, partition, rowtext, scalar, shard
from ..operators import lookup, metrics
from ..schema import TableSchema
from ..sources import generate
from ..sources.configured import ConfiguredTable
from ..sources.files import JvmFiles, shared_path
from ..sources.format import register
from ..sources.roots import FirstAvailable, path_exists
from ..sources.table import KeyedTable, NotMounted, Partitioning, TablePath, last_rows
from ..streaming import sink

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
NTZ = T.TimestampNTZType()


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# scans


@query("select event_id, user_id, value from events")
def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only three columns are read."""
    return read(spark, sf_dir, "events").select("event_id", "user_id", "value")


@query("select least(count(*), 100)::bigint as n from events")
def scan_limit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a limit takes is open, how many is not."""
    return read(spark, sf_dir, "events").limit(100).agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, user_id from events where user_id = 3 and event_type = 'click'")
def point_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated select; both predicates reach the scan."""
    return lookup.point_select(read(spark, sf_dir, "events"), {"user_id": 3, "event_type": "click"}, ["event_id", "user_id"])


@query("select event_id, user_id, event_type, timestamp '2024-02-01 00:00:00' as updated_at from events")
def insert_select_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-select with an added time, written to a table and read again."""
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    table = KeyedTable(spark, TablePath(shared_path(spark, "insert"), "events"))
    table.create(TableSchema.from_struct(rows.schema, ["event_id"]))
    table.upsert(rows)
    return table.scan()


@query("select event_id, ts, value from events where ts >= timestamp '2024-01-05 00:00:00' and ts < timestamp '2024-01-08 12:00:00'")
def scan_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of the partition key reads only the partitions that overlap it."""
    return events_by_day(spark, sf_dir).scan(["event_id", "ts", "value"], between=("2024-01-05 00:00:00", "2024-01-08 12:00:00"))


@query("select count(*)::bigint as n, min(id) as first_id, max(id) as last_id, sum(case when g between 0 and 9 then 0 else 1 end)::bigint as outside from (select row_number() over () - 1 as id, 5 as g from events)")
def generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows as there are events, with a sequence and a random field."""
    struct = T.StructType([T.StructField("id", T.LongType()), T.StructField("g", T.IntegerType())])
    df = generate.rows(spark, struct, {"id": generate.Sequence(0), "g": generate.Random(0, 10)}, read(spark, sf_dir, "events").count())
    return df.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.sum(F.when(F.col("g").between(0, 9), 0).otherwise(1)).alias("outside"))


# the format


def events_by_id(spark: SparkSession, sf_dir: str, shards: int = 64) -> str:
    """The path of a table of the events by event_id."""
    register(spark)
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    path = TablePath(shared_path(spark, "events"))
    table = KeyedTable(spark, path)
    table.create(TableSchema.from_struct(rows.schema, ["event_id"]), shards=shards)
    table.upsert(rows)
    return path.base


@query("select event_id, user_id, value from events")
def scan_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read by its format and options only; the schema names the columns that are read."""
    path = events_by_id(spark, sf_dir, 8)
    return spark.read.format("stratakey").schema("event_id long, user_id long, value double").load(path)


@query("select event_id, user_id, event_type from events where event_id = 77")
def point_select_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison is pushed into the format, which reads one file of 64."""
    return spark.read.format("stratakey").option("filters", "pushed").load(events_by_id(spark, sf_dir)).where("event_id = 77").select("event_id", "user_id", "event_type")


@query("select event_id, user_id, event_type from events where event_id = 77")
def point_lookup_of_a_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the table, without Python."""
    return KeyedTable(spark, TablePath(events_by_id(spark, sf_dir))).point({"event_id": 77}, ["event_id", "user_id", "event_type"])


# lookups

_ORDERS_CUSTOMER = "select o_orderkey, o_custkey, o_totalprice, c_name, c_acctbal from orders {} join customer on o_custkey = c_custkey"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query(_ORDERS_CUSTOMER.format("left"))
def lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3, J1, J2, J8."""
    return lookup.lookup_join(orders(spark, sf_dir), read(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, "left", ["c_name", "c_acctbal"], declared_keys=["c_custkey"])


@query(_ORDERS_CUSTOMER.format("inner"))
def lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1."""
    return lookup.lookup_join(orders(spark, sf_dir), read(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, "inner", ["c_name", "c_acctbal"])


@query("select l.l_orderkey, l.l_linenumber, d.top_price from lineitem l left join (select l_orderkey, l_linenumber, max(l_extendedprice) as top_price from lineitem where l_linenumber <= 3 group by 1, 2) d using (l_orderkey, l_linenumber)")
def lookup_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 with two key columns."""
    li = read(spark, sf_dir, "lineitem")
    dim = li.where("l_linenumber <= 3").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("top_price"))
    keys = ["l_orderkey", "l_linenumber"]
    return lookup.lookup_join(li.select(*keys), dim, {k: k for k in keys}, "left", declared_keys=keys)


@query("select n_nationkey, n_name, s_suppkey, s_name from nation left join supplier on n_nationkey = s_nationkey")
def lookup_select_nonkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By a column that is no key; several rows may be found."""
    return lookup.lookup_join(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), read(spark, sf_dir, "supplier"), {"n_nationkey": "s_nationkey"}, "left", ["s_suppkey", "s_name"], lookup.SELECT, ["s_suppkey"])


def events_by_day(spark: SparkSession, sf_dir: str) -> KeyedTable:
    rows = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    table = KeyedTable(spark, TablePath(shared_path(spark, "events"), "by_day"))
    table.create(TableSchema.from_struct(rows.schema, ["event_id"]), Partitioning("ts", "DAY", ttl_days=30))
    table.upsert(rows, ["ts"])
    return table


@query("select a.event_id, b.user_id, b.value from (select event_id from events union all select -1) a left join events b using (event_id)")
def lookup_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all partitions of a table; a key in two partitions would be an error."""
    asked = read(spark, sf_dir, "events").select("event_id").union(spark.sql("select -1L"))
    return lookup.partitioned_lookup(asked, events_by_day(spark, sf_dir), {"event_id": "event_id"}, "left", ["user_id", "value"])


def _through_cache(spark: SparkSession, sf_dir: str, cache: lookup.DimensionCache) -> DataFrame:
    rows, out = orders(spark, sf_dir), None
    for half in (rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 <> 0")):
        asked = half.select(F.col("o_custkey").alias("c_custkey"))
        got = lookup.lookup_join(half, cache.get(asked), {"o_custkey": "c_custkey"}, "left", ["c_name", "c_acctbal"])
        out = got if out is None else out.union(got)
    return out


@query(_ORDERS_CUSTOMER.format("left"))
def lookup_full_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: two lookups of one cached dimension."""
    return _through_cache(spark, sf_dir, lookup.DimensionCache(lambda: read(spark, sf_dir, "customer"), "FULL", "PERIODIC", timedelta(minutes=10)))


@query(_ORDERS_CUSTOMER.format("left"))
def lookup_partial_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: a bounded cache of the keys asked for; the second lookup reads only those that the first has not brought."""
    return _through_cache(spark, sf_dir, lookup.DimensionCache(lambda: read(spark, sf_dir, "customer"), "PARTIAL", expire_after_write=timedelta(minutes=10), max_rows=1_000))


@query(_ORDERS_CUSTOMER.format("left"))
def lookup_no_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1."""
    return _through_cache(spark, sf_dir, lookup.DimensionCache(lambda: read(spark, sf_dir, "customer")))


@query(_ORDERS_CUSTOMER.format("left"))
def lookup_first_available_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first root is missing, so the second serves the lookup."""
    pick = FirstAvailable({"near": f"{sf_dir}/no-such-root", "far": sf_dir}, path_exists(spark), ["NEAR", "far"])
    return pick.run(lambda root: lookup.lookup_join(orders(spark, sf_dir), read(spark, root, "customer"), {"o_custkey": "c_custkey"}, "left", ["c_name", "c_acctbal"]))


def streamed(spark: SparkSession, sf_dir: str, table: str, max_files: int = 1) -> DataFrame:
    schema = read(spark, sf_dir, table).schema
    return sink.read_table_stream(spark.readStream, sf_dir, table, schema, maxFilesPerTrigger=max_files)


@query("select event_id, user_id, c_name from events left join customer on user_id = c_custkey")
def lookup_stream_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream looks up a dimension that is read with each micro-batch."""
    out = shared_path(spark, "lookup-stream")
    cache = lookup.DimensionCache(lambda: read(spark, sf_dir, "customer"))
    q = sink.start_lookup(streamed(spark, sf_dir, "events").select("event_id", "user_id"), cache, {"user_id": "c_custkey"}, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/data/batch={n}"), f"{out}/checkpoint", columns=["c_name"])
    q.awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id", "c_name")


def configured(spark: SparkSession, rows: DataFrame, keys: list[str], **options: object) -> ConfiguredTable:
    raw = {"proxy": "local", "path": shared_path(spark, "configured"), "schema": TableSchema.from_struct(rows.schema, keys).dump()}
    raw |= {k.replace("__", ".").replace("_", "-"): v for k, v in options.items()}
    if "path-map" in raw:
        del raw["proxy"], raw["path"]
    return ConfiguredTable(spark, TableOptions.parse(raw, rows.schema), registry=metrics.Registry())


@query(_ORDERS_CUSTOMER.format("left"))
def configured_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made, sharded, written and looked up as its options say."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    table = configured(spark, customers, ["c_custkey"], reshard__strategy="FIXED", reshard__tablet_count=4, reshard__uniform=True, lookup__cache="FULL", lookup__full_cache__reload_strategy="PERIODIC", retry_strategy="EXPONENTIAL")
    table.write(customers, batch=("load", 0))
    return table.lookup(orders(spark, sf_dir), {"o_custkey": "c_custkey"}, "left", ["c_name", "c_acctbal"])


@query("select event_id, user_id, value from events")
def scan_first_available_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to two roots; one goes, and the other is read."""
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "value")
    near, far = shared_path(spark, "near"), shared_path(spark, "far")
    table = configured(spark, rows, ["event_id"], path_map=f"near:{near},far:{far}")
    table.write(rows)
    gone = spark._jvm.org.apache.hadoop.fs.Path(near)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return table.scan()


@query("select user_id, event_id, value from (select *, row_number() over (partition by user_id, strftime(ts, '%Y-%m-%d') order by ts desc, event_id desc) as r from events) where r = 1")
def configured_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a table partitioned as its options say, shards after the last partitions."""
    rows = streamed(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    table = configured(spark, rows, ["user_id"], partition_key="ts", partition_scale="DAY", reshard__strategy="LAST_PARTITIONS", reshard__tablet_count=2, reshard__uniform=True, trackable_field="ts")
    table.start(rows, shared_path(spark, "checkpoint"), "w", ["ts", "event_id"], drain=True).awaitTermination()
    return table.scan(["user_id", "event_id", "value"])


@query("select event_id, user_id, value from events")
def scan_of_a_lost_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned and read under one root, which then goes; the same DataFrame reads the other."""
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "value")
    near, far = shared_path(spark, "near"), shared_path(spark, "far")
    table = configured(spark, rows, ["event_id"], path_map=f"near:{near},far:{far}")
    table.write(rows, batch=("load", 0))
    df = table.scan()
    df.count()
    JvmFiles(spark).delete(near)
    return df


# upserts

_LAST = "select user_id, event_id, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1"
_LAST_BY_DAY = "select user_id, ts, event_id, value from (select *, row_number() over (partition by user_id, strftime(ts, '%Y-%m-%d') order by ts desc, event_id desc) as r from events) where r = 1"


@query(_LAST)
def upsert_last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes to one table, the later events last."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    table = KeyedTable(spark, TablePath(shared_path(spark, "upsert"), "users"))
    table.create(TableSchema.from_struct(rows.schema, ["user_id"]), shards=4)
    for part in (rows.where("ts < timestamp_ntz'2024-01-15 00:00:00'"), rows.where("ts >= timestamp_ntz'2024-01-15 00:00:00'")):
        table.upsert(part, ["ts", "event_id"])
    return table.scan(["user_id", "event_id", "value"])


@query(_LAST)
def last_rows_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 as one aggregation."""
    return last_rows(read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


def _users_by_day(spark: SparkSession, label: str) -> KeyedTable:
    table = KeyedTable(spark, TablePath(shared_path(spark, label), "users"))
    struct = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("ts", NTZ), T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    table.create(TableSchema.from_struct(struct, ["user_id"]), Partitioning("ts", "DAY"))
    return table


@query(_LAST_BY_DAY)
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key is unique within its day."""
    table = _users_by_day(spark, "upsert-days")
    table.upsert(read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value"), ["ts", "event_id"])
    return table.scan()


@query(_LAST_BY_DAY)
def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream, one commit a micro-batch."""
    table = _users_by_day(spark, "upsert-stream")
    rows = streamed(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    sink.start_upsert(rows, table, f"{table.path}/checkpoint", "stream", ["ts", "event_id"]).awaitTermination()
    return table.scan()


@query("select count(*)::bigint as committed_rows, max(epoch_us(ts) // 1000)::bigint as max_tracked, max(event_id)::bigint as max_event, 0::bigint as replayed from events")
def commit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A3, A4, M3: metrics of a commit; a replay of the same batch adds nothing."""
    rows = read(spark, sf_dir, "events").select("event_id", "ts", "value")
    table = KeyedTable(spark, TablePath(shared_path(spark, "metrics"), "events"))
    table.create(TableSchema.from_struct(rows.schema, ["event_id"]))
    own = metrics.Registry()
    write = sink.upsert_batches(table, "w", ["ts"], "ts", {"event": "event_id"}, own)
    write(rows, 0)
    first = own.table(table.path).committed_rows
    write(rows, 0)
    m = own.table(table.path)
    return spark.createDataFrame([(m.committed_rows, m.max_tracked, m.maxima["event"], m.committed_rows - first)], "committed_rows long, max_tracked long, max_event long, replayed long")


@query("select max(epoch_us(ts) // 1000)::bigint as tracked from events")
def tracked_field_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3."""
    df = read(spark, sf_dir, "events")
    return df.agg(F.max(metrics.tracked_millis(df, "ts")).alias("tracked"))


@query("select event_type, max(event_id) as max_event from events group by event_type")
def data_metrics_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 for each type."""
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.max("event_id").alias("max_event"))


@query("select t as transaction, m as modification, count(*)::bigint as n_rows from (select n // 99000 as t, (n - n // 99000 * 99000) // 1000 + n // 99000 * 99 as m from (select row_number() over (order by l_orderkey, l_linenumber) - 1 as n from lineitem)) group by 1, 2")
def commit_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One write, cut into commits of at most rows-in-transaction-limit rows and these into modifications, as the table has them."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    table = configured(spark, rows, [], rows_in_transaction_limit=99_000, rows_in_modification_limit=1_000)
    table.write(rows, batch=("load", 0))
    done = table.table(table.options["path"]).modifications()
    # a full transaction has 99 modifications
    return done.select(F.col("piece").alias("transaction"), (F.col("modification") + F.col("piece") * 99).alias("modification"), F.col("rows").alias("n_rows"))


@query(_LAST)
def upsert_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes by format and options only, the later events last; the last row of a key is found when it is read."""
    register(spark)
    rows, path = read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts"), shared_path(spark, "by-format")
    options = {"schema": TableSchema.from_struct(rows.schema, ["user_id"]).dump(), "order-by": "ts,event_id", "reshard.strategy": "FIXED", "reshard.tablet-count": "4", "reshard.uniform": "true"}
    for part in (rows.where("ts < timestamp_ntz'2024-01-15 00:00:00'"), rows.where("ts >= timestamp_ntz'2024-01-15 00:00:00'")):
        part.write.format("stratakey").mode("append").options(**options).save(path)
    return spark.read.format("stratakey").schema("user_id long, event_id long, value double").load(path)


@query(_LAST)
def stream_by_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the versions of one table added streams into another, both by format."""
    register(spark)
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts")
    source, target = TablePath(shared_path(spark, "source")), TablePath(shared_path(spark, "target"))
    for path, key in ((source, "event_id"), (target, "user_id")):
        KeyedTable(spark, path).create(TableSchema.from_struct(rows.schema, [key]), shards=4)
    KeyedTable(spark, source).upsert(rows)
    stream = spark.readStream.format("stratakey").load(source.base).writeStream.format("stratakey").outputMode("append")
    stream.options(**{"writer": "w", "order-by": "ts,event_id", "checkpointLocation": f"{target.base}-checkpoint"}).trigger(availableNow=True).start(target.base).awaitTermination()
    return KeyedTable(spark, target).scan(["user_id", "event_id", "value"])


@query("select p_partkey, p_name, p_retailprice from part")
def write_schema_drop_computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A computed key column is evaluated at the write and sorts the files; it isn't among the columns that are written or scanned."""
    table = KeyedTable(spark, TablePath(shared_path(spark, "computed")))
    table.create(TableSchema.parse('<strict=%true;unique_keys=%true>[{name=hash;type=uint64;sort_order=ascending;expression="farm_hash(p_partkey)"};{name=p_partkey;type=int64;sort_order=ascending};{name=p_name;type=string};{name=p_retailprice;type=double}]'), shards=4)
    table.upsert(read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"))
    return table.scan()


@query("select event_id, value, 1::integer as refused from events")
def upsert_when_mounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unmounted table refuses a write; mount-mode ALWAYS mounts it and writes."""
    rows = read(spark, sf_dir, "events").select("event_id", "value")
    table = configured(spark, rows, ["event_id"], mount_mode="ALWAYS")
    stored = table.table(table.options["path"])
    stored.unmount()
    try:
        stored.upsert(rows)
        refused = 0
    except NotMounted:
        refused = 1
    table.write(rows)
    return table.scan().withColumn("refused", F.lit(refused))


# partitions


def _named(table: str, ts: str, scale: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(spark, sf_dir, table).groupBy(partition.name(partition.instant(F.col(ts)), scale).alias("p")).agg(F.count(F.lit(1)).alias("n"))

    return run


for _scale, _unit, _fmt, _table, _ts in (
    ("HOUR", "hour", "%Y-%m-%d %H:%M:%S", "events", "ts"),
    ("HOUR_T", "hour", "%Y-%m-%dT%H:%M:%S", "events", "ts"),
    ("DAY", "day", "%Y-%m-%d", "orders", "o_orderdate"),
    ("WEEK", "week", "%Y-%m-%d", "orders", "o_orderdate"),
    ("MONTH", "month", "%Y-%m-%d", "orders", "o_orderdate"),
    ("SHORT_MONTH", "month", "%Y-%m", "orders", "o_orderdate"),
    ("YEAR", "year", "%Y-%m-%d", "orders", "o_orderdate"),
    ("SHORT_YEAR", "year", "%Y", "orders", "o_orderdate"),
):
    QUERIES[f"partition_{_scale.lower()}"] = _named(_table, _ts, _scale)
    SQL[f"partition_{_scale.lower()}"] = f"select strftime(date_trunc('{_unit}', {_ts}::timestamp), '{_fmt}') as p, count(*)::bigint as n from {_table} group by 1"


@query("select o_orderkey, date_trunc('week', o_orderdate)::timestamp as p_start, date_trunc('week', o_orderdate)::timestamp + interval 7 day as p_end from orders")
def partition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10."""
    ts = partition.instant(F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").select("o_orderkey", partition.start(ts, "WEEK").alias("p_start"), partition.end(ts, "WEEK").alias("p_end"))


@query("select distinct strftime(o_orderdate, '%Y-%m') as p, date_trunc('month', o_orderdate)::timestamp as p_start from orders")
def partition_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T11."""
    names = read(spark, sf_dir, "orders").select(partition.name(F.col("o_orderdate"), "SHORT_MONTH").alias("p")).distinct()
    return names.select("p", partition.parse(F.col("p"), "SHORT_MONTH").alias("p_start"))


@query("select o_orderkey, strftime(greatest(date_trunc('month', o_orderdate) + interval 1 month + interval 30 day, timestamp '1998-01-01 00:00:00' + interval 20 day), '%Y-%m-%d %H:%M:%S') || '+00:00' as expires from orders")
def partition_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12, T13."""
    now = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    e = partition.expiry(partition.instant(F.col("o_orderdate")), "MONTH", now, ttl_days=30)
    return read(spark, sf_dir, "orders").select("o_orderkey", partition.expiry_text(e).alias("expires"))


@query("select count(*)::bigint as n from events where strftime(ts, '%Y-%m-%d') >= '2024-01-11'")
def partition_ttl_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12 at work: partitions whose time has come leave the table."""
    rows = read(spark, sf_dir, "events").select("event_id", "ts")
    table = KeyedTable(spark, TablePath(shared_path(spark, "ttl"), "events"))
    table.create(TableSchema.from_struct(rows.schema, ["event_id"]), Partitioning("ts", "DAY", ttl_days=10, min_ttl_days=None))
    table.upsert(rows, now="2024-01-01 00:00:00")
    table.drop_expired("2024-01-21 00:00:00+00:00")
    return table.scan().agg(F.count(F.lit(1)).alias("n"))


# shards


@query("select i::integer as shard, ((18446744073709551616::hugeint * i) // n)::varchar as pivot, case when (18446744073709551616::hugeint * i) // n < 9223372036854775808::hugeint then ((18446744073709551616::hugeint * i) // n)::bigint else ((18446744073709551616::hugeint * i) // n - 18446744073709551616::hugeint)::bigint end as pivot_signed from (select unnest(range(count(*))) as i, any_value(c) as n from supplier, (select count(*) as c from supplier))")
def shard_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: a shard for each supplier."""
    return shard.pivot_table(spark, read(spark, sf_dir, "supplier").count()).withColumn("pivot", F.col("pivot").cast("string"))


@query("select coalesce(cast(floor(avg(n)) as integer), 20) as shards from (select p, n from (select strftime(ts, '%Y-%m-%d') as p, count(*) as n from events group by 1) order by p desc limit 7) where p <> '2024-01-30' and n > 0")
def shard_last_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, H3, W1."""
    days = read(spark, sf_dir, "events").groupBy(partition.name(F.col("ts"), "DAY").alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return shard.last_partitions_count(days, "2024-01-30", 7, 20)


@query("select event_id, (event_id * 7 // 1000000007)::integer as shard from (select event_id, event_id as e from events where event_id < 0) union all select event_id, least(floor((event_id % 1000) * 8 / 1000)::integer, 7) from events")
def shard_of_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: shards of hashes spread evenly over the range by hand."""
    u = (F.col("event_id") % 1000).cast("decimal(22,0)") * F.lit(str(2**64 // 1000 + 1)).cast("decimal(18,0)")
    return read(spark, sf_dir, "events").select("event_id", shard.shard_of(shard.to_signed(u.cast("decimal(20,0)")), 8).alias("shard"))


# codecs


@query("select event_id, epoch_us(ts) as m, epoch_us(ts) // 1000000 as sec from events")
def codec_micros_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2."""
    return read(spark, sf_dir, "events").select("event_id", codecs.stored(F.col("ts"), NTZ, "timestamp").alias("m"), codecs.stored(F.col("ts"), NTZ, "datetime").alias("sec"))


@query("select c_custkey, cast(trunc(cast(c_acctbal as decimal(12, 2))) as bigint) as v from customer")
def codec_decimal_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", codecs.decimal_to_long(F.col("c_acctbal").cast("decimal(12,2)")).alias("v"))


_FRACTION = r"regexp_replace(strftime(ts, '.%f'), '\.?0+$', '')"


@query(f"select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || {_FRACTION} as t from events")
def codec_timestamp_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", codecs.stored(F.col("ts"), NTZ).alias("t"))


@query(f"select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || {_FRACTION} as t from events")
def codec_timestamp_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", codecs.stored(F.col("ts"), NTZ, None, codecs.SQL).alias("t"))


@query("select o_orderkey, (o_orderdate::date - date '1970-01-01')::integer as d from orders")
def codec_date_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", codecs.stored(F.col("o_orderdate").cast("date"), T.DateType(), "date").alias("d"))


@query("select o_orderkey, o_orderkey::varchar as u, -o_orderkey as s from orders")
def codec_uint64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1's two views of 64 bits, there and back."""
    u = shard.to_unsigned(-F.col("o_orderkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", shard.to_unsigned(F.col("o_orderkey")).cast("string").alias("u"), shard.to_signed(u).alias("s"))


@query("select o_orderkey, (o_orderkey % 1000) * 1000000 + 250000 as i from orders")
def codec_interval_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.make_dt_interval(secs=((F.col("o_orderkey") % 1000) + F.lit(0.25)).cast("decimal(18,6)"))
    return read(spark, sf_dir, "orders").select("o_orderkey", codecs.stored(i, T.DayTimeIntervalType()).alias("i"))


@query("select event_id, strftime(ts, '%H:%M:%S') as t from events")
def codec_time_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time of day loses its fraction."""
    return read(spark, sf_dir, "events").select("event_id", codecs.time_text(F.date_format("ts", "HH:mm:ss.SSSSSS")).alias("t"))


@query("select o_orderkey, try_cast(case when o_orderkey % 3 = 0 then 'x' || o_orderkey else ' ' || o_orderkey || ' ' end as integer) as v from orders")
def codec_lenient_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can't be read is null."""
    k = F.col("o_orderkey").cast("string")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x"), k)).otherwise(F.concat(F.lit(" "), k, F.lit(" ")))
    return read(spark, sf_dir, "orders").select("o_orderkey", codecs.loaded(text, T.IntegerType(), T.StringType(), lenient=True).alias("v"))


@query("select event_id, epoch_us(ts) // 1000 as ms from events")
def codec_text_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3."""
    return read(spark, sf_dir, "events").select("event_id", codecs.text_millis(codecs.stored(F.col("ts"), NTZ)).alias("ms"))


# rows as text

_PART = """'{"p_partkey"=' || p_partkey || ';"p_name"="' || p_name || '";"p_size"=' || p_size || ';"p_retailprice"=' || p_retailprice || '};'"""


def _part_text(df: DataFrame) -> F.Column:
    names = ("p_partkey", "p_name", "p_size", "p_retailprice")
    return rowtext.encode_row({n: (F.col(n), df.schema[n].dataType) for n in names})


@query(f"select p_partkey, {_PART} as row from part")
def rowtext_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10."""
    df = read(spark, sf_dir, "part")
    return df.select("p_partkey", _part_text(df).alias("row"))


@query("select p_partkey, p_name, p_size, p_retailprice from part")
def rowtext_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back from text."""
    df = read(spark, sf_dir, "part")
    struct = T.StructType([df.schema[n] for n in ("p_partkey", "p_name", "p_size", "p_retailprice")])
    return df.select(rowtext.decode(_part_text(df), struct).alias("r")).select("r.*")


@query("select vec_id, len(embedding)::integer as n, unnest(range(len(embedding)))::integer as i, unnest(embedding) as x, label from embeddings")
def rowtext_roundtrip_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10, S11 with a list and a nested row: every element comes back."""
    df = read(spark, sf_dir, "embeddings").select("vec_id", F.struct("embedding", "label").alias("body"))
    text = rowtext.encode(F.col("body"), df.schema["body"].dataType)
    back = df.select("vec_id", rowtext.decode(text, df.schema["body"].dataType).alias("b"))
    return back.select("vec_id", F.size("b.embedding").alias("n"), F.posexplode("b.embedding").alias("i", "x"), F.col("b.label").alias("label"))


# the rest


@query("select w as word, count(*)::bigint as cnt from (select unnest(regexp_split_to_array(trim(text), '[ \\n\\t\\r]+')) as w from documents) where w <> '' group by w")
def wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4, A6."""
    words = read(spark, sf_dir, "documents").select(F.explode(F.split(F.trim("text"), "[ \n\t\r]+")).alias("word")).where("word <> ''")
    return sink.running_counts(words, "word")


@query("select event_type, count(*)::bigint as cnt from events group by event_type")
def count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: a running count of a stream, in complete mode; the last result is the whole count."""
    name = f"counts_{uuid.uuid4().hex}"
    sink.running_counts(streamed(spark, sf_dir, "events"), "event_type").writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


@query("select p_partkey, cast((((case when x >= 2147483648 then x - 4294967296 else x end) % 1000) + 1000) % 1000 as integer) as h from (select p_partkey, list_reduce(list_prepend(0::bigint, list_transform(string_split(p_name, ''), lambda ch: ord(ch)::bigint)), lambda a, b: (a * 31 + b) % 4294967296) as x from part)")
def simple_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, R5."""
    return read(spark, sf_dir, "part").select("p_partkey", scalar.simple_hash(F.col("p_name")).alias("h"))


_MAJOR, _PATCH = "p_partkey % 5", "p_partkey * 7 % 1100"


@query(f"select p_partkey, case when {_PATCH} > 999 then null else ({_MAJOR})::bigint * 1000000000000 + p_size::bigint * 1000000000 + ({_PATCH}) * 1000000 + case p_partkey % 4 when 0 then 999000 when 1 then 300002 when 2 then 200005 else 100005 end end::bigint as number from part")
def version_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of releases, candidates, snapshots and others, some of them malformed."""
    suffix = F.element_at(F.array(*[F.lit(x) for x in ("", "-rc.2", "-SNAPSHOT.5", "-alpha.5")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    text = F.concat(F.expr(_MAJOR).cast("string"), F.lit("."), F.col("p_size").cast("string"), F.lit("."), F.expr(_PATCH).cast("string"), suffix)
    return read(spark, sf_dir, "part").select("p_partkey", scalar.version_number(text).alias("number"))


@query("select p_partkey, case p_partkey % 6 when 0 then p_size::bigint * 1073741824 when 1 then p_size * 1048576 when 2 then p_size * 1024 when 3 then p_size when 4 then p_size else null end::bigint as bytes from part")
def memory_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5."""
    unit = F.element_at(F.array(*[F.lit(x) for x in ("G", "M", "KB", "B", "", "X")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", scalar.memory_bytes(F.concat(F.col("p_size").cast("string"), unit)).alias("bytes"))


@query("select name, value, (select count(*) from region) as n_rows from (values ('custom', '1'), ('dynamic', 'true'), ('optimize_for', 'scan')) t(name, value)")
def table_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options to the attributes of a table that is made and written; custom ones come last."""
    rows = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    table = configured(spark, rows, ["r_regionkey"], optimize_for="lookup", custom_attributes={"optimize_for": "scan", "custom": "1u"})
    table.write(rows)
    attributes = [(k, str(v).lower()) for k, v in table.table(table.options["path"]).attributes().items()]
    counted = table.scan().agg(F.count(F.lit(1)).alias("n_rows"))
    return spark.createDataFrame(attributes, "name string, value string").join(F.broadcast(counted))
