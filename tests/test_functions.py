import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakey.functions import codecs, partition, scalar, shard

NTZ = T.TimestampNTZType()


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("scale", "at", "name"),
    [
        ("HOUR", "2023-01-02 03:04:05", "2023-01-02 03:00:00"),
        ("HOUR_T", "2023-01-02 03:04:05", "2023-01-02T03:00:00"),
        ("DAY", "2022-10-30 10:10:10", "2022-10-30"),
        ("WEEK", "2023-06-02 00:00:00", "2023-05-29"),
        ("WEEK", "2023-05-30 00:00:00", "2023-05-29"),
        ("WEEK", "2023-06-05 00:00:00", "2023-06-05"),
        ("MONTH", "2023-06-02 00:00:00", "2023-06-01"),
        ("SHORT_MONTH", "2023-06-02 00:00:00", "2023-06"),
        ("YEAR", "2023-06-02 00:00:00", "2023-01-01"),
        ("SHORT_YEAR", "2023-06-02 00:00:00", "2023"),
    ],
)
def test_partition_names_and_back(spark, scale, at, name):
    assert value(spark, partition.name(ts(at), scale)) == name
    assert value(spark, partition.parse(F.lit(name), scale)) == value(spark, partition.start(ts(at), scale))


@pytest.mark.parametrize(("scale", "end"), [("HOUR", "2020-05-16 15:00:00"), ("DAY", "2020-05-17 00:00:00"), ("WEEK", "2020-05-18 00:00:00"), ("MONTH", "2020-06-01 00:00:00"), ("YEAR", "2021-01-01 00:00:00")])
def test_partition_ends(spark, scale, end):
    assert value(spark, partition.expiry_text(partition.end(ts("2020-05-16 14:08:13.31231"), scale))) == end + "+00:00"


def test_bounds_at_the_last_microsecond(spark):
    assert value(spark, partition.start(ts("2024-04-17 23:59:59.999999"), "WEEK")) == dt.datetime(2024, 4, 15)
    assert value(spark, partition.end(ts("2024-04-17 23:59:59.999999"), "WEEK")) == dt.datetime(2024, 4, 22)


NOW = dt.datetime(2024, 10, 10, 10, 10, 10)


@pytest.mark.parametrize(
    ("at", "ttl", "creation", "least", "want"),
    [
        ("2014-10-10 10:10:10", 1, None, 7, NOW + dt.timedelta(days=7)),
        ("2024-10-10 10:10:10", None, 3, 7, NOW + dt.timedelta(days=7)),
        ("2024-10-10 10:10:10", 100, None, 7, dt.datetime(2024, 10, 11) + dt.timedelta(days=100)),
        ("2024-10-10 10:10:10", None, 100, 7, NOW + dt.timedelta(days=100)),
        ("2024-10-10 10:10:10", None, None, 7, None),
        ("2024-10-10 10:10:10", 2, None, None, dt.datetime(2024, 10, 13)),
    ],
)
def test_expiry(spark, at, ttl, creation, least, want):
    assert value(spark, partition.expiry(ts(at), "DAY", ts(str(NOW)), ttl, creation, least)) == want


def test_partition_keys(spark):
    with pytest.raises(Exception, match="null"):
        value(spark, partition.instant(F.lit(None).cast("date")))
    with pytest.raises(ValueError):
        partition.check_key(T.StringType())
    with pytest.raises(ValueError):
        partition.name(ts("2024-01-01"), "DECADE")


def test_pivots(spark):
    assert shard.pivots(1) == [None]
    assert shard.pivots(3) == [None, 6148914691236517205, 12297829382473034410]
    assert shard.pivots(8)[1:] == [2305843009213693952 * i for i in range(1, 8)]
    table = [(r.shard, int(r.pivot), r.pivot_signed) for r in shard.pivot_table(spark, 3).orderBy("shard").collect()]
    assert table == [(i, p or 0, shard.signed(p or 0)) for i, p in enumerate(shard.pivots(3))]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_shards_agree_with_the_pivots(spark, n):
    points = {0, 1, 2**63, 2**64 - 1} | {p + d for p in shard.pivots(n)[1:] for d in (-1, 0, 1)}
    df = spark.createDataFrame([(shard.signed(u),) for u in points], "h long")
    for r in df.select("h", shard.shard_of(F.col("h"), n).alias("s")).collect():
        u = r.h % 2**64
        assert r.s == sum(u >= p for p in shard.pivots(n)[1:])


def test_last_partitions(spark):
    df = spark.createDataFrame([("2024-01-01", 9), ("2024-01-02", 4), ("2024-01-03", 0), ("2024-01-04", 7), ("2024-01-05", 100)], "partition string, n int")
    assert shard.last_partitions_count(df, "2024-01-05", 4, 20).first()[0] == 5
    assert shard.last_partitions_count(df.limit(0), "2024-01-05", 4, 20).first()[0] == 20


@pytest.mark.parametrize(("args", "error"), [(("FIXED",), ValueError), (("FIXED", 3), NotImplementedError), (("FIXED", 0, True), ValueError), (("LAST_PARTITIONS", 3, True, 0), ValueError), (("OTHER",), ValueError)])
def test_resharding_rules(args, error):
    with pytest.raises(error):
        shard.check_resharding(*args)


def test_resharding_that_is_fine():
    shard.check_resharding()
    shard.check_resharding("FIXED", 3, True)


def test_codecs_of_dates_and_times(spark):
    assert value(spark, codecs.stored(F.lit("1970-01-01").cast("date"), T.DateType(), "date")) == 0
    assert value(spark, codecs.stored(ts("1970-01-01 00:00:01"), NTZ, "datetime")) == 1
    assert value(spark, codecs.stored(ts("1970-01-01 00:00:01"), NTZ, "timestamp")) == 1_000_000
    assert value(spark, codecs.stored(ts("2022-10-30 10:10:10"), NTZ)) == "2022-10-30T10:10:10"
    assert value(spark, codecs.stored(ts("2022-10-30 10:10:10.120"), NTZ, None, codecs.SQL)) == "2022-10-30 10:10:10.12"
    assert value(spark, codecs.text_millis(F.lit("2023-11-08T12:23:58.808"))) == 1699446238808
    assert value(spark, codecs.stored(F.expr("interval '0' second"), T.DayTimeIntervalType())) == 0
    assert value(spark, codecs.stored(F.expr("interval '1 02:00:00.5' day to second"), T.DayTimeIntervalType())) == 93600500000
    assert value(spark, codecs.stored(F.expr("interval '1-2' year to month"), T.YearMonthIntervalType())) == 14


def test_zoned_timestamps_are_written_in_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        zoned = F.lit("2024-01-01 09:00:00").cast("timestamp")
        assert value(spark, codecs.stored(zoned, T.TimestampType())) == "2024-01-01T00:00:00"
        assert value(spark, codecs.stored(ts("1970-01-01 00:00:01"), NTZ, "timestamp")) == 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_decimals(spark):
    d = lambda x: F.lit(x).cast("decimal(30,2)")
    assert value(spark, codecs.decimal_to_long(d("-7.99"))) == -7
    assert value(spark, codecs.decimal_to_long(d("18446744073709551617.5"), wrap=True)) == 1
    assert value(spark, codecs.decimal_to_long(d("9223372036854775808"), wrap=True)) == -(2**63)
    with pytest.raises(Exception, match="(?i)overflow|out of range|cannot be represented"):
        value(spark, codecs.decimal_to_long(d("9223372036854775808")))
    assert value(spark, codecs.stored(d("18446744073709551615"), T.DecimalType(30, 2), "uint64")) == Decimal(2**64 - 1)


@pytest.mark.parametrize(("text", "kind", "want"), [(" 12 ", T.IntegerType(), 12), ("x", T.IntegerType(), None), ("TRUE ", T.BooleanType(), True), ("yes", T.BooleanType(), False), ("2024-02-30", T.DateType(), None), ("2024-01-02T03:04:05", NTZ, dt.datetime(2024, 1, 2, 3, 4, 5))])
def test_lenient_reading(spark, text, kind, want):
    assert value(spark, codecs.loaded(F.lit(text), kind, T.StringType(), lenient=True)) == want


def test_nested_values_and_refusals(spark):
    kind = T.MapType(T.StringType(), T.ArrayType(T.DateType()))
    m = F.create_map(F.lit("a"), F.array(F.lit("2024-01-01").cast("date"), F.lit(None).cast("date")))
    assert value(spark, codecs.stored(m, kind)) == {"a": ["2024-01-01", None]}
    with pytest.raises(ValueError):
        codecs.stored(F.lit(1), T.MapType(T.IntegerType(), T.IntegerType()))


def java_hash(s):
    h = 0
    for c in s:
        h = (h * 31 + ord(c)) % 2**32
    return (h - 2**32 if h >= 2**31 else h) % 1000


@pytest.mark.parametrize("s", ["", "a", "hello world", "zzzzzzzzzzzzzzzz", "straße"])
def test_simple_hash(spark, s):
    assert value(spark, scalar.simple_hash(F.lit(s))) == java_hash(s)


def test_simple_hash_of_null(spark):
    assert value(spark, scalar.simple_hash(F.lit(None).cast("string"))) == 0


def test_functions_in_sql(spark):
    scalar.register(spark)
    got = spark.sql("select simple_hash(w) h, w from values ('hello world'), (''), (null) t(w)").collect()
    assert [r.h for r in got] == [java_hash(r.w or "") for r in got]
