import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakey.functions import rowtext
from stratakey.nodetext import NodeTextError, Unsigned, dump, parse, plain

scalars = st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | st.floats(allow_nan=False) | st.text()
nodes = st.recursive(scalars, lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=12)


@given(nodes)
def test_what_is_written_is_read_again(node):
    assert parse(dump(node)) == node


@pytest.mark.parametrize(("text", "value"), [("1", 1), ("1.1", 1.1), ("%true", True), ("custom_value1", "custom_value1"), ("#", None), ('"a\\"\\x41\\n"', 'a"A\n'), ("[1;2;]", [1, 2]), ("{a=1;b={};}", {"a": 1, "b": {}}), ("%-inf", -math.inf)])
def test_values(text, value):
    assert parse(text) == value


def test_unsigned_and_attributes():
    assert isinstance(parse("1u"), Unsigned)
    node = parse("<strict=%true>[1]")
    assert node.attributes == {"strict": True} and plain(node) == [1]


@pytest.mark.parametrize("text", ["", "[1;2", "{a}", "{a=1", "1 2", "@", "1x", "%maybe", "{[]=1}"])
def test_broken_text(text):
    with pytest.raises(NodeTextError):
        parse(text)


NESTED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("xs", T.ArrayType(T.StringType())),
        T.StructField("m", T.MapType(T.StringType(), T.StringType())),
        T.StructField("r", T.StructType([T.StructField("b", T.BooleanType()), T.StructField("d", T.DoubleType())])),
    ]
)


def test_nested_rows_come_back(spark):
    data = [(1, 'q"u\\o\nte', ["abacaba", None, "caba", None], {"nullKey": None, "key": "value"}, (True, 1.5)), (None, None, None, None, None), (-5, "", [], {}, (None, float("inf")))]
    df = spark.createDataFrame(data, NESTED).select(F.struct("*").alias("row"))
    text = rowtext.encode(F.col("row"), df.schema["row"].dataType)
    back = df.select("row", rowtext.decode(text, NESTED).alias("back"))
    assert all(r["row"] == r["back"] for r in back.collect())


def test_strict_and_lenient(spark):
    struct = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.IntegerType()))])
    df = spark.createDataFrame([("{a=x;b=[1;y]}",), ("{b=[2]}",), ("{",), (None,)], "t string")
    got = [r[0] for r in df.select(rowtext.decode(F.col("t"), struct, ignore_parse_errors=True)).collect()]
    assert [tuple(g) if g else g for g in got] == [(None, [1, None]), (None, [2]), (None, None), None]
    with pytest.raises(Exception, match="missing"):
        df.where("t like '{b%'").select(rowtext.decode(F.col("t"), struct, fail_on_missing_field=True)).collect()
    with pytest.raises(Exception, match="expected"):
        df.where("t = '{'").select(rowtext.decode(F.col("t"), struct)).collect()
    with pytest.raises(ValueError):
        rowtext.decode(F.col("t"), struct, True, True)


def test_rows_are_read_without_python(spark):
    struct = T.StructType([
        T.StructField("s", T.StringType()), T.StructField("n", T.LongType()), T.StructField("d", T.DoubleType()), T.StructField("b", T.BooleanType()), T.StructField("l", T.ArrayType(T.StringType())),
        T.StructField("m", T.MapType(T.StringType(), T.LongType())), T.StructField("t", T.TimestampNTZType()), T.StructField("day", T.DateType()), T.StructField("dec", T.DecimalType(10, 2)), T.StructField("i", T.DayTimeIntervalType()), T.StructField("r", T.StructType([T.StructField("x", T.IntegerType())])),
    ])
    texts = [
        r'{s="a\\n\x41\"q\" = ; [ ] { } # \n\t\q\0";n=18u;d=1.5;b=%true;l=[a;"b c";#;];m={k=1;"k 2"=-2;};t="2024-02-29 01:02:03.5";day="2024-02-29";dec=1.25;i=1500;r={x=7}};',
        r'<a=1;b=<c=2>[1;2]>{s=<x=y>word;n="  12 ";d=%-inf;b="TRUE";l=[];m={};t="2024-02-29T01:02:03+02:00"; day = "1999-12-31" ;i=-1;r=#}',
        "{}",
        "{n=1.0;d=%inf;s=%false;l=#}",
        r'{s="\\\\\\n";l=["\\";"";"é漢"]}',
        '{s="line one\nline two\ttab"}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", "t", rowtext.decode(F.col("t"), struct).alias("r"), rowtext._decoded_by_parser(F.col("t"), struct, False, False).alias("p"))
    assert "Python" not in df.select("r")._jdf.queryExecution().executedPlan().toString()
    for row in df.orderBy("k").collect():
        assert repr(row["r"]) == repr(row["p"]), row["t"]
    nan = spark.createDataFrame([("{d=%nan}",)], "t string").select(rowtext.decode(F.col("t"), struct)["d"]).first()[0]
    assert nan != nan
    bad = ["{", "{s=1;;n=2}", "{s=%maybe}", "{s=\"open}", "[1;2]", "{n=[1]}", "{1}", "s=1", "{n=x}", "{t=\"2024-99-01\"}", ""]
    for text in bad:
        one = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(Exception, match="expected|CAST_INVALID|cast|malformed"):
            one.select(rowtext.decode(F.col("t"), struct)).collect()
        got = one.select(rowtext.decode(F.col("t"), struct, ignore_parse_errors=True).alias("r")).first()["r"]
        assert got["n"] is None and got["t"] is None
    long = "{s=\"" + "x\\\\n\\\"" * 200_000 + "\"}"
    assert len(spark.createDataFrame([(long,)], "t string").select(rowtext.decode(F.col("t"), struct)["s"]).first()[0]) == 800_000
