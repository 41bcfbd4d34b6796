import dataclasses
import datetime as dt

import pytest
from pyspark.sql import types as T

from stratakey.config.options import TableOptions
from stratakey.config.profile import PRESETS, Profile, merge, setting
from stratakey.config.versions import Version, latest, memory_bytes, split_artifact
from stratakey.schema import TableSchema, struct_of

SCHEMA = '<strict=%true;unique_keys=%true>[{name=hash;type=uint64;sort_order=ascending;expression="hash(id)"};{name=id;type=int64;sort_order=ascending};{name=date;type=string};{name=ts;type=timestamp}]'
BASE = {"proxy": "p", "path": "//home/t", "schema": SCHEMA}


def test_schema_round_trip_and_write_schema():
    s = TableSchema.parse(SCHEMA)
    assert TableSchema.parse(s.dump()) == s
    assert s.write_schema().names == ["id", "date", "ts"] and s.write_schema().unique_keys
    assert s.keys == ["id"]
    assert TableSchema.from_struct(s.struct()) == s
    assert s.struct()["hash"].dataType == T.DecimalType(20, 0)


@pytest.mark.parametrize("text", ["{a=1}", "[{name=a}]", "[{name=a;type=strange}]", "[1]"])
def test_bad_schemas(text):
    with pytest.raises(ValueError):
        TableSchema.parse(text)


def test_columns_must_be_in_the_schema():
    with pytest.raises(ValueError, match="other"):
        TableSchema.parse(SCHEMA).check_covers(T.StructType([T.StructField("other", T.LongType())]))


@dataclasses.dataclass
class Inner:
    x: float


@dataclasses.dataclass
class Outer:
    b: int
    a: str | None
    renamed: list[Inner] = dataclasses.field(metadata={"name": "inners"})


def test_row_type_of_a_class():
    s = struct_of(Outer)
    assert s.names == ["b", "a", "inners"]
    assert s["inners"].dataType == T.ArrayType(T.StructType([T.StructField("x", T.DoubleType())]))


def test_defaults_and_aliases():
    o = TableOptions.parse(BASE | {"partitionKey": "ts", "partitionScale": "day"})
    assert o["partition-key"] == "ts" and o["partition-scale"] == "DAY"
    assert o["rows-in-transaction-limit"] == 99_000 and o["commit-transaction-period"] == dt.timedelta(seconds=10)
    assert o["min-partition-ttl"] == 20 and o["lookup-method"] == "LOOKUP"


def test_properties_win():
    o = TableOptions.parse(BASE | {"mount-mode": "ALWAYS", "properties.mount-mode": "ON_CREATE", "properties.anything": "x", "properties.attributes.a": "1u", "properties.data_metrics.timestamp.lag.column": "id"})
    assert o["mount-mode"] == "ON_CREATE" and o.attributes()["a"] == 1 and o.metrics() == {"lag": "id"}


@pytest.mark.parametrize(
    "more",
    [
        {"unknown": "1"},
        {"partition-key": "ts"},
        {"partition-key": "nope", "partition-scale": "DAY"},
        {"partition-key": "date", "partition-scale": "DAY"},
        {"rows-in-transaction-limit": "90000", "rows-in-modification-limit": "10001"},
        {"lookup.cache": "FULL"},
        {"lookup.cache": "FULL", "lookup.async": "true", "lookup.full-cache.reload-strategy": "PERIODIC"},
        {"reshard.strategy": "FIXED"},
        {"trackable-field": "nope"},
        {"path-map": "A:/a"},
        {"optimize-for": "speed"},
        {"fail-on-missing-field": "true", "ignore-parse-errors": "true"},
    ],
)
def test_refused_options(more):
    with pytest.raises((ValueError, KeyError)):
        TableOptions.parse(BASE | more)


def test_limits_that_just_fit():
    assert TableOptions.parse(BASE | {"rows-in-transaction-limit": "90000", "rows-in-modification-limit": "10000"})["rows-in-modification-limit"] == 10_000


def test_required_options():
    with pytest.raises(ValueError):
        TableOptions.parse({"proxy": "p", "path": "/t"})
    with pytest.raises(ValueError):
        TableOptions.parse({"schema": SCHEMA})
    assert TableOptions.parse({"schema": SCHEMA, "path-map": "A:/a,b:/b"})["path-map"] == {"A": "/a", "b": "/b"}


@pytest.mark.parametrize(("text", "n"), [("4G", 4 << 30), ("512M", 512 << 20), ("10KB", 10240), ("7B", 7), (12, 12)])
def test_memory(text, n):
    assert memory_bytes(text) == n


def test_versions():
    order = ["1.0.0-alpha", "1.0.0-alpha.2", "1.0.0-rc.1", "1.0.0", "1.2.0", "1.10.0"]
    assert sorted(order[::-1], key=Version) == order
    assert split_artifact("lib/some-tool-1.2.3-rc.1.jar") == ("some-tool", "1.2.3-rc.1")
    assert latest(["a-1.9.0.jar", "a-1.10.0.jar", "b-c-0.1.0.jar"]) == {"a": "a-1.10.0.jar", "b-c": "b-c-0.1.0.jar"}
    for bad in ("1.2", "x"):
        with pytest.raises(ValueError):
            Version(bad)


def test_profiles(monkeypatch):
    assert merge({"a": 1, "m": {"x": 1}}, {"a": "", "m": {"y": 2}}, {"b": 3}) == {"a": 1, "m": {"x": 1, "y": 2}, "b": 3}
    monkeypatch.setenv("STRATAKEY_POOL", "env")
    assert setting("pool", None, {"pool": "profile"}) == "env" and setting("pool", "cli") == "cli"
    monkeypatch.delenv("STRATAKEY_POOL")
    assert setting("pool", None, {"pool": "profile"}) == "profile"
    assert PRESETS["XLARGE"].cores == 8
    with pytest.warns(UserWarning):
        assert Profile.of({"name": "n", "strange": 1}).name == "n"
    with pytest.raises(ValueError):
        Profile(preset="HUGE")
    with pytest.raises(ValueError):
        Profile(packages=["g:a:1", "g:a:2"])


def test_a_name_without_a_version_is_below_all_others():
    assert latest(["a/foo-1.2.jar", "b/foo-0.9.1.jar", "c/bar-1.2.jar"]) == {"foo": "b/foo-0.9.1.jar", "bar": "c/bar-1.2.jar"}
