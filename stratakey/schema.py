"""Table schemas: the text form with sort order, required and computed columns, and Spark's StructType."""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import typing
from dataclasses import dataclass

from pyspark.sql import types as T

from .nodetext import Attributed, NodeTextError, dump, parse, plain

# Stored types and what Spark reads them as.
STORE_TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "utf8": T.StringType(),
    "any": T.BinaryType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
    "interval": T.DayTimeIntervalType(),
}
PYTHON_TYPES: dict[type, T.DataType] = {
    bool: T.BooleanType(),
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bytes: T.BinaryType(),
    datetime.date: T.DateType(),
    datetime.datetime: T.TimestampNTZType(),
    datetime.timedelta: T.DayTimeIntervalType(),
    decimal.Decimal: T.DecimalType(38, 18),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    required: bool = False
    sort_order: str | None = None
    expression: str | None = None


@dataclass(frozen=True)
class TableSchema:
    columns: tuple[ColumnSpec, ...]
    strict: bool = True
    unique_keys: bool = False

    @classmethod
    def parse(cls, text: str) -> TableSchema:
        """From the text form, which must be a list of maps."""
        node = parse(text)
        attributes = plain(node.attributes) if isinstance(node, Attributed) else {}
        items = plain(node)
        if not isinstance(items, list):
            raise NodeTextError("a schema is a list of columns")
        columns = []
        for c in items:
            if not isinstance(c, dict) or "name" not in c or "type" not in c:
                raise NodeTextError(f"a column needs a name and a type: {c!r}")
            if c["type"] not in STORE_TYPES:
                raise NodeTextError(f"column {c['name']!r} has the unknown type {c['type']!r}")
            columns.append(ColumnSpec(c["name"], c["type"], bool(c.get("required", False)), c.get("sort_order"), c.get("expression")))
        return cls(tuple(columns), attributes.get("strict", True), attributes.get("unique_keys", False))

    def dump(self) -> str:
        columns = [{k: v for k, v in dataclasses.asdict(c).items() if v is not None} for c in self.columns]
        return dump(Attributed(columns, {"strict": self.strict, "unique_keys": self.unique_keys}))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[str]:
        """The names of the sorted columns that a writer supplies."""
        return [c.name for c in self.columns if c.sort_order and not c.expression]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"the table schema has no column {name!r}; it has {', '.join(self.names)}")

    def write_schema(self) -> TableSchema:
        """Without computed columns; the attributes stay."""
        return dataclasses.replace(self, columns=tuple(c for c in self.columns if not c.expression))

    def struct(self) -> T.StructType:
        """As Spark's type, with what Spark has no place for in the fields' metadata."""
        fields = []
        for c in self.columns:
            meta = {"type": c.type, **({"sort_order": c.sort_order} if c.sort_order else {}), **({"expression": c.expression} if c.expression else {})}
            fields.append(T.StructField(c.name, STORE_TYPES[c.type], not c.required, meta))
        return T.StructType(fields)

    @classmethod
    def from_struct(cls, struct: T.StructType, keys: list[str] | None = None) -> TableSchema:
        by_kind = {v.simpleString(): k for k, v in reversed(STORE_TYPES.items())}
        columns = []
        for f in struct.fields:
            kind = f.metadata.get("type") or by_kind.get(f.dataType.simpleString(), "any")
            order = f.metadata.get("sort_order") or ("ascending" if keys and f.name in keys else None)
            columns.append(ColumnSpec(f.name, kind, not f.nullable, order, f.metadata.get("expression")))
        return cls(tuple(columns), True, bool(keys) or any(c.sort_order for c in columns))

    def check_covers(self, struct: T.StructType) -> None:
        """Every column that is written must be in the schema; the schema may have more."""
        missing = [f.name for f in struct.fields if f.name not in self.names]
        if missing:
            raise ValueError(f"columns that are not in the table schema: {', '.join(missing)}")


def struct_of(cls: type) -> T.StructType:
    """The row type of a dataclass, in the order of its fields; metadata={"name": ..} renames one."""

    def kind(t: typing.Any) -> T.DataType:
        origin, args = typing.get_origin(t), typing.get_args(t)
        if origin in (list, tuple):
            return T.ArrayType(kind(args[0]))
        if origin is dict:
            return T.MapType(kind(args[0]), kind(args[1]))
        rest = [a for a in args if a is not type(None)]
        if origin is not None and len(rest) == 1:
            return kind(rest[0])
        if dataclasses.is_dataclass(t):
            return struct_of(t)
        if t in PYTHON_TYPES:
            return PYTHON_TYPES[t]
        raise ValueError(f"{t!r} has no row type")

    hints = typing.get_type_hints(cls)
    return T.StructType([T.StructField(f.metadata.get("name", f.name), kind(hints[f.name])) for f in dataclasses.fields(cls)])
