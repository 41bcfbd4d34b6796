"""Rows as text in the notation of stratakey.nodetext, one row a line's worth, ended by a separator.

Writing and reading are expressions: a row's text is cut into tokens, which become those of JSON with every scalar a text, Spark
reads that by the schema, and the texts are cast. Only schemas with binary columns, which take the notation of any value as it stands, go
through the parser of nodetext in an Arrow function.

Reading differs from that parser in what only malformed or unusual rows show: a fraction read as a whole number is cut, also where it is quoted;
a list or map read as a string comes as JSON; what follows a complete row is passed over.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..nodetext import NodeTextError, dump, parse, plain
from .codecs import SQL, decimal_to_long, interval_micros, interval_months, time_text, timestamp_text


def quoted(s: Column) -> Column:
    out = s
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), out, F.lit('"'))


def encode(value: Column, kind: T.DataType, fmt: str = SQL) -> Column:
    """A value's text; null is #. Entries of maps without a key are left out; keys must be strings."""
    if isinstance(kind, T.NullType):
        return F.lit("#")
    if isinstance(kind, T.BooleanType):
        out = F.when(value, F.lit("%true")).otherwise(F.lit("%false"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        out = F.when(F.isnan(value), F.lit("%nan")).when(value == float("inf"), F.lit("%inf")).when(value == float("-inf"), F.lit("%-inf")).otherwise(value.cast("string"))
    elif isinstance(kind, T.IntegralType):
        out = value.cast("string")
    elif isinstance(kind, T.DecimalType):
        out = decimal_to_long(value).cast("string")
    elif isinstance(kind, T.StringType):
        out = quoted(value)
    elif isinstance(kind, T.BinaryType):  # already notation
        out = value.cast("string")
    elif isinstance(kind, T.DateType):
        out = quoted(F.date_format(value, "yyyy-MM-dd"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = quoted(timestamp_text(value, kind, fmt))
    elif isinstance(kind, T.DayTimeIntervalType):  # milliseconds here, microseconds in the table
        out = F.floor(interval_micros(value) / 1000).cast("bigint").cast("string")
    elif isinstance(kind, T.YearMonthIntervalType):
        out = interval_months(value).cast("string")
    elif kind.typeName() == "time":
        out = quoted(time_text(value))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: encode(x, kind.elementType, fmt)), ";"), F.lit("]"))
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("a map needs string keys to be written")
        out = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(value), lambda e: F.concat(quoted(e["key"]), F.lit("="), encode(e["value"], kind.valueType, fmt))), ";"), F.lit("}"))
    elif isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(f'"{f.name}"='), encode(value[f.name], f.dataType, fmt)) for f in kind.fields]
        out = F.concat(F.lit("{"), F.concat_ws(";", *fields), F.lit("}"))
    else:
        raise ValueError(f"{kind.simpleString()} has no notation")
    return F.when(value.isNull(), F.lit("#")).otherwise(out)


def encode_row(columns: dict[str, tuple[Column, T.DataType]], fmt: str = SQL) -> Column:
    """A row of named columns, with the separator at its end."""
    fields = [F.concat(F.lit(f'"{n}"='), encode(c, k, fmt)) for n, (c, k) in columns.items()]
    return F.concat(F.lit("{"), F.concat_ws(";", *fields), F.lit("};"))


class MissingField(ValueError):
    pass


def convert(node: Any, kind: T.DataType, fail_on_missing: bool, lenient: bool) -> Any:
    """A parsed node as a value of the type. A field that fails is null where lenient, and so is a missing or null one unless forbidden."""
    if node is None:
        return None
    try:
        return _convert(node, kind, fail_on_missing, lenient)
    except MissingField:
        raise
    except (ValueError, TypeError, AttributeError, ArithmeticError):
        if lenient:
            return None
        raise


def _convert(node: Any, kind: T.DataType, strict: bool, lenient: bool) -> Any:
    if isinstance(kind, T.BooleanType):
        return node if isinstance(node, bool) else str(node).strip().lower() == "true"
    if isinstance(kind, T.IntegralType):
        return int(node.strip()) if isinstance(node, str) else int(node)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(node)
    if isinstance(kind, T.StringType):
        return node if isinstance(node, str) else str(node).lower() if isinstance(node, bool) else dump(node) if isinstance(node, (dict, list)) else str(node)
    if isinstance(kind, T.BinaryType):
        return dump(node).encode() if isinstance(node, (dict, list)) else str(node).encode()
    if isinstance(kind, T.DecimalType):
        return decimal.Decimal(str(node).strip()).quantize(decimal.Decimal(1).scaleb(-kind.scale))
    if isinstance(kind, T.DateType):
        return datetime.date.fromisoformat(node.strip())
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        t = datetime.datetime.fromisoformat(node.strip().replace("Z", "+00:00"))
        utc = t.astimezone(datetime.UTC) if t.tzinfo else t.replace(tzinfo=datetime.UTC)
        return utc if isinstance(kind, T.TimestampType) else utc.replace(tzinfo=None)
    if isinstance(kind, T.DayTimeIntervalType):
        return datetime.timedelta(milliseconds=int(node))
    if isinstance(kind, T.ArrayType):
        return [convert(x, kind.elementType, strict, lenient) for x in _of(node, list)]
    if isinstance(kind, T.MapType):
        return {k: convert(v, kind.valueType, strict, lenient) for k, v in _of(node, dict).items()}
    if isinstance(kind, T.StructType):
        out, have = {}, _of(node, dict)
        for f in kind.fields:
            x = have.get(f.name)
            if x is None and strict:
                raise MissingField(f"field {f.name!r} is missing")
            out[f.name] = convert(x, f.dataType, strict, lenient)
        return out
    raise ValueError(f"{kind.simpleString()} can't be read")


def _of(node: Any, kind: type) -> Any:
    if not isinstance(node, kind):
        raise ValueError(f"expected a {kind.__name__}, found {node!r}")
    return node


# While strings are cut, an escaped backslash and an escaped quote are these two, which are no characters.
BACKSLASH, QUOTE = "\uffff", "\ufffe"
TOKEN = r"""[\[\]{}<>=;]|"[^"]*+"|%[a-z-]+|#|[+-]?\d[\w.+-]*+|[A-Za-z_][\w.\-/]*+"""
CORRUPT = "__corrupt"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _json_string(token: Column) -> Column:
    """A quoted token with JSON's escapes."""
    out = F.regexp_replace(token, rf"\\([^bfnrtx0av])", "$1")
    out = F.regexp_replace(out, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    for c, code in (("0", "0000"), ("a", "0007"), ("v", "000b")):
        out = F.replace(out, F.lit(f"\\{c}"), F.lit(f"\\u{code}"))
    return F.replace(F.replace(out, F.lit(BACKSLASH), F.lit("\\\\")), F.lit(QUOTE), F.lit('\\"'))


def _json_token(t: Column) -> Column:
    fixed = {"=": ":", ";": ",", "#": "null", "%true": "true", "%false": "false", "%nan": '"NaN"', "%inf": '"Infinity"', "%-inf": '"-Infinity"'}
    out = F.when(t.startswith('"'), _json_string(t)).when(t.rlike(r"^[\[\]{}]$"), t)
    for word, json in fixed.items():
        out = out.when(t == word, json)
    # an unknown flag is no JSON and so an error
    return out.when(t.startswith("%"), t).otherwise(F.concat(F.lit('"'), F.when(t.rlike(r"^[+-]?\d"), F.regexp_replace(t, "u$", "")).otherwise(t), F.lit('"')))


def _without_attributes(tokens: Column) -> Column:
    """Tokens without those between < and >."""
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))
    step = lambda a, t: F.struct((a["depth"] + F.when(t == "<", 1).when(t == ">", -1).otherwise(0)).alias("depth"), F.when((a["depth"] == 0) & (t != "<"), F.array_append(a["out"], t)).otherwise(a["out"]).alias("out"))
    return F.when(F.array_contains(tokens, "<"), F.aggregate(tokens, start, step, lambda a: a["out"])).otherwise(tokens)


def to_json(text: Column) -> Column:
    """A row's text as JSON whose scalars, but for null and flags, are texts; what is no notation becomes what is no JSON."""
    marked = F.replace(F.replace(text, F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))
    tokens = lambda t: _without_attributes(F.regexp_extract_all(t, F.lit(f"({TOKEN})"), F.lit(1)))
    # a separator may follow the last element
    needed = lambda ts: F.filter(ts, lambda t, i: (t != ";") | ~F.coalesce(F.get(ts, i + 1), F.lit("]")).isin("]", "}"))
    joined = lambda t: F.array_join(F.transform(_let(tokens(t), needed), _json_token), "")
    return _let(marked, lambda t: F.when(F.regexp_replace(t, TOKEN, "").rlike(r"^\s*$") & ~t.rlike(r"^\s*$"), joined(t)).otherwise("?"))


def _texts(kind: T.DataType) -> T.DataType:
    """The type with texts for its scalars."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _texts(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_texts(kind.elementType))
    return T.MapType(T.StringType(), _texts(kind.valueType)) if isinstance(kind, T.MapType) else T.StringType()


def _value(v: Column, kind: T.DataType, strict: bool, lenient: bool) -> Column:
    """What _texts(kind) says as a value of kind."""
    to = (lambda c, t: c.try_cast(t)) if lenient else (lambda c, t: c.cast(t))
    if isinstance(kind, T.StructType):

        def field(f: T.StructField) -> Column:
            x = _value(v[f.name], f.dataType, strict, lenient)
            return (F.when(v[f.name].isNull(), F.raise_error(F.lit(f"field '{f.name}' is missing"))).otherwise(x) if strict else x).alias(f.name)

        return F.when(v.isNotNull(), F.struct(*[field(f) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(v, lambda x: _value(x, kind.elementType, strict, lenient))
    if isinstance(kind, T.MapType):
        return F.transform_values(v, lambda _, x: _value(x, kind.valueType, strict, lenient))
    if isinstance(kind, T.StringType):
        return v
    t = F.trim(v)
    if isinstance(kind, T.BooleanType):
        return F.lower(t) == "true"
    if isinstance(kind, (T.IntegralType, T.DayTimeIntervalType)):
        n = F.when(t.rlike(r"^[+-]?\d+$"), to(t, "decimal(38,0)")).otherwise(to(to(t, "double"), "decimal(38,0)"))
        return to(n, kind) if isinstance(kind, T.IntegralType) else F.make_dt_interval(secs=(n.cast("decimal(38,3)") / 1000).cast("decimal(18,6)"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zone = t.rlike(r"(?:Z|[+-]\d\d:?\d\d)$")
        utc = F.when(zone, F.convert_timezone(F.current_timezone(), F.lit("UTC"), to(F.when(zone, t), "timestamp").cast("timestamp_ntz"))).otherwise(to(F.when(~zone, t), "timestamp_ntz"))
        return utc if isinstance(kind, T.TimestampNTZType) else F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")
    return to(t, kind)


def _has_binary(kind: T.DataType) -> bool:
    inner = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else [getattr(kind, a) for a in ("elementType", "keyType", "valueType") if hasattr(kind, a)]
    return isinstance(kind, T.BinaryType) or any(map(_has_binary, inner))


def decode(text: Column, schema: T.StructType, fail_on_missing_field: bool = False, ignore_parse_errors: bool = False) -> Column:
    """A struct of the schema from a row's text. The two settings exclude each other."""
    if fail_on_missing_field and ignore_parse_errors:
        raise ValueError("fail-on-missing-field and ignore-parse-errors exclude each other")
    if _has_binary(schema):
        return _decoded_by_parser(text, schema, fail_on_missing_field, ignore_parse_errors)
    texts = _texts(schema).add(CORRUPT, "string")
    read = F.from_json(to_json(text), texts, {"columnNameOfCorruptRecord": CORRUPT, "allowUnquotedControlChars": "true"})

    def whole(r: Column) -> Column:
        out = _value(r, schema, fail_on_missing_field, ignore_parse_errors)
        return out if ignore_parse_errors else F.when(r[CORRUPT].isNotNull(), F.raise_error(F.concat(F.lit("expected a row of the schema, found "), r[CORRUPT]))).otherwise(out)

    return F.when(text.isNotNull(), _let(read, whole))


def _decoded_by_parser(text: Column, schema: T.StructType, fail_on_missing_field: bool, ignore_parse_errors: bool) -> Column:

    def one(t: str | None) -> dict | None:
        if t is None:
            return None
        try:
            return convert(plain(parse(t)), schema, fail_on_missing_field, ignore_parse_errors)
        except NodeTextError:
            if ignore_parse_errors:
                return None
            raise

    @F.pandas_udf(schema)
    def rows(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            got = [one(t) or {} for t in s]
            yield pd.DataFrame({f.name: pd.Series([g.get(f.name) for g in got], dtype=object) for f in schema.fields})

    return F.when(text.isNotNull(), rows(text))
