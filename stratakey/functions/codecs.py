"""Values to and from the types that a table stores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shard import RANGE, U

ISO, SQL = "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"


def utc(ts: Column, kind: T.DataType) -> Column:
    """A timestamp as a time without zone, in UTC."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")) if isinstance(kind, T.TimestampType) else ts.cast("timestamp_ntz")


def epoch_micros(ts: Column, kind: T.DataType) -> Column:
    zoned = ts if isinstance(kind, T.TimestampType) else F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts.cast("timestamp_ntz")).cast("timestamp")
    return F.unix_micros(zoned)


def epoch_seconds(ts: Column, kind: T.DataType) -> Column:
    return F.floor(epoch_micros(ts, kind) / 1000000).cast("bigint")


def text_millis(text: Column) -> Column:
    """An ISO date and time in UTC as milliseconds since the epoch."""
    return F.floor(epoch_micros(text.cast("timestamp_ntz"), T.TimestampNTZType()) / 1000).cast("bigint")


def timestamp_text(ts: Column, kind: T.DataType, fmt: str = ISO) -> Column:
    """ISO or SQL text in UTC, with as many digits of a second as are needed."""
    t = utc(ts, kind)
    return F.concat(F.date_format(t, fmt), F.regexp_replace(F.date_format(t, ".SSSSSS"), r"\.?0+$", ""))


def interval_micros(i: Column) -> Column:
    whole = i.cast(T.DayTimeIntervalType())
    part = lambda u: F.extract(F.lit(u), whole)
    return ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")).cast("bigint") * 60000000 + (part("SECOND") * 1000000).cast("bigint")


def interval_months(i: Column) -> Column:
    whole = i.cast(T.YearMonthIntervalType())
    return (F.extract(F.lit("YEAR"), whole) * 12 + F.extract(F.lit("MONTH"), whole)).cast("int")


def decimal_to_long(d: Column, wrap: bool = False) -> Column:
    """The integer part. Out of range is an error, or with wrap the value modulo 2**64."""
    whole = F.when(d < 0, F.ceil(d)).otherwise(F.floor(d)).cast("decimal(38,0)")
    if not wrap:
        return whole.cast("bigint")
    r = F.lit(str(RANGE)).cast("decimal(21,0)")
    u = F.pmod(whole, r.cast("decimal(38,0)"))
    return F.when(u >= F.lit(str(RANGE // 2)).cast(U), u - r).otherwise(u).cast("bigint")


def time_text(t: Column) -> Column:
    """A time of day as HH:mm:ss."""
    return F.substring(t.cast("string"), 1, 8)


def stored(value: Column, kind: T.DataType, store_type: str | None = None, fmt: str = ISO, wrap: bool = False) -> Column:
    """The value as the table stores it. Native dates and times exist at the top level only; nested fields have no store_type."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value) if store_type == "date" else F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        native = {"timestamp": epoch_micros, "datetime": epoch_seconds}.get(store_type)
        return native(value, kind) if native else timestamp_text(value, kind, fmt)
    if isinstance(kind, T.DayTimeIntervalType):
        return interval_micros(value)
    if isinstance(kind, T.YearMonthIntervalType):
        return interval_months(value)
    if isinstance(kind, T.DecimalType):
        return F.when(value >= 0, F.floor(value)).cast(U) if store_type == "uint64" else decimal_to_long(value, wrap)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: stored(x, kind.elementType, None, fmt, wrap))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("a stored map has string keys")
        return F.transform_values(value, lambda _, v: stored(v, kind.valueType, None, fmt, wrap))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[stored(value[f.name], f.dataType, None, fmt, wrap).alias(f.name) for f in kind.fields]))
    if kind.typeName() == "time":
        return time_text(value)
    if isinstance(kind, (T.BooleanType, T.NumericType, T.StringType, T.BinaryType, T.NullType, T.VariantType)):
        return value
    raise ValueError(f"{kind.simpleString()} can't be stored")


def loaded(value: Column, kind: T.DataType, stored_kind: T.DataType, store_type: str | None = None, lenient: bool = False) -> Column:
    """The way back; with lenient, what can't be read is null instead of an error."""
    to = (lambda c, t: c.try_cast(t)) if lenient else (lambda c, t: c.cast(t))
    text = isinstance(stored_kind, T.StringType)
    trimmed = F.trim(value) if text else value
    if isinstance(kind, T.DateType):
        return to(trimmed, kind) if text else F.date_from_unix_date(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if text:
            local = to(trimmed, T.TimestampNTZType())
        else:
            micros = value * 1000000 if store_type == "datetime" else value
            local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_micros(micros).cast("timestamp_ntz"))
        return local if isinstance(kind, T.TimestampNTZType) else F.convert_timezone(F.lit("UTC"), F.current_timezone(), local).cast("timestamp")
    if isinstance(kind, T.BooleanType) and text:
        return F.lower(trimmed) == "true"
    if isinstance(kind, T.DayTimeIntervalType):
        return F.make_dt_interval(secs=(value / 1000000).cast("decimal(18,6)"))
    if isinstance(kind, T.YearMonthIntervalType):
        return F.make_ym_interval(months=value)
    return to(trimmed if text and not isinstance(kind, T.StringType) else value, kind)
