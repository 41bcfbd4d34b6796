"""Time partitions: names, bounds, the way back, and expiry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Scale:
    unit: str
    fmt: str
    #: makes a name complete so that it can be read with full_fmt
    suffix: str = ""
    full_fmt: str = "yyyy-MM-dd"


# Scales and their name formats.
SCALES: dict[str, Scale] = {
    "HOUR": Scale("HOUR", "yyyy-MM-dd HH:mm:ss", full_fmt="yyyy-MM-dd HH:mm:ss"),
    "HOUR_T": Scale("HOUR", "yyyy-MM-dd'T'HH:mm:ss", full_fmt="yyyy-MM-dd'T'HH:mm:ss"),
    "DAY": Scale("DAY", "yyyy-MM-dd"),
    "WEEK": Scale("WEEK", "yyyy-MM-dd"),
    "MONTH": Scale("MONTH", "yyyy-MM-dd"),
    "SHORT_MONTH": Scale("MONTH", "yyyy-MM", "-01"),
    "YEAR": Scale("YEAR", "yyyy-MM-dd"),
    "SHORT_YEAR": Scale("YEAR", "yyyy", "-01-01"),
}
KEY_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def scale_of(name: str) -> Scale:
    if name not in SCALES:
        raise ValueError(f"unknown partition scale {name!r}; known: {', '.join(SCALES)}")
    return SCALES[name]


def instant(key: Column) -> Column:
    """The key as a time in UTC; a null key is an error. Times of day are no keys (check_key)."""
    return F.coalesce(key.cast("timestamp_ntz"), F.raise_error(F.lit("the partition key is null")).cast("timestamp_ntz"))


def check_key(kind: T.DataType) -> None:
    if not isinstance(kind, KEY_TYPES):
        raise ValueError(f"a partition key is a date or a timestamp, not {kind.simpleString()}")


def start(ts: Column, scale: str) -> Column:
    return F.date_trunc(scale_of(scale).unit, ts).cast("timestamp_ntz")


def end(ts: Column, scale: str) -> Column:
    return start(ts, scale) + F.expr(f"INTERVAL 1 {scale_of(scale).unit}")


def name(ts: Column, scale: str) -> Column:
    return F.date_format(start(ts, scale), scale_of(scale).fmt)


def parse(partition: Column, scale: str) -> Column:
    """The start of a partition from its name."""
    s = scale_of(scale)
    return F.to_timestamp_ntz(F.concat(partition, F.lit(s.suffix)), F.lit(s.full_fmt))


def expiry(ts: Column, scale: str, now: Column, ttl_days: int | None = None, from_creation_days: int | None = None, min_ttl_days: int | None = 20) -> Column:
    """When the partition of ts expires: the latest of what the settings say; null if neither of the first two is set."""
    if ttl_days is None and from_creation_days is None:
        return F.lit(None).cast("timestamp_ntz")
    days = lambda n: F.make_dt_interval(F.lit(n))
    said = []
    if ttl_days is not None:
        said.append(end(ts, scale) + days(ttl_days))
    said += [now + days(n) for n in (from_creation_days, min_ttl_days) if n is not None]
    return F.greatest(*said) if len(said) > 1 else said[0]


def expiry_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))


@dataclass(frozen=True)
class Partitioning:
    """How a table is cut into partitions, and when they expire."""

    key: str
    scale: str
    ttl_days: int | None = None
    from_creation_days: int | None = None
    min_ttl_days: int | None = 20

    def name(self) -> Column:
        return name(instant(F.col(self.key)), self.scale)
