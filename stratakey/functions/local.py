"""Hashes and partition names of Arrow columns, for the processes in which Spark runs Python data sources: the rules of shard.py and partition.py."""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .partition import scale_of

SEED = 42
MASK = 2**64 - 1


def _bytes(kind: pa.DataType) -> Any:
    """How Spark hashes a value: as a text's bytes, or as 4 or 8 bytes."""
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return lambda v: v.encode()
    if pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        return bytes
    if pa.types.is_boolean(kind) or pa.types.is_int8(kind) or pa.types.is_int16(kind) or pa.types.is_int32(kind):
        return lambda v: struct.pack("<i", v)
    if pa.types.is_int64(kind):
        return lambda v: struct.pack("<q", v)
    if pa.types.is_date32(kind):
        return lambda v: struct.pack("<i", (v - dt.date(1970, 1, 1)).days)
    if pa.types.is_timestamp(kind):
        return lambda v: struct.pack("<q", (v.replace(tzinfo=None) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1))
    if pa.types.is_duration(kind):
        return lambda v: struct.pack("<q", v // dt.timedelta(microseconds=1))
    if pa.types.is_float32(kind):
        return lambda v: struct.pack("<f", v or 0.0)
    if pa.types.is_float64(kind):
        return lambda v: struct.pack("<d", v or 0.0)
    if pa.types.is_decimal(kind) and kind.scale == 0 and kind.precision > 18:
        return lambda v: int(v).to_bytes((int(v) + (int(v) < 0)).bit_length() // 8 + 1, "big", signed=True)
    raise TypeError(f"a key of type {kind} is not hashed here")


def key_hash(columns: Sequence[pa.Array | pa.ChunkedArray]) -> list[int]:
    """The signed 64-bit hash of each row of key columns; a null leaves the hash as it is."""
    out = [SEED] * len(columns[0]) if columns else []
    for c in columns:
        as_bytes = _bytes(c.type)
        out = [h if v is None else xxhash.xxh64_intdigest(as_bytes(v), h & MASK) for h, v in zip(out, c.to_pylist())]
    return [h - 2**64 if h >= 2**63 else h for h in out]


# The formats of partition names.
FORMATS = {"HOUR": "%Y-%m-%d %H:%M:%S", "HOUR_T": "%Y-%m-%dT%H:%M:%S", "DAY": "%Y-%m-%d", "WEEK": "%Y-%m-%d", "MONTH": "%Y-%m-%d", "SHORT_MONTH": "%Y-%m", "YEAR": "%Y-%m-%d", "SHORT_YEAR": "%Y"}


def partition_names(key: pa.ChunkedArray, scale: str) -> pa.ChunkedArray:
    if key.null_count:
        raise ValueError("the partition key is null")
    start = pc.floor_temporal(key.cast(pa.timestamp("s"), safe=False), unit=scale_of(scale).unit.lower(), week_starts_monday=True)
    return pc.strftime(start, FORMATS[scale].replace("%S", "00"))


def bounds(name: str, scale: str) -> tuple[dt.datetime, dt.datetime]:
    """The first moment of a partition, and the first after it."""
    start, unit = dt.datetime.strptime(name, FORMATS[scale]), scale_of(scale).unit
    if unit == "MONTH":
        return start, (start.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
    if unit == "YEAR":
        return start, start.replace(year=start.year + 1) if start.year < 9999 else dt.datetime.max
    return start, start + {"HOUR": dt.timedelta(hours=1), "DAY": dt.timedelta(days=1), "WEEK": dt.timedelta(days=7)}[unit]


def expiry_text(name: str, scale: str, now: dt.datetime, ttl_days: int | None, from_creation_days: int | None, min_ttl_days: int | None) -> str | None:
    """When a partition expires, as partition.expiry says."""
    if ttl_days is None and from_creation_days is None:
        return None
    said = [bounds(name, scale)[1] + dt.timedelta(days=ttl_days)] if ttl_days is not None else []
    said += [now + dt.timedelta(days=n) for n in (from_creation_days, min_ttl_days) if n is not None]
    return max(said).strftime("%Y-%m-%d %H:%M:%S") + "+00:00"
