"""Metrics that become visible with a commit, and only then."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codecs import epoch_micros


def tracked_millis(df: DataFrame, column: str) -> Column:
    """A timestamp or date column in milliseconds since the epoch, cut, not rounded."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise ValueError(f"the tracked field {column!r} is {kind.simpleString()}, not a date or timestamp")
    return F.floor(epoch_micros(F.col(column), T.TimestampNTZType() if isinstance(kind, T.DateType) else kind) / 1000).cast("bigint")


def metric_columns(df: DataFrame, tracked: str | None = None, maxima: Mapping[str, str] | None = None) -> list[Column]:
    out = [F.count(F.lit(1)).alias("rows")]
    if tracked:
        out.append(F.max(tracked_millis(df, tracked)).alias("tracked"))
    for metric, column in (maxima or {}).items():
        if not isinstance(df.schema[column].dataType, T.LongType):
            raise ValueError(f"metric {metric!r} needs a bigint column, {column!r} is {df.schema[column].dataType.simpleString()}")
        out.append(F.max(column).alias(f"max_{metric}"))
    return out


@dataclass
class TableMetrics:
    """The gauges of one table."""

    committed_rows: int = 0
    failed_rows: int = 0
    last_tracked: int | None = None
    max_tracked: int | None = None
    #: of the last commit, not of all
    maxima: dict[str, int] = field(default_factory=dict)


class Registry:
    def __init__(self) -> None:
        self._tables: dict[str, TableMetrics] = {}
        self._lock = threading.Lock()

    def table(self, name: str) -> TableMetrics:
        with self._lock:
            return self._tables.setdefault(name, TableMetrics())

    def committed(self, name: str, seen: Mapping[str, Any]) -> None:
        t = self.table(name)
        with self._lock:
            t.committed_rows += seen.get("rows") or 0
            if seen.get("tracked") is not None:
                t.last_tracked = seen["tracked"]
                t.max_tracked = max(seen["tracked"], t.max_tracked if t.max_tracked is not None else seen["tracked"])
            t.maxima = {k.removeprefix("max_"): v for k, v in seen.items() if k.startswith("max_") and v is not None}

    def failed(self, name: str, rows: int) -> None:
        t = self.table(name)
        with self._lock:
            t.failed_rows += rows


REGISTRY = Registry()


def observed_write(df: DataFrame, write: Callable[[DataFrame], Any], name: str, tracked: str | None = None, maxima: Mapping[str, str] | None = None, registry: Registry = REGISTRY) -> Any:
    """write(df) with metrics taken as the rows pass; published if it returns, counted as failed if it raises."""
    seen = Observation()
    try:
        out = write(df.observe(seen, *metric_columns(df, tracked, maxima)))
    except Exception as e:
        # a table's write says how many rows it had counted; otherwise nobody has
        rows = getattr(e, "rows_seen", None)
        registry.failed(name, df.count() if rows is None else rows)
        raise
    if getattr(out, "fresh", True):
        registry.committed(name, seen.get)
    return out
