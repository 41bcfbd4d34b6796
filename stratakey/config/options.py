"""The options of a table, with their old names, types, defaults and rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import timedelta
from typing import Any

from ..functions.partition import SCALES, Partitioning, check_key
from ..functions.shard import check_resharding
from ..nodetext import parse
from ..schema import TableSchema

UNITS = {"ms": 0.001, "s": 1, "sec": 1, "min": 60, "m": 60, "h": 3600, "d": 86400}


def duration(x: Any) -> timedelta:
    if isinstance(x, timedelta):
        return x
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", str(x))
    if not m or (m[2] or "ms") not in UNITS:
        raise ValueError(f"{x!r} is no duration")
    return timedelta(seconds=int(m[1]) * UNITS[m[2] or "ms"])


def boolean(x: Any) -> bool:
    if str(x).lower() not in ("true", "false"):
        raise ValueError(f"{x!r} is neither true nor false")
    return str(x).lower() == "true"


def one_of(*names: str) -> Callable[[Any], str]:
    def read(x: Any) -> str:
        for n in names:
            if str(x).lower() == n.lower():
                return n
        raise ValueError(f"{x!r} is none of {', '.join(names)}")

    return read


def mapping(x: Any) -> dict[str, str]:
    if isinstance(x, Mapping):
        return dict(x)
    return dict(part.split(":", 1) for part in str(x).split(",") if part)


def listing(x: Any) -> list[str]:
    return list(x) if isinstance(x, (list, tuple)) else [p for p in re.split(r"[;,]", str(x)) if p]


@dataclass(frozen=True)
class Option:
    read: Callable[[Any], Any]
    default: Any = None

    def alias(self, key: str) -> str:
        head, *rest = re.split(r"[-.]", key)
        return head + "".join(w.capitalize() for w in rest)


# Names and defaults.
OPTIONS: dict[str, Option] = {
    "path": Option(str),
    "path-map": Option(mapping),
    "proxy": Option(str),
    "schema": Option(str),
    "credentials-source": Option(str),
    "username": Option(str),
    "token": Option(str),
    "partition-key": Option(str),
    "partition-scale": Option(one_of(*SCALES)),
    "partition-ttl-day-cnt": Option(int),
    "partition-ttl-in-days-from-creation": Option(int),
    "min-partition-ttl": Option(int, 20),
    "timestamp-format": Option(one_of("ISO_8601", "SQL"), "ISO_8601"),
    "eager-initialization": Option(boolean, True),
    "enable-dynamic-store-read": Option(boolean, True),
    "optimize-for": Option(one_of("lookup", "scan")),
    "primary-medium": Option(str),
    "tablet-cell-bundle": Option(str),
    "custom-attributes": Option(mapping),
    "retry-strategy": Option(one_of("EXPONENTIAL", "NO_RETRY"), "EXPONENTIAL"),
    "reshard.strategy": Option(one_of("NONE", "FIXED", "LAST_PARTITIONS"), "NONE"),
    "reshard.tablet-count": Option(int),
    "reshard.uniform": Option(boolean, False),
    "reshard.last-partitions-count": Option(int, 7),
    "lookup.async": Option(boolean, False),
    "lookup-method": Option(one_of("LOOKUP", "SELECT"), "LOOKUP"),
    "lookup.cache": Option(one_of("NONE", "PARTIAL", "FULL"), "NONE"),
    "lookup.partial-cache.max-rows": Option(int),
    "lookup.partial-cache.expire-after-write": Option(duration),
    "lookup.partial-cache.expire-after-access": Option(duration),
    "lookup.partial-cache.cache-missing-key": Option(boolean, True),
    "lookup.full-cache.reload-strategy": Option(one_of("PERIODIC", "TIMED")),
    "lookup.full-cache.periodic-reload.interval": Option(duration),
    "lookup.full-cache.periodic-reload.schedule-mode": Option(one_of("FIXED_DELAY", "FIXED_RATE"), "FIXED_DELAY"),
    "lookup.full-cache.timed-reload.iso-time": Option(str),
    "lookup.full-cache.timed-reload.interval-in-days": Option(int, 1),
    "cluster-pick-strategy": Option(one_of("firstAvailable"), "firstAvailable"),
    "commit-transaction-period": Option(duration, timedelta(seconds=10)),
    "flush-modification-period": Option(duration, timedelta(seconds=1)),
    "transaction-timeout": Option(duration, timedelta(minutes=5)),
    "rows-in-transaction-limit": Option(int, 99_000),
    "rows-in-modification-limit": Option(int, 1_000),
    "mount-mode": Option(one_of("ALWAYS", "ON_CREATE"), "ALWAYS"),
    "transaction-atomicity": Option(one_of("Full", "None"), "Full"),
    "proxy-role": Option(str),
    "trackable-field": Option(str),
    "locks.provider": Option(str, "noop"),
    "format": Option(str),
    "sink.parallelism": Option(int),
    "fail-on-missing-field": Option(boolean, False),
    "ignore-parse-errors": Option(boolean, False),
    "timestamp-format.standard": Option(one_of("SQL", "ISO-8601"), "SQL"),
}
ROWS_LIMIT = 100_000
FREE_PREFIXES = ("properties.", "locks.", "cluster-pick-strategy.")


@dataclass(frozen=True)
class TableOptions:
    values: dict[str, Any]
    properties: dict[str, str]
    free: dict[str, str]
    schema: TableSchema | None

    def __getitem__(self, key: str) -> Any:
        return self.values.get(key, OPTIONS[key].default)

    @classmethod
    def parse(cls, raw: Mapping[str, Any], row: Any = None) -> TableOptions:
        """Reads and checks options. row is the StructType that the caller declares, where there is one.

        An entry properties.k is also option k, and wins over it.
        """
        aliases = {o.alias(k): k for k, o in OPTIONS.items()}
        properties = {k.removeprefix("properties."): v for k, v in raw.items() if k.startswith("properties.")}
        free = {k: v for k, v in raw.items() if k.startswith(FREE_PREFIXES) and k not in OPTIONS}
        values: dict[str, Any] = {}
        merged = {k: v for k, v in raw.items() if k not in free} | {k: v for k, v in properties.items() if aliases.get(k, k) in OPTIONS}
        for k, v in merged.items():
            name = aliases.get(k, k)
            if name not in OPTIONS:
                raise ValueError(f"unknown option {k!r}")
            try:
                values[name] = OPTIONS[name].read(v)
            except (ValueError, TypeError) as e:
                raise ValueError(f"option {k!r}: {e}") from e
        out = cls(values, properties, free, TableSchema.parse(values["schema"]) if "schema" in values else None)
        out.check(row)
        return out

    def check(self, row: Any = None) -> None:
        if self.schema is None:
            raise ValueError("option 'schema' is required")
        if ("proxy" in self.values) == ("path-map" in self.values):
            raise ValueError("exactly one of 'proxy' and 'path-map' is required")
        if "proxy" in self.values and "path" not in self.values:
            raise ValueError("option 'path' is required with 'proxy'")
        if row is not None:
            self.schema.check_covers(row)
        key, scale = self["partition-key"], self["partition-scale"]
        if (key is None) != (scale is None):
            raise ValueError("'partition-key' and 'partition-scale' go together")
        if key is not None:
            self.schema.column(key)
            check_key((row if row is not None else self.schema.struct())[key].dataType)
        if (tracked := self["trackable-field"]) is not None:
            self.schema.column(tracked)
        check_resharding(self["reshard.strategy"], self["reshard.tablet-count"], self["reshard.uniform"], self["reshard.last-partitions-count"])
        if self["rows-in-transaction-limit"] + self["rows-in-modification-limit"] > ROWS_LIMIT:
            raise ValueError(f"the two row limits may be {ROWS_LIMIT} together at most")
        if min(self["rows-in-transaction-limit"], self["rows-in-modification-limit"]) < 1:
            raise ValueError("row limits are positive")
        if self["lookup.cache"] == "FULL":
            if self["lookup.async"]:
                raise ValueError("an asynchronous lookup can't have a FULL cache")
            if self["lookup.full-cache.reload-strategy"] is None:
                raise ValueError("lookup.full-cache.reload-strategy is required for a FULL cache")
        if self["fail-on-missing-field"] and self["ignore-parse-errors"]:
            raise ValueError("fail-on-missing-field and ignore-parse-errors exclude each other")

    def attributes(self) -> dict[str, Any]:
        """Table attributes; custom ones come last and may override."""
        out: dict[str, Any] = {"dynamic": True}
        for option, name in (("optimize-for", "optimize_for"), ("primary-medium", "primary_medium"), ("tablet-cell-bundle", "tablet_cell_bundle")):
            if self[option] is not None:
                out[name] = self[option].lower() if option != "tablet-cell-bundle" else self[option]
        custom = dict(self["custom-attributes"] or {})
        custom |= {k.removeprefix("attributes."): v for k, v in self.properties.items() if k.startswith("attributes.")}
        return out | {k: parse(v) for k, v in custom.items()}

    def partitioning(self) -> Partitioning | None:
        if not self["partition-key"]:
            return None
        return Partitioning(self["partition-key"], self["partition-scale"], self["partition-ttl-day-cnt"], self["partition-ttl-in-days-from-creation"], self["min-partition-ttl"])

    def metrics(self) -> dict[str, str]:
        """Metric name to column, from properties.data_metrics.timestamp.<metric>.column."""
        found = (re.fullmatch(r"data_metrics\.timestamp\.(.+)\.column", k) for k in self.properties)
        return {m[1]: self.properties[m[0]] for m in found if m}

    def strategy(self, name: str) -> dict[str, str]:
        prefix = f"cluster-pick-strategy.{name}."
        return {k.removeprefix(prefix): v for k, v in self.free.items() if k.startswith(prefix)}
