"""Lookup joins against dimension tables.

A lookup of a stream of keys is an equi-join here: Catalyst broadcasts a small dimension and sorts a large one, pushes the
columns down, and prunes. What remains of the operator are its rules: which columns may be looked up, what a missing key gives,
what happens when a key is in several partitions, and when a cached dimension is read again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..locks import LockError
from ..schema import TableSchema
from ..sources.files import JvmFiles, shared_path
from ..sources.log import Conflict
from ..sources.roots import NoRoot
from ..sources.table import PARTITION, KeyedTable

ASKED, FOUND, WRITTEN, USED = "__asked", "__found", "__written", "__used"
LOOKUP, SELECT = "LOOKUP", "SELECT"


def check_keys(keys: Sequence[str], struct: T.StructType, method: str, declared: Sequence[str] | None) -> None:
    if not keys:
        raise ValueError("a lookup needs a key")
    for k in keys:
        if not k.isidentifier():
            raise ValueError(f"{k!r} is no plain column name")
        if k not in struct.names:
            raise ValueError(f"the dimension has no column {k!r}")
        if isinstance(struct[k].dataType, (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError(f"key {k!r} is nested")
    if method not in (LOOKUP, SELECT):
        raise ValueError(f"unknown lookup method {method!r}")
    if method == LOOKUP and declared is not None and set(keys) != set(declared):
        raise ValueError(f"method LOOKUP takes the key columns {', '.join(declared)}, not {', '.join(keys)}; use SELECT")


def lookup_join(left: DataFrame, dim: DataFrame, on: dict[str, str], how: str = "left", columns: Sequence[str] | None = None, method: str = LOOKUP, declared_keys: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """left with the dimension's columns. on maps columns of left to columns of dim; a null key finds nothing.

    With how="left" a row without a match has nulls, with "inner" it goes. LOOKUP wants exactly the declared keys,
    SELECT any columns, and may find several rows.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a lookup is left or inner, not {how!r}")
    check_keys(list(on.values()), dim.schema, method, declared_keys)
    wanted = list(columns) if columns is not None else [c for c in dim.columns if c not in on.values()]
    right = dim.select(*[F.col(d).alias(f"__k_{i}") for i, d in enumerate(on.values())], *[F.col(c).alias(prefix + c) for c in wanted])
    cond = [left[k] == right[f"__k_{i}"] for i, k in enumerate(on)]
    return left.join(right, cond, how).drop(*[f"__k_{i}" for i in range(len(on))])


def point_select(dim: DataFrame, keys: dict[str, object], columns: Sequence[str]) -> DataFrame:
    """The rows with these key values; the predicate reaches the scan."""
    check_keys(list(keys), dim.schema, SELECT, None)
    cond = F.lit(True)
    for k, v in keys.items():
        cond = cond & (F.col(k) == F.lit(v))
    return dim.where(cond).select(*columns)


def unique_over_partitions(dim: DataFrame, keys: Sequence[str], partition: str | Column = PARTITION) -> DataFrame:
    """dim, failing on read if one key lies in several partitions. Keys and partitions are aggregated, rows are only joined with the offenders."""
    p = F.col(partition) if isinstance(partition, str) else partition
    seen = dim.withColumn("__p", p).groupBy(*keys).agg(F.min("__p").alias("__a"), F.max("__p").alias("__b"))
    text = F.concat(F.lit("duplicate key in different partitions: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    offends = seen.where(~F.col("__a").eqNullSafe(F.col("__b"))).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.lit(True).alias("__twice"))
    marked = dim.join(offends, [dim[k].eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "left")
    fine = F.when(F.col("__twice"), F.raise_error(text)).otherwise(F.lit(True))
    return marked.where(fine.cast("boolean")).select(*[dim[c] for c in dim.columns])


def partitioned_lookup(left: DataFrame, table: KeyedTable, on: dict[str, str], how: str = "left", columns: Sequence[str] | None = None, method: str = LOOKUP) -> DataFrame:
    """A lookup over all partitions that the table has now. Only keys that left asks for are checked for duplicates."""
    dim = table.scan(with_partition=table.partitioning is not None)
    keys = list(on.values())
    if table.partitioning is not None:
        asked = left.select(*[F.col(k).alias(d) for k, d in on.items()]).distinct()
        dim = unique_over_partitions(dim.join(asked, keys, "left_semi"), keys).drop(PARTITION) if method == LOOKUP else dim.drop(PARTITION)
    return lookup_join(left, dim, on, how, columns, method, table.schema.keys or None)


@dataclass
class DimensionCache:
    """A dimension for repeated lookups. load reads it.

    NONE reads it each time. FULL keeps it whole and reads it again at intervals (PERIODIC) or at a time of day (TIMED).
    PARTIAL keeps the rows of the keys that were asked for, and, with missing, which keys have none: a table of the shared folder, an
    entry a row or absent key with the times when it was read and last used. An entry goes a time after either; of more than max_rows entries the longest
    unused go. Only keys without an entry are looked up, by a semi-join with what load gives or by by_keys, which gets them and gives their rows.
    """

    load: Callable[[], DataFrame]
    mode: str = "NONE"
    reload: str | None = None
    interval: timedelta = timedelta(minutes=10)
    at: str = "00:00"
    days: int = 1
    expire_after_write: timedelta | None = None
    expire_after_access: timedelta | None = None
    max_rows: int | None = None
    missing: bool = True
    by_keys: Callable[[DataFrame], DataFrame] | None = None
    clock: Callable[[], float] = time.time
    loads: int = field(default=0, init=False)
    #: PARTIAL: keys looked up in the dimension, and keys found here
    looked_up: int = field(default=0, init=False)
    hits: int = field(default=0, init=False)
    _held: DataFrame | None = field(default=None, init=False)
    _folder: str | None = field(default=None, init=False)
    _old: list[str] = field(default_factory=list, init=False)
    _read: float = field(default=0.0, init=False)

    def __post_init__(self) -> None:
        if self.mode not in ("NONE", "PARTIAL", "FULL"):
            raise ValueError(f"unknown cache mode {self.mode!r}")
        if self.mode == "FULL" and self.reload not in ("PERIODIC", "TIMED"):
            raise ValueError("a FULL cache needs the reload strategy PERIODIC or TIMED")

    @classmethod
    def of(cls, load: Callable[[], DataFrame], options: object, by_keys: Callable[[DataFrame], DataFrame] | None = None) -> DimensionCache:
        o = options
        return cls(
            load, o["lookup.cache"], o["lookup.full-cache.reload-strategy"], o["lookup.full-cache.periodic-reload.interval"] or timedelta(minutes=10), o["lookup.full-cache.timed-reload.iso-time"] or "00:00",
            o["lookup.full-cache.timed-reload.interval-in-days"], o["lookup.partial-cache.expire-after-write"], o["lookup.partial-cache.expire-after-access"], o["lookup.partial-cache.max-rows"], o["lookup.partial-cache.cache-missing-key"], by_keys,
        )

    def _stale(self) -> bool:
        now = self.clock()
        if self._held is None:
            return True
        if self.reload == "PERIODIC":
            return now - self._read >= self.interval.total_seconds()
        return now >= self._next_time()

    def _next_time(self) -> float:
        h, m = (int(x) for x in self.at.split(":")[:2])
        read = datetime.fromtimestamp(self._read)
        due = read.replace(hour=h, minute=m, second=0, microsecond=0)
        while due <= read:
            due += timedelta(days=self.days)
        return due.timestamp()

    def get(self, asked: DataFrame | None = None) -> DataFrame:
        """The dimension for one lookup; asked has the key columns, under the dimension's names, that will be looked up."""
        if self.mode == "NONE":
            self.loads += 1
            return self.load()
        if self.mode == "PARTIAL":
            if asked is None:
                raise ValueError("a PARTIAL cache needs the keys that are asked for")
            return self._partial(asked)
        if self._stale():
            self.clear()
            self._held, self._read = self.load().persist(), self.clock()
            self.loads += 1
        return self._held

    def _partial(self, asked: DataFrame) -> DataFrame:
        spark, keys, now = asked.sparkSession, asked.columns, F.lit(self.clock())
        # a null key finds nothing, here or there
        asked = asked.dropna().distinct()
        live = self._live()
        known = live.select(*keys).distinct() if live is not None else None
        folder = shared_path(spark, "partial-cache")
        wanted = asked.join(known, keys, "left_anti") if known is not None else asked
        wanted.write.parquet(f"{folder}/wanted")
        wanted = spark.read.schema(asked.schema).parquet(f"{folder}/wanted")
        n = wanted.count()
        self.looked_up += n
        parts = []
        if n or live is None:
            self.loads += 1
            rows = self.by_keys(wanted) if self.by_keys else self.load().join(wanted, keys, "left_semi")
            found = rows.withColumns({ASKED: F.lit(True), FOUND: F.lit(True), WRITTEN: now, USED: now})
            parts.append(found)
            if self.missing:
                found_keys = found.select(*keys).distinct()
                rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields if f.name not in (*keys, ASKED, FOUND, WRITTEN, USED)]
                absent = wanted.join(found_keys, keys, "left_anti").select(*keys, *rest, F.lit(True).alias(ASKED), F.lit(False).alias(FOUND), now.alias(WRITTEN), now.alias(USED))
                parts.append(absent.select(*found.columns))
        if live is not None:
            hit = asked.withColumn("__hit", F.lit(True))
            kept = live.join(hit, keys, "left").withColumn(ASKED, F.coalesce("__hit", F.lit(False))).withColumn(USED, F.when(F.col(ASKED), now).otherwise(F.col(USED)))
            parts.append(kept.select(*live.columns))
        state = reduce(DataFrame.unionByName, parts)
        state.write.parquet(f"{folder}/all")
        out = spark.read.schema(state.schema).parquet(f"{folder}/all")
        size, of_asked = out.agg(F.count(F.lit(1)), F.count(F.when(F.col(ASKED) & (F.col(WRITTEN) < now), 1))).first()
        self.hits += of_asked
        if self._folder:
            self._old.append(self._folder)
        self._held, self._folder = out, folder
        if self.max_rows is not None and size > self.max_rows:
            out.orderBy(F.col(USED).desc(), F.col(WRITTEN).desc(), *keys).limit(self.max_rows).write.parquet(f"{folder}/kept")
            self._held = spark.read.schema(state.schema).parquet(f"{folder}/kept")
        # a caller may still read what the lookup before this one gave
        while len(self._old) > 1:
            JvmFiles(spark).delete(self._old.pop(0))
        return out.where(F.col(ASKED) & F.col(FOUND)).drop(ASKED, FOUND, WRITTEN, USED)

    def _live(self) -> DataFrame | None:
        """The entries that have not expired."""
        if self._held is None:
            return None
        out, now = self._held, self.clock()
        for limit, column in ((self.expire_after_write, WRITTEN), (self.expire_after_access, USED)):
            if limit:
                out = out.where(F.col(column) + limit.total_seconds() > now)
        return out

    def clear(self) -> None:
        if self._held is None:
            return
        if self._folder:
            for folder in (*self._old, self._folder):
                JvmFiles(self._held.sparkSession).delete(folder)
            self._folder = None
            self._old.clear()
        else:
            self._held.unpersist()
        self._held = None


def passing(e: Exception) -> bool:
    """Whether trying again can help: files and services that don't answer, locks and commits that someone else had. Wrong queries and wrong data stay wrong."""
    if isinstance(e, PySparkException):
        return any(x in str(e) for x in ("FAILED_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException", "FileNotFoundError", "java.io.IOException", "java.net."))
    return isinstance(e, (OSError, LockError, Conflict, NoRoot))


def with_retries(work: Callable[[], DataFrame], attempts: int = 5, first: float = 10.0, most: float = 120.0, give_up: Callable[[], bool] = lambda: False, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """work(), tried anew with growing waits if another attempt can help (passing); give_up ends it early."""
    for i in range(attempts):
        try:
            return work()
        except Exception as e:
            if i == attempts - 1 or give_up() or not passing(e):
                raise
            sleep(min(most, first * 2**i))
    raise ValueError("attempts must be positive")
