"""A table as its options describe it: where it lies, how it is created, read, looked up and written."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import credentials
from ..config.options import TableOptions
from ..locks import LocksProvider, Mode, choose, locked
from ..operators.lookup import DimensionCache, lookup_join, with_retries
from ..operators.metrics import REGISTRY, Registry, observed_write
from .format import register
from .roots import STRATEGIES, path_exists
from .table import Committed, KeyedTable, create_from

R = TypeVar("R")


class ConfiguredTable:
    """A table of parsed options. Reads go to the root in use, which is chosen anew when it is gone; writes go to each root.

    Where there are several roots a scan is Spark's format "stratakey", whose tasks change roots by themselves, so that a
    DataFrame outlives the root that it was planned for. act() runs a whole action, with any number of jobs, and runs it again if a read
    fails. Retries wait longer each time (retry-strategy EXPONENTIAL) or are left out (NO_RETRY); errors that no other attempt can mend are raised at once.

    The limits rows-in-transaction-limit, with it rows-in-modification-limit, and transaction-timeout hold where the options name them;
    their defaults are those of a store that takes rows one by one.
    """

    def __init__(self, spark: SparkSession, options: TableOptions, locks: LocksProvider | None = None, registry: Registry = REGISTRY, sleep: Callable[[float], None] = time.sleep):
        self.spark, self.options, self.registry, self.sleep = spark, options, registry, sleep
        credentials.apply(spark, options)
        self.locks = locks or choose(options["locks.provider"], spark, options.free)
        self.roots = options["path-map"] or {"": options["path"]}
        name = options["cluster-pick-strategy"]
        priorities = options.strategy(name).get("priorities")
        self.pick = STRATEGIES[name](self.roots, path_exists(spark), priorities.replace(";", ",").split(",") if priorities else None)
        self.cache = DimensionCache.of(self.scan, options, self._by_keys if options.schema.keys and options["lookup-method"] == "LOOKUP" else None)

    def _retried(self, work: Callable[[], Any]) -> Any:
        if self.options["retry-strategy"] == "NO_RETRY":
            return work()
        return with_retries(work, sleep=self.sleep)

    def table(self, root: str) -> KeyedTable:
        return create_from(self.spark, self.options, self.locks, root)

    # reading

    def scan(self, columns: Sequence[str] | None = None, **options: Any) -> DataFrame:
        if len(self.roots) > 1 and not set(options) - {"between", "limit"}:
            return self._retried(lambda: self._by_format(columns, **options))
        return self._retried(lambda: self.pick.run(lambda root: self.table(root).scan(columns, **options)))

    def _by_format(self, columns: Sequence[str] | None, between: tuple[Any, Any] | None = None, limit: int = -1) -> DataFrame:
        register(self.spark)
        named = {n.upper(): root for n, root in self.roots.items()}
        order = [named[n] for n in (self.pick.pick(), *self.pick.order)]
        reader = self.spark.read.format("stratakey").option("path-map", ",".join(f"{i}:{root}" for i, root in enumerate(dict.fromkeys(order))))
        if between:
            reader = reader.option("between", f"{between[0]},{between[1]}")
        if columns is not None:
            struct = self.options.schema.struct()
            reader = reader.schema(T.StructType([struct[c] for c in columns]))
        df = reader.load()
        return df.limit(limit) if limit >= 0 else df

    def _by_keys(self, asked: DataFrame) -> DataFrame:
        return self._retried(lambda: self.pick.run(lambda root: self.table(root).of_keys(asked)))

    def act(self, work: Callable[[DataFrame], R], columns: Sequence[str] | None = None, **options: Any) -> R:
        """work(scan), again with a new scan if reading fails: with waits, and under another root if this one is gone."""
        return self._retried(lambda: self.pick.run(lambda root: work(self.table(root).scan(columns, **options))))

    def lookup(self, left: DataFrame, on: dict[str, str], how: str = "left", columns: Sequence[str] | None = None) -> DataFrame:
        """left with the table's columns, through the cache that the options ask for, by the method that they name."""
        asked = left.select(*[left[k].alias(d) for k, d in on.items()])
        dim = self._retried(lambda: self.cache.get(asked))
        return lookup_join(left, dim, on, how, columns, self.options["lookup-method"], self.options.schema.keys or None)

    def start_lookup(self, stream: DataFrame, on: dict[str, str], emit: Callable[[DataFrame, int], None], checkpoint: str, how: str = "left", columns: Sequence[str] | None = None) -> StreamingQuery:
        """Looks up each micro-batch; one that fails is tried again with the root that is available then."""

        def step(batch: DataFrame, number: int) -> None:
            self._retried(lambda: self.pick.run(lambda _: emit(self.lookup(batch, on, how, columns), number)))

        return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    # writing

    def write(self, rows: DataFrame, order_by: Sequence[str] = (), batch: tuple[str, int] | None = None) -> list[Committed]:
        """One commit in each root, under a shared lock, with the metrics that the options ask for."""

        def into(root: str) -> Committed:
            table = self.table(root)
            given = self.options.values
            limit, modification = given.get("rows-in-transaction-limit"), given.get("rows-in-modification-limit")
            timeout = given["transaction-timeout"].total_seconds() if "transaction-timeout" in given else None
            with locked(self.locks, table.path, Mode.SHARED):
                return observed_write(rows, lambda df: table.upsert(df, order_by, batch, rows_limit=limit, timeout=timeout, modification_limit=modification), table.path, self.options["trackable-field"], self.options.metrics(), self.registry)

        return [self._retried(lambda root=root: into(root)) for root in self.roots.values()]

    def start(self, stream: DataFrame, checkpoint: str, writer: str, order_by: Sequence[str] = (), drain: bool = False) -> StreamingQuery:
        """Writes a stream, a commit each commit-transaction-period; with drain what is there now, and no more."""
        w = stream.writeStream.foreachBatch(lambda batch, number: self.write(batch, order_by, (writer, number)) and None).option("checkpointLocation", checkpoint)
        period = self.options["commit-transaction-period"].total_seconds()
        return (w.trigger(availableNow=True) if drain else w.trigger(processingTime=f"{period} seconds")).start()
