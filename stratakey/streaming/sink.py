"""Streams into keyed tables, stream-static lookups, and running counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lookup import DimensionCache, lookup_join
from ..operators.metrics import REGISTRY, Registry, observed_write
from ..sources.table import KeyedTable


def upsert_batches(table: KeyedTable, writer: str, order_by: Sequence[str] = (), tracked: str | None = None, maxima: Mapping[str, str] | None = None, registry: Registry = REGISTRY) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each micro-batch is one commit, named by the writer and the batch's number, so a replayed batch changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        observed_write(batch, lambda df: table.upsert(df, order_by, (writer, number)), table.path, tracked, maxima, registry)

    return write


def start_upsert(stream: DataFrame, table: KeyedTable, checkpoint: str, writer: str, order_by: Sequence[str] = (), period: str | None = None, **options: Any) -> StreamingQuery:
    """Writes a stream into a table. period is the commit period; without it, what is there now is written and the query ends."""
    w = stream.writeStream.foreachBatch(upsert_batches(table, writer, order_by, **options)).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=period) if period else w.trigger(availableNow=True)).start()


def start_lookup(stream: DataFrame, cache: DimensionCache, on: dict[str, str], emit: Callable[[DataFrame, int], None], checkpoint: str, how: str = "left", period: str | None = None, **options: Any) -> StreamingQuery:
    """Joins each micro-batch with the dimension as it is when the batch runs, and hands the result on."""

    def step(batch: DataFrame, number: int) -> None:
        asked = batch.select(*[F.col(k).alias(d) for k, d in on.items()])
        emit(lookup_join(batch, cache.get(asked), on, how, **options), number)

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=period) if period else w.trigger(availableNow=True)).start()


def running_counts(stream: DataFrame, key: str, out: str = "cnt") -> DataFrame:
    """Counts a key; on a stream use it with outputMode("update") or ("complete")."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def read_table_stream(stream_source: Any, sf_dir: str, table: str, schema: Any, **options: Any) -> DataFrame:
    """A Parquet file of a folder as a stream: file streams take folders, so the name is a filter."""
    return stream_source.schema(schema).options(**options).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
