"""Made-up rows for demos and tests, and a printing sink."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Sequence:
    """start, start + 1 .. end, and from start again."""

    start: int = 0
    end: int | None = None


@dataclass(frozen=True)
class Random:
    low: float = 0
    high: float = 1_000_000
    length: int = 100


def field(spec: Sequence | Random, kind: T.DataType, n: Column, seed: int) -> Column:
    if isinstance(spec, Sequence):
        out = n + spec.start if spec.end is None else n % (spec.end - spec.start + 1) + spec.start
        return out.cast(kind)
    # a hash of the row's number: repeated runs agree
    u = F.pmod(F.xxhash64(n, F.lit(seed)), F.lit(2**52)) / float(2**52)
    if isinstance(kind, T.StringType):
        hexes = F.concat(*[F.sha2(F.concat_ws(":", n.cast("string"), F.lit(f"{seed}:{i}")), 512) for i in range(-(-spec.length // 128))])
        return F.substring(hexes, 1, spec.length)
    if isinstance(kind, T.BooleanType):
        return u < 0.5
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.timestamp_seconds(spec.low + u * (spec.high - spec.low)).cast(kind)
    value = spec.low + u * (spec.high - spec.low)
    return (F.floor(value) if isinstance(kind, (T.IntegralType, T.DecimalType)) else value).cast(kind)


def rows(spark: SparkSession, schema: T.StructType, fields: Mapping[str, Sequence | Random] | None = None, number_of_rows: int = 1000, seed: int = 0) -> DataFrame:
    n = spark.range(number_of_rows)
    return n.select(*[field((fields or {}).get(f.name, Random()), f.dataType, F.col("id"), seed + i).alias(f.name) for i, f in enumerate(schema.fields)])


def stream(spark: SparkSession, schema: T.StructType, fields: Mapping[str, Sequence | Random] | None = None, rows_per_second: int = 50, seed: int = 0) -> DataFrame:
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(*[field((fields or {}).get(f.name, Random()), f.dataType, F.col("value"), seed + i).alias(f.name) for i, f in enumerate(schema.fields)])


def print_rows(df: DataFrame, n: int = 20) -> StreamingQuery | None:
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", n).outputMode("update").start()
    df.show(n, truncate=False)
    return None
