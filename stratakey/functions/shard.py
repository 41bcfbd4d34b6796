"""Sharding arithmetic over the unsigned 64-bit hash range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE = 2**64
U = "decimal(20,0)"


def pivots(n: int) -> list[int | None]:
    """Lower ends of n uniform shards as unsigned numbers; the first has none."""
    if n < 1:
        raise ValueError("a table has at least one shard")
    return [None, *(RANGE * i // n for i in range(1, n))]


def signed(u: int) -> int:
    return u - RANGE if u >= RANGE // 2 else u


def divided(a: Column, b: Column) -> Column:
    """The whole part of a / b for whole numbers of any size; decimal division would round."""
    a, b = a.cast("decimal(38,0)"), b.cast("decimal(38,0)")
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")


def pivot_table(spark: SparkSession, n: int) -> DataFrame:
    """(shard, pivot, pivot_signed) for a table of n shards; the first pivot is 0 here."""
    i = F.col("id").cast("int")
    p = divided(F.lit(str(RANGE)).cast("decimal(22,0)") * i, F.lit(n)).cast(U)
    return spark.range(n).select(i.alias("shard"), p.alias("pivot"), to_signed(p).alias("pivot_signed"))


def to_signed(u: Column) -> Column:
    """An unsigned number as the signed number of the same 64 bits."""
    top = F.lit(str(RANGE // 2)).cast(U)
    return F.when(u >= top, u - F.lit(str(RANGE)).cast("decimal(21,0)")).otherwise(u).cast("bigint")


def to_unsigned(x: Column) -> Column:
    d = x.cast("decimal(21,0)")
    return F.when(x < 0, d + F.lit(str(RANGE)).cast("decimal(21,0)")).otherwise(d).cast(U)


def shard_of(hash_: Column, n: int) -> Column:
    """The shard of a signed 64-bit hash among n; a rounded-down pivot belongs to the shard above it."""
    u, whole = to_unsigned(hash_), F.lit(str(RANGE)).cast("decimal(22,0)")
    t = divided(u * F.lit(n).cast("decimal(6,0)"), whole).cast("int")
    next_ = divided((t + 1).cast("decimal(8,0)") * whole, F.lit(n))
    return F.least(t + F.when(u >= next_, 1).otherwise(0), F.lit(n - 1)).cast("int")


def key_hash(*keys: Column) -> Column:
    return F.xxhash64(*keys)


def last_partitions_count(partitions: DataFrame, current: str, last: int, default: int, name: str = "partition", count: str = "n") -> DataFrame:
    """(shards): the mean count of the `last` newest partitions, without the current one and empty ones, cut to an integer.

    The newest are chosen before the current one is left out.
    """
    newest = partitions.orderBy(F.col(name).desc()).limit(last)
    used = newest.where((F.col(name) != current) & (F.col(count) > 0))
    return used.agg(F.coalesce(F.floor(F.avg(count)).cast("int"), F.lit(default)).alias("shards"))


def check_resharding(strategy: str = "NONE", shards: int | None = None, uniform: bool = False, last: int = 7) -> None:
    if strategy == "NONE":
        return
    if strategy not in ("FIXED", "LAST_PARTITIONS"):
        raise ValueError(f"unknown reshard strategy {strategy!r}")
    if shards is None:
        raise ValueError(f"reshard.tablet-count is required for strategy {strategy}")
    if not uniform:
        raise NotImplementedError("only uniform sharding is available")
    if shards < 1 or strategy == "LAST_PARTITIONS" and last < 1:
        raise ValueError("reshard counts must be positive")
