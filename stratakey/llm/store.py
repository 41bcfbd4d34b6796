"""Intermediate tables in the folder that all executors share, and small column helpers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Inside a character class: the white space that separates words.
WS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a single-process session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="stratakey-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: later steps neither recompute it nor depend on any one executor."""
    return written(df, fresh_path(df.sparkSession, label))


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store once nothing reads it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """The stored tables of one operator: a new table under a label takes the place of the old one, clear() deletes all."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_path(self.spark, label)
        out = written(df, path)
        self.drop(label)
        self.paths[label] = path
        return out

    def drop(self, *labels: str) -> None:
        for label in labels:
            if label in self.paths:
                remove(self.spark, self.paths.pop(label))

    def clear(self) -> None:
        self.drop(*list(self.paths))


def release(spark: SparkSession) -> None:
    """Asks both collectors to run: Spark deletes the shuffle files of finished steps only once the driver has collected their plans."""
    gc.collect()
    spark._jvm.System.gc()


def trim() -> None:
    """At the end of a task over whole texts: gives freed memory back, so that an idle Python worker stays small."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


#: Ids that are broadcast at most: some ten MB. More are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def row_key(docs: DataFrame) -> Column:
    """What tells a row from others with its doc_id, null or not: the id and 128 bits of its text. Keys with an id come first."""
    digest = F.coalesce(F.unhex(F.md5(docs["text"])), F.lit(b""))
    return F.struct(docs["doc_id"].isNull().alias("no_id"), docs["doc_id"].alias("id"), digest.alias("digest"))


def without_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs without the rows whose row_key is in keys (one column, gone_key). Texts move only if keys are many."""
    keys = materialise(keys.distinct(), "gone-keys")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    return docs.join(side, row_key(docs) == side["gone_key"], "left_anti")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 250) -> Iterator[None]:
    """Fewer rows an Arrow batch for what runs inside, so that a batch of long texts fits a worker's memory; the setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)
