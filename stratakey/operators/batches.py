"""Numbering the rows of a large table, from which commits of so many rows are cut."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@contextmanager
def numbered(df: DataFrame, order_by: Sequence[str], name: str = "n") -> Iterator[DataFrame]:
    """df with 0, 1, 2.. in the order, without bringing all rows to one task, for use inside the block.

    Rows are range-partitioned and sorted, and a monotonically increasing id has their partition above bit 33 and their place in it
    below; the partitions' sizes, a row each, give the offsets. The sorted rows are cached until the block ends, because a second
    evaluation could draw other ranges. They come in the order, partition by partition.
    """
    parts = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("__own", F.monotonically_increasing_id()).persist()
    try:
        part = F.shiftright("__own", 33)
        sizes = parts.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
        before = F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = sizes.select("__part", before.alias("__before"))
        own = F.col("__own").bitwiseAND(F.lit((1 << 33) - 1))
        yield parts.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(name, own + F.col("__before")).drop("__part", "__own", "__before")
    finally:
        parts.unpersist()
