"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the least node of its component.

    The result reads the table `edges` of the scratch, which the caller clears.

    Each round is two aggregations and joins on a node; hubs are aggregated before the shuffle and their joins can be split. The
    number of rounds grows with the logarithm of the longest path. Loops and repeated edges are harmless.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    e, seen = scratch.store(edges.where("u <> v").select("u", "v").distinct(), "edges"), None
    while True:
        state = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == seen or not state["n"]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()
        seen = state
        e = scratch.store(small_star(large_star(e)), "edges")


def large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least).distinct()
