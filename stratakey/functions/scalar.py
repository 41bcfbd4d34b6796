"""Scalar functions as expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def simple_hash(text: Column, modulus: int = 1000) -> Column:
    """31-based hash over the characters of a text, wrapped to 32 bits, floor modulo; null gives 0. Characters of the first plane only."""
    step = lambda a, c: (a * 31 + F.ascii(c).cast("bigint")) % F.lit(4294967296)
    wrap = lambda a: F.when(a >= 2147483648, a - F.lit(4294967296)).otherwise(a)
    h = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("bigint"), step, wrap)
    return F.coalesce(F.pmod(h, F.lit(modulus)), F.lit(0)).cast("int")


# Ranks of versions by kind.
RELEASE, CANDIDATE, SNAPSHOT, OTHER = 999, 300, 200, 100


def version_number(version: Column) -> Column:
    """major, minor, patch, rank and pre-release number as one number of base 1000; null if the version is malformed."""
    parts = F.split(F.regexp_replace(F.regexp_replace(version, "[^0-9.]", ""), r"\.+$", ""), r"\.")
    num = lambda i: F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint")
    within = lambda c: c.between(0, 999)
    rank = (
        F.when(version.rlike(r"^(\d{1,3}\.){2,3}\d{1,3}$"), RELEASE)
        .when(version.contains("rc"), CANDIDATE)
        .when(version.contains("SNAPSHOT") | version.contains("dev"), SNAPSHOT)
        .otherwise(OTHER)
    ).cast("bigint")
    base = num(0) * 1000**4 + num(1) * 1000**3 + num(2) * 1000**2 + rank * 1000
    three = (F.size(parts) == 3) & within(num(0)) & within(num(1)) & within(num(2))
    four = (F.size(parts) == 4) & within(num(0)) & within(num(1)) & within(num(2)) & within(num(3))
    return F.when(three, base).when(four, base + num(3))


def memory_bytes(size: Column) -> Column:
    """4G, 512M, 10KB, 7B or a bare number in bytes; null if malformed."""
    n = F.regexp_extract(size, r"^(\d+)", 1).try_cast("bigint")
    unit = F.lower(F.trim(F.regexp_replace(size, r"^\d+", "")))
    factor = F.when(unit.isin("", "b", "bb"), 1)
    for i, u in enumerate("kmg", 1):
        factor = factor.when(unit.isin(u, u + "b"), 1024**i)
    return n * factor.cast("bigint")


#: SQL bodies by signature; Spark inlines them, so they are as fast as the expressions above.
SQL_FUNCTIONS = {
    "simple_hash(s STRING) RETURNS INT": """coalesce(cast(pmod(aggregate(filter(split(s, ''), c -> c <> ''), 0L, (a, c) -> (a * 31 + ascii(c)) % 4294967296L,
        a -> if(a >= 2147483648L, a - 4294967296L, a)), 1000) AS INT), 0)""",
}


def register(spark: SparkSession, java: dict[str, tuple[str, str]] | None = None) -> None:
    """Makes the functions known to SQL; java adds functions by class name, as name to (class, return type)."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    for name, (cls, kind) in (java or {}).items():
        spark.udf.registerJavaFunction(name, cls, kind)
