"""Line deduplication over levelled sorted runs of line hashes.

A run is two bucketed tables, sorted by h, the 128-bit hash of a line's key: `fresh` (h, n_docs, keeper) has the keys that no older
run knew, with their keeper, `again` (h, n_docs) how often the batch has known ones. A new batch is written bucketed and merge-anti-joined
with the fresh keys of each run; buckets meet buckets, so neither side of these joins is shuffled or sorted again. When a level
holds `fanout` runs they are compacted into one run of the next level, so every row is rewritten once a level and a batch meets a
number of runs that grows with the logarithm of the input.

Batches arrive from the largest doc_id down, so the first batch that shows a key also holds its keeper, the largest
doc_id with that key; this is why a later batch never has to change an older run.

Defined cases: null or empty text is one empty line; each row counts as one document, also where doc_id repeats; a null
doc_id orders below all others and keeps a line only where no other row holds it; of rows that tie for the keeper all keep the line;
a very long text is split in one task, its lines are rows; an empty table gives no rows; other columns, whatever their names, are
passed over. Nothing is gathered on the driver but the batch boundaries. Hot lines are pre-aggregated before each shuffle, and where
a line of very many documents is joined with its hash the documents' side is split by AQE.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import WS_CHARS, Scratch, ascii_lower, documents, fresh_path, let, materialise, remove

RUN = "h binary, n_docs long, keeper long"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WS_CHARS)))


def key_hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(doc_id, h): the distinct keys of at least min_chars code points of every row."""
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col("text")), line_key), lambda k: F.length(k) >= min_chars))
    return docs.select("doc_id", F.explode(keys).alias("k")).select("doc_id", key_hash(F.col("k")).alias("h"))


@dataclass
class Run:
    fresh: str
    again: str


class LineRuns:
    """The levels; level i holds runs of about fanout**i batches. Runs are tables of the session's catalogue, stored in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout, self.levels, self.paths = spark, fanout, [], {}
        # as many buckets as a shuffle has partitions: what comes from a shuffle by h is written without another
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[Run]:
        return [r for level in self.levels for r in level]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch with a column h whose key no run holds: what an incremental, first-come deduplication keeps."""
        for r in self.runs():
            batch = batch.join(self.spark.table(r.fresh).select("h"), "h", "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Adds a batch of (doc_id, h) as a run."""
        keys = self._write(batch.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")))
        of_batch = self.spark.table(keys)
        fresh = self._write(self.unseen(of_batch))
        again = self._write(of_batch.join(self.spark.table(fresh).select("h"), "h", "left_anti").select("h", "n_docs"))
        self._drop(keys)
        self._push(0, Run(fresh, again))

    def _write(self, rows: DataFrame) -> str:
        name, path = f"line_run_{uuid.uuid4().hex}", fresh_path(self.spark, "line-run")
        rows.write.bucketBy(self.buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"drop table if exists {name}")
        remove(self.spark, self.paths.pop(name))

    def _push(self, level: int, run: Run) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            both = lambda part: reduce(DataFrame.union, [self.spark.table(getattr(r, part)) for r in old])
            # no key is in two fresh tables
            merged = Run(self._write(both("fresh").repartition(self.buckets, "h")), self._write(both("again").groupBy("h").agg(F.sum("n_docs").alias("n_docs"))))
            for r in old:
                self._drop(r.fresh)
                self._drop(r.again)
            self._push(level + 1, merged)

    def folded(self) -> DataFrame:
        """(h, n_docs, keeper) of all keys."""
        none = F.lit(None).cast("long").alias("keeper")
        parts = [p for r in self.runs() for p in (self.spark.table(r.fresh), self.spark.table(r.again).select("h", "n_docs", none))]
        rows = reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], RUN)
        return rows.groupBy("h").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))

    def clear(self) -> None:
        for name in list(self.paths):
            self._drop(name)
        self.levels = []


def batches(lines: DataFrame, n: int) -> Iterator[DataFrame]:
    """n ranges of doc_id, from the largest down; null ids come last."""
    at = [i / n for i in range(1, n)]
    cuts = sorted({float(c) for c in lines.stat.approxQuantile("doc_id", at, 0.01)}, reverse=True) if at else []
    d, above = F.col("doc_id"), None
    for c in cuts:
        yield lines.where(d > c if above is None else (d > c) & (d <= above))
        above = c
    rest = F.lit(True) if above is None else (d <= above) | d.isNull()
    yield lines.where(rest)


#: Hashes of dropped lines that are broadcast at most: some ten MB. More are joined by a shuffle.
BROADCAST_LINES = 500_000


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc_id, lines, kept): the lines of every row, and those that stay."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    lines = scratch.store(line_hashes(docs, min_chars), "line-hashes")
    runs = LineRuns(spark, fanout)
    for batch in batches(lines, n_batches):
        runs.add(batch)
    hot = runs.folded().where(F.col("n_docs") >= min_docs).select("h", "keeper")
    gone = lines.join(hot, "h").where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("h").alias("gone"))
    gone = materialise(gone, "dropped-lines")
    runs.clear()
    scratch.clear()
    small = (gone.agg(F.sum(F.size("gone") + 1)).first()[0] or 0) <= BROADCAST_LINES
    gone = F.broadcast(gone) if small else gone
    stays = lambda gone: lambda x: let(line_key(x), lambda k: (F.length(k) < min_chars) | ~F.array_contains(gone, key_hash(k)))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter("lines", stays(F.col("gone"))))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["id"]), "left").select("doc_id", split_lines(F.col("text")).alias("lines"), "gone")
    return joined.select("doc_id", "lines", kept.alias("kept"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir))
    n, k = F.size("lines").cast("long"), F.size("kept").cast("long")
    return out.select("doc_id", n.alias("n_lines"), (n - k).alias("n_dropped"), F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


OP2_SQL = r"""
with l as (
  select rid, doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select rid, doc_id, unnest(ls) as line, unnest(range(len(ls))) as i
        from (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
hot as (select k, max(doc_id) as keeper from l where length(k) >= 40 group by k having count(distinct rid) >= 5),
f as (select l.*, hot.k is not null and l.doc_id is distinct from hot.keeper as gone from l left join hot on l.k = hot.k)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from f group by rid
"""
