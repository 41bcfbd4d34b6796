"""Sharded storage with size-tiered compaction and a versioned manifest.

An arrival becomes a run: a folder of small immutable Parquet shards. Runs of similar size form a tier (powers of `fanout`);
when a tier holds `fanout` runs they are merged into one run of files of about `target_bytes`, so each row is rewritten once a
tier. Merging reads whole runs and writes as many files as the target asks for, without a shuffle: tasks take neighbouring
scan partitions. A change becomes visible only when its manifest, the list of runs with their files, is renamed to the next
version, which fails if another writer has taken that version; the loser tries again on top of it, without writing its data
again. Readers name a version and see exactly its runs. Data are deleted by vacuum() only, which keeps what the last versions name.

The driver holds the manifest only: an entry a shard. Defined cases: an empty arrival adds no run and no version; repeated
rows are kept; null ids arrive first; ids that tie arrive together; a text longer than a shard is one row of one shard; any columns
are stored as they are, but reading adds `shard` and `manifest_version`, so columns of these names are refused.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, fresh_path, remove

ARRIVAL = "stratakey_arrival"


@dataclass
class Shard:
    name: str
    rows: int
    bytes: int


@dataclass
class Run:
    name: str
    path: str
    shards: list[Shard] = field(default_factory=list)

    @property
    def bytes(self) -> int:
        return sum(s.bytes for s in self.shards)


class Conflict(RuntimeError):
    """Another writer committed this version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4, base_bytes: int = 1 << 20):
        self.spark, self.root, self.target_bytes, self.fanout, self.base_bytes = spark, root.rstrip("/"), target_bytes, fanout, base_bytes
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    # manifests

    def _fs(self):
        return self._hadoop.Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self._hadoop.Path(f"{self.root}/manifests")
        if not self._fs().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> tuple[int, list[Run]]:
        """The runs of a version, by default the last; version 0 is empty."""
        version = (self.versions() or [0])[-1] if version is None else version
        if not version:
            return 0, []
        text = self.spark.read.option("wholetext", True).text(self._manifest_path(version)).first()[0]
        return version, [Run(r["name"], r["path"], [Shard(**s) for s in r["shards"]]) for r in json.loads(text)["runs"]]

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/v{version:09d}.json"

    def commit(self, version: int, runs: list[Run]) -> int:
        """Publishes runs as the version after `version`, or raises Conflict; the rename is the one visible step."""
        drafts = fresh_name(f"{self.root}/drafts/v{version + 1}")
        out = self._fs().create(self._hadoop.Path(drafts), False)
        out.write(bytearray(json.dumps({"version": version + 1, "runs": [asdict(r) for r in runs]}).encode()))
        out.close()
        final = self._hadoop.Path(self._manifest_path(version + 1))
        self._fs().mkdirs(final.getParent())
        context = self._hadoop.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(self._hadoop.Path(drafts)), context.makeQualified(final), options)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"version {version + 1} exists") from e
            raise
        return version + 1

    # writing

    def _describe(self, path: str) -> Run:
        name = path.removeprefix(f"{self.root}/data/")
        m = F.col("_metadata")
        files = self.spark.read.parquet(path).groupBy(m["file_name"].alias("file"), m["file_size"].alias("size")).agg(F.count(F.lit(1)).alias("n"))
        return Run(name, path, [Shard(f"{name}/{r['file']}", r["n"], r["size"]) for r in files.orderBy("file").collect()])

    def append(self, arrivals: DataFrame, arrival: Column | None = None, retries: int = 20) -> int:
        """Adds each arrival as a run, all in one job and one commit; without `arrival` the rows are one arrival."""
        if taken := {"shard", "manifest_version", ARRIVAL} & set(arrivals.columns):
            raise ValueError(f"columns with reserved names: {', '.join(sorted(taken))}")
        path = fresh_name(f"{self.root}/data/a")
        if arrival is None:
            arrivals.write.parquet(path)
            new = [self._describe(path)]
        else:
            arrivals.withColumn(ARRIVAL, arrival).write.partitionBy(ARRIVAL).parquet(path)
            parts = self._hadoop.Path(path)
            folders = sorted((s.getPath().getName() for s in self._fs().listStatus(parts) if s.isDirectory()), key=lambda n: int(n.split("=")[1]))
            new = [self._describe(f"{path}/{f}") for f in folders]
        new = [r for r in new if r.shards]
        for attempt in range(retries + 1):
            version, runs = self.manifest()
            if not new:
                return version
            try:
                return self.commit(version, runs + new)
            except Conflict:
                if attempt == retries:
                    remove(self.spark, path)
                    raise
        raise AssertionError

    def tier(self, run: Run) -> int:
        return max(0, int(math.log(max(run.bytes, 1) / self.base_bytes, self.fanout))) if run.bytes > self.base_bytes else 0

    def compact(self) -> int:
        """Merges tiers that are full until none is; each merge is a commit of its own."""
        while True:
            version, runs = self.manifest()
            tiers: dict[int, list[Run]] = {}
            for r in runs:
                tiers.setdefault(self.tier(r), []).append(r)
            full = next((t for t in sorted(tiers) if len(tiers[t]) >= self.fanout), None)
            if full is None:
                return version
            self._merge(tiers[full][: self.fanout])

    def _merge(self, old: list[Run]) -> None:
        """Puts one run in the place of old ones; gives up if another writer has taken one of them out."""
        path = fresh_name(f"{self.root}/data/m")
        n = max(1, math.ceil(sum(r.bytes for r in old) / self.target_bytes))
        self.spark.read.parquet(*[r.path for r in old]).coalesce(n).write.parquet(path)
        merged, gone = self._describe(path), {r.name for r in old}
        while True:
            version, runs = self.manifest()
            if not gone <= {r.name for r in runs}:
                remove(self.spark, path)
                return
            try:
                self.commit(version, [r for r in runs if r.name not in gone] + [merged])
                return
            except Conflict:
                continue

    def vacuum(self, keep: int = 1) -> None:
        """Deletes the manifests before the last `keep` ones, and the runs that only they name. Call it when nobody reads older ones."""
        versions = self.versions()
        named = {r.path for v in versions[-keep:] for r in self.manifest(v)[1]}
        for v in versions[:-keep]:
            for r in self.manifest(v)[1]:
                if r.path not in named:
                    remove(self.spark, r.path)
            remove(self.spark, self._manifest_path(v))

    # reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version with the columns shard and manifest_version."""
        version, runs = self.manifest(version)
        if not runs:
            raise ValueError("the store is empty")
        parts = []
        for r in runs:
            parts.append(self.spark.read.parquet(r.path).select("*", F.concat(F.lit(r.name + "/"), F.col("_metadata.file_name")).alias("shard")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn("manifest_version", F.lit(version))


def fresh_name(prefix: str) -> str:
    import uuid

    return f"{prefix}-{uuid.uuid4().hex}"


def arrival_by_range(docs: DataFrame, n: int) -> Column:
    """n arrivals of about as many rows each, by ranges of doc_id, whatever ids there are and however they lie; null ids come with the first."""
    cuts = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.01) if n > 1 else []
    above = [(F.col("doc_id").cast("double") > c).cast("int") for c in sorted(set(cuts))]
    return F.coalesce(reduce(Column.__add__, above, F.lit(0)), F.lit(0))


def shard_documents(docs: DataFrame, n_arrivals: int = 8, root: str | None = None, **options) -> DataFrame:
    """docs through a store: appended as arrivals, compacted, and read at the last version."""
    spark = docs.sparkSession
    store = ShardStore(spark, root or fresh_path(spark, "shards"), **options)
    store.append(docs, arrival_by_range(docs, n_arrivals))
    store.compact()
    if root is None:  # nobody else can know this store
        store.vacuum()
    if not store.manifest()[1]:
        return docs.limit(0).withColumns({"shard": F.lit(""), "manifest_version": F.lit(0)})
    return store.read()


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
    return shard_documents(docs).select("doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "shard", "manifest_version")
