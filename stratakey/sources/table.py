"""Keyed, time-partitioned tables on shared storage.

A table is a folder: Parquet data in one sub-folder a batch, partition and shard, and a log of versions that says which folders hold
which partition, oldest first. A write adds folders with its own rows only, so its cost follows the batch and not the table; a reader
takes the last row of each key, without a shuffle where a partition has one folder. When a write finds DELTAS folders in a partition it
merges them, so a row is rewritten about once in so many writes. The pieces of one write have no key in common and are read as one folder. Each write commits one version, or one for so many rows, so a reader or
a failed writer never sees half of one. A batch named by (writer, number) commits once however often it is retried.

Keys are unique within a partition: each partition is a table of its own. A row's shard is its key's hash modulo the partition's number
of shards, which all its folders share: a write that makes a partition outgrow its shards doubles them and merges it. So a key is in one
file of each folder, and point() reads no other. Folders written through Spark's format may be "loose": a key may stand in one more than once.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import partition as parts
from ..functions.partition import Partitioning
from ..functions.shard import key_hash, last_partitions_count, to_unsigned
from ..locks import LocksProvider, Mode, NoLocks, do_unless, locked
from ..operators.batches import numbered
from ..schema import STORE_TYPES, ColumnSpec, TableSchema
from .files import JvmFiles
from .log import MORE, Conflict, VersionLog

PARTITION, SHARD, AGE, PIECE, MODIFICATION = "__partition", "__shard", "__age", "__piece", "__modification"
DELTAS = 8  # folders of a partition that are merged by the next write
SHARD_ROWS = 1_000_000  # rows that one task writes at most on average
WHOLE = "all"
MOUNTED, UNMOUNTED = "mounted", "unmounted"
logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class TablePath:
    """Where a table lies. Without a name it is <base>/<last part of base>."""

    base: str
    name: str | None = None
    cluster: str | None = None

    @property
    def full(self) -> str:
        base = self.base.rstrip("/")
        return f"{base}/{self.name or base.rsplit('/', 1)[-1]}"


@dataclass
class Committed:
    """What a write did: its version, and whether it was the first to commit this batch."""

    version: int
    fresh: bool
    partitions: list[str] = field(default_factory=list)
    rows: int = 0


class KeyedTable:
    def __init__(self, spark: SparkSession, path: TablePath | str, locks: LocksProvider | None = None):
        self.spark, self.path, self.locks = spark, (path.full if isinstance(path, TablePath) else path).rstrip("/"), locks or NoLocks()
        self.files = JvmFiles(spark)
        self.log = VersionLog(self.files, f"{self.path}/_versions")

    # metadata

    def exists(self) -> bool:
        return bool(self.log.versions())

    def create(self, schema: TableSchema, partitioning: Partitioning | None = None, attributes: dict[str, Any] | None = None, shards: int = 1, last_partitions: int | None = None, mounted: bool = True) -> bool:
        """Creates the table unless it exists; False if it did. Concurrent creators end with one table.

        shards is the least number of shards of a partition; with last_partitions a new one gets as many as the mean of so many before it.
        A table made without being mounted takes writes only after mount().
        """
        state = initial_state(schema, partitioning, attributes, shards, last_partitions, mounted)

        def make() -> None:
            try:
                self.log.commit(0, state)
            except Conflict:
                pass  # someone else was first, which is as good

        return do_unless(self.locks, self.path, self.exists, make)

    def state(self, version: int | None = None) -> tuple[int, dict[str, Any]]:
        v, state = self.log.read(version)
        if not v:
            raise FileNotFoundError(f"there is no table at {self.path}")
        return v, state

    @property
    def schema(self) -> TableSchema:
        return TableSchema.parse(self.state()[1]["schema"])

    @property
    def partitioning(self) -> Partitioning | None:
        p = self.state()[1]["partitioning"]
        return Partitioning(**p) if p else None

    def attributes(self) -> dict[str, Any]:
        return self.state()[1]["attributes"]

    def partitions(self) -> list[str]:
        return sorted(self.state()[1]["partitions"])

    def partition_table(self) -> DataFrame:
        """(partition, shards, expires) of the partitions, for the sharding rules."""
        return self._partition_table(self.state()[1])

    def _partition_table(self, state: dict[str, Any]) -> DataFrame:
        rows = [(n, p["shards"], p["expires"]) for n, p in sorted(state["partitions"].items())]
        return self.spark.createDataFrame(rows, "partition string, n int, expires string")

    # reading

    def scan(self, columns: Sequence[str] | None = None, limit: int = -1, between: tuple[Any, Any] | None = None, version: int | None = None, strict: bool = False, with_partition: bool = False) -> DataFrame:
        """The rows. between names times [from, to) of the partition key and reads only the partitions that can hold them.

        strict refuses partitioned tables, as scans of single tables do.
        """
        _, state = self.state(version)
        partitioning = Partitioning(**state["partitioning"]) if state["partitioning"] else None
        if strict and partitioning:
            raise NotImplementedError("partitioned tables are not scanned in strict mode")
        struct = stored(state)
        names = sorted(state["partitions"])
        if between and partitioning:
            names = self._overlapping(names, partitioning, between)
        df = self._rows(state, names, columns if not between else None)
        if between and partitioning:
            k = F.col(partitioning.key)
            df = df.where((k >= F.lit(between[0]).cast(struct[partitioning.key].dataType)) & (k < F.lit(between[1]).cast(struct[partitioning.key].dataType)))
        if with_partition:
            df = df.withColumn(PARTITION, partitioning.name() if partitioning else F.lit(WHOLE))
        df = df.select(*(visible(state).names if columns is None else columns), *([PARTITION] if with_partition else []))
        return df.limit(limit) if limit >= 0 else df

    def point(self, keys: Mapping[str, Any], columns: Sequence[str] | None = None, between: tuple[Any, Any] | None = None) -> DataFrame:
        """The rows of one key: in each folder only the file of the key's shard is read, and of partitions those that between allows."""
        _, state = self.state()
        schema = TableSchema.parse(state["schema"])
        if set(keys) != set(schema.keys) or not keys:
            raise ValueError(f"a point lookup takes the key columns {', '.join(schema.keys)}, not {', '.join(keys)}")
        struct, names = stored(state), sorted(state["partitions"])
        if between and state["partitioning"]:
            names = self._overlapping(names, Partitioning(**state["partitioning"]), between)
        values = {k: F.lit(keys[k]).cast(struct[k].dataType) for k in schema.keys}
        by_shards: dict[int, list[str]] = {}
        for n in names:
            by_shards.setdefault(state["partitions"][n]["shards"], []).append(n)
        counts = sorted(by_shards)
        at = self.spark.range(1).select(F.array(*[F.pmod(key_hash(*values.values()), F.lit(n)) for n in counts]) if counts else F.array()).first()[0]
        found = [self._rows(state, by_shards[n], None, [shard]) for n, shard in zip(counts, at)]
        df = reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], struct)
        # computed sort columns come first in each file, so their value skips the row groups of other keys
        sorted_by = [c for c in schema.columns if c.expression and c.sort_order]
        if sorted_by:
            row = self.spark.range(1).select(*[v.alias(k) for k, v in values.items()]).select(*[computed(c).alias(c.name) for c in sorted_by]).first()
            values = {c.name: F.lit(row[c.name]).cast(struct[c.name].dataType) for c in sorted_by} | values
        for k, v in values.items():
            df = df.where(F.col(k) == v)
        return df.select(*(visible(state).names if columns is None else columns))

    def of_keys(self, asked: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """The rows whose keys are among those of asked (the key columns): only the shards that hold such keys are read.

        The shards are found by a pass over asked, which should be a stored table; of them the driver gets numbers, no keys.
        """
        _, state = self.state()
        schema, struct = TableSchema.parse(state["schema"]), stored(state)
        if set(asked.columns) != set(schema.keys):
            raise ValueError(f"a lookup takes the key columns {', '.join(schema.keys)}, not {', '.join(asked.columns)}")
        asked = asked.select(*[F.col(k).cast(struct[k].dataType).alias(k) for k in schema.keys]).distinct()
        by_shards: dict[int, list[str]] = {}
        for n in sorted(state["partitions"]):
            by_shards.setdefault(state["partitions"][n]["shards"], []).append(n)
        counts = sorted(by_shards)
        hashes = key_hash(*map(F.col, schema.keys))
        held = asked.agg(*[F.collect_set(F.pmod(hashes, F.lit(n))).alias(f"s{n}") for n in counts]).first() if counts else None
        found = [self._rows(state, by_shards[n], None, sorted(held[f"s{n}"])) for n in counts if held[f"s{n}"]]
        df = reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], struct)
        return df.join(asked, schema.keys, "left_semi").select(*(visible(state).names if columns is None else columns))

    def _read(self, struct: T.StructType, paths: Sequence[str]) -> DataFrame:
        # the folders' own columns are not wanted, so they are not looked for
        return self.spark.read.schema(struct).option("recursiveFileLookup", True).parquet(*paths) if paths else self.spark.createDataFrame([], struct)

    def _rows(self, state: Mapping[str, Any], names: Sequence[str], columns: Sequence[str] | None = None, shards: Sequence[int] | None = None) -> DataFrame:
        """The rows of some partitions as they are now, or of some shards of each; of columns at least those named."""
        struct = stored(state)
        keys = TableSchema.parse(state["schema"]).keys
        partitioning = Partitioning(**state["partitioning"]) if state["partitioning"] else None
        order = state.get("order") or []
        layered, plain = [], []
        for p in (state["partitions"][n] for n in names):
            for paths in [p["paths"]] if shards is None else [shard_paths(p, s) for s in shards]:
                if keys and (len(layers := in_layers(paths)) > 1 or p.get("loose")):
                    layered += [layers] if layers else []
                else:
                    plain += paths
        out = self._read(struct, plain)
        if not layered:
            return out
        needed = {*keys, *order, *([partitioning.key] if partitioning else []), *(struct.names if columns is None else columns)}
        kept = T.StructType([f for f in struct.fields if f.name in needed])
        by_age = [[path for layers in layered if i <= len(layers) for path in layers[-i]] for i in range(1, max(map(len, layered)) + 1)]
        read = [self._read(kept, paths).withColumn(AGE, F.lit(-i)) for i, paths in enumerate(by_age)]
        rows = reduce(DataFrame.unionByName, read).withColumn(PARTITION, partitioning.name() if partitioning else F.lit(WHOLE))
        # computed sort columns follow from the keys; among them, filters reach the files
        group = [c.name for c in TableSchema.parse(state["schema"]).columns if c.sort_order and c.name in kept.names]
        newest = last_rows(rows, [PARTITION, *group], [AGE, *order]).select(*kept.names)
        return out.select(*kept.names).unionByName(newest) if plain else newest

    def _overlapping(self, names: list[str], p: Partitioning, between: tuple[Any, Any]) -> list[str]:
        if not names:
            return []
        n = self.spark.createDataFrame([(x,) for x in names], "name string")
        begin = parts.parse(F.col("name"), p.scale)
        low, high = (F.lit(x).cast("timestamp_ntz") for x in between)
        return [r[0] for r in n.where((begin < high) & (parts.end(begin, p.scale) > low)).orderBy("name").collect()]

    def history(self) -> DataFrame:
        """(version, rows, partitions, writer, batch, piece, pieces): what each version in the log added; merges and the like add no rows."""
        rows = []
        for v in self.log.versions():
            c = self.log.change(v).get("commit")
            if c:
                rows.append((v, c["rows"], c["partitions"], *c["batch"], c["piece"], c["pieces"]))
        return self.spark.createDataFrame(rows, "version long, rows long, partitions long, writer string, batch long, piece long, pieces long")

    def modifications(self) -> DataFrame:
        """(version, piece, modification, rows): the modifications of the versions whose write had a limit for them, numbered in each from 0."""
        named = []
        for v in self.log.versions():
            c = self.log.change(v).get("commit")
            if c and c.get("modifications"):
                named.append((v, c["piece"], c["modifications"]))
        folders = sorted({n for _, _, n in named})
        struct = T.StructType([T.StructField(PIECE, T.IntegerType()), T.StructField(MODIFICATION, T.LongType()), T.StructField(PARTITION, T.StringType()), T.StructField("count", T.LongType()), T.StructField("write", T.StringType())])
        kept = F.broadcast(self.spark.createDataFrame(named, f"version long, {PIECE} int, write string"))
        sums = self._read(struct, [f"{self.path}/modifications/{n}" for n in folders]).groupBy("write", PIECE, MODIFICATION).agg(F.sum("count").alias("rows"))
        return sums.join(kept, ["write", PIECE]).select("version", F.col(PIECE).cast("bigint").alias("piece"), F.col(MODIFICATION).alias("modification"), "rows")

    # writing

    def prepared(self, rows: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
        """rows with the table's columns, each key once, and their PARTITION."""
        _, state = self.state()
        schema = TableSchema.parse(state["schema"])
        full = self._typed(rows, schema, order_by)
        partitioning = Partitioning(**state["partitioning"]) if state["partitioning"] else None
        full = full.withColumn(PARTITION, partitioning.name() if partitioning else F.lit(WHOLE))
        last = last_rows(full, [PARTITION, *schema.keys], [f"__o{i}" for i in range(len(order_by))]) if schema.keys else full
        return last.select(*stored(state).names, PARTITION)

    def arranged(self, rows: DataFrame) -> DataFrame:
        """rows for a write through Spark's format: with the computed columns, and each shard in one task, so that it becomes one file."""
        _, state = self.state()
        schema = TableSchema.parse(state["schema"])
        partitioning = Partitioning(**state["partitioning"]) if state["partitioning"] else None
        out = self._typed(rows, schema, ()).withColumn(PARTITION, partitioning.name() if partitioning else F.lit(WHOLE))
        keys = [F.col(k) for k in schema.keys]
        # shards of a partition that exists; a new one gets the least number
        sizes = F.create_map(*[F.lit(x) for n, p in state["partitions"].items() for x in (n, p["shards"])]) if state["partitions"] else None
        size = F.coalesce(sizes[F.col(PARTITION)], F.lit(state["shards"])) if sizes is not None else F.lit(state["shards"])
        return out.repartition(PARTITION, F.pmod(key_hash(*keys), size)).drop(PARTITION) if keys else out.repartition(PARTITION).drop(PARTITION)

    def _typed(self, rows: DataFrame, schema: TableSchema, order_by: Sequence[str]) -> DataFrame:
        """rows in the schema's columns and types, missing ones null, and then the computed ones."""
        schema.check_covers(rows.schema)
        missing = [c.name for c in schema.write_schema().columns if c.required and c.name not in rows.columns]
        if missing:
            raise ValueError(f"required columns are missing: {', '.join(missing)}")
        given = schema.write_schema().struct().fields
        order = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
        out = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in given], *order)
        return out.withColumns({c.name: computed(c) for c in schema.columns if c.expression})

    def upsert(self, rows: DataFrame, order_by: Sequence[str] = (), batch: tuple[str, int] | None = None, retries: int = 5, now: str | None = None, rows_limit: int | None = None, timeout: float | None = None, modification_limit: int | None = None) -> Committed:
        """Writes rows; of rows with one key the last by order_by stays, and it replaces the row that the table has.

        Without keys the rows are added. With rows_limit no version adds more rows: the batch is cut by key order and committed piece after
        piece, and a batch that is tried again goes on after the pieces that it has committed. Data are written once, also where commits
        conflict. With modification_limit too the rows of each version are counted by modifications of so many rows, in the same order, and the
        version names the table of these counts. A write that takes longer than timeout seconds before its last commit fails with TimeoutError. An error has the number of rows as rows_seen once
        they are counted.
        """
        version, state = self.state()
        if state.get("mounted", MOUNTED) != MOUNTED:
            raise NotMounted(f"{self.path} is {state['mounted']}")
        if batch and state["batches"].get(batch[0], -1) >= batch[1]:
            return Committed(version, False)
        schema, until = TableSchema.parse(state["schema"]), None if timeout is None else time.monotonic() + timeout
        last = self.prepared(rows, order_by).persist()
        try:
            if rows_limit is None:
                return self._write_all(last.withColumn(PIECE, F.lit(0)), schema, batch, retries, now, until)
            sortable = schema.keys or [f.name for f in stored(state).fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
            # a first column with one value would leave the sort nothing to tell rows apart by at once
            with numbered(last, [PARTITION, *sortable] if state["partitioning"] or not sortable else sortable, "__n") as rows:
                placed = rows.withColumn(PIECE, F.expr(f"cast(__n div {rows_limit} as int)"))
                if modification_limit:
                    placed = placed.withColumn(MODIFICATION, F.expr(f"__n % {rows_limit} div {modification_limit}"))
                return self._write_all(placed.drop("__n"), schema, batch, retries, now, until)
        finally:
            last.unpersist()

    def _write_all(self, rows: DataFrame, schema: TableSchema, batch: tuple[str, int] | None, retries: int, now: str | None, until: float | None) -> Committed:
        listed = uuid.uuid4().hex if MODIFICATION in rows.columns else None
        sizes = rows.groupBy(PIECE, PARTITION).count()
        if listed:
            by_modification = rows.groupBy(PIECE, PARTITION, MODIFICATION).count().withColumn("write", F.lit(listed))
            by_modification.write.parquet(f"{self.path}/modifications/{listed}")
            rows = rows.drop(MODIFICATION)
            sizes = self._read(by_modification.schema, [f"{self.path}/modifications/{listed}"]).groupBy(PIECE, PARTITION).agg(F.sum("count"))
        counts = {(r[0], r[1]): r[2] for r in sizes.collect()}
        total, pieces = sum(counts.values()), max((p for p, _ in counts), default=0) + 1
        of_piece: list[dict[str, int]] = [{} for _ in range(pieces)]
        for (p, n), c in counts.items():
            of_piece[p][n] = c
        # without keys any shard may take a row, so a piece that one task can write is one file
        by_piece = not schema.keys and pieces > 1 and max(map(sum, (own.values() for own in of_piece))) <= SHARD_ROWS
        try:
            _, state = self.state()
            shards = self._shard_plan(state, counts)
            folder, holds = self._write(rows, schema, shards, by_piece)
            done, touched = None, set()
            for piece, own in enumerate(of_piece):
                for attempt in range(retries + 1):
                    version, state = self.state()
                    opened = state.get("open", {}).get(batch[0]) if batch else None
                    if batch and state["batches"].get(batch[0], -1) >= batch[1]:
                        # another attempt has finished the batch
                        return done or Committed(version, False)
                    if opened and opened[0] == batch[1] and opened[1] > piece:
                        break
                    if until is not None and time.monotonic() > until:
                        raise TimeoutError(f"the write of {total} rows took longer than its transaction may")
                    try:
                        moved = {n for n in own if state["partitions"].get(n, {}).get("shards", shards[n]) != shards[n]}
                        if moved:  # shards have grown in between: write again what they hold
                            shards |= self._shard_plan(state, {(0, n): own[n] for n in moved})
                            again, more = self._write(rows.where((F.col(PIECE) == piece) & F.col(PARTITION).isin(sorted(moved))), schema, {n: shards[n] for n in moved}, by_piece)
                            holds |= more
                        else:
                            again = folder
                        paths = {n: place(again if n in moved else folder, n, piece) for n in own}
                        if by_piece:
                            holds |= {paths[n]: [piece % shards[n]] for n in own if shards[n] > 1}
                        change = self._change(state, own, paths, holds, shards, schema, now, merge=pieces == 1)
                        change["commit"] = {"rows": sum(own.values()), "partitions": len(own), "batch": list(batch or (None, None)), "piece": piece, "pieces": pieces, "added": list(paths.values())}
                        if listed:
                            change["commit"]["modifications"] = listed
                        if batch:
                            final = piece == pieces - 1
                            change |= {"batches": {batch[0]: batch[1]}, "open": {batch[0]: None}} if final else {"open": {batch[0]: [batch[1], piece + 1]}}
                        touched |= set(own)
                        done = Committed(self.log.commit(version, change), True, sorted(touched), total)
                        break
                    except Conflict:
                        if attempt == retries:
                            raise
            if pieces > 1:
                self.compact(DELTAS, sorted(touched))
            return done or Committed(self.state()[0], False)
        except Exception as e:
            e.rows_seen = total
            raise

    def _shard_plan(self, state: Mapping[str, Any], counts: Mapping[tuple[int, str], int]) -> dict[str, int]:
        sums: dict[str, int] = {}
        for (_, n), c in counts.items():
            sums[n] = sums.get(n, 0) + c
        return {n: state["partitions"].get(n, {}).get("shards") or self._shards(state, n, c) for n, c in sums.items()}

    def _change(self, state: Mapping[str, Any], counts: Mapping[str, int], paths: Mapping[str, str], holds: Mapping[str, Sequence[int]], shards: Mapping[str, int], schema: TableSchema, now: str | None, merge: bool) -> dict[str, Any]:
        """What adding these folders changes. Partitions with many folders, and those that outgrow their shards, are merged."""
        known = state["partitions"]
        expires = self._expiry([n for n in counts if n not in known], Partitioning(**state["partitioning"]) if state["partitioning"] else None, now)
        touched, more = {}, {}
        for n, c in counts.items():
            if n in known and not merge:
                more[n] = {"paths": [paths[n]], "rows": c, "holds": {paths[n]: holds[paths[n]]} if paths[n] in holds else {}}
                continue
            was = known.get(n, {"paths": [], "rows": 0, "expires": expires.get(n), "shards": shards[n]})
            touched[n] = entry(was, [*was["paths"], paths[n]], holds, rows=was["rows"] + c)
        if merge:
            grown = {n: self._shards(state, n, p["rows"]) for n, p in touched.items()}
            full = sorted(n for n, p in touched.items() if len(p["paths"]) > DELTAS or grown[n] != p["shards"])
            touched |= self._merged({**state, "partitions": {**known, **touched}}, full, schema, grown)
        return {"partitions": touched, MORE: more} if more else {"partitions": touched}

    def _merged(self, state: Mapping[str, Any], names: Sequence[str], schema: TableSchema, shards: Mapping[str, int]) -> dict[str, Any]:
        """The entries of partitions after their folders are merged into one each."""
        if not names:
            return {}
        partitioning = Partitioning(**state["partitioning"]) if state["partitioning"] else None
        whole = self._rows(state, names).withColumn(PARTITION, partitioning.name() if partitioning else F.lit(WHOLE)).withColumn(PIECE, F.lit(0))
        folder, holds = self._write(whole, schema, {n: shards[n] for n in names})
        return {n: entry(state["partitions"][n], [place(folder, n)], holds, shards=shards[n]) for n in names}

    def _shards(self, state: Mapping[str, Any], name: str, rows: int) -> int:
        """As many shards as the rows need, and no fewer than its rule says; those of a partition that exists are doubled until they suffice."""
        need = -(-rows // SHARD_ROWS)
        own = state["partitions"].get(name, {}).get("shards")
        if own is not None:
            while own < need:
                own *= 2
            return own
        least = state["shards"]
        if state["last_partitions"] and state["partitions"]:
            least = last_partitions_count(self._partition_table(state), name, state["last_partitions"], state["shards"]).first()[0]
        return max(least, need)

    def _write(self, rows: DataFrame, schema: TableSchema, shards: Mapping[str, int], by_piece: bool = False) -> tuple[str, dict[str, list[int]]]:
        """Writes rows with their PIECE and PARTITION, each partition in its number of shards by hash of the key, or of the row where there is none.

        With by_piece the pieces take the shards in turn. The folder, and for the paths that lack some of their shards those that they
        hold; with by_piece the caller knows them.
        """
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        placed = sharded(rows, schema, shards, by_piece)
        if not by_piece:  # pieces are runs of rows in order, which are in few tasks as they come
            placed = placed.repartition(PIECE, PARTITION, SHARD)
        placed.sortWithinPartitions(PIECE, PARTITION, SHARD, *[c.name for c in schema.columns if c.sort_order]).write.partitionBy(PIECE, PARTITION, SHARD).parquet(folder)
        if by_piece or max(shards.values(), default=1) == 1:
            return folder, {}
        held = sharded(rows.select(PIECE, PARTITION, *hashed(schema)), schema, shards).groupBy(PIECE, PARTITION).agg(F.collect_set(SHARD).alias("s"))
        some = [(place(folder, r[1], r[0]), sorted(r["s"]), shards[r[1]]) for r in held.collect()]
        return folder, {path: own for path, own, n in some if len(own) < n}

    def compact(self, more_than: int = 1, names: Sequence[str] | None = None) -> int:
        """Merges the folders of each partition, or those named, that has more than so many, in one commit; the version."""
        version, state = self.state()
        wanted = state["partitions"] if names is None else {n: state["partitions"][n] for n in names if n in state["partitions"]}
        grown = {n: self._shards(state, n, p["rows"]) for n, p in wanted.items()}
        several = sorted(n for n, p in wanted.items() if len(p["paths"]) > more_than or p.get("loose") or grown[n] != p["shards"])
        if not several:
            return version
        return self.log.commit(version, {"partitions": self._merged(state, several, TableSchema.parse(state["schema"]), grown)})

    def _expiry(self, names: list[str], p: Partitioning | None, now: str | None) -> dict[str, str | None]:
        if not p or not names:
            return {}
        n = self.spark.createDataFrame([(x,) for x in names], "name string")
        at = F.lit(now).cast("timestamp_ntz") if now else F.current_timestamp().cast("timestamp_ntz")
        e = parts.expiry(parts.parse(F.col("name"), p.scale), p.scale, at, p.ttl_days, p.from_creation_days, p.min_ttl_days)
        return {r[0]: r[1] for r in n.select("name", parts.expiry_text(e)).collect()}

    def drop_expired(self, now: str) -> list[str]:
        """Takes the partitions that have expired out of the table."""
        version, state = self.state()
        gone = sorted(n for n, p in state["partitions"].items() if p["expires"] and p["expires"] <= now)
        if gone:
            self.log.commit(version, {"partitions": dict.fromkeys(gone)})
        return gone

    def vacuum(self) -> int:
        """Deletes data folders that the last version doesn't name, versions before the last checkpoint, and counts of modifications that no version left names; returns how many data folders. Not while writers run."""
        _, state = self.state()
        used = {path.removeprefix(f"{self.path}/data/").split("/", 1)[0] for p in state["partitions"].values() for path in p["paths"]}
        old = [n for n in self.files.names(f"{self.path}/data") if n not in used]
        for n in old:
            self.files.delete(f"{self.path}/data/{n}")
        self.log.prune()
        named = {(self.log.change(v).get("commit") or {}).get("modifications") for v in self.log.versions()}
        for n in self.files.names(f"{self.path}/modifications"):
            if n not in named:
                self.files.delete(f"{self.path}/modifications/{n}")
        return len(old)

    # mount states: a table that isn't mounted is read, but not written

    def mounted(self) -> str:
        return self.state()[1].get("mounted", MOUNTED)

    def unmount(self) -> int:
        version, _ = self.state()
        return self.log.commit(version, {"mounted": UNMOUNTED})

    def mount(self, attempts: int = 5, backoff: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> None:
        """Mounts the table unless it is mounted; when another commit comes between, waits and looks again, so many times."""
        for attempt in range(attempts + 1):
            version, state = self.state()
            if state.get("mounted", MOUNTED) == MOUNTED:
                return
            if attempt == attempts:
                raise NotMounted(f"{self.path} is still {state['mounted']} after {attempts} attempts")
            try:
                self.log.commit(version, {"mounted": MOUNTED})
                return
            except Conflict:
                sleep(backoff)

    def wait_mounted(self, timeout: float = 300.0, poll: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> bool:
        """Waits until someone has mounted the table; when that takes too long it only warns."""
        waited = 0.0
        while self.mounted() != MOUNTED:
            if waited >= timeout:
                logger.warning("%s isn't mounted after %s s", self.path, timeout)
                return False
            sleep(poll)
            waited += poll
        return True


class NotMounted(RuntimeError):
    pass


def computed(c: ColumnSpec) -> Column:
    """A computed column's value. Hashes of the store are xxhash64 here; a hash in an unsigned column is read as unsigned."""
    value = F.expr(re.sub(r"\b(farm_hash|hash)\s*\(", "xxhash64(", c.expression))
    kind = STORE_TYPES[c.type]
    if c.type != "uint64":
        return value.cast(kind)
    # whole numbers keep their bits, as the store's unsigned arithmetic does
    return to_unsigned(value.cast("bigint"))


def initial_state(schema: TableSchema, partitioning: Partitioning | None = None, attributes: dict[str, Any] | None = None, shards: int = 1, last_partitions: int | None = None, mounted: bool = True) -> dict[str, Any]:
    """What the first version of a table says."""
    if partitioning:
        parts.scale_of(partitioning.scale)
        parts.check_key(schema.struct()[partitioning.key].dataType)
    return {
        "schema": schema.dump(), "partitioning": partitioning and vars(partitioning), "attributes": {"dynamic": True} | (attributes or {}), "shards": shards, "last_partitions": last_partitions,
        "partitions": {}, "batches": {}, "open": {}, "mounted": MOUNTED if mounted else UNMOUNTED,
    }


def stored(state: Mapping[str, Any]) -> T.StructType:
    """The columns that a table's files hold, computed ones included."""
    return TableSchema.parse(state["schema"]).struct()


def visible(state: Mapping[str, Any]) -> T.StructType:
    """The columns that a scan gives when none are named."""
    return TableSchema.parse(state["schema"]).write_schema().struct()


def shard_paths(partition: Mapping[str, Any], shard: int) -> list[str]:
    """The folders of one shard of a partition, oldest first, without those that hold no row of it."""
    holds = partition.get("holds", {})
    return [f"{p}/{SHARD}={shard}" for p in partition["paths"] if p not in holds or shard in holds[p]]


def entry(was: Mapping[str, Any], paths: Sequence[str], holds: Mapping[str, Sequence[int]], **changes: Any) -> dict[str, Any]:
    """A partition's entry with other paths. holds names the shards of the paths that lack some."""
    own = set(paths)
    kept = {p: h for p, h in {**was.get("holds", {}), **holds}.items() if p in own}
    loose = [p for p in was.get("loose", []) if p in own]
    return {k: v for k, v in {**was, **changes, "paths": list(paths), "holds": kept, "loose": loose}.items() if v or k not in ("holds", "loose")}


def place(folder: str, name: str, piece: int = 0) -> str:
    return f"{folder}/{PIECE}={piece}/{PARTITION}={escaped(name)}"


def in_layers(paths: Sequence[str]) -> list[list[str]]:
    """The folders of a partition, those of pieces that one write added one after another together: each of its keys is in one piece."""
    return [list(g) for _, g in groupby(paths, lambda p: p.rsplit(f"/{PIECE}=", 1)[0])]


def hashed(schema: TableSchema) -> list[str]:
    """The columns whose hash decides the shard."""
    return schema.keys or [f.name for f in schema.write_schema().struct().fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def sharded(rows: DataFrame, schema: TableSchema, shards: Mapping[str, int], by_piece: bool = False) -> DataFrame:
    """rows that have their PIECE and PARTITION, with their SHARD."""
    sizes = rows.sparkSession.createDataFrame(list(shards.items()) or [("", 1)], "__name string, __shards int")
    shard = F.pmod(F.col(PIECE) if by_piece else key_hash(*[F.col(k) for k in hashed(schema)]), F.col("__shards")).cast("int")
    placed = rows.join(F.broadcast(sizes), F.col(PARTITION) == F.col("__name"))
    # a column that the optimizer knows to be constant would leave the order of rows, and the writer would sort anew without the keys
    placed = placed.withColumns({SHARD: shard, PARTITION: F.col("__name"), PIECE: F.col(PIECE) + F.least(F.col("__shards"), F.lit(0))})
    return placed.drop("__name", "__shards")


def escaped(name: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^" or ord(c) < 32 or ord(c) == 127 else c for c in name)


def last_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row a key: the greatest by order_by, then by the whole row, so that the choice is never left to chance."""
    rest = [c for c in df.columns if c not in keys]
    sortable = [c for c in rest if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    order = F.struct(*[F.col(c) for c in (*order_by, *[c for c in sortable if c not in order_by])]) if sortable else F.lit(0)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest) if rest else F.lit(0), order).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def create_from(spark: SparkSession, options: Any, locks: LocksProvider | None = None, path: str | None = None) -> KeyedTable:
    """The table of parsed options at their path or another, created if it is missing."""
    table = KeyedTable(spark, TablePath(path or options["path"], None), locks)
    if options["eager-initialization"] or not table.exists():
        last = options["reshard.last-partitions-count"] if options["reshard.strategy"] == "LAST_PARTITIONS" else None
        created = table.create(options.schema, options.partitioning(), options.attributes(), options["reshard.tablet-count"] or 1, last, mounted=False)
        if created or options["mount-mode"] == "ALWAYS":
            if table.mounted() != MOUNTED:
                with locked(table.locks, table.path, Mode.EXCLUSIVE):
                    table.mount()
        else:
            table.wait_mounted()
    return table
