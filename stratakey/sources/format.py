"""Keyed tables as a format of Spark: spark.read, write, readStream and writeStream with format("stratakey").

    register(spark)
    spark.read.format("stratakey").option("key.event_id", 7).load("hdfs:///tables/events")
    table.arranged(df).write.format("stratakey").mode("append").save("hdfs:///tables/events")

Options are those of a table. `path` is a table, `path-map` its replicas under several roots, of which the first whose log can be read is used, in
the order of `cluster-pick-strategy.firstAvailable.priorities`; this is decided when a loaded DataFrame is first planned, and again in each task: a task
whose files are gone reads the same shard under the next root, where that holds the same batches. `key.<column>` names a value of a key column
and `between` two times of the partition key, as from,to: the one leads to shards and so to single files, the other to partitions. A schema
given to the reader says which columns are read. One shard is read by one task and merged there, so a task holds about as many rows
as a shard has; shards with one folder are streamed.

With `filters` = `pushed` Spark's own comparisons with constants are pushed down as well: of the partition key to partitions, of all keys to
shards, the rest to row groups and rows. This is not the default, because Spark 4.1 keeps one plan of a Python source for each load(): with it a
DataFrame that has been read with a filter would be read with that filter ever after. So a DataFrame loaded with it may stand in one
query, and once. For everything else there is KeyedTable.scan, which Catalyst pushes into.

A write appends: each task writes a file for each partition and shard that it has rows of, so rows should come from
KeyedTable.arranged, which brings each shard into one task. The commit adds them as one version. Keys that stand in several files of a write are
told apart by the columns of `order-by`, then by the whole row, when they are read (NaN counts as the least there); the next merge of the
partition leaves one. A stream's write is named by the option `writer` and the batch's number, so a replayed batch changes nothing. A
stream reads what versions after `starting-version` (0: all there is) added, as it was written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..config.options import TableOptions, listing, mapping
from ..functions import local
from ..schema import TableSchema
from .files import ArrowFiles
from .log import Conflict, VersionLog
from .table import DELTAS, MOUNTED, PARTITION, PIECE, SHARD, SHARD_ROWS, WHOLE, NotMounted, Partitioning, TablePath, entry, escaped, initial_state, shard_paths, stored, visible

FLUSH_ROWS = 1_000_000  # rows that a writing task holds at most, about
COMPARED = {D.EqualTo: pc.equal, D.GreaterThan: pc.greater, D.GreaterThanOrEqual: pc.greater_equal, D.LessThan: pc.less, D.LessThanOrEqual: pc.less_equal}
#: Of these types both engines compare alike.
EXACT = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.DateType, T.TimestampNTZType)


def roots_of(options: Mapping[str, str]) -> list[str]:
    """The folders of the tables that the options name, the preferred first."""
    named = mapping(options["path-map"]) if "path-map" in options else {"": options["path"]}
    first = listing(options.get("cluster-pick-strategy.firstavailable.priorities", ""))
    order = sorted(named, key=lambda n: [p.upper() for p in first].index(n.upper()) if first else 0)
    return [TablePath(named[n]).full for n in order]


def log_of(root: str) -> VersionLog:
    return VersionLog(ArrowFiles(), f"{root}/_versions")


def available(roots: Sequence[str]) -> list[tuple[str, int, dict[str, Any]]]:
    """(root, version, state) of the roots whose tables can be read; the errors of all if none can."""
    out, errors = [], []
    for root in roots:
        try:
            version, state = log_of(root).read()
            if version:
                out.append((root, version, state))
            else:
                errors.append(f"there is no table at {root}")
        except OSError as e:
            errors.append(f"{root}: {e}")
    if not out:
        raise FileNotFoundError("; ".join(errors))
    return out


def asked(options: Mapping[str, str], struct: T.StructType, partitioning: Partitioning | None) -> list[D.Filter]:
    """The filters that the options key.<column> and between name."""
    kinds = to_arrow_schema(struct)
    names = {n.lower(): n for n in struct.names}
    value = lambda name, text: pa.scalar(text).cast(kinds.field(name).type).as_py()
    out: list[D.Filter] = []
    for option, text in options.items():
        if option.startswith("key."):
            if (name := names.get(option[4:].lower())) is None:
                raise ValueError(f"{option} names no column of the table")
            out.append(D.EqualTo((name,), value(name, text)))
    if "between" in options:
        if partitioning is None:
            raise ValueError("option 'between' is for partitioned tables")
        low, high = options["between"].split(",")
        out += [D.GreaterThanOrEqual((partitioning.key,), value(partitioning.key, low)), D.LessThan((partitioning.key,), value(partitioning.key, high))]
    return out


def condition(f: D.Filter) -> pc.Expression | None:
    column = pc.field(f.attribute[0])
    if type(f) in COMPARED:
        return COMPARED[type(f)](column, pc.scalar(f.value))
    if isinstance(f, D.In):
        return column.isin([v for v in f.value if v is not None])
    return column.is_valid() if isinstance(f, D.IsNotNull) else None


class TableReader(D.DataSourceReader):
    def __init__(self, options: Mapping[str, str], wanted: T.StructType):
        self.roots, self.wanted, self.pushes = roots_of(options), wanted, options.get("filters") == "pushed"
        state = available(self.roots)[0][2]
        self.struct, self.keys = stored(state), TableSchema.parse(state["schema"]).keys
        self.filters = asked(options, self.struct, Partitioning(**state["partitioning"]) if state["partitioning"] else None)
        for f in wanted.fields:
            if f.name not in self.struct.names or f.dataType != self.struct[f.name].dataType:
                raise ValueError(f"the table has no column {f.name} of type {f.dataType.simpleString()}")

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if self.pushes and name in self.struct.names and (isinstance(f, D.IsNotNull) or isinstance(self.struct[name].dataType, EXACT)) and condition(f) is not None:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[D.InputPartition]:
        """Shards, several small ones to a task; each as its folders under each root that holds the same."""
        (_, _, state), *others = available(self.roots)
        chosen, rows, tasks = [], 0.0, []
        for n in self._partition_names(state):
            p = state["partitions"][n]
            for shard in self._shards(p["shards"]):
                unit = [self._folders(p, shard)]
                for _, _, other in others:
                    q = other["partitions"].get(n)
                    if q and other["batches"] == state["batches"] and (q["shards"], q["rows"]) == (p["shards"], p["rows"]):
                        unit.append(self._folders(q, shard))
                if unit[0][0]:
                    chosen.append(unit)
                    rows += p["rows"] / p["shards"]
                if chosen and rows >= SHARD_ROWS / 4:
                    tasks.append(D.InputPartition((state.get("order") or [], chosen)))
                    chosen, rows = [], 0.0
        return [*tasks, D.InputPartition((state.get("order") or [], chosen))]

    @staticmethod
    def _folders(p: Mapping[str, Any], shard: int) -> tuple[list[str], bool]:
        """The folders of a shard, oldest first, and whether keys may stand in them more than once."""
        paths = shard_paths(p, shard)
        return paths, len(paths) > 1 or bool(p.get("loose"))

    def _partition_names(self, state: Mapping[str, Any]) -> list[str]:
        names = sorted(state["partitions"])
        if not state["partitioning"]:
            return names
        p = Partitioning(**state["partitioning"])
        at = lambda v: v if isinstance(v, dt.datetime) else dt.datetime.combine(v, dt.time())

        def holds(name: str) -> bool:
            start, end = local.bounds(name, p.scale)
            for f in self.filters:
                if f.attribute != (p.key,) or isinstance(f, D.IsNotNull):
                    continue
                low = high = None  # what the filter leaves lies in [low, high]
                if isinstance(f, (D.EqualTo, D.In)):
                    values = [at(v) for v in (f.value if isinstance(f, D.In) else [f.value]) if v is not None]
                    if not any(start <= v < end for v in values):
                        return False
                elif isinstance(f, (D.GreaterThan, D.GreaterThanOrEqual)):
                    low = at(f.value)
                else:
                    high = at(f.value)
                if (low is not None and end <= low) or (high is not None and start > high):
                    return False
            return True

        return [n for n in names if holds(n)]

    def _shards(self, n: int) -> Sequence[int]:
        """The shards that can hold the keys asked for."""
        asked = []
        for k in self.keys:
            values = [{f.value} if isinstance(f, D.EqualTo) else {v for v in f.value if v is not None} for f in self.filters if f.attribute == (k,) and isinstance(f, (D.EqualTo, D.In))]
            if not values:
                return range(n)
            asked.append(sorted(set.intersection(*values)))
        if not asked or len(list(product(*asked))) > 10_000:
            return range(n)
        kinds = to_arrow_schema(self.struct)
        rows = list(zip(*product(*asked)))
        columns = [pa.array(list(r), kinds.field(k).type) for k, r in zip(self.keys, rows)]
        return sorted({h % n for h in local.key_hash(columns)})

    def read(self, partition: D.InputPartition) -> Iterator[pa.RecordBatch]:
        order, units = partition.value
        target = to_arrow_schema(self.wanted)
        for unit in units:
            for batch in self._unit(unit, order):
                if len(batch):
                    yield pa.RecordBatch.from_arrays([batch[n].cast(target.field(n).type) for n in target.names], schema=target)

    def _unit(self, candidates: Sequence[tuple[list[str], bool]], order: Sequence[str]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = context.attemptNumber() % len(candidates) if context else 0
        for i in range(len(candidates)):
            folders, several = candidates[(first + i) % len(candidates)]
            try:
                opened = [self._opened(f) for f in folders]
                rows = self._merged(opened, order) if several and self.keys else None
                break
            except OSError:
                if i == len(candidates) - 1:
                    raise
        needed = [n for n in self.struct.names if n in {*self.wanted.names, *[f.attribute[0] for f in self.filters]}]
        if rows is not None:
            where = self._condition(self.filters)
            yield from (rows.filter(where) if where is not None else rows).select(needed).to_batches()
        else:
            for d in opened:
                yield from d.scanner(columns=self.wanted.names, filter=self._condition(self.filters)).to_batches()

    @staticmethod
    def _opened(folder: str) -> ds.Dataset:
        fs, p = ArrowFiles.place(folder)
        found = [i.path for i in ArrowFiles().listed(folder) if i.base_name.endswith(".parquet")]
        if not found:
            raise FileNotFoundError(p)
        out = ds.dataset(sorted(found), format="parquet", filesystem=fs)
        for fragment in out.get_fragments():
            fragment.ensure_complete_metadata()
        return out

    @staticmethod
    def _condition(filters: Sequence[D.Filter]) -> pc.Expression | None:
        out = None
        for f in filters:
            out = condition(f) if out is None else out & condition(f)
        return out

    def _merged(self, opened: Sequence[ds.Dataset], order: Sequence[str]) -> pa.Table:
        """The last row of each key: of the newest folder, then by order, then by the whole row."""
        where = self._condition([f for f in self.filters if f.attribute[0] in self.keys])
        kinds = pa.schema([f.with_nullable(True) for f in to_arrow_schema(self.struct)])
        tables = [pa.table([d[n].cast(kinds.field(n).type) for n in kinds.names], schema=kinds) for d in (d.to_table(filter=where) for d in opened)]
        rows = pa.concat_tables([t.append_column("__age", pa.array([i] * len(t), pa.int32())) for i, t in enumerate(tables)])
        by = ["__age", *order, *[n for n in rows.column_names if n not in {*self.keys, *order, "__age"}]]
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(n, "descending") for n in by], null_placement="at_end"))
        rows = rows.append_column("__row", pa.array(range(len(rows)), pa.int64()))
        first = rows.group_by(self.keys, use_threads=False).aggregate([("__row", "min")])["__row_min"]
        return rows.take(first).drop_columns(["__age", "__row"])


@dataclass
class Written(D.WriterCommitMessage):
    """What a task wrote. A stream's commit is made by another writer object than its tasks', so all that it needs is here."""

    folder: str
    rows: dict[str, int]
    shards: dict[str, set[int]]
    files: set[str]
    sizes: dict[tuple[str, str], int]  # shards by root and partition


class TableWriter(D.DataSourceArrowWriter, D.DataSourceStreamArrowWriter):
    """Writes under each root that the options name. Tasks write files, the commit names them in the logs."""

    def __init__(self, options: Mapping[str, str], given: T.StructType, stream: bool = False):
        self.roots, self.order = roots_of(options), listing(options.get("order-by", ""))
        self.writer, self.folder = options.get("writer"), uuid.uuid4().hex
        if stream and not self.writer:
            raise ValueError("option 'writer' names a stream's batches and is required")
        self.plans = []
        for root in self.roots:
            version, state = log_of(root).read()
            if not version:
                state = self._created(root, options)
            self._check(root, state, given)
            self.plans.append((root, state["schema"], state["partitioning"], state["shards"], {n: p["shards"] for n, p in state["partitions"].items()}))

    @staticmethod
    def _created(root: str, options: Mapping[str, str]) -> dict[str, Any]:
        own = {k: v for k, v in options.items() if k not in ("order-by", "writer")}
        o = TableOptions.parse(own if "path-map" in own else {"proxy": "path", **own})
        state = initial_state(o.schema, o.partitioning(), o.attributes(), o["reshard.tablet-count"] or 1, None)
        try:
            log_of(root).commit(0, state)
        except Conflict:
            pass  # someone else was first
        return log_of(root).read()[1]

    def _check(self, root: str, state: Mapping[str, Any], given: T.StructType) -> None:
        if state.get("mounted", MOUNTED) != MOUNTED:
            raise NotMounted(f"{root} is {state['mounted']}")
        struct = stored(state)
        if unknown := [n for n in given.names if n not in struct.names]:
            raise ValueError(f"columns that are not in the table schema: {', '.join(unknown)}")
        if missing := [f.name for f in struct.fields if f.name not in given.names and (not f.nullable or "expression" in f.metadata)]:
            raise ValueError(f"required or computed columns are missing: {', '.join(missing)}; KeyedTable.arranged computes")
        if unknown := [c for c in self.order if c not in struct.names]:
            raise ValueError(f"order-by names columns that the table lacks: {', '.join(unknown)}")
        if state.get("order") and self.order != state["order"]:
            raise ValueError(f"rows of this table are ordered by {', '.join(state['order'])}")

    # in tasks

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        context = TaskContext.get()
        number = context.getLocalProperty("streaming.sql.batchId") if context else None
        out, held, n = Written(self.folder if number is None else f"{self.folder}-{number}", {}, {}, set(), {}), [], 0
        for batch in iterator:
            held.append(batch)
            n += len(batch)
            if n >= FLUSH_ROWS:
                self._flush(held, out)
                held, n = [], 0
        if n:
            self._flush(held, out)
        return out

    def _flush(self, batches: Sequence[pa.RecordBatch], out: Written) -> None:
        given = pa.Table.from_batches(batches)
        for root, schema, partitioning, shards, sizes in self.plans:
            columns = TableSchema.parse(schema)
            target = to_arrow_schema(columns.struct())
            arrays = [given[f.name].cast(f.type) if f.name in given.column_names else pa.nulls(len(given), f.type) for f in target]
            table = pa.table(arrays, schema=pa.schema([f.with_nullable(True) for f in target]))
            if partitioning:
                p = Partitioning(**partitioning)
                names = local.partition_names(table[p.key], p.scale).to_pylist()
            else:
                names = [WHOLE] * len(table)
            hashes = local.key_hash([table[k] for k in columns.keys]) if columns.keys else range(len(table))
            places = [h % sizes.get(n, shards) for h, n in zip(hashes, names)]
            placed = table.append_column(PARTITION, pa.array(names)).append_column(SHARD, pa.array(places, pa.int32()))
            placed = placed.sort_by([(c, "ascending") for c in (PARTITION, SHARD, *[c.name for c in columns.columns if c.sort_order])])
            runs = placed.select([PARTITION, SHARD]).group_by([PARTITION, SHARD], use_threads=False).aggregate([([], "count_all")])
            at = 0
            for run in runs.to_pylist():
                name, shard, count = run[PARTITION], run[SHARD], run["count_all"]
                fs, folder = ArrowFiles.place(f"{root}/data/{out.folder}/{PIECE}=0/{PARTITION}={escaped(name)}/{SHARD}={shard}")
                fs.create_dir(folder, recursive=True)
                file = f"part-{uuid.uuid4().hex}.parquet"
                pq.write_table(placed.slice(at, count).select(target.names), f"{folder}/{file}", filesystem=fs)
                out.files.add(file)
                out.sizes[root, name] = sizes.get(name, shards)
                at += count
                if root == self.roots[0]:
                    out.rows[name] = out.rows.get(name, 0) + count
                    out.shards.setdefault(name, set()).add(shard)

    # in one process beside the driver

    def commit(self, messages: Sequence[Written | None], batchId: int | None = None) -> None:  # noqa: N803
        written = [m for m in messages if m and m.rows]
        if not written:
            return
        whole = Written(written[0].folder, {}, {}, set(), {})
        for m in written:
            for n, c in m.rows.items():
                whole.rows[n] = whole.rows.get(n, 0) + c
                whole.shards.setdefault(n, set()).update(m.shards[n])
            whole.files |= m.files
            whole.sizes |= m.sizes
        for root in self.roots:
            # attempts that failed have left files
            for i in ArrowFiles().listed(f"{root}/data/{whole.folder}", recursive=True):
                if i.extension == "parquet" and i.base_name not in whole.files:
                    ArrowFiles.place(root)[0].delete_file(i.path)
            self._commit(root, whole, batchId)

    def _commit(self, root: str, new: Written, number: int | None, retries: int = 20) -> None:
        log = log_of(root)
        for attempt in range(retries + 1):
            version, state = log.read()
            if number is not None and state["batches"].get(self.writer, -1) >= number:
                return self._discard(root, new.folder)
            p = Partitioning(**state["partitioning"]) if state["partitioning"] else None
            touched = {}
            for n, c in new.rows.items():
                was = state["partitions"].get(n)
                if (was or state)["shards"] != new.sizes[root, n]:
                    raise Conflict(f"partition {n} of {root} has been sharded anew since this write began; try it again")
                if was is None:
                    expires = p and local.expiry_text(n, p.scale, dt.datetime.now(dt.UTC).replace(tzinfo=None), p.ttl_days, p.from_creation_days, p.min_ttl_days)
                    was = {"paths": [], "rows": 0, "expires": expires, "shards": state["shards"]}
                path = f"{root}/data/{new.folder}/{PIECE}=0/{PARTITION}={escaped(n)}"
                holds = {path: sorted(new.shards[n])} if len(new.shards[n]) < was["shards"] else {}
                touched[n] = entry({**was, "loose": [*was.get("loose", []), path]}, [*was["paths"], path], holds, rows=was["rows"] + c)
            commit = {"rows": sum(new.rows.values()), "partitions": len(new.rows), "batch": [self.writer, number], "piece": 0, "pieces": 1, "added": [q["paths"][-1] for q in touched.values()]}
            change = {"partitions": touched, "commit": commit, "order": self.order or state.get("order") or []}
            if number is not None:
                change["batches"] = {self.writer: number}
            try:
                log.commit(version, change)
                return None
            except Conflict:
                if attempt == retries:
                    raise
        return None

    def abort(self, messages: Sequence[Written | None], batchId: int | None = None) -> None:  # noqa: N803
        for folder in {m.folder for m in messages if m}:
            for root in self.roots:
                self._discard(root, folder)

    @staticmethod
    def _discard(root: str, folder: str) -> None:
        """Deletes a folder that no version names; one that is named has been committed, and only the answer was lost."""
        path = f"{root}/data/{folder}"
        _, state = log_of(root).read()
        if not any(x.startswith(f"{path}/") for p in state["partitions"].values() for x in p["paths"]):
            ArrowFiles().delete(path)


class ChangeReader(D.DataSourceStreamReader):
    """The rows that versions added, as they were written."""

    def __init__(self, options: Mapping[str, str], wanted: T.StructType):
        self.roots, self.wanted = roots_of(options), wanted
        self.start = int(options.get("starting-version", 0))

    def _log(self) -> VersionLog:
        return log_of(available(self.roots)[0][0])

    def initialOffset(self) -> dict[str, int]:
        return {"version": self.start}

    def latestOffset(self) -> dict[str, int]:
        return {"version": self._log().read()[0]}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> Sequence[D.InputPartition]:
        log = self._log()
        commits = [log.change(v).get("commit") for v in range(start["version"] + 1, end["version"] + 1)]
        return [D.InputPartition(folder) for c in commits if c for folder in c["added"]]

    def read(self, partition: D.InputPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = ArrowFiles.place(partition.value)
        found = sorted(i.path for i in ArrowFiles().listed(partition.value, recursive=True) if i.base_name.endswith(".parquet"))
        target = to_arrow_schema(self.wanted)
        for batch in ds.dataset(found, format="parquet", filesystem=fs).scanner(columns=self.wanted.names).to_batches():
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch[n].cast(target.field(n).type) for n in target.names], schema=target)


class KeyedTables(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "stratakey"

    def schema(self) -> T.StructType:
        return visible(available(roots_of(self.options))[0][2])

    def reader(self, schema: T.StructType) -> TableReader:
        return TableReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        if overwrite:
            raise ValueError("a keyed table is appended to; mode overwrite has no meaning for it")
        return TableWriter(self.options, schema)

    def streamReader(self, schema: T.StructType) -> ChangeReader:
        return ChangeReader(self.options, schema)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        return TableWriter(self.options, schema, stream=True)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark push filters into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(KeyedTables)
