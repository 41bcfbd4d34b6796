"""A Merkle manifest of a dataset: a digest a row, a tree a group, one root over all, and a proof for each row.

A node is the SHA-256 of its children's digests as hex text, one after another; a tree has `fanout` children a node. Rows are numbered
within their group by ranges and offsets, so no group is sorted in one task. Then superblocks are reduced: rows are bucketed by
number // fanout**k, applyInPandas collapses k levels of each bucket to its root, and the bucket roots are reduced in the same way until
every tree has one node left; the groups' roots, in the order of their groups, are a tree once more. Proofs go down the same
steps: those of a bucket's root (upper) are appended to those inside the bucket (lower). A task holds one bucket of at most fanout**k rows, whatever a
group's size, and only digests are shuffled, never texts.

Defined cases: a null value is written `-`, an empty one `0:`; a null group is a group of its own and comes first; null order values
come first, of rows with one order value the smaller digest does; repeated rows are leaves of their own with the same digest;
a lone row's digest is its group's root; a very long text is hashed in one task; an empty table has no rows and the root None; other columns,
whatever their names, are not read. Every step is written to the shared folder, so a lost executor costs a step at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch, ascii_lower, documents

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = {"left": "array<string>", "right": "array<string>", "subroot": "string"}
#: Columns of a manifest that its rows can't have themselves.
OWN = ("tree", "idx", "n", "h", *PROOF)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values: Column) -> Column:
    """The digest of a row: of each value `-` if null, else its bytes' number, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def folded(digest: Column, left: Column, right: Column) -> Column:
    """The root that a digest and its siblings, level by level, lead to."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: F.struct(a.alias("l"), b.alias("r"))), digest, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def proof_text(left: Column, right: Column) -> Column:
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def height(n: int, fanout: int) -> int:
    """The levels above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def above(nodes: Sequence[str], fanout: int) -> list[str]:
    return [sha256("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]


@dataclass
class Manifest:
    root: str | None
    subroots: DataFrame  # (tree, n, h): a row a group
    proofs: DataFrame  # the rows' own columns, tree, idx, h, left, right, subroot


def numbered(rows: DataFrame, order: Sequence[str], scratch: Scratch, label: str) -> DataFrame:
    """rows with a column tree, numbered within it from 0 by order (idx), and their number (n).

    Rows that agree in every order column are spread by where they are stored, so not even those must fit one task.
    """
    at = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    placed = rows.withColumn("__at", F.monotonically_increasing_id()).repartitionByRange(*at, "__at").withColumn("__part", F.spark_partition_id())
    placed = scratch.store(placed, f"{label}-ranges")
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("__size").over(tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = placed.groupBy("tree", "__part").agg(F.count(F.lit(1)).alias("__size"))
    sizes = sizes.select("tree", "__part", before.alias("__before"), F.sum("__size").over(tree).alias("n"))
    own = F.row_number().over(Window.partitionBy("tree", "__part").orderBy(*at[1:], "__at")) - 1
    out = placed.withColumn("__own", own).join(sizes, ["tree", "__part"]).withColumn("idx", (F.col("__own") + F.col("__before")).cast("long"))
    out = scratch.store(out.drop("__at", "__part", "__own", "__before"), label)
    scratch.drop(f"{label}-ranges")
    return out


def bucket(size: int) -> Column:
    return F.expr(f"idx div {size}L")


def reduced(nodes: DataFrame, fanout: int, k: int, scratch: Scratch, label: str) -> list[DataFrame]:
    """The nodes (tree, idx, h, n) after 0, k, 2k.. levels, until every tree has one."""
    size, steps = fanout**k, [nodes]

    def collapse(key: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("idx")
        n, h = int(part["n"].iloc[0]), list(part["h"])
        for _ in range(min(k, height(n, fanout))):
            h = above(h, fanout)
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "h": h, "n": [-(-n // size)]})

    left = nodes.agg(F.max("n")).first()[0] or 0
    while left > 1:
        up = steps[-1].select("tree", "idx", "h", "n").groupBy("tree", bucket(size).alias("b")).applyInPandas(collapse, "tree string, idx long, h string, n long")
        steps.append(scratch.store(up, f"{label}-{len(steps)}"))
        left = -(-left // size)
    return steps


def lowered(nodes: DataFrame, upper: DataFrame, fanout: int, k: int) -> DataFrame:
    """The proofs of nodes: those inside their bucket, then those of the bucket's root in upper (PROOF)."""

    def extend(part: pa.Table, roots: pa.Table) -> pa.Table:
        part = part.sort_by("idx")
        rest = roots.to_pylist()[0]
        sides, h = ([], []), part["h"].to_pylist()
        for _ in range(min(k, height(part["n"][0].as_py(), fanout))):
            sides[0].append(["".join(h[i - i % fanout : i]) for i in range(len(h))])
            sides[1].append(["".join(h[i + 1 : i - i % fanout + fanout]) for i in range(len(h))])
            h = above(h, fanout)
        for name, side in zip(("left", "right"), sides):
            whole = [[level[i // fanout**j] for j, level in enumerate(side)] + rest[name] for i in range(len(part))]
            part = part.append_column(name, pa.array(whole, pa.list_(pa.string())))
        return part.append_column("subroot", pa.array([rest["subroot"]] * len(part), pa.string()))

    schema = nodes.select("*", *[F.lit(None).cast(t).alias(c) for c, t in PROOF.items()]).schema
    by = lambda df, b: df.groupBy("tree", b.alias("b"))
    return by(nodes, bucket(fanout**k)).cogroup(by(upper, F.col("idx"))).applyInArrow(extend, schema)


def manifest(rows: DataFrame, digest: Column, group: Column, order: Sequence[str], fanout: int = 8, k: int = 4, scratch: Scratch | None = None) -> Manifest:
    """The manifest of rows, of which digest is the leaf and group names the tree. The proofs' tables stay in the scratch until it is cleared.

    The rows travel with the proofs, so they should be short: select what is needed before.
    """
    if fanout < 2 or k < 1:
        raise ValueError("a tree needs a fanout of 2 and buckets of one level at least")
    if taken := sorted(set(rows.columns) & set(OWN)):
        raise ValueError(f"columns of the manifest's own names: {', '.join(taken)}")
    scratch = scratch or Scratch(rows.sparkSession)
    # "-" sorts before "=", so a null group comes first and the others by their bytes
    named = rows.select("*", digest.alias("h"), F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-")).alias("tree"))
    named = scratch.store(named, "merkle-leaves")
    leaves = numbered(named, [*order, "h"], scratch, "merkle-numbered")
    scratch.drop("merkle-leaves")
    steps = reduced(leaves, fanout, k, scratch, "merkle-group")
    subroots = steps[-1].select("tree", "h", "n")
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h")
    top_steps = reduced(numbered(tops, ["name"], scratch, "merkle-tops"), fanout, k, scratch, "merkle-top")
    root = top_steps[-1].select("h").first()
    none = F.array().cast("array<string>")
    proofs = top_steps[-1].select("*", none.alias("left"), none.alias("right"), F.col("h").alias("subroot"))
    for nodes in reversed(top_steps[:-1]):
        proofs = lowered(nodes, proofs.select("tree", "idx", *PROOF), fanout, k)
    # a group's root: its proof goes on in the tree of groups
    proofs = proofs.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), "left", "right", F.col("h").alias("subroot"))
    proofs = scratch.store(proofs, "merkle-proofs-of-groups")
    if len(steps) == 1:  # every group is one row
        return Manifest(root and root[0], subroots, leaves.join(proofs, ["tree", "idx"]))
    for i, nodes in enumerate(reversed(steps[:-1])):
        proofs = lowered(nodes, proofs, fanout, k)
        if nodes is not leaves:
            proofs = scratch.store(proofs.select("tree", "idx", *PROOF), f"merkle-proofs-{i}")
    return Manifest(root and root[0], subroots, proofs)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*COLUMNS)
    tampers = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0) & F.col("text").rlike("[A-Z]")
    changed = F.when(tampers, leaf(*[ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS]))
    rows = docs.select("doc_id", "lang", leaf(*map(F.col, COLUMNS)).alias("leaf"), changed.alias("tampered"))
    m = manifest(rows, F.col("leaf"), F.col("lang"), ["doc_id"])
    root = F.lit(m.root).cast("string")
    out = m.proofs.select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2(proof_text(F.col("left"), F.col("right")), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("left"), F.col("right")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))



def _levels(of: str, n: int) -> str:
    """The runs ({of}_r<i>) and nodes ({of}<i + 1>) of n levels above {of}0 (tree, idx, h, n)."""
    out = ""
    for i in range(n):
        out += f"""
{of}_r{i} as (select tree, idx // 8 as b, string_agg(h, '' order by idx) as hs, any_value(n) as n from {of}{i} where n > 1 group by all),
{of}{i + 1} as (select tree, b as idx, sha256(hs) as h, (n + 7) // 8 as n from {of}_r{i} union all select tree, idx, h, n from {of}{i} where n = 1),"""
    return out


def _folds(of: str, rows: str, n: int) -> str:
    """{rows}<n>: {rows}0 (tree, idx, proof, folded) taken up n levels."""
    out = ""
    for i in range(n):
        j = f"f.idx // {8**i} % 8"
        out += f"""
{rows}{i + 1} as (select f.* replace (proof || coalesce(substr(hs, 1, 64 * ({j})) || substr(hs, 64 * ({j}) + 65), '') as proof,
  case when hs is null then folded else sha256(substr(hs, 1, 64 * ({j})) || folded || substr(hs, 64 * ({j}) + 65)) end as folded)
  from {rows}{i} f left join {of}_r{i} r on f.tree = r.tree and f.idx // {8 ** (i + 1)} = r.b),"""
    return out


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(({c})::varchar) || ':' || ({c})::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _step(x: str) -> str:
    return f"(case when ({x}) % 2 = 1 then xor(({x}) // 2, 3988292384) else ({x}) // 2 end)"


#: For up to 8**8 rows of a language and 8**3 languages; crc32 by its table, which is made from its rule.
OP11_SQL = rf"""
with recursive bits(b, i, x) as (select range, 0, range::bigint from range(256) union all select b, i + 1, {_step("x")} from bits where i < 8),
crcs as (select list(x order by b) as t from bits where i = 8),
d as (select doc_id, row_number() over () as rid, coalesce('=' || lang, '-') as tree, {_leaf_sql("text")} as h,
        {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as lower_leaf,
        list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda a, c: xor(a // 256, t[xor(a, c) % 256 + 1])) as crc
      from documents d, crcs),
a0 as (select *, row_number() over (partition by tree order by doc_id nulls first, h, rid) - 1 as idx, count(*) over (partition by tree) as n from d),
{_levels("a", 8)}
b0 as (select '' as tree, tree as name, h, row_number() over (order by tree) - 1 as idx, count(*) over () as n from a8),
{_levels("b", 3)}
f0 as (select doc_id, tree, idx, h as leaf, '' as proof, case when xor(crc, 4294967295) % 3 = 0 then lower_leaf else h end as folded from a0),
{_folds("a", "f", 8)}
g0 as (select f8.* exclude (tree, idx), b0.tree, b0.idx, b0.h as subroot from f8 join b0 on f8.tree = b0.name),
{_folds("b", "g", 3)}
root as (select h from b3)
select doc_id, leaf, subroot, root.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = root.h as verified from g3, root
"""
