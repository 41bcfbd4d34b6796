"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: each source gets its weight's share of the mix, at most `max_repeats` times its own size; what is cut off is
shared out again by weight, which is a water level found in one pass over the sources sorted by size per weight.
Quotas: the mix is N blocks of B words; block after block goes to the source with the highest quotient
target / (2k + 1). The method is house monotone, so shard j's quotas are the seats of the first j shards less those of
the first j - 1. The quotient that wins the last seat is searched for by counting how many quotients lie above each of a row of
values, a few times, each time between closer values; only the few quotients left between the last two are ranked.
Selection: a source's documents, ordered by a seeded hash, are one stream of words cut into blocks, read lap after lap from
a seeded block on. Shard after shard takes its quota of blocks from there. A document's spans for each shard follow from its place in
the stream by arithmetic, so no block is ever a row.

Places in the stream are prefix sums in two levels (hash buckets within a source, then rows within a bucket); the number of
buckets grows with the rows, so a hot source is spread over many tasks; what a source is due reaches its documents by broadcast, up to
`BROADCAST_SOURCES` sources, and by a join beyond. Only tables of sources and of buckets go through
one window. Defined cases: a null text has no words, a null source is a source of its own and last; a document without
words takes nothing; repeated rows are separate documents; a very long document may be cut into spans for several shards; equal
quotients go to the source that comes first; empty input gives no rows; other columns, whatever their names, are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import WS, WS_CHARS, documents, materialise, row_key

WEIGHTS = (5, 2, 1)
D = "decimal(38,0)"
PIECES = "array<struct<shard:int,lap:bigint,a:bigint,b:bigint>>"
#: Sources whose plans, of some hundred bytes each, are broadcast at most. More are joined by a shuffle.
BROADCAST_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WS}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = 2, share_percent: int = 150) -> DataFrame:
    """(source, source_size, rank, weight, target) of (source, size)."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.array(*[F.lit(int(x)) for x in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("rank", rank).withColumn("weight", F.get(w, (F.col("rank") - 1) % len(weights)).cast("long"))
    ranked = Window.orderBy((F.col("source_size").cast("double") / F.col("weight")), "rank")
    upto, below = ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing)
    cap = (F.col("source_size") * max_repeats).cast(D)
    s = s.select("*", (F.sum(F.col("source_size").cast(D)).over(Window.partitionBy()) * share_percent).cast(D).alias("mix100"), cap.alias("cap"))
    s = s.select("*", F.coalesce(F.sum("cap").over(upto), F.lit(0)).cast(D).alias("capped"), F.sum("weight").over(below).cast(D).alias("w_left"))
    # 100 times what is left for the sources from this one on
    s = s.withColumn("left100", (F.col("mix100") - 100 * F.col("capped")).cast(D))
    full = (F.col("cap") * 100 * F.col("w_left")).cast(D) <= (F.col("left100") * F.col("weight")).cast(D)
    # full holds for a first part of the order; the level is that of the first source that isn't full
    s = s.withColumn("full", full)
    first = F.min(F.when(~F.col("full"), F.struct("capped", "left100", "w_left"))).over(Window.partitionBy())
    level = (F.col("weight") * first["left100"]).cast("double") / (100 * first["w_left"]).cast("double")
    return s.select("source", "source_size", "rank", "weight", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level).alias("target"))


def quotients_from(x: Column) -> Column:
    """How many of a source's quotients, of which it can use `most`, are at least x."""
    return F.least(F.col("most"), F.greatest(F.lit(0), F.floor((F.col("target") / x - 1) / 2) + 1)).cast("long")


def block_quotas(targets: DataFrame, n_shards: int = 8, max_block: int = 512, max_repeats: int = 2, points: int = 64, rounds: int = 4) -> DataFrame:
    """(source, rank, shard, block, upto, quota): blocks of `block` words that each shard takes of each source."""
    everything = Window.partitionBy()
    block = F.greatest(F.lit(1), F.least(F.lit(max_block), F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(everything) / 256))).cast("long")
    t = targets.where("target > 0").select("source", "rank", "source_size", "target", block.alias("block"), F.sum("target").over(everything).alias("all"))
    shard = F.explode(F.sequence(F.lit(1), F.lit(n_shards))).alias("shard")
    t = t.select("*", F.floor(F.col("all") / F.col("block") + 0.5).cast("long").alias("house"), shard)
    seats = F.floor(F.col("house") * F.col("shard") / F.lit(n_shards)).cast("long")
    t = t.select("*", seats.alias("seats"), (F.ceil(F.col("source_size") / F.col("block")) * max_repeats).cast("long").alias("most"))
    # the last winning quotient lies between low and high: from low on there are as many quotients as seats, from high on fewer
    edges = t.groupBy("shard", "seats").agg((F.min(F.col("target") / (2 * F.col("most") + 1)) / 2).alias("low"), (F.max("target") * 2).alias("high"))
    for _ in range(rounds):
        grid = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: F.col("low") * F.pow(F.col("high") / F.col("low"), i / points))).alias("i", "x")
        counted = t.join(F.broadcast(edges.select("shard", "low", "high", grid)), "shard").groupBy("shard", "seats", "low", "high", "x").agg(F.sum(quotients_from(F.col("x"))).alias("n"))
        enough = F.col("n") >= F.col("seats")
        low, high = F.coalesce(F.max(F.when(enough, F.col("x"))), F.min("low")), F.coalesce(F.min(F.when(~enough, F.col("x"))), F.max("high"))
        edges = counted.groupBy("shard", "seats").agg(low.alias("low"), high.alias("high"))
    slack = 1e-9  # far more than rounding moves a quotient
    t = t.join(F.broadcast(edges.select("shard", (F.col("low") * (1 - slack)).alias("x_low"), (F.col("high") * (1 + slack)).alias("x_high"))), "shard")
    t = t.select("*", quotients_from(F.col("x_high")).alias("low"), F.least(F.col("most"), quotients_from(F.col("x_low")) + 1).alias("high"))
    t = t.select("*", (F.col("seats") - F.sum("low").over(Window.partitionBy("shard"))).alias("open"))
    band = t.select("*", F.explode_outer(F.when(F.col("low") < F.col("high"), F.sequence(F.col("low"), F.col("high") - 1))).alias("k"))
    quotient = (F.col("target") / (2 * F.col("k") + 1)).desc_nulls_last()
    place = F.row_number().over(Window.partitionBy("shard").orderBy(quotient, "rank", "k"))
    won = F.sum(F.when(F.col("k").isNotNull() & (F.col("place") <= F.col("open")), 1).otherwise(0))
    total = band.withColumn("place", place).groupBy("source", "rank", "shard", "block", "low").agg(won.alias("won"))
    upto = (F.col("low") + F.col("won")).cast("long")
    before = F.coalesce(F.lag(upto).over(Window.partitionBy("rank").orderBy("shard")), F.lit(0))
    return total.select("source", "rank", "shard", "block", upto.alias("upto"), (upto - before).alias("quota"))


def seeded(seed: int, c: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit("null"))))


def stream_places(sizes: DataFrame, seed: int, digits: int, also: Sequence[str] = ()) -> DataFrame:
    """sizes with `start`, the words before a row in its source's stream. sizes has doc_id, source, size, rank; `also` orders rows that agree."""
    rows = sizes.withColumn("h", seeded(seed, F.col("doc_id"))).withColumn("bucket", F.substring("h", 1, digits))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("rank", "bucket").orderBy("h", "doc_id", "size", *also).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(sums, ["rank", "bucket"]).withColumn("start", F.col("bucket_start") + F.col("inside"))


def shard_pieces(targets: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """(rank, pieces): what of a source's stream each shard takes, as (shard, lap, a, b) with words [a, b); a few for each shard."""
    q = quotas.where("quota > 0").join(targets.select("rank", F.col("source").alias("of"), F.col("source_size").alias("words")), "rank")
    nb = F.greatest(F.lit(1), F.ceil(F.col("words") / F.col("block"))).cast("long")
    offset = F.conv(F.substring(seeded(seed, F.col("of")), 1, 12), 16, 10).cast("long") % nb
    # blocks are numbered over all laps; the first lap begins at the seeded block
    q = q.select("rank", "shard", "words", "block", nb.alias("nb"), (offset + F.col("upto") - F.col("quota")).alias("from"), (offset + F.col("upto")).alias("to"))
    whole = lambda x: F.floor(x / F.col("nb")).cast("long")
    laps = q.select("*", F.explode(F.sequence(whole(F.col("from")), whole(F.col("to") - 1))).alias("lap"))
    a = (F.greatest(F.col("from"), F.col("lap") * F.col("nb")) - F.col("lap") * F.col("nb")) * F.col("block")
    b = F.least((F.least(F.col("to"), (F.col("lap") + 1) * F.col("nb")) - F.col("lap") * F.col("nb")) * F.col("block"), F.col("words"))
    return laps.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("shard", "lap", a.alias("a"), b.alias("b")))).alias("pieces"))


def mix(docs: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, max_repeats: int = 2, share_percent: int = 150, n_shards: int = 8, rows_per_bucket: int = 20_000, also: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, spans, taken). A span (shard, lap, a, b) gives the words [a, b) of the document to a shard.

    Columns of docs named in `also` come with it.
    """
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *also), "mix-sizes")
    targets = materialise(source_targets(sizes, weights, max_repeats, share_percent), "mix-targets")
    quotas = materialise(block_quotas(targets, n_shards, max_repeats=max_repeats), "mix-quotas")
    plan = targets.join(shard_pieces(targets, quotas, seed), "rank", "left").select(F.col("source").alias("of"), "rank", "source_size", "target", "pieces")
    # the documents of a hot source stay where they are
    plan = F.broadcast(plan) if targets.count() <= BROADCAST_SOURCES else plan
    known = sizes.join(plan.select("of", "rank"), sizes["source"].eqNullSafe(plan["of"])).select("doc_id", "size", "rank", *also)
    digits = max(1, min(6, math.ceil(math.log(max(1, sizes.count()) / rows_per_bucket + 1, 16))))
    placed = stream_places(known, seed, digits, also).join(plan, "rank")
    end = F.col("start") + F.col("size")
    inside = lambda p: F.struct(
        p["shard"].alias("shard"), p["lap"].alias("lap"), (F.greatest(p["a"], F.col("start")) - F.col("start")).cast("long").alias("a"), (F.least(p["b"], end) - F.col("start")).cast("long").alias("b")
    )
    spans = F.filter(F.transform(F.coalesce("pieces", F.array().cast(PIECES)), inside), lambda p: p["b"] > p["a"])
    out = placed.select("doc_id", "size", "source_size", "target", spans.alias("spans"), *also)
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda n, p: n + p["b"] - p["a"])
    return out.withColumn("taken", taken)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row for each span of a document. A document cut into spans keeps the white space inside each."""
    # rows of one doc_id, text and source are alike but for other columns, so they are only numbered, each apart if there are any
    keyed = docs.withColumn("__key", F.struct(row_key(docs).alias("row"), F.col("source")))
    if not keyed.groupBy("__key").count().where("count > 1").isEmpty():
        others = [F.col(c).cast("string") for c in docs.columns if c != "text"]
        keyed = materialise(keyed.withColumn("__copy", F.row_number().over(Window.partitionBy("__key").orderBy(*others))), "mix-copies")
        keyed = keyed.withColumn("__key", F.struct("__key", "__copy")).drop("__copy")
    plan = mix(keyed, also=["__key"], **options)
    spans = plan.where(F.size("spans") > 0).select(F.col("__key").alias("__mixed"), F.col("spans").alias("__spans"))
    # each word with the white space after it; what stands before the first word is dropped where a document is cut
    words = F.filter(F.split("text", f"(?<=[{WS}])(?=[^{WS}])"), lambda w: w.rlike(f"[^{WS}]"))
    piece = F.rtrim(F.array_join(F.slice(words, (F.col("__p.a") + 1).cast("int"), (F.col("__p.b") - F.col("__p.a")).cast("int")), ""), F.lit(WS_CHARS))
    cut = F.when(F.col("__p.b") - F.col("__p.a") == word_count(F.col("text")), F.col("text")).otherwise(piece)
    joined = keyed.join(spans, F.col("__key") == F.col("__mixed")).withColumn("__p", F.explode("__spans"))
    length = {"n_chars": F.length(cut).cast("long")} if "n_chars" in docs.columns else {}
    return joined.withColumns({"text": cut, **length}).select(*docs.columns)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
with sizes as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
src as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as rank from sizes group by source),
w as (select *, [5, 2, 1][((rank - 1) % 3 + 1)::int]::bigint as weight, sum(source_size::hugeint) over () * 150 as mix100, (source_size * 2)::hugeint as cap from src),
l as (select *, coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as capped,
        sum(weight::hugeint) over (o rows between current row and unbounded following) as w_left
      from w window o as (order by source_size::double / weight, rank)),
f as (select *, mix100 - 100 * capped as left100, cap * 100 * w_left <= (mix100 - 100 * capped) * weight as is_full from l),
lev as (select arg_min(left100, capped) as l100, arg_min(w_left, capped) as wl from f where not is_full),
t as (select source, source_size, rank, case when is_full then cap::double else (weight * l100)::double / (100 * wl)::double end as target from f left join lev on true),
b as (select *, greatest(1, least(512, floor(min(target) over () / 256)))::bigint as block, count(*) over () as n, sum(target) over () as tot from t where target > 0),
c as (select *, floor(tot / block + 0.5)::bigint as seats from b),
d as (select *, target / tot * seats as fair, (ceil(source_size / block) * 2)::bigint as most from c),
e as (select *, least(most, greatest(0, floor(fair - n / 2 - 1)))::bigint as low, least(most - 1, ceil(fair + n / 2 + 1))::bigint as high from d),
g as (select *, seats - sum(low) over () as open_seats from e),
k as (select rank, open_seats, target, unnest(range(low, high + 1)) as k from g),
p as (select *, row_number() over (order by target / (2 * k + 1) desc, rank, k) as place from k),
q as (select g.rank, g.block, g.low + coalesce((select count(*) from p where p.rank = g.rank and place <= p.open_seats), 0) as q from g),
plan as (
  select t.*, coalesce(q.q, 0)::bigint as q, coalesce(q.block, 1)::bigint as block, greatest(1, ceil(source_size / coalesce(q.block, 1)))::bigint as nb
  from t left join q using (rank)),
pl as (select *, q // nb as passes, q % nb as r, ('0x' || substr(md5('7:' || coalesce(source, 'null')), 1, 12))::bigint % nb as first_block from plan),
st as (
  select doc_id, size, source, coalesce(sum(size) over (partition by source order by md5('7:' || coalesce(doc_id::varchar, 'null')), doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from sizes),
x as (
  select doc_id, size, source_size, target, passes,
    least(greatest(first_block * block - start, 0), size) as a0,
    least(greatest(least((first_block + r) * block, source_size) - start, 0), size) as a1,
    least(greatest(greatest(0, first_block + r - nb) * block - start, 0), size) as z1
  from st join pl on st.source is not distinct from pl.source)
select doc_id, size, source_size, target, (passes * size + greatest(a0, a1) - a0 + z1)::bigint as taken from x
"""
