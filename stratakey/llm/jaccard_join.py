"""N-gram Jaccard join over word shingles with vertical partitioning, and its connected components.

1. Order. All shingles of all documents are counted in a fixed number of fragments of the hash range (each batch of texts sends its
   distinct shingles with counts, so a shingle in every document costs one entry a batch), sorted, so that a task's memory is
   bounded. A fragment returns a few bitmaps: which shingles occur at least twice, five times and so on. The bitmaps give each shingle
   a level; the global order is by level, then by hash, rare ones first. A false positive only moves a shingle later, for all
   documents alike, so any bitmap size gives the same links; `bitmap_bytes` bounds what is sent to the driver and the tasks.
2. Sets. Each text becomes its set's 128-bit hash, its size, and its shingles that may occur elsewhere, cut at fixed places of
   the global order into fragments. Equal sets are one class; shingles that occur once can be in no overlap.
3. Candidates. Two sets that are similar enough share a shingle among the first n - ceil(0.75 n) + 1 in the order (prefix
   filter), at places that leave room for the overlap (position and length filter). A list of classes with a common
   prefix shingle is first compared with one leader only; links found join classes, and only pairs of classes not yet joined,
   whose parity bitmaps leave enough room for the overlap, are compared in the end. A group of near copies therefore costs its size, not its square, and no link
   between different components can be missed.
4. Overlaps. Fragment by fragment, a pair's partial overlaps are counted and then summed per pair.

Defined cases: a text of fewer words than n is one shingle; a text without words, or null, has an empty set and is linked with
nothing; equal rows are copies; each row is one document, also where doc_id repeats; a null doc_id is never a component's id
unless all its documents have none; other columns, whatever their names, are passed over; a very long text is one set, hashed in one
task; where pairs tie for a leader the greater class wins, which changes no component; an empty table gives no rows.
Stored tables are deleted when a later one replaces them and at the end; the result is a stored table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .store import BROADCAST_IDS, Scratch, documents, materialise, release, row_key, small_batches, trim, without_rows
from .wordhash import NOT_SPACE, grams, mix, text_groups, words

N = 5
#: A shingle's level is the number of these document counts that it reaches, less one.
LEVELS = (2, 5, 20, 100, 1000)
#: Fragments of the global order: the first level in four parts by hash, the others one each.
CUTS = 4
PARITY = 512
FLUSH = 500_000  # shingles that a task gathers before it sends them; sorting and coding them takes some 80 bytes each
FRAGMENT_BITS = 10  # the hash range is counted in 2**10 fragments, whatever the input
WIDE = (1 << 24) - 1


def shingle_sets(texts: list[str | None], n: int = N) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for lo, hi in text_groups(texts):
        h, count = words(texts[lo:hi], NOT_SPACE)
        g, at = grams(h, n, salt=n), 0
        for k in count:
            k = int(k)
            if k >= n:
                s = np.sort(g[at : at + k - n + 1])
                yield s[np.concatenate([[True], s[1:] != s[:-1]])]
            else:
                yield grams(h[at : at + k], k, salt=k) if k else np.zeros(0, np.uint64)
            at += k


def fragment_counts(docs: DataFrame, sub_bits: int) -> DataFrame:
    """(frag, sub, gaps, counts): the distinct shingles of some batches of texts, by fragment and part of it, with their counts.

    A shingle is its 32 bits after those that name the fragment, in order, written as gaps of three bytes; wider gaps take several,
    all but the last of them WIDE. Two shingles that agree in these bits share a count, which moves both later.
    """

    def emit(gathered: list[np.ndarray]) -> pa.RecordBatch:
        u = np.concatenate(gathered)
        gathered.clear()
        u.sort()
        starts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        u, c = u[starts], np.diff(starts, append=len(u))
        key = (u >> np.uint64(64 - FRAGMENT_BITS - sub_bits)).astype(np.int64)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        value = within(u).astype(np.int64)
        gap = np.diff(value, prepend=0)
        gap[first] = value[first] - base_of(key[first], sub_bits)
        end = np.cumsum(gap // WIDE + 1)
        codes = np.full(end[-1], WIDE, np.uint32)
        codes[end - 1] = gap % WIDE
        last = np.append(first[1:], len(u))
        return pa.RecordBatch.from_arrays(
            [
                pa.array((key[first] >> sub_bits).astype(np.int32)),
                pa.array((key[first] & ((1 << sub_bits) - 1)).astype(np.int32)),
                binaries(np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4)[:, :3]), 3 * np.append(0, end[last - 1])),
                binaries(np.minimum(c, 65535).astype(np.uint16), 2 * np.append(0, last)),
            ],
            names=["frag", "sub", "gaps", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for b in batches:
            for s in shingle_sets(b.column(0).to_pylist()):
                if len(s):
                    gathered.append(s)
                    size += len(s)
                if size >= FLUSH:
                    yield emit(gathered)
                    gathered, size = [], 0
        if gathered:
            yield emit(gathered)
        trim()

    return docs.select("text").mapInArrow(run, "frag int, sub int, gaps binary, counts binary")


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def base_of(key: np.ndarray | int, sub_bits: int) -> np.ndarray | int:
    """The least value in a part of a fragment."""
    return (key & ((1 << sub_bits) - 1)) << (32 - sub_bits)


def decoded(gaps: list[bytes], base: int) -> np.ndarray:
    """The values of several rows of one part, each row ascending from base."""
    codes = np.frombuffer(b"".join(gaps), np.uint8).reshape(-1, 3).astype(np.int64) @ np.array([1, 1 << 8, 1 << 16])
    total, sizes = np.cumsum(codes), np.array([len(g) // 3 for g in gaps])
    start = np.cumsum(sizes) - sizes
    return (base + total - np.repeat(total[start] - codes[start], sizes))[codes != WIDE]


def fragment_maps(counts: DataFrame, sub_bits: int, most_bytes: Sequence[int]) -> DataFrame:
    """(frag, b0, b1, ..): each fragment's bitmaps of the shingles that reach each of LEVELS.

    Rows come sorted by fragment and part, so a task holds one part's counts and one fragment's bitmaps at a time, whatever the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps, counts, at, maps, members = [], [], None, [], []

        def close_part() -> None:
            t, c = decoded(gaps, base_of(at[1], sub_bits)), np.frombuffer(b"".join(counts), np.uint16).astype(np.int64)
            order = np.argsort(t)
            t, c = t[order], c[order]
            first = np.flatnonzero(np.diff(t, prepend=-1))
            t, c = t[first].astype(np.uint64), np.add.reduceat(c, first)
            for k, least in enumerate(LEVELS):
                mark(maps[k], of := t[c >= least])
                members[k] += len(of)
            gaps.clear()
            counts.clear()

        def row() -> pa.RecordBatch:
            packed = [folded(m, n) for m, n in zip(maps, members)]
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]], names=["frag", *[f"b{k}" for k in range(len(LEVELS))]])

        for b in batches:
            for frag, sub, g, c in zip(*(x.to_pylist() for x in b.columns)):
                if (frag, sub) != at and at is not None:
                    close_part()
                    if frag != at[0]:
                        yield row()
                if at is None or frag != at[0]:
                    maps, members = [np.zeros(8 * m, bool) for m in most_bytes], [0] * len(LEVELS)
                at = (frag, sub)
                gaps.append(g)
                counts.append(c)
        if at is not None:
            close_part()
            yield row()
        trim()

    placed = counts.repartition("frag").sortWithinPartitions("frag", "sub")
    return placed.mapInArrow(run, "frag int, " + ", ".join(f"b{k} binary" for k in range(len(LEVELS))))


def within(t: np.ndarray) -> np.ndarray:
    """The 32 bits of the hashes after those that name the fragment."""
    return t << np.uint64(FRAGMENT_BITS) >> np.uint64(32)


def probes(t: np.ndarray) -> list[np.ndarray]:
    return [t * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20), t * np.uint64(0xA0761D6478BD642F) >> np.uint64(20), t * np.uint64(0xE7037ED1A0B428DB) >> np.uint64(20)]


def mark(bits: np.ndarray, t: np.ndarray) -> None:
    """Sets the places of the shingles t in a bitmap whose size is a power of two."""
    for p in probes(t):
        bits[(p & np.uint64(len(bits) - 1)).astype(np.int64)] = True


def folded(bits: np.ndarray, members: int) -> bytes:
    """The bitmap in bytes, halved while it has more than 16 bits for each member; a probe's place in a half is its lower bits."""
    while len(bits) > 64 and len(bits) > 16 * members:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return np.packbits(bits, bitorder="little").tobytes()


class Order:
    """The bitmaps of all fragments, one row of fragments for each level."""

    def __init__(self, maps: list[dict[int, bytes]]):
        self.levels = []
        for of_level in maps:
            parts = [np.frombuffer(of_level.get(f, bytes(8)), np.uint8) for f in range(2**FRAGMENT_BITS)]
            sizes = np.array([len(p) for p in parts], np.int64)
            self.levels.append((np.concatenate(parts), np.cumsum(sizes) - sizes, (sizes * 8 - 1).astype(np.uint64)))

    def level(self, t: np.ndarray) -> np.ndarray:
        """-1 for shingles that occur once; else the place of their count among LEVELS."""
        out = np.full(len(t), -1, np.int64)
        left = np.arange(len(t))
        for k, (data, start, mask) in enumerate(self.levels):
            x = t[left]
            f = (x >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64)
            ok = np.ones(len(x), bool)
            for p in probes(within(x)):
                bit = p & mask[f]
                ok &= (data[start[f] + (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            left = left[ok]
            out[left] = k
        return out


def global_order(docs: DataFrame, bitmap_bytes: int, per_part: int = 8_000_000) -> Order:
    """Half of bitmap_bytes for the first level, an eighth for each other: what the driver and each task hold at most."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sub_bits = min(20, max(0, math.ceil(math.log2(size / 6 / per_part / 2**FRAGMENT_BITS + 1e-9))))
    share = max(8, 2 ** int(math.log2(bitmap_bytes / 2**FRAGMENT_BITS / 2)))
    with small_batches(spark):
        rows = fragment_maps(fragment_counts(docs, sub_bits), sub_bits, [share if k == 0 else max(8, share // 4) for k in range(len(LEVELS))]).collect()
    return Order([{r["frag"]: bytes(r[f"b{k}"]) for r in rows} for k in range(len(LEVELS))])


def prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def ordered_sets(docs: DataFrame, order: Order, percent: int) -> DataFrame:
    """(doc_id, set_hash, n, once, lead, bits, segs): `once` shingles are in no other set; `lead` shingles of the segments, taken in order,
    are in the prefix, none if no other set can be near; bits say of PARITY classes of shingles whether the set has an odd number."""
    shared = docs.sparkSession.sparkContext.broadcast(order)
    n_frags = CUTS + len(LEVELS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, sizes, alone, leads, bits, flat, inner, outer, odds = [], [], [], [], [], [], [0], [0], [0]
            for s in shingle_sets(b.column(1).to_pylist()):
                m = mix(s)
                hashes.append(int(m.sum(dtype=np.uint64)).to_bytes(8, "big") + int(mix(m ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)).to_bytes(8, "big"))
                sizes.append(len(s))
                level = shared.value.level(s)
                known = level >= 0
                once = int((~known).sum())
                alone.append(once)
                lead = max(0, prefix_size(len(s), percent) - once) if len(s) else 0
                leads.append(lead)
                if lead:
                    odd = np.bincount((m >> np.uint64(32)).astype(np.int64) % PARITY, minlength=PARITY) & 1
                    bits.append(np.packbits(odd.astype(bool)).view(np.int64))
                    t, level = s[known], level[known]
                    frag = np.where(level == 0, (t >> np.uint64(62)).astype(np.int64), CUTS - 1 + level)
                    by = np.argsort(frag, kind="stable")
                    flat.append(t[by])
                    inner.extend((inner[-1] + np.cumsum(np.bincount(frag, minlength=n_frags))).tolist())
                outer.append(len(inner) - 1)
                odds.append(len(bits) * (PARITY // 64))
            values = np.concatenate(flat).view(np.int64) if flat else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(values))
            parity = pa.ListArray.from_arrays(pa.array(odds, pa.int32()), pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(hashes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(alone, pa.int64()), pa.array(leads, pa.int32()), parity, pa.ListArray.from_arrays(pa.array(outer, pa.int32()), lists)],
                names=["doc_id", "set_hash", "n", "once", "lead", "bits", "segs"],
            )
        trim()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, set_hash binary, n bigint, once bigint, lead int, bits array<bigint>, segs array<array<bigint>>")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with common, the size of the intersection: partial overlaps by fragment, summed. pairs is a stored table."""
    seg = sets.where("lead > 0").select("cls", F.posexplode("segs").alias("frag", "seg")).where(F.size("seg") > 0)
    few = F.broadcast if pairs.count() <= BROADCAST_IDS else lambda df: df  # then segments that no pair needs stay where they are
    of_b = seg.withColumnsRenamed({"cls": "b", "seg": "seg_b"}).join(few(pairs.select("a", "b")), "b")
    of_a = seg.withColumnsRenamed({"cls": "a", "seg": "seg_a"}).join(few(pairs.select("a").distinct()), "a", "left_semi")
    part = of_b.join(of_a, ["a", "frag"]).select("a", "b", F.size(F.array_intersect("seg_a", "seg_b")).alias("part"))
    return part.groupBy("a", "b").agg(F.sum("part").alias("common"))


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b, n_a, n_b) as (a, b, linked): whether the similarity reaches percent."""
    counted = pairs.join(overlaps(pairs, sets), ["a", "b"], "left").select("a", "b", "n_a", "n_b", F.coalesce("common", F.lit(0)).alias("common"))
    return counted.select("a", "b", near(F.col("common"), F.col("n_a"), F.col("n_b"), percent).alias("linked"))


def near(common: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * common.cast("bigint") >= percent * (a.cast("bigint") + b - common)


def may_be_near(percent: int) -> Column:
    """Length and position filter for two places (n, at, idx) and (n_b, at_b, idx_b) of a common prefix shingle.

    at counts all shingles of the set before it, idx those of them that other sets may have.
    """
    room = F.least("idx", "idx_b") + 1 + F.least(F.col("n") - F.col("at") - 1, F.col("n_b") - F.col("at_b") - 1)
    return near(F.least("n", "n_b"), F.col("n"), F.col("n_b"), percent) & near(F.least(room, F.least("n", "n_b")), F.col("n"), F.col("n_b"), percent)


def parities_allow(percent: int) -> Column:
    """The same for bits and bits_b: parities that differ stand for a shingle each that is in one set only."""
    differ = sum((F.bit_count(F.get("bits", i).bitwiseXOR(F.get("bits_b", i))) for i in range(PARITY // 64)), F.lit(0))
    return near(F.floor((F.col("n") + F.col("n_b") - differ) / 2), F.col("n"), F.col("n_b"), percent)


def components(docs: DataFrame, percent: int = 75, bitmap_bytes: int = 1 << 26) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    order = global_order(docs, bitmap_bytes)
    release(spark)  # the counts, about as large as the input, have done their work
    with small_batches(spark):
        sets = scratch.store(ordered_sets(docs, order, percent).withColumn("cls", F.monotonically_increasing_id()), "shingle-sets")
    # equal sets are one class, named by one of its rows; a set with an equal one has no shingle of its own, so sets without a lead are alone
    classes = scratch.store(sets.where("lead > 0").groupBy("set_hash").agg(F.min("cls").alias("cls"), F.min("doc_id").alias("rep")), "shingle-classes")
    first = sets.where("lead > 0").select("cls", "n", "once", F.slice(F.flatten("segs"), 1, F.col("lead")).alias("prefix"))
    places = first.join(classes.select("cls"), "cls", "left_semi").select("cls", F.col("n").cast("int").alias("n"), "once", F.posexplode("prefix").alias("idx", "token"))
    places = places.select("token", "cls", "n", "idx", (F.col("once") + F.col("idx")).cast("int").alias("at"))
    common = places.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
    placed = scratch.store(places.join(common, "token").withColumns({"root": F.col("cls"), "largest": F.lit(-1).cast("bigint")}), "open-postings")

    found, r = [], 0
    while True:
        pairs = scratch.store(star_pairs(placed, r, percent), "star-pairs")
        tried = scratch.store(compared(pairs, sets, percent), f"compared-{r}")
        found.append(tried.where("linked").select("a", "b"))
        roots = rooted(found, scratch)
        placed = scratch.store(unsettled(placed, roots), "open-postings")
        release(spark)
        cost = placed.groupBy("token", "largest").agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("root") != F.col("largest"), 1)).alias("minor"))
        left = cost.agg(F.coalesce(F.sum(F.col("all") * F.col("minor")), F.lit(0)).alias("pairs"), F.coalesce(F.sum("all"), F.lit(0)).alias("places")).first()
        won = tried.agg(F.count(F.when(F.col("linked"), 1)).alias("links"), F.count(F.lit(1)).alias("pairs")).first()
        r += 1
        # stars go on while they find many links and the pairs left are many times the places
        if left["pairs"] <= 8 * left["places"] or 20 * won["links"] <= won["pairs"]:
            break
    pairs = scratch.store(cross_pairs(placed, sets, percent), "cross-pairs")
    found.append(scratch.store(compared(pairs, sets, percent), "compared").where("linked").select("a", "b"))
    roots = rooted(found, scratch)

    named = classes.join(roots, "cls", "left").select("set_hash", "rep", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_set = named.join(least, "root").select(F.col("set_hash").alias("of"), "component_id", F.lit(True).alias("known"))
    out = sets.select("doc_id", "n", "set_hash").join(of_set, F.col("set_hash") == F.col("of"), "left")
    result = materialise(out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "components")
    scratch.clear()
    return result


def unsettled(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """The places of shingles whose classes lie in several components, with root and the shingle's largest component."""
    placed = placed.drop("root", "largest").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    sizes = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("largest"), F.count(F.lit(1)).alias("roots"))
    return placed.join(largest.where("roots > 1").select("token", "largest"), "token").select("token", "cls", "n", "idx", "at", "root", "largest")


def star_pairs(placed: DataFrame, r: int, percent: int) -> DataFrame:
    """At most one pair a class: with the leader that it meets most often.

    A shingle's leader is a class of its largest component: first the one with the smallest part of shingles of its own, which in
    a family of copies is the likeliest original; in later rounds another one each time.
    """
    own = F.col("at") - F.col("idx")
    pick = F.struct(F.when(F.lit(r) > 0, 0.0).otherwise(own / F.col("n")), F.xxhash64(F.lit(r), "cls"), "cls")
    lead = placed.where((F.lit(r) == 0) | (F.col("root") == F.col("largest"))).groupBy("token").agg(F.min_by(F.struct("cls", "root", "n", "at", "idx"), pick).alias("l"))
    lead = lead.select("token", F.col("l.cls").alias("a"), F.col("l.root").alias("root_a"), F.col("l.n").alias("n_b"), F.col("l.at").alias("at_b"), F.col("l.idx").alias("idx_b"))
    tried = placed.join(lead, "token").where(F.col("root") != F.col("root_a")).where(may_be_near(percent))
    tried = tried.groupBy("cls", "a").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n_b"), F.first("n_b").alias("n_a"))
    best = tried.groupBy("cls").agg(F.max_by(F.struct("a", "n_a", "n_b"), F.struct("k", "a")).alias("p"))
    return best.select(F.col("p.a").alias("a"), F.col("cls").alias("b"), F.col("p.n_a").alias("n_a"), F.col("p.n_b").alias("n_b"))


def cross_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of places of a shingle in different components that may be near. One side is never in the largest component."""
    full = placed.join(sets.where("lead > 0").select("cls", "bits"), "cls")
    minor = full.where(F.col("root") != F.col("largest")).select("token", "cls", "n", "at", "idx", "bits", "root")
    other = full.select("token", *[F.col(c).alias(to) for c, to in (("cls", "b"), ("n", "n_b"), ("at", "at_b"), ("idx", "idx_b"), ("bits", "bits_b"), ("root", "root_b"))], (F.col("root") == F.col("largest")).alias("in_largest"))
    once = F.col("in_largest") | (F.col("cls") < F.col("b"))
    pairs = minor.join(other, (minor["token"] == other["token"]) & (F.col("root") != F.col("root_b")) & once & may_be_near(percent) & parities_allow(percent))
    return pairs.select(F.col("cls").alias("a"), "b", F.col("n").alias("n_a"), "n_b").distinct()


def rooted(found: Sequence[DataFrame], scratch: Scratch) -> DataFrame:
    """(cls, root) of the classes that have links, under all links found so far."""
    links = reduce(DataFrame.union, found)
    cc = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    return scratch.store(cc.select(F.col("node").alias("cls"), "root"), "roots")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs without the near copies: of each component one row, that of the least doc_id (nulls last) and text hash."""
    found = components(docs.select(row_key(docs).alias("doc_id"), "text"), **options)
    kept = without_rows(docs, found.where("doc_id != component_id").select(F.col("doc_id").alias("gone_key")))
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.withColumn("__key", row_key(kept)).dropDuplicates(["__key"]).drop("__key")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(documents(spark, sf_dir))


OP9_SQL = r"""
with recursive d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
p as (select rid, unnest(w) as x, unnest(range(len(w))) as i from d),
g as (
  select rid, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o || ' ' || lead(x, 3) over o || ' ' || lead(x, 4) over o as s from p window o as (partition by rid order by i)
  union all select rid, array_to_string(w, ' ') from d where len(w) between 1 and 4),
s as (select distinct rid, s from g where s is not null),
n as (select rid, count(*) as n from s group by rid),
c as (select a.rid as a, b.rid as b, count(*) as k from s a join s b on a.s = b.s and a.rid < b.rid group by all),
l as (select a, b from c join n x on x.rid = a join n y on y.rid = b where 100 * k >= 75 * (x.n + y.n - k)),
e as (select a, b from l union select b, a from l),
r as (select rid as a, rid as b from n union select r.a, e.b from r join e on r.b = e.a),
m as (select r.a, min(d.doc_id) as component_id from r join d on d.rid = r.b group by r.a)
select doc_id, coalesce(n.n, 0)::bigint as n_shingles, case when n.n is null then doc_id else component_id end as component_id
from d left join n using (rid) left join m on m.a = d.rid
"""
