"""Benchmark decontamination by winnowing.

A window is `span` consecutive words; among its k-grams it selects the one with the least hash, the last of equal ones. Selected
k-grams are the fingerprints of a text, each kept once however many windows select it. Equal windows select the same one, so any
shared span of at least `span` words shares a fingerprint at the same place in it.
Documents are cut into words where they lie (numpy in an Arrow function); a fixed-size bitmap of the benchmark's
fingerprints, `bitmap_bits` in all whatever the benchmark's size, drops nearly all of theirs on the spot. What is left, a few
rows, is joined with the benchmark's fingerprints alone. Each hit is then extended word by word to both sides, as far as any of the
windows around it reaches; a run of a whole window or more is a hit span, and shorter ones are dropped, which is the exact check.
Items shorter than a window are one window of their own length.

Defined cases: null or wordless texts have no words and no hits; wordless items never occur; equal items each count;
each row is one document, also where doc_id repeats; an empty benchmark hits nothing; a very long text is cut into words in one task;
other columns, whatever their names, are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, materialise, row_key, small_batches, trim, without_rows
from .wordhash import ALNUM, grams, text_groups, words

SPAN, K = 10, 5
FOUND = "array<struct<pos:int, len:int, fp:bigint, left:array<bigint>, gram:array<bigint>, right:array<bigint>>>"


def selected(h: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that windows of `size` words select. h has the words of many texts, text i those from at[i] to at[i + 1]."""
    k = min(K, size)
    g = grams(h, k, salt=k)
    window = np.arange(max(0, len(h) - size + 1))
    window = window[window + size <= at[np.searchsorted(at, window, side="right")]]
    place = window + size - k
    for j in range(size - k - 1, -1, -1):
        place = np.where(g[window + j] < g[place], window + j, place)
    place = np.unique(place)
    return place, g[place]


def neighbours(h: np.ndarray, first: np.ndarray, count: np.ndarray, step: int) -> pa.Array:
    """For each place, the hashes of count words from first on, in steps of 1 or -1."""
    end = np.cumsum(count)
    i = np.arange(end[-1] if len(end) else 0) - np.repeat(end - count, count)
    return pa.ListArray.from_arrays(pa.array(np.append(0, end).astype(np.int32)), pa.array(h[np.repeat(first, count) + step * i].view(np.int64)))


def fingerprints(df: DataFrame, key: str, lengths: list[int], bitmap: np.ndarray | None, own_length: bool = False) -> DataFrame:
    """(key, n_words, found): the fingerprints of each text that are in the bitmap, with the words around them that windows reach.

    own_length: a text of fewer than SPAN words is one window, and no shorter windows are taken from longer ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                h, n = words(texts[lo:hi], ALNUM)
                at = np.concatenate([[0], np.cumsum(n)])
                rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
                for size in lengths:
                    place, fp = selected(h, at, size)
                    ok = np.ones(len(place), bool)
                    if own_length and size < SPAN:
                        ok &= n[np.searchsorted(at, place, side="right") - 1] == size
                    if bitmap is not None:
                        bit = fp & np.uint64(len(bitmap) * 8 - 1)
                        ok &= (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    rows.append((place[ok], np.full(ok.sum(), size), fp[ok]))
                place, size, fp = (np.concatenate(x) for x in zip(*rows))
                order = np.argsort(place, kind="stable")
                place, size, fp = place[order], size[order], fp[order]
                doc = np.searchsorted(at, place, side="right") - 1
                k = np.minimum(K, size)
                left, right = np.minimum(size - k, place - at[doc]), np.minimum(size - k, at[doc + 1] - place - k)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=hi - lo))]).astype(np.int32)
                around = [neighbours(h, place - 1, left, -1), neighbours(h, place, k, 1), neighbours(h, place + k, right, 1)]
                parts = [pa.array((place - at[doc]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(fp.view(np.int64)), *around]
                found = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, names=["pos", "len", "fp", "left", "gram", "right"]))
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array(n.astype(np.int64)), found], names=[key, "n_words", "found"])
        trim()

    kind = dict(df.dtypes)[key]
    return df.select(key, "text").mapInArrow(run, f"{key} {kind}, n_words bigint, found {FOUND}")


def benchmark_index(bench: DataFrame) -> DataFrame:
    """(fp, len, of_left, of_gram, of_right, items): each distinct fingerprint in its surroundings, with the items that have it."""
    found = fingerprints(bench, "item_id", list(range(1, SPAN + 1)), None, own_length=True)
    w = found.select("item_id", F.explode("found").alias("w"))
    w = w.select("item_id", "w.fp", "w.len", F.col("w.left").alias("of_left"), F.col("w.gram").alias("of_gram"), F.col("w.right").alias("of_right"))
    return w.groupBy("fp", "len", "of_left", "of_gram", "of_right").agg(F.collect_set("item_id").alias("items"))


def agreeing(a: Column, b: Column) -> Column:
    """How many elements from the first on are equal."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def fingerprint_bitmap(index: DataFrame, bits: int) -> np.ndarray:
    """bits (a power of two) as bytes; Spark sets them, the driver gets the bits / 8 bytes at most."""
    bit = F.col("fp").bitwiseAND(bits - 1)
    bytes_ = index.groupBy(F.shiftright(bit, 3).alias("byte")).agg(F.bit_or(F.get(F.array(*[F.lit(1 << i) for i in range(8)]), bit.bitwiseAND(7).cast("int"))).alias("v"))
    out = np.zeros(bits // 8, np.uint8)
    for r in bytes_.collect():
        out[r["byte"]] = r["v"]
    return out


def covered(windows: Column) -> Column:
    """Words inside any of the (pos, len) windows."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    end = lambda w: (w["pos"] + w["len"]).cast("int")
    step = lambda a, w: F.struct((a["n"] + F.greatest(F.lit(0), end(w) - F.greatest(w["pos"], a["end"]))).cast("long").alias("n"), F.greatest(a["end"], end(w)).alias("end"))
    return F.aggregate(F.array_sort(windows), start, step, lambda a: a["n"])


def hits(docs: DataFrame, bench: DataFrame, bitmap_bits: int = 1 << 22) -> DataFrame:
    """(row, doc_id, n_words, windows, items) of every row: the (pos, len) spans shared with items, and these items' ids."""
    with small_batches(docs.sparkSession):
        index = materialise(benchmark_index(bench), "benchmark-windows")
    lengths = sorted(r["len"] for r in index.select("len").distinct().collect()) or [SPAN]
    bitmap = fingerprint_bitmap(index, bitmap_bits)
    # the row number is made on the scan and travels as text does, so a row's number never changes within this job
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col("doc_id")).alias("k"), "text")
    with small_batches(docs.sparkSession):
        found = materialise(fingerprints(rows, "k", lengths, bitmap).select("k.row", "k.doc_id", "n_words", "found"), "document-windows")
    w = found.select("row", F.explode("found").alias("w")).select("row", "w.*")
    met = w.join(index, ["fp", "len"]).where(F.col("gram") == F.col("of_gram"))
    met = met.select("row", "pos", "len", "items", F.size("gram").alias("k"), agreeing(F.col("left"), F.col("of_left")).alias("l"), agreeing(F.col("right"), F.col("of_right")).alias("r"))
    hit = met.where(F.col("l") + F.col("k") + F.col("r") >= F.col("len")).select("row", (F.col("pos") - F.col("l")).alias("pos"), (F.col("l") + F.col("k") + F.col("r")).alias("len"), "items")
    spans = hit.groupBy("row").agg(F.collect_set(F.struct("pos", "len")).alias("windows"))
    items = hit.select("row", F.explode("items").alias("item_id")).distinct().groupBy("row").agg(F.collect_list("item_id").alias("items"))
    return found.select("row", "doc_id", "n_words").join(spans, "row", "left").join(items, "row", "left")


def clean_documents(docs: DataFrame, bench: DataFrame, max_share: float = 0.0) -> DataFrame:
    """The documents of which no more than max_share of the words are hit. Each row is judged by its own text."""
    h = hits(docs.select(row_key(docs).alias("doc_id"), "text"), bench)
    dirty = h.where(F.col("windows").isNotNull()).where(covered(F.col("windows")) > max_share * F.col("n_words")).select(F.col("doc_id").alias("gone_key"))
    return without_rows(docs, dirty)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n = F.coalesce(covered(F.col("windows")), F.lit(0)).cast("long")
    items = F.coalesce(F.transform("items", lambda x: x.cast("string")), F.array().cast("array<string>"))
    return h.select("doc_id", "n_words", n.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"), (n > 0).alias("contaminated"))


OP8_SQL = r"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, n, list_aggregate(w[i:i+n-1], 'string_agg', ' ') as g
       from (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select rid, i, n, list_aggregate(w[i:i+n-1], 'string_agg', ' ') as g
       from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
h as (select rid, i, dw.n, item_id from dw join bw on dw.g = bw.g and dw.n = bw.n),
pos as (select rid, count(distinct p)::bigint as n_hit from (select rid, unnest(range(i, i + n)) as p from (select distinct rid, i, n from h)) group by rid),
it as (select rid, count(*)::bigint as n_items, string_agg(s, ',' order by s) as s from (select distinct rid, item_id::varchar as s from h) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (rid) left join it using (rid)
"""
