"""Ball k-means on whole numbers: exact clusters with few distances.

A cluster is a ball, its centroid and a radius that holds every member. Another centroid can win members only if it is at most two radii
away, so each ball has a list of neighbours, nearest first. A member at distance d of its centroid stays, without another distance, if
d is less than half of that to the nearest neighbour (the stable core); else it lies in an annulus, between half the
distances to neighbours t and t + 1, and only the first t are compared. All comparisons that decide are of squared distances in
whole numbers, and equal distances count as within reach, so the result is that of comparing every vector with every centroid.

Vectors are cut into batches by Spark; each round writes the vectors with their clusters to the shared folder, in place of the
round before, and sums them by cluster on the executors. The driver holds k centroids, k radii and k x k distances, whatever the
input. A lost executor costs a part of a round.

Defined cases: null vectors, vectors of another length and those with null or non-finite components are left out; components become
floor(scale * x), cut to +-2^27 so that distances fit 64 bits; repeated rows are vectors of their own; equal distances go to the smaller
number; null ids seed last, rows of one id by their components; fewer vectors than k give as many centroids; empty clusters keep their
centroid; without vectors there are no rows; inertias beyond 64 bits are given as the greatest 64-bit number; other columns, whatever their names, are
passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch

LIMIT = 2**27
ASSIGNED = "vec_id long, v array<int>, cluster int, d2 long"


def whole(vector: Column, scale: int = 256) -> Column:
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.transform(scaled, lambda x: F.greatest(F.least(x, F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))


def usable(vector: Column, dims: int) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce((F.size(vector) == dims) & ~F.exists(vector, bad), F.lit(False))


@dataclass
class Balls:
    """The centroids and, where members are known, their balls' radii (upper bounds); neighbours of each, nearest first."""

    centroids: np.ndarray
    radii: np.ndarray | None = None

    def __post_init__(self) -> None:
        c = self.centroids
        self.between = np.stack([((c - x) ** 2).sum(1) for x in c]) if len(c) else np.zeros((0, 0), np.int64)
        self.near: list[np.ndarray] = []
        for i, row in enumerate(self.between):
            order = np.lexsort((np.arange(len(c)), row))
            order = order[order != i]
            if self.radii is not None:
                reach = 2 * self.radii[i] * (1 + 1e-9) + 1e-6
                order = order[np.sqrt(row[order].astype(float)) <= reach * (1 + 1e-9)]
            self.near.append(order)

    def moved(self, centroids: np.ndarray, farthest: np.ndarray) -> Balls:
        """The balls around new centroids of members that were at most sqrt(farthest) from the old ones."""
        way = np.sqrt(((centroids - self.centroids) ** 2).sum(1).astype(float))
        return Balls(centroids, np.sqrt(farthest.astype(float)) + way)

    def assign(self, v: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, and its squared distance; cluster says which ball each is in."""
        best, least = cluster.copy(), np.empty(len(v), np.int64)
        for i in np.unique(cluster):
            rows = np.flatnonzero(cluster == i)
            x = v[rows]
            own = ((x - self.centroids[i]) ** 2).sum(1)
            near = self.near[i]
            # the annulus of each member: how many neighbours are at most twice its distance away
            ring = np.searchsorted(self.between[i, near], 4 * own, side="right")
            at, d2 = np.full(len(x), i), own.copy()
            for t in range(int(ring.max(initial=0))):
                some = np.flatnonzero(ring > t)
                j = near[t]
                d = ((x[some] - self.centroids[j]) ** 2).sum(1)
                wins = some[(d < d2[some]) | ((d == d2[some]) & (j < at[some]))]
                d2[wins], at[wins] = d[np.isin(some, wins, assume_unique=True)], j
            best[rows], least[rows] = at, d2
        return best, least


def seeds(vectors: DataFrame, k: int) -> np.ndarray:
    first = vectors.select("v", F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256).alias("s")).orderBy(F.col("s").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def assigned(vectors: DataFrame, balls: Balls) -> DataFrame:
    """vectors (ASSIGNED) with the clusters that balls give."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            v = part["v"].flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1).astype(np.int64)
            best, d2 = balls.assign(v, part["cluster"].to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([part["vec_id"], part["v"], pa.array(best, pa.int32()), pa.array(d2, pa.int64())], ["vec_id", "v", "cluster", "d2"])

    return vectors.select("vec_id", "v", "cluster").mapInArrow(run, ASSIGNED)


def summed(clusters: DataFrame, dims: int) -> dict[int, tuple[int, list[int], int]]:
    """Number, component sums and greatest distance of each cluster: k rows."""
    sums = F.array(*[F.sum(F.col("v")[i].cast("long")) for i in range(dims)])
    rows = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), sums.alias("sums"), F.max("d2").alias("far")).collect()
    return {r["cluster"]: (r["n"], r["sums"], r["far"]) for r in rows}


@dataclass
class Clustering:
    vectors: DataFrame  # ASSIGNED
    centroids: np.ndarray


def ball_kmeans(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scratch: Scratch | None = None) -> Clustering:
    """Clusters vectors (vec_id long, v array<int>) of dims components; the result's table stays in the scratch until it is cleared."""
    scratch = scratch or Scratch(vectors.sparkSession)
    now = scratch.store(vectors.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(None).cast("long").alias("d2")), "vectors-0")
    balls = Balls(seeds(now, k))
    if not len(balls.centroids):
        return Clustering(now, balls.centroids)
    for r in range(1, rounds + 2):
        now = scratch.store(assigned(now, balls), f"vectors-{r}")
        scratch.drop(f"vectors-{r - 1}")
        if r <= rounds:
            found = summed(now, dims)
            centroids = np.array([[s // found[i][0] for s in found[i][1]] if i in found else c for i, c in enumerate(balls.centroids)], np.int64)
            balls = balls.moved(centroids, np.array([found[i][2] if i in found else 0 for i in range(len(centroids))]))
    return Clustering(now, balls.centroids)


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    done = ball_kmeans(raw.where(usable(F.col("embedding"), 64)).select("vec_id", whole(F.col("embedding")).alias("v")))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(done.centroids.tolist())]
    of_cluster = done.vectors.groupBy("cluster").agg(F.sum(F.col("d2").cast("decimal(38,0)")).alias("d"))
    fits = lambda c: F.least(c, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    inertia = {r["cluster"]: (r["d"], r["l"]) for r in of_cluster.select("cluster", "d", fits(F.col("d")).alias("l")).collect()}
    total = min(sum(int(d) for d, _ in inertia.values()), 2**63 - 1)
    rows = [(i, s, inertia.get(i, (0, 0))[1], total) for i, s in digests]
    table = spark.createDataFrame(rows, "cluster int, centroid_sha256 string, cluster_inertia long, inertia long")
    # k rows
    out = done.vectors.join(F.broadcast(table), "cluster")
    return out.select("vec_id", "cluster", F.col("d2").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def _assign_sql(centroids: str) -> str:
    d = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    return f"select rid, vec_id, v, min(struct_pack(d := d, k := k)) as b from (select e.*, k, {d}::bigint as d from e, {centroids}) group by all"


OP13_SQL = f"""
with e as (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by sha256('2:' || vec_id::varchar) nulls last, v) - 1 as k, v as c from e qualify k < 40),
""" + "".join(
    f"""a{i} as materialized ({_assign_sql(f"c{i}")}),
s{i} as (select b.k as k, j, sum(v[j])::bigint as s, count(*) as n from a{i}, (select unnest(range(1, 65)) as j) group by 1, 2),
m{i} as (select k, list((s - ((s % n + n) % n)) // n order by j)::bigint[] as m from s{i} group by k),
c{i + 1} as materialized (select k, coalesce(m, c) as c from c{i} left join m{i} using (k)),
"""
    for i in range(5)
) + f"""a5 as materialized ({_assign_sql("c5")})
select vec_id, b.k::integer as cluster, b.d::bigint as distance, sum(b.d) over (partition by b.k)::bigint as cluster_inertia, sum(b.d) over ()::bigint as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from a5 join c5 on b.k = c5.k
"""
