"""The Merkle manifest, license scans and ball k-means against plain Python."""

import re
import time
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratakey.llm import ball_kmeans, license_scan, merkle, queries
from stratakey.llm.store import Scratch

from ..conftest import SF

SF2 = "/root/testdata/sf0.01"


def documents(spark, path=SF):
    return spark.read.parquet(f"{path}/documents.parquet")


# 11


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(h, fanout):
    """(root, for each node its siblings level by level as (left, right))."""
    proofs, at = [[] for _ in h], list(range(len(h)))
    while len(h) > 1:
        for node, i in enumerate(at):
            lo = i - i % fanout
            proofs[node].append(("".join(h[lo:i]), "".join(h[i + 1 : lo + fanout])))
        h, at = [digest("".join(h[i : i + fanout])) for i in range(0, len(h), fanout)], [i // fanout for i in at]
    return h[0], proofs


def brute_manifest(rows, fanout=8):
    """{(doc_id, leaf): [...]} of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {n: climb([leaf(r) for r in groups[n]], fanout) for n in names}
    root, tops = climb([trees[n][0] for n in names], fanout)
    out = []
    for n, top in zip(names, tops):
        for r, own in zip(groups[n], trees[n][1]):
            proof = own + top
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), r[4]) if r[4] is not None else None
            h = leaf((*r[:4], lower)) if r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0 else leaf(r)
            for a, b in proof:
                h = digest(a + h + b)
            out.append((r[0], leaf(r), trees[n][0], root, digest("".join(a + b for a, b in proof)), h, h == root))
    return out


SHAPES = {
    "one row": [(1, "s", "en", 1, "A")],
    "a row a language": [(i, None, lang, None, "Text") for i, lang in enumerate([None, "", "é", "z", "a", "aa", "b", "c", "d", "e"])],
    "like rows": [(3, "s", "en", 4, "Same")] * 130 + [(None, "s", "en", i, None) for i in range(20)],
    "last runs of one": [(i, "s", "en", 1, "") for i in range(73)] + [(i, "s", "de", 1, "x" * 50_000) for i in range(9)],
}


@pytest.mark.parametrize("name", sorted(SHAPES))
@pytest.mark.parametrize("k", [1, 2, 4])
def test_manifest_equals_a_tree_in_plain_python(name, k, spark):
    rows = SHAPES[name]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf(*[F.lower(c) if c == "text" else F.col(c) for c in df.columns]))
    slim = df.select("doc_id", "lang", merkle.leaf(*map(F.col, df.columns)).alias("leaf"), changed.alias("changed"))
    m = merkle.manifest(slim, F.col("leaf"), F.col("lang"), ["doc_id"], 8, k)
    got = m.proofs.select("doc_id", "leaf", "subroot", F.lit(m.root), F.sha2(merkle.proof_text(F.col("left"), F.col("right")), 256), merkle.folded(F.coalesce("changed", "leaf"), F.col("left"), F.col("right")).alias("f")).collect()
    assert sorted(map(repr, ((*r, r["f"] == m.root) for r in got))) == sorted(map(repr, brute_manifest(rows)))
    assert m.subroots.count() == len({r[2] for r in rows})


def test_manifest_query_equals_plain_python(spark):
    rows = [tuple(r) for r in documents(spark, SF2).select(*merkle.COLUMNS).collect()]
    got = queries.QUERIES["op11_merkle_manifest"](spark, SF2).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got)) == sorted(brute_manifest(rows))


def test_manifest_of_nothing_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, leaf string, lang string")
    m = merkle.manifest(none, F.col("leaf"), F.col("lang"), ["doc_id"])
    assert m.root is None and m.proofs.count() == 0
    with pytest.raises(ValueError, match="idx"):
        merkle.manifest(none.withColumn("idx", F.lit(1)), F.col("leaf"), F.col("lang"), ["doc_id"])


def test_manifest_buckets_are_small_and_texts_stay(spark):
    scratch = Scratch(spark)
    rows = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    m = merkle.manifest(rows, F.col("leaf"), F.col("lang"), ["doc_id"], 8, 2, scratch)
    assert m.root == climb([digest(str(i)) for i in range(5_000)], 8)[0]
    ids = [r[0] for r in m.proofs.select("idx").orderBy("doc_id").collect()]
    assert ids == list(range(5_000))
    assert "Python" not in m.subroots._jdf.queryExecution().executedPlan().toString()
    scratch.clear()


# 12

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TRICKY = [
    None,
    "",
    " \n.,",
    "MIT License",
    "mit-license MIT  LICENSE mit.license",
    "summit license, mitlicense",
    "CC BY-NC and cc by cc by",
    "gnu general public license apache license",
    "Apache\nLicense\x00mit license",
    "KKmit license ÀPACHE apache licenseé",
    "mit license" * 3,
]


def brute_base(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at = [(i, label) for phrase, label in license_scan.BASE.items() for n in [len(phrase.split())] for i in range(len(words) - n + 1) if words[i : i + n] == phrase.split()]
    return len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({label for _, label in at}))


def test_license_places_equal_plain_python(spark):
    for text in TRICKY:
        found = license_scan.scan_text(text)
        base = [(p["word"], p["label"]) for p in found["places"] if p["base"]]
        assert (found["n_words"], len(base), min(base)[0] if base else None, max(base)[0] if base else None, ",".join(sorted({b for _, b in base}))) == brute_base(text), text
    src = {r["doc_id"]: r["text"] for r in documents(spark, SF2).collect()}
    out = queries.QUERIES["op12_license_scan"](spark, SF2).collect()
    assert len(out) == len(src)
    for r in out:
        assert tuple(r)[1:6] == brute_base(src[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and list(filter(None, r["labels"].split(","))) == sorted(set(filter(None, r["labels"].split(","))))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
    assert sum(r["n_base"] > 0 for r in out) > 10


@pytest.mark.parametrize(
    ("text", "labels", "obligation"),
    [
        (" MIT", ["mit"], license_scan.NOTICE),
        (" mit OR gpl-2.0-only", ["gpl", "mit"], license_scan.NOTICE),
        (" MIT AND GPL-2.0-only", ["gpl", "mit"], license_scan.STRONG),
        (" MIT OR GPL-2.0 AND CC-BY-NC-4.0", ["cc-by-nc", "gpl", "mit"], license_scan.NOTICE),
        (" (MIT OR GPL-2.0) AND CC-BY-NC-4.0", ["cc-by-nc", "gpl", "mit"], license_scan.CLOSED),
        (" GPL-2.0-or-later WITH Classpath-exception-2.0 */", ["classpath-exception-2.0", "gpl"], license_scan.WEAK),
        (" CC0-1.0 WITH x AND MIT", ["cc0", "mit", "x"], license_scan.NOTICE),
        (" (((MIT", ["mit"], license_scan.NOTICE),
        (" MIT)) AND GPL-3.0", ["mit"], license_scan.NOTICE),
        (" MIT AND (", ["mit"], license_scan.NOTICE),
        (" MIT AND\nGPL-3.0", ["mit"], license_scan.NOTICE),
        (" LicenseRef-own OR Apache-2.0", ["apache", "licenseref-own"], license_scan.NOTICE),
        (" BSD-3-Clause-Clear+", ["bsd"], license_scan.NOTICE),
    ],
)
def test_license_expressions(text, labels, obligation):
    assert license_scan.read_expression(text, 0, True)[1:] == (labels, obligation)


def test_license_tags():
    found = license_scan.expressions('# SPDX-License-Identifier: Foo-1 OR MIT\n{"license": "ISC"}\nLicense: see the file\nsublicense: MIT\nLicense: MIT or see the file, SPDX-License-Identifier: AND')
    assert [(t, labels) for _, t, labels, _ in found] == [("Foo-1 OR MIT", ["foo-1", "mit"]), ("ISC", ["isc"]), ("MIT or", ["mit"])]


def test_license_scan_is_linear_in_long_texts():
    for text in ("a" * 2_000_000, "mit license " * 200_000, "license: " * 200_000, "spdx-license-identifier: x and " * 60_000, "license: " + "(" * 1_000_000 + ")" * 1_000_000, "spdx-license-identifier: " + " or ".join(f"a{i}" for i in range(100_000))):
        start = time.time()
        license_scan.scan_text(text)
        assert time.time() - start < 10


# 13


def brute_kmeans(vectors, k=40, rounds=5):
    """vectors: (vec_id, list of whole numbers). (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    first = sorted(vectors, key=lambda r: (r[0] is None, digest(f"2:{r[0]}"), r[1]))[:k]
    c = [list(v) for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), i) for i, x in enumerate(c))
    for _ in range(rounds):
        of = {}
        for _, v in vectors:
            of.setdefault(near(v)[1], []).append(v)
        c = [[sum(col) // len(of[i]) for col in zip(*of[i])] if i in of else x for i, x in enumerate(c)]
    last = [near(v) for _, v in vectors]
    inertia = [sum(d for d, i in last if i == j) for j in range(len(c))]
    return [(vid, i, d, inertia[i], sum(inertia), digest(",".join(map(str, c[i])))) for (vid, _), (d, i) in zip(vectors, last)]


def test_kmeans_query_equals_plain_python(spark):
    src = [(r["vec_id"], [int(np.floor(256 * float(x))) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_ball_kmeans"](spark, SF).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute_kmeans(src))


def test_kmeans_with_ties_like_vectors_and_empty_clusters(spark):
    rng = np.random.default_rng(3)
    src = [(i // 2, [int(x) for x in rng.integers(-3, 4, 4)]) for i in range(300)] + [(1_000 + i, [50, 50, 50, 50]) for i in range(100)]
    df = spark.createDataFrame(src, "vec_id long, v array<int>").repartition(5)
    done = ball_kmeans.ball_kmeans(df, k=9, rounds=3, dims=4)
    got = done.vectors.select("vec_id", "v", "cluster", "d2").collect()
    want = brute_kmeans([(r["vec_id"], r["v"]) for r in got], 9, 3)
    assert [(r["vec_id"], r["cluster"], r["d2"]) for r in got] == [w[:3] for w in want]


def test_balls_compare_few_centroids_and_miss_none():
    rng = np.random.default_rng(0)
    for trial in range(300):
        k, d, n = rng.integers(1, 12), rng.integers(1, 4), rng.integers(1, 60)
        v, c, cluster = rng.integers(-6, 7, (n, d)), rng.integers(-6, 7, (k, d)), rng.integers(0, k, n).astype(np.int32)
        far = np.zeros(k, int)
        np.maximum.at(far, cluster, ((v - c[cluster]) ** 2).sum(1))
        balls = ball_kmeans.Balls(c, None if trial % 2 else np.sqrt(far.astype(float)))
        every = ((v[:, None] - c[None]) ** 2).sum(2)
        best, least = balls.assign(v, cluster)
        assert (best == every.argmin(1)).all() and (least == every.min(1)).all()
    apart = ball_kmeans.Balls(np.array([[0, 0], [1_000, 0], [0, 1_000]]), np.array([1.0, 2.0, 3.0]))
    assert all(len(near) == 0 for near in apart.near)


def test_vectors_become_whole_numbers(spark):
    df = spark.createDataFrame([([1e30, -1e30, -0.001, 0.999 / 256],)], "e array<float>")
    assert df.select(ball_kmeans.whole(F.col("e"))).first()[0] == [2**27, -(2**27), -1, 0]
