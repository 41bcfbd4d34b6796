import os
import re
import string
import time
from collections import defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratakey.llm import components, decontaminate, html_extract, jaccard_join, line_dedup, mixing, pii, quality_classifier, quality_rules, queries, sharding, url_filter, wordhash
from stratakey.llm.store import fresh_path

from ..conftest import SF, rows

SF2 = "/root/testdata/sf0.01"
LONG = " ".join(f"word{i % 997}" for i in range(4_000))
LINE = "A line that is long enough to be a key of the deduplication."
EDGE_DOCS = [
    (1, None, "en", "b"),
    (2, "", "en", None),
    (3, " \t\n \x0b", "en", "a"),
    (4, LONG, "en", "a"),
    (5, LONG, "en", "a"),
    (6, "one two three", "en", "c"),
    (6, "one two three", "en", "c"),
    (7, "ONE two  three", "de", ""),
    (8, "\n".join([LINE, "short", LINE, "  " + LINE.upper() + " "]), "en", "a"),
    *[(10 + i, f"{LINE}\nown {i}\n\n{LINE.lower()}", "en", "d") for i in range(6)],
    (20, "the quick brown fox jumps over the lazy dog again and again and again, said the fox", "en", "é"),
    (21, "x " * 50, "en", "a"),
    (22, "Ünï cödé wörds ßtraße — “quoted” ğ 漢字 and some more of the same words here now", "de", "b"),
    (None, "a document without an id has words too and here they are in a row", "en", "a"),
    (23, "mail me at a.b@c.example.org or +1 (503) 555-0199", "en", "b"),
]
CLASHES = ["size", "rank", "row", "h", "k", "n", "host", "winner", "taken", "shard", "keeper", "gone_id", "items", "passed", "main_text", "cls", "root", "n_mentions", "source_size", "lead", "bits"]
EDGE_BENCH = [(0, "quick brown fox jumps over the lazy dog again and again and"), (1, "ONE two-three"), (2, None), (3, ""), (4, "one two three"), (5, "x"), (6, "nothing of this occurs"), (7, LONG[:400])]
EDGE_PAGES = [
    (0, None, None),
    (1, "no scheme here", ""),
    (2, "HTTP://WWW.Example.COM/en/71?x=1#y", "<html><body><article><p>Hi &amp; <b>bye</b></p></article></body></html>"),
    (3, "https://example.com", "<p>only<p>text &lt;b&gt;"),
    (4, "http://notexample.net/de/8", "<div class=comments>Nice!</div>"),
    (5, "ftp://a.b.example.net/de/8/x", "<!-- <p>no</p> --><script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p>"),
    (5, "ftp://a.b.example.net/de/8/x", "<!-- <p>no</p> --><script>var a='<p>no</p>'</script><style>p{}</style><p>yes</p>"),
    (6, "x://#frag", "<body><nav>menu</nav><div>one<br>two</div><aside>side</aside><form>f</form><footer>foot</footer>"),
    (7, "x://h?://y/z", "<p>" + "long " * 20_000 + "</p>"),
]
VECTOR = [i / 64 for i in range(64)]
EDGE_VECTORS = [(0, None), (1, []), (2, VECTOR[:63]), (3, [*VECTOR, 1.0]), (4, [None, *VECTOR[1:]]), (5, [float("nan"), *VECTOR[1:]]), (6, [float("-inf"), *VECTOR[1:]]), (7, VECTOR), (7, VECTOR), (8, [-x for x in VECTOR]), (None, VECTOR[::-1]), (9, [0.001, *[-0.001] * 63])]


def write(path, docs, bench, pages, labels):
    os.makedirs(path)
    extra = lambda n: {c: pa.array([None] * n, pa.string()) for c in CLASHES}
    cols = lambda r, i, t: pa.array([x[i] for x in r], t)
    d = {"doc_id": cols(docs, 0, pa.int64()), "text": cols(docs, 1, pa.string()), "lang": cols(docs, 2, pa.string()), "source": cols(docs, 3, pa.string()), "n_chars": pa.array([len(x[1] or "") for x in docs], pa.int64())}
    pq.write_table(pa.table(d | extra(len(docs))), f"{path}/documents.parquet")
    pq.write_table(pa.table({"item_id": cols(bench, 0, pa.int64()), "text": cols(bench, 1, pa.string())} | extra(len(bench))), f"{path}/benchmark.parquet")
    pq.write_table(pa.table({"page_id": cols(pages, 0, pa.int64()), "url": cols(pages, 1, pa.string()), "html": cols(pages, 2, pa.string())} | extra(len(pages))), f"{path}/pages.parquet")
    vectors = [(i, v) for i, v in EDGE_VECTORS if docs]
    pq.write_table(pa.table({"vec_id": cols(vectors, 0, pa.int64()), "embedding": cols(vectors, 1, pa.list_(pa.float32()))} | extra(len(vectors))), f"{path}/embeddings.parquet")
    pq.write_table(pa.table({"doc_id": cols(labels, 0, pa.int64()), "quality": cols(labels, 1, pa.int32()), "toxic": cols(labels, 1, pa.int32())}), f"{path}/labels.parquet")


@pytest.fixture(scope="session")
def edge(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge") / "t")
    write(path, EDGE_DOCS, EDGE_BENCH, EDGE_PAGES, [(4, 1), (20, 1), (21, 0), (8, None), (None, 1), (99, 0), (20, 1)])
    return path


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "t")
    write(path, [], [], [], [])
    return path


def documents(spark, path=SF):
    return spark.read.parquet(f"{path}/documents.parquet")


def made(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(name, same):
    same(queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_on_edge_cases(name, spark, edge):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"create view {t} as select * from '{edge}/{t}.parquet'")
    got, want = rows(queries.QUERIES[name](spark, edge)), rows(c.execute(queries.SQL[name]).to_arrow_table())
    assert got == want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_row_of_edge_cases_gets_one_result(name, spark, edge):
    n = {"op6": len(EDGE_PAGES), "op10": len(EDGE_PAGES), "op13": 5}.get(name.split("_")[0], len(EDGE_DOCS))
    assert queries.QUERIES[name](spark, edge).count() == n


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(name, spark, empty):
    assert queries.QUERIES[name](spark, empty).count() == 0


# 1


def test_pii_keeps_format_coreference_and_distinctness(spark):
    texts = [
        "Mail Bob.Smith77@Mail3.Example.com, or BOB.SMITH77@MAIL3.EXAMPLE.COM; call +1 (503) 555-0199 or +1-503-555-0199.",
        "Mr Ivan Petrov met Mrs. Anna Petrov; Mr Petrov left. г-н Иван Петров и г-жа Анна Петрова.",
        'card 4111 1111 1111 1111 and 4111111111111111, ip 10.1.2.3 / 8.8.8.8, token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", SSN 123-45-6789, DE89 3704 0044 0532 0130 00',
        "nothing here, not even in 2024 or at 12:30",
        None,
        "",
    ]
    out = [r["text"] for r in pii.replace_pii(made(spark, texts), "k").orderBy("doc_id").collect()]
    again = [r["text"] for r in pii.replace_pii(made(spark, texts), "k").orderBy("doc_id").collect()]
    other = [r["text"] for r in pii.replace_pii(made(spark, texts), "another").orderBy("doc_id").collect()]
    assert out == again and out[3:] == texts[3:] and all(a != b for a, b in zip(out[:3], other[:3]))
    a, b = re.findall(r"[\w.]+@[\w.]+", out[0])
    assert a.lower().rstrip(".") == b.lower().rstrip(".") and b == b.upper() and a.endswith(".com")
    p, q = re.findall(r"\+1[ -]\(?\d{3}\)?[ -]\d{3}-\d{4}", out[0])
    assert re.sub(r"\D", "", p) == re.sub(r"\D", "", q) != "15035550199"
    m = re.fullmatch(r"Mr (\w+) (\w+) met Mrs. (\w+) (\w+); Mr (\w+) left. г-н (\w+) (\w+) и г-жа (\w+) (\w+)\.", out[1])
    assert m and m[2] == m[4] == m[5] and m[1][-1] == "n" and m[3][-1] == "a" and m[8][-1] == "а"
    assert all(re.fullmatch("[а-я]+", x.lower()) for x in m.groups()[5:])
    cards = re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}(?= and|,)", out[2])
    digits = [int(c) for c in cards[0].replace(" ", "")]
    assert cards[0].replace(" ", "") == cards[1]
    assert sum(d * 2 - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"ip 10\.\d+\.\d+\.\d+ / \d+\.\d+\.\d+\.\d+, token = \"[0-9a-f]{40}\", SSN \d{3}-\d{2}-\d{4}, DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d", out[2])
    assert not any(x in " ".join(out[:3]) for x in ("555-0199", "4111", "8.8.8.8", "24be64", "123-45", "3704", "Petrov", "Anna", "Smith"))


def test_pii_on_the_corpus(spark):
    found = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|(?<!\d)\d{16}(?!\d)|(?<=token = \")[0-9a-f]{40}")
    src = {r["doc_id"]: r["text"] for r in documents(spark, SF2).collect()}
    real = {e for t in src.values() for e in found.findall(t)}
    assert len(real) > 50
    out = queries.QUERIES["op1_pii_surrogates"](spark, SF2).collect()
    assert not any(e in r["text"] for r in out for e in real)
    assert all((r["n_mentions"] > 0) == (r["text"] != src[r["doc_id"]]) for r in out)


def test_surrogates_are_one_to_one_in_a_crowded_space(spark):
    ips = spark.range(900).select(F.lit("ssn").alias("kind"), F.format_string("%09d", F.col("id")).alias("canon"))
    got = pii.surrogates(ips, "k").collect()
    assert len({r["surrogate"] for r in got}) == 900 and not {r["surrogate"] for r in got} & {r["canon"] for r in got}
    full = spark.range(10).select(F.lit("ssn").alias("kind"), F.col("id").cast("string").alias("canon"))
    with pytest.raises(ValueError):
        pii.surrogates(full, "k", attempts=3)
    wider = pii.surrogates(full, "k").collect()
    assert len({r["surrogate"] for r in wider}) == 10 and all(len(r["surrogate"]) > 1 for r in wider)


def replaced(spark, texts, key="k"):
    return [r["text"] for r in pii.replace_pii(made(spark, texts), key).orderBy("doc_id").collect()]


def test_pii_mailboxes_begin_at_edges_and_long_runs_are_read_once(spark):
    out = replaced(spark, ["...x@r.de ........zoe@g.org aa..bb@c.de .w@v.uk a.@b.de x@@y.de é@ü.de (q@w.ee)", "a" * 300_000 + " 1", "a.." * 100_000 + "1", "1" * 300_000, "a@" * 100_000])
    assert not re.search(r"x@r|zoe@|aa\.\.bb|w@v|é@ü|q@w", out[0]) and "a.@b.de x@@y.de" in out[0] and re.match(r"\.\.\.\w@\w\.de \.{8}\w{3}@\w\.org \w\w\.\.\w\w@\w\.de \.\w@\w\.uk ", out[0])
    assert out[1:] == ["a" * 300_000 + " 1", "a.." * 100_000 + "1", "1" * 300_000, "a@" * 100_000]


def test_pii_digest_is_an_hmac(spark):
    import hashlib
    import hmac

    for key in ("k", "x" * 200):
        got = spark.range(1).select(pii.digest(key, F.lit("ssn"), F.lit("123é"), 4)).first()[0]
        assert got == hmac.new(key.encode(), "ssn\n4\n123é".encode(), hashlib.sha512).hexdigest()


def test_pii_names_corefer_whatever_their_titles(spark):
    out = replaced(spark, ["Mrs Anna Petrova and Dr Anna Petrova; later Anna Petrova and ANNA came. MR JUAN CARLOS LOPEZ, Mr Juan de la Cruz. г-жа Петрова, г-н Петров.", "Mr Smith However it was. Dr Anna left."])
    m = re.fullmatch(r"Mrs (\w+) (\w+) and Dr (\w+) (\w+); later (\w+) (\w+) and (\w+) came\. MR (\w+) (\w+) (\w+), Mr (\w+) de la (\w+)\. г-жа (\w+), г-н (\w+)\.", out[0])
    assert m and m[1] == m[3] == m[5] == m[7].capitalize() and m[2] == m[4] == m[6] and m[7].isupper()
    assert m[8].isupper() and m[8].capitalize() == m[11] and not {"JUAN", "CARLOS", "LOPEZ"} & {m[8], m[9], m[10]} and m[12] != "Cruz"
    assert m[13][-1] == "а" and m[14][-1] == "н" and m[13] != "Петрова"
    n = re.fullmatch(r"Mr (\w+) However it was\. Dr (\w+) left\.", out[1])
    assert n and n[1] != "Smith" and n[2] == m[1]


def test_pii_keeps_scripts_and_check_digits(spark):
    texts = ["王小明@例子.公司.cn José@exámple.com", "call (503) 555-0199 or 503-555-0199 or 030 1234567", "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "378282246310005 3782 822463 10005", "fe80::1ff:fe23:4567:890a API_KEY=abcdEFGH12345678 Password: hunter2hunter2", "+٩٦٦ ٥٥ ١٢٣ ٤٥٦٧"]
    out = replaced(spark, texts)
    a, b = out[0].split()
    assert re.fullmatch(r"[\u4e00-\u9fff]{3}@[\u4e00-\u9fff]{2}\.[\u4e00-\u9fff]{2}\.cn", a) and re.fullmatch(r"[A-Z][a-z]{2}[à-ý]@[a-z]{2}[à-ý][a-z]{4}\.com", b)
    p = re.fullmatch(r"call \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4}) or (0\d\d) (\d{7})", out[1])
    assert p and p.groups()[:3] == p.groups()[3:6] != ("503", "555", "0199") and p[8] != "1234567"
    for text in out[2].split(" and "):
        n = text.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in n[4:] + n[:4])) % 97 == 1 and n[:2] in ("DE", "GB")
    c = re.fullmatch(r"(\d{15}) (\d{4}) (\d{6}) (\d{5})", out[3])
    assert c and c[1] == c[2] + c[3] + c[4] != "378282246310005"
    assert sum(d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(c[1])))) % 10 == 0
    assert re.fullmatch(r"[0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4}:[0-9a-f]{4}:[0-9a-f]{4} API_KEY=\w{16} Password: \w{14}", out[4]) and not any(x in out[4] for x in ("fe23", "abcd", "hunter2"))
    assert re.fullmatch(r"\+[٠-٩]{3} [٠-٩]{2} [٠-٩]{3} [٠-٩]{4}", out[5]) and out[5] != texts[5]


def test_pii_replaces_mention_by_mention(spark):
    """Against a replacement in plain Python with the same table of surrogates."""
    docs = documents(spark, SF2).select("doc_id", "text")
    out = {r["doc_id"]: r for r in pii.replace_pii(docs, "k").collect()}
    mail = re.compile(r"([\w.%+-]*[\w%+-])@([\w-]+(?:\.[\w-]+)+)")
    table, n = {}, 0
    for r in docs.collect():
        old, new = mail.findall(r["text"] or ""), mail.findall(out[r["doc_id"]]["text"] or "")
        assert len(old) == len(new)
        for o, w in zip(old, new):
            n += 1
            assert table.setdefault(o, w) == w and o[0] != w[0] and o[1] != w[1]
    assert n > 10 and len(set(table.values())) == len(table)
    assert len({(a[1], b[1]) for a, b in table.items()}) == len({b[1] for b in table.values()}) == len({a[1] for a in table})


def test_pii_with_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(1, "mail a@b.example.com", 7, 8, "x"), (2, None, 7, 8, "x"), (2, "", 7, 8, "x")], "doc_id long, text string, n_mentions long, pos long, canon string")
    out = pii.replace_pii(df, "k").orderBy("doc_id", "text").collect()
    assert [(r["n_mentions"], r["n_entities"], r["pos"], r["canon"]) for r in out] == [(1, 2, 8, "x"), (0, 0, 8, "x"), (0, 0, 8, "x")]
    assert out[1]["text"] is None and out[2]["text"] == ""


# 2


def test_line_runs_are_levelled_and_new_lines_are_told_apart(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    batch = lambda *keys: spark.createDataFrame([(9, k.encode()) for k in keys], "doc_id long, h binary")
    for i in range(5):
        assert sorted(r["h"].decode() for r in runs.unseen(batch("a", f"b{i}")).collect()) == (["a"] if i == 0 else []) + [f"b{i}"]
        runs.add(batch("a", f"b{i}"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {r["h"].decode(): r["n_docs"] for r in runs.folded().collect()} == {"a": 5, **{f"b{i}": 1 for i in range(5)}}


def test_batches_meet_runs_without_a_shuffle(spark):
    before, tables = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), {t.name for t in spark.catalog.listTables()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        runs = line_dedup.LineRuns(spark, fanout=9)
        for i in range(3):
            runs.add(spark.range(50).select(F.col("id").alias("doc_id"), F.unhex(F.md5((F.col("id") + 20 * i).cast("string"))).alias("h")))
        plan = runs.unseen(spark.table(runs.runs()[-1].fresh))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        runs.clear()
    assert {t.name for t in spark.catalog.listTables()} == tables


@pytest.mark.parametrize("n", [1, 2, 7])
def test_line_dedup_does_not_depend_on_the_batches(spark, n):
    out = lambda k: sorted(map(str, line_dedup.dedup_lines(documents(spark), min_docs=3, n_batches=k).select("doc_id", "kept").collect()))
    assert out(n) == out(4)


# 3


def test_shards_hold_every_row_once(spark):
    docs = documents(spark)
    store = sharding.ShardStore(spark, fresh_path(spark, "s"), target_bytes=60_000, fanout=3, base_bytes=20_000)
    store.append(docs.where("doc_id % 5 = 4"))
    store.append(docs.where("doc_id % 5 < 4"), F.col("doc_id") % 5)
    seen = store.read().count()
    store.compact()
    version, runs = store.manifest()
    out = store.read()
    assert seen == out.count() == docs.count() and out.drop("shard", "manifest_version").exceptAll(docs).isEmpty()
    tiers = [store.tier(r) for r in runs]
    assert all(tiers.count(t) < store.fanout for t in tiers)
    assert {r["shard"]: r["count"] for r in out.groupBy("shard").count().collect()} == {s.name: s.rows for r in runs for s in r.shards}
    assert max(s.bytes for r in runs for s in r.shards) < 2 * store.target_bytes
    with pytest.raises(sharding.Conflict):
        store.commit(version - 1, runs)
    assert store.append(docs.limit(0)) == version
    assert len(store.versions()) > 1 and store.read(1).count() == docs.where("doc_id % 5 = 4").count()
    store.vacuum()
    assert store.versions() == [version] and store.read().count() == docs.count()


def test_writers_that_meet_lose_nothing(spark, monkeypatch):
    store = sharding.ShardStore(spark, fresh_path(spark, "s"), fanout=2, base_bytes=1 << 30)
    real, others = sharding.ShardStore.commit, [1, 2, 3]

    def interrupted(self, version, runs):
        if others:
            other = sharding.ShardStore(spark, self.root)
            rows = spark.createDataFrame([(others.pop(), "other")], "doc_id long, text string")
            rows.write.parquet(path := sharding.fresh_name(f"{self.root}/data/o"))
            real(other, version, runs[:-1] + [other._describe(path)] if version == 0 else other.manifest(version)[1] + [other._describe(path)])
        return real(self, version, runs)

    monkeypatch.setattr(sharding.ShardStore, "commit", interrupted)
    store.append(spark.createDataFrame([(10, "mine")], "doc_id long, text string"))
    store.compact()
    assert sorted(r["doc_id"] for r in store.read().collect()) == [1, 2, 3, 10]


def test_arrivals_of_extreme_and_skewed_ids(spark):
    ids = [-(2**63), 2**63 - 1, None, *range(800), *[10**12 + i for i in range(5)]]
    docs = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    sizes = [r["count"] for r in docs.groupBy(sharding.arrival_by_range(docs, 8).alias("a")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 150 and sum(sizes) == len(ids)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in sharding.shard_documents(docs).collect()) == sorted((i is None, i or 0) for i in ids)
    alike = docs.select(F.lit(7).cast("long").alias("doc_id"), "text")
    assert sharding.shard_documents(alike).count() == len(ids)


def test_shard_names_are_whole_file_names(spark):
    store = sharding.ShardStore(spark, fresh_path(spark, "s"))
    store.append(spark.createDataFrame([(i, "x") for i in range(4)], "doc_id long, text string").repartition(2))
    names = {r["shard"] for r in store.read().collect()}
    assert names == {s.name for r in store.manifest()[1] for s in r.shards} and all(n.endswith(".parquet") and len(n.rsplit("/", 1)[-1]) > 40 for n in names)


# 4


def test_classifier_tells_held_out_rows(spark):
    out = queries.QUERIES["op4_quality_classifier"](spark, SF2).join(spark.read.parquet(f"{SF2}/labels.parquet"), "doc_id").toPandas()
    assert (out["held_out"] == out["doc_id"].map(lambda d: crc32(str(d).encode()) % 3 == 1)).all()
    held = out[out["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.93
    good = held[held["quality"] == 1]
    assert good["predicted"].mean() > 0.97
    assert out["score"].between(0, 1).all() and ((out["score"] >= 0.5) == (out["predicted"] == 1)).all()


def test_classifier_sees_whole_texts_in_any_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list(string.ascii_lowercase), 5)) for _ in range(300)]
    good = [" ".join(rng.choice(words, 120)) for _ in range(30)]
    bad = [" ".join(f"{w}$$$" for w in rng.choice(words, 120)) for _ in range(30)]
    net = quality_classifier.fit(good + bad, [1] * 30 + [0] * 30, min_steps=150)
    assert min(map(net.score, good)) > 0.5 > max(map(net.score, bad))
    late = " ".join([*rng.choice(words, 60_000), *[f"{w}$$$" for w in rng.choice(words, 400)]])
    whole = net.features(late.encode())
    clean = net.features(" ".join(rng.choice(words, 60_400)).encode())
    assert np.abs(whole[:24] - clean[:24]).max() > 0.5
    assert 0 <= net.score(None) == net.score("") <= 1
    repeated = (" ".join(["again"] * 300) + " " + " ".join(rng.choice(words, 300))) * 20
    for text in (late, repeated, "ab", ""):
        data = quality_classifier.padded(text.encode())
        marks, whole = quality_classifier.repeats(data, 0, len(data)), net.features(text.encode())
        for block in (256, 1 << 12, 1 << 14):
            cut = [quality_classifier.repeats(data, i, min(len(data), i + block - 3)) for i in range(0, len(data), block - 3)]
            assert (np.concatenate(cut) == marks).all()
            monkeypatch.setattr(quality_classifier, "BLOCK", block)
            assert np.allclose(net.features(text.encode()), whole, rtol=1e-5, atol=1e-6)
        monkeypatch.undo()


def naive_features(net, text):
    """Filter by filter and byte by byte."""
    n, w, s = max(1, -(-len(text) // quality_classifier.STRIDE)), quality_classifier.WIDTH, quality_classifier.STRIDE
    data = text + bytes(n * s + w - s - len(text))
    marks = [0] * len(data)
    for j in range(len(data) - 7):
        if data[j : j + 8] != bytes(8) and any(j >= lag and data[j : j + 8] == data[j - lag : j - lag + 8] for lag in range(2, 30)):
            marks[j] = marks[j + 7] = 1
    z = []
    for i in range(n):
        x = [v for b in range(i * s, i * s + w) for v in (*net.emb[data[b]], marks[b])]
        z.append(np.maximum(np.array(x) @ net.filt + net.bias, 0))
    cell = quality_classifier.CELL
    cells = [np.max(z[i : i + cell], 0) for i in range(0, n, cell)]
    pooled = [np.max(cells[i : i + quality_classifier.CHUNK], 0) for i in range(0, max(1, len(cells) - 1), quality_classifier.HOP)]
    return np.concatenate([np.max(pooled, 0), np.mean(pooled, 0)])


def test_network_against_naive_convolution_and_numerical_gradients():
    rng = np.random.default_rng(8)
    net = quality_classifier.fit(["some text that is good " * 9, "bad !! " * 40, "x"], [1, 0, 1], filters=5, dims=3, min_steps=3)
    for text in (b"", b"a", bytes(rng.integers(0, 256, 1501).astype(np.uint8)), b"again and " * 130):
        assert np.allclose(net.features(text), naive_features(net, text), rtol=1e-4, atol=1e-5)
    text, y = b"some words, some words, and others " * 30, 1.0
    net.emb, net.filt, net.bias = (p.astype(np.float64) for p in (net.emb, net.filt, net.bias))
    wide = lambda e: np.lib.stride_tricks.sliding_window_view(e, (quality_classifier.WIDTH, e.shape[1]))[:: quality_classifier.STRIDE, 0].reshape(-1, quality_classifier.WIDTH * e.shape[1])
    net.convolve = lambda e: wide(e) @ net.filt + net.bias
    grads = [np.zeros_like(p, dtype=np.float64) for p in (net.emb, net.filt, net.bias, net.out)] + [0.0]
    quality_classifier.accumulate(net, text, y, 1.0, grads)
    loss = lambda: -np.log(1 / (1 + np.exp(-(net.features(text) @ net.out + net.out_bias))))
    for param, grad in zip((net.emb, net.filt, net.bias, net.out), grads):
        for at in map(tuple, np.argwhere(np.abs(grad) > np.abs(grad).max() / 3)[:5]):
            old = param[at]
            param[at] = old + 1e-6
            up = loss()
            param[at] = old - 1e-6
            down = loss()
            param[at] = old
            assert (up - down) / 2e-6 == pytest.approx(grad[at], rel=2e-2, abs=1e-6)


def test_long_texts_are_in_the_training_sample(spark):
    docs = made(spark, ["short", "long " * 9_000, "medium " * 10, None])
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    held = {i for i in range(4) if crc32(str(i).encode()) % 3 == 1}
    texts, _ = quality_classifier.training_sample(docs, labels, 10, 1_000_000)
    assert len(texts) == len({0, 1, 2} - held)
    few, _ = quality_classifier.training_sample(docs, labels, 10, 100)
    assert sum(map(len, few)) <= 100


def test_classifier_without_labels_passes_everything():
    net = quality_classifier.fit(["a", "b"], [1, 1])
    assert net.score("anything") == 0.5


# 5


@pytest.mark.parametrize("path", [SF, SF2])
def test_mix_comes_near_its_targets(spark, path):
    out = mixing.mix(documents(spark, path)).toPandas()
    src = documents(spark, path).select("doc_id", "source").toPandas()
    by = out.merge(src).groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("source_size", "first"))
    assert (abs(by["taken"] - by["target"]) <= 0.01 * by["target"] + 1).all()
    assert (out["taken"] <= 2 * out["size"]).all() and (by["target"] <= 2 * by["size"]).all()
    assert abs(by["target"].sum() - 1.5 * by["size"].sum()) < 1e-6 * by["size"].sum()


def test_quotas_are_highest_quotients_in_every_shard(spark):
    sizes = spark.createDataFrame([("a", 4000), ("b", 900), ("c", 2500), ("d", 60), (None, 700)], "source string, size long")
    targets = mixing.source_targets(sizes)
    t = {r["rank"]: r["target"] for r in targets.collect()}
    got = mixing.block_quotas(targets, n_shards=5).collect()
    block = got[0]["block"]
    house = int(sum(t.values()) / block + 0.5)
    quotients = sorted(((-v / (2 * k + 1), rank, k) for rank, v in t.items() for k in range(house)))
    for j in range(1, 6):
        won = defaultdict(int)
        for _, rank, _ in quotients[: house * j // 5]:
            won[rank] += 1
        assert {r["rank"]: r["upto"] for r in got if r["shard"] == j} == {k: won[k] for k in t}
    assert all(r["quota"] >= 0 for r in got)


def test_each_shard_takes_its_quota_of_each_source(spark):
    docs = documents(spark, SF2)
    sizes = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    quotas = {(r["source"], r["shard"]): r["quota"] * r["block"] for r in mixing.block_quotas(mixing.source_targets(sizes)).collect()}
    block = mixing.block_quotas(mixing.source_targets(sizes)).first()["block"]
    got = mixing.mix(docs.withColumn("src", F.col("source")), also=["src"]).select(F.col("src").alias("source"), F.explode("spans").alias("s")).groupBy("source", "s.shard").agg(F.sum(F.col("s.b") - F.col("s.a")).alias("n")).collect()
    assert {(r["source"], r["shard"]) for r in got} == {k for k, v in quotas.items() if v}
    # a lap's last block may be short
    assert all(0 <= quotas[r["source"], r["shard"]] - r["n"] < 3 * block for r in got)


def test_many_sources_get_the_seats_of_the_highest_quotients(spark):
    rng = np.random.default_rng(6)
    sizes = [(f"s{i:03}", int(x)) for i, x in enumerate(np.append(rng.integers(1, 50, 150), rng.integers(1000, 90_000, 150)))]
    targets = mixing.source_targets(spark.createDataFrame(sizes + sizes[:5], "source string, size long"))
    t = {r["rank"]: (r["target"], r["source_size"]) for r in targets.collect()}
    got = mixing.block_quotas(targets, n_shards=3).collect()
    block, house = got[0]["block"], sum(r["upto"] for r in got if r["shard"] == 3)
    assert abs(house - sum(x for x, _ in t.values()) / block) < 0.500001
    quotients = sorted((-x / (2 * k + 1), rank) for rank, (x, size) in t.items() for k in range(min(house, 2 * -(-size // block))))
    for j in range(1, 4):
        won = defaultdict(int)
        for _, rank in quotients[: house * j // 3]:
            won[rank] += 1
        assert {r["rank"]: r["upto"] for r in got if r["shard"] == j} == {k: won[k] for k in t}


def test_targets_by_repeated_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 5, "e": 800, None: 300}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        share = {k: left * weight[k] / sum(weight[x] for x in open_) for k in open_}
        over = {k for k in open_ if share[k] > 2 * sizes[k]}
        if not over:
            want |= share
            break
        for k in over:
            want[k] = 2.0 * sizes[k]
            left -= want[k]
        open_ -= over
    assert got == pytest.approx(want)


def test_mixed_documents_hold_the_words_taken(spark):
    docs = documents(spark)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    out = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        out[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(out)


# 6


def brute_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    return max(fits, key=len, default=None)


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_url_rules(spark, edge, which):
    path = edge if which == "edge" else SF2
    out = queries.QUERIES["op6_url_filter"](spark, path).join(spark.read.parquet(f"{path}/pages.parquet").select("page_id", "url").distinct(), "page_id").collect()
    for r in out:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r["url"] or "")
        host, p = (m[1].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)), m[2]) if m else ("", "")
        rule = brute_rule(host, p)
        assert (r["host"], r["path"], r["rule"]) == (host, p, rule)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == url_filter.RULES[rule])


def test_segmentation():
    costs = {"the": 2.0, "there": 6.0, "re": 5.0, "news": 5.0, "paper": 6.0, "newspaper": 12.0, "s": 9.0}
    assert url_filter.segment("thenewspaper", costs) == ["the", "news", "paper"]
    assert url_filter.segment("there", costs) == ["there"]
    assert url_filter.segment("qxqthe", costs) == ["qxq", "the"]
    assert url_filter.segment("", costs) == [] and "".join(url_filter.segment("zzz", {})) == "zzz"


def test_bayes_follows_its_evidence(spark):
    decided = spark.createDataFrame([("spam.com", "/casino/1", "block")] * 5 + [("news.org", "/science/2", "allow")] * 6, "host string, path string, verdict string")
    weights, prior = url_filter.bayes_weights(decided, {"spam": 1.0, "news": 1.0})
    assert weights["p:casino"] > 0 > weights["p:science"] and weights["h:spam"] > 0 > weights["h:news"] and prior < 0
    assert url_filter.bayes_weights(decided.limit(0), {}) == ({}, 0.0)


def test_verdicts_against_plain_python(spark):
    """Segmentation and naive Bayes over all words and tokens, recomputed without Spark."""
    import math

    out = queries.QUERIES["op6_url_filter"](spark, SF2).collect()
    words = defaultdict(int)
    for r in documents(spark, SF2).collect():
        for w in re.findall(r"[^\W\d_]+", (r["text"] or "").lower()):
            words[w] += len(w) <= 63
    total = sum(words.values())
    costs = {w: math.log(total / n) for w, n in words.items() if n}
    highest, cut = max(costs.values()), {}

    def tokens(r):
        labels = re.findall(r"[^\W\d_]+", r["host"])
        for label in labels:
            cut[label] = cut.get(label) or url_filter.segment(label, costs, highest=highest)
        return ["h:" + w for label in labels for w in cut[label]] + ["p:" + re.sub(r"\d+", "0", x) for x in re.findall(r"\w+", r["path"].lower())]

    seen, pages = {"block": defaultdict(int), "allow": defaultdict(int)}, {"block": 0, "allow": 0}
    for r in out:
        if r["rule"]:
            pages[url_filter.RULES[r["rule"]]] += 1
            for x in tokens(r):
                seen[url_filter.RULES[r["rule"]]][x] += 1
    known = set(seen["block"]) | set(seen["allow"])
    size = {v: sum(seen[v].values()) + len(known) for v in seen}
    odds = {x: math.log((seen["block"][x] + 1) / size["block"]) - math.log((seen["allow"][x] + 1) / size["allow"]) for x in known}
    for r in out:
        if not r["rule"]:
            score = math.log(pages["block"] / pages["allow"]) + sum(odds.get(x, 0) for x in tokens(r))
            assert abs(score) < 1e-9 or r["verdict"] == ("block" if score > 0 else "allow")


def test_rare_words_and_tokens_count(spark):
    letters = "bcdfghjklm"
    frequent = " ".join("x" + "".join(letters[i // 10**k % 10] for k in range(5)) for i in range(50_001))
    docs = made(spark, [frequent, frequent, "poker casino"])
    crowd = "/" + frequent.replace(" ", "/")
    urls = ["http://poker.bad.com/zrare", "http://bad.com" + crowd, "http://good.com" + crowd, "http://good.com/", "http://pokercasino.org/", "http://y.org/zrare", "http://y.org/"]
    rules = {"bad.com/": "block", "good.com/": "allow"}
    out = {r["url"]: r["url_verdict"] for r in url_filter.judge(spark.createDataFrame([(u,) for u in urls], "url string"), docs, rules).collect()}
    assert [out[u] for u in urls] == ["block", "block", "allow", "allow", "block", "block", "allow"]


# 7


def test_rules_keep_clean_documents_and_reject_junk(spark):
    out = quality_rules.apply_rules(documents(spark, SF2)).join(spark.read.parquet(f"{SF2}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("passed").cast("int")).alias("p"))
    p = {r["quality"]: r["p"] for r in out.collect()}
    assert p[1] > 0.97 and p[0] < 0.2
    only = quality_rules.apply_rules(made(spark, ["a b", "c"]), [quality_rules.Rule("n_words", low=2)]).orderBy("doc_id").collect()
    assert [r["passed"] for r in only] == [True, False]


def test_the_stop_word_rule_needs_a_known_language(spark):
    text = " ".join(f"sana{i}" for i in range(40))
    out = quality_rules.apply_rules(spark.createDataFrame([(0, text, "fi"), (1, text, None), (2, text, "en")], "doc_id long, text string, lang string")).orderBy("doc_id").collect()
    assert [r["passed"] for r in out] == [True, True, False]


def test_rules_are_one_scan(spark):
    plan = quality_rules.op7_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


# 8


def test_every_window_has_a_selected_minimum():
    h, n = wordhash.words(["a b c d e f g h i j k l", None, "", "A-b c"], wordhash.ALNUM)
    assert n.tolist() == [12, 0, 0, 3] and h[0] == h[12] and h[2] == h[14]
    rng = np.random.default_rng(1)
    for size in range(1, 11):
        h = rng.integers(1, 8, 300).astype(np.uint64)  # few words, so that k-grams repeat
        at = np.array([0, 120, 121, 300])
        k = min(decontaminate.K, size)
        g = wordhash.grams(h, k, salt=k).tolist()
        place, fp = decontaminate.selected(h, at, size)
        want = set()
        for a, b in zip(at[:-1], at[1:]):
            for i in range(a, b - size + 1):
                span = g[i : i + size - k + 1]
                want.add(i + max(j for j, x in enumerate(span) if x == min(span)))
        assert place.tolist() == sorted(want) and fp.tolist() == [g[p] for p in place]


def brute_hits(docs, bench):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    of = defaultdict(set)
    for item, t in bench:
        w = cut(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            of[tuple(w[i : i + 10])].add(item)
    out = []
    for _, t in docs:
        w, hit, items = cut(t), set(), set()
        for size in range(1, 11):
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in of:
                    hit |= set(range(i, i + size))
                    items |= of[tuple(w[i : i + size])]
        out.append((len(w), len(hit), sorted(items)))
    return out


def test_every_shared_span_is_hit(spark):
    rng = np.random.default_rng(4)
    prose = lambda n, v=6: [f"w{x}" for x in rng.integers(0, v, n)]
    bench = [(i, " ".join(prose(int(rng.integers(1, 40))))) for i in range(12)] + [(20, "w1 w2 w3 w1 w2 w3 w1 w2 w3 w1 w2 w3"), (21, None), (22, "w1")]
    docs = []
    for i in range(60):
        w = prose(int(rng.integers(0, 60)), 30)
        for _ in range(2):
            item = (bench[int(rng.integers(0, 13))][1] or "").split()
            a = int(rng.integers(0, len(item)))
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = item[a : a + int(rng.integers(1, 25))]
        docs.append((i, " ".join(w)))
    out = decontaminate.hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"] or 0, sorted(r["items"] or [])) for r in out.withColumn("n_hit", decontaminate.covered(F.col("windows"))).collect()}
    assert [got[i] for i in range(60)] == brute_hits(docs, bench)


def test_clean_documents_stay(spark):
    docs, bench = documents(spark, SF2), spark.read.parquet(f"{SF2}/benchmark.parquet")
    dirty = {r["doc_id"] for r in queries.QUERIES["op8_decontamination"](spark, SF2).where("contaminated").collect()}
    kept = {r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()}
    assert dirty and kept == {r["doc_id"] for r in docs.collect()} - dirty


# 9


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b, sb in enumerate(sets):
        for a, sa in enumerate(sets[:b]):
            if sa and sb and 100 * len(sa & sb) >= 75 * len(sa | sb):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def families():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = [None, "", "a b", "A  b", "a b c", " ".join(vocabulary[:5]), " ".join(vocabulary[:5]).upper()]
    passage = list(rng.choice(vocabulary, 60))
    for _ in range(6):  # families of copies that are near the threshold, and documents that share a passage
        base = list(rng.choice(vocabulary, int(rng.integers(20, 200))))
        for _ in range(12):
            copy = list(base)
            for at in rng.integers(0, len(copy), int(rng.integers(0, max(2, len(copy) // 22)))):
                copy[at] = str(rng.choice(vocabulary))
            texts.append(" ".join(copy))
    for _ in range(25):
        texts.append(" ".join([*rng.choice(vocabulary, int(rng.integers(1, 80))), *passage, *rng.choice(vocabulary, 5)]))
    return texts + texts[7:12]


def test_links_near_the_threshold(spark):
    texts = families()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(made(spark, texts)).collect()}
    want = brute_components(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert len({c for _, c in want}) < len(texts) - 20


def test_small_bitmaps_change_no_link(spark):
    texts = families()[:60]
    out = lambda size: sorted(map(str, jaccard_join.components(made(spark, texts), bitmap_bytes=size).collect()))
    assert out(1 << 26) == out(1 << 12)


@pytest.mark.parametrize("sub_bits", [0, 3])
def test_fragment_maps_count_every_shingle(spark, sub_bits):
    texts = families()[:40]
    counts = jaccard_join.fragment_counts(made(spark, texts).repartition(3), sub_bits)
    rows = jaccard_join.fragment_maps(counts, sub_bits, [1024] * len(jaccard_join.LEVELS)).collect()
    assert len({r["frag"] for r in rows}) == len(rows)
    order = jaccard_join.Order([{r["frag"]: bytes(r[f"b{k}"]) for r in rows} for k in range(len(jaccard_join.LEVELS))])
    seen = defaultdict(int)
    for s in jaccard_join.shingle_sets(texts):
        for t in s.tolist():
            seen[t] += 1
    want = [sum(n >= least for least in jaccard_join.LEVELS) - 1 for n in seen.values()]
    got = order.level(np.array(list(seen), np.uint64)).tolist()
    assert all(g >= w for g, w in zip(got, want)) and sum(g != w for g, w in zip(got, want)) < len(want) / 20


def test_an_operator_leaves_no_stored_table_but_its_result(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    jaccard_join.components(made(spark, families()[:40])).collect()
    assert [d.rsplit("-", 1)[0] for d in set(os.listdir(folder)) - before if not d.startswith(".")] == ["components"]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199), (199, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 199: 199, 200: 199}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).isEmpty()


# 10


def test_extraction_of_the_pages(spark):
    import html as entities

    out = queries.QUERIES["op10_html_extraction"](spark, SF2).join(spark.read.parquet(f"{SF2}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in out:
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"</?(?:p|h1)>|<br>", " ", article).replace("<b>", "").replace("</b>", "")).split())
        assert r["text"] == want and r["n_chars"] == len(want)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text &amp &#x41;", "just text & A"),
        ("<body><header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>Some <i>text</i> of a page, long enough to be it.</p></main></body>", "Title Some text of a page, long enough to be it."),
        ('<div id=content><p>The story of a page is told here at length.</p><div class="user-comments"><p>I disagree with all of this, at even greater length than that.</p></div><aside>x</aside></div>', "The story of a page is told here at length."),
        ("<article>a<br>b\n\n c<ul><li>one<li>two</ul></article><div class='cookie-notice'>We use cookies</div>", "a b c one two"),
        ("<article><p>cut off in the <b", "cut off in the"),
        ('<body class="has-sidebar"><div class="with-sidebar"><p>The text of the page.</p></div><div class="leftsidebar">x</div><ol class="usercomments"><li>y</ol></body>', "The text of the page."),
    ],
)
def test_extraction(page, text):
    assert html_extract.extract(page, None) == text


@pytest.mark.parametrize("unit", ["<div>", "<div class=ad>", "<article><div class=comments>", "<svg>", "<li class=menu>"])
def test_deep_nesting_takes_linear_time(unit):
    page = unit * (1_000_000 // len(unit)) + "the end"
    start = time.process_time()
    assert html_extract.extract(page, ">".join(["div"] * 1000)) in ("the end", "")
    assert time.process_time() - start < 20
    mixed = "".join(f"<div>part {i} " for i in range(2000))
    assert html_extract.extract(mixed, None) == " ".join(f"part {i}" for i in range(2000))


def test_no_text_is_lost_against_a_tree_walk():
    """Pages without noise yield all their text, whatever closes, nests or is left open."""
    rng = np.random.default_rng(2)
    tags = ["div", "section", "p", "ul", "li", "table", "tr", "td", "article", "main", "blockquote", "b", "i", "h2", "figure", "figcaption"]
    for _ in range(150):
        parts, words = [], []
        for i in range(int(rng.integers(1, 60))):
            what = rng.random()
            tag = tags[int(rng.integers(0, len(tags)))]
            if what < 0.4:
                words.append(f"w{i}")
                parts.append(f" w{i} ")
            else:
                parts.append(f"<{tag} class='c{i}'>" if what < 0.75 else f"</{tag}>")
        assert html_extract.extract("".join(parts), None) == " ".join(words)


def test_ties_of_votes_and_clashing_columns(spark):
    page = "<div class={}><p>some text of it</p></div>"
    df = spark.createDataFrame([(1, "x://h/", page.format("a"), "w", "m"), (2, "x://h/", page.format("b"), "w", "m")], "page_id long, url string, html string, winner string, path string")
    assert html_extract.host_paths(df.withColumn("host", F.lit("h"))).first()["winner"] == "div.b"
    out = html_extract.extract_pages(df)
    assert out.columns == [*df.columns, "main_text"] and {(r["winner"], r["main_text"]) for r in out.collect()} == {("w", "some text of it")}


def test_hosts_agree_on_a_path(spark):
    page = "<body><div class='post-{0}'><p>{1}</p></div><div class='promo-x'><p>{2}</p></div></body>"
    odd = page.format(9, "short", "words " * 50)
    pages = [(i, "http://h.example.com/a", page.format(i, "the text of this page number " * 5, "buy")) for i in range(5)] + [(5, "http://h.example.com/b", odd)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    winner = html_extract.host_paths(df.withColumn("host", F.lit("h"))).first()["winner"]
    assert winner == "body>div.post-0"
    assert html_extract.extract_pages(df).where("page_id = 5").first()["main_text"] == "short"


def story(i, n=4):
    return " ".join(f"Story {i} paragraph {j} has some words of its own, number {i * 7 + j}." for j in range(n))


def in_paragraphs(text):
    return "".join(f"<p>{s}.</p>" for s in text.rstrip(".").split(". "))


def extracted(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, u struct<url:string,html:string>").select("page_id", "u.*")
    return [r["main_text"] for r in html_extract.extract_pages(rows).orderBy("page_id").collect()]


def test_what_most_pages_of_a_host_share_is_its_frame(spark):
    """The frame has names that no list knows; only the vote over the host's pages tells it from the story."""
    frame = ("<div class='zq1'><p>Read our great teaser every day, it is the same.</p></div>", "<div class='zq2'><p>Copyright of the same people, all year round.</p></div>")
    page = lambda i, box: f"<html><body>{frame[0]}<div class='{box}'>{in_paragraphs(story(i))}</div>{frame[1]}</body></html>"
    pages = [(f"http://h.org/{i}", page(i, "mid")) for i in range(12)] + [("http://few.org/1", page(50, "mid")), ("http://few.org/2", page(51, "mid"))]
    got = extracted(spark, pages)
    assert got[:12] == [story(i) for i in range(12)]
    assert all("teaser" in t and "Copyright" in t for t in got[12:])  # two pages are no majority of anything
    hashes = {tuple(r["frame"]) for r in html_extract.host_frames(spark.createDataFrame([("h", page(i, "mid")) for i in range(5)], "host string, html string")).collect()}
    found = [html_extract.block_hash(b) for b in html_extract.blocks(frame[0] + frame[1])[0] if html_extract.worth(b)]
    assert hashes == {tuple(sorted(found))}


@pytest.mark.parametrize("name", ["search", "promoted", "related", "share", "login"])
def test_an_article_of_a_telling_name_stays(name, spark):
    assert extracted(spark, [("http://a.org", f"<body><div class='{name}'>{in_paragraphs(story(1))}</div><div class='x'>more</div></body>")]) == [story(1) + " more"]
    assert extracted(spark, [("http://a.org", f"<body><div class='post'><div class='{name}'>{in_paragraphs(story(1))}</div></div></body>")]) == [story(1)]
    assert extracted(spark, [("http://a.org", f"<body><div class='{name}'>A box.</div><div>{in_paragraphs(story(1))}</div></body>")]) == [story(1)]
    assert extracted(spark, [("http://a.org", f"<body><div class='{name}'>{in_paragraphs(story(1))}</div><article><p>Short.</p></article></body>")]) == ["Short."]


def test_comments_and_forms_go_however_long(spark):
    long = in_paragraphs(story(3))
    assert extracted(spark, [("u", f"<body><div class='comments'>{long}</div><p>Short.</p></body>"), ("u", f"<div class='login'><input>{long}</div><p>Short.</p>")]) == ["Short.", "Short."]


def test_lists_tables_and_quotes_are_part_of_the_article(spark):
    prose, items = "<p>" + "prose of it " * 25 + "</p>", "".join(f"<li>item {i} of a long list" for i in range(100))
    page = f"<body><article>{prose}<ul>{items}</ul></article></body>"
    text = html_extract.extract(page, None)
    assert text.startswith("prose") and text.endswith("item 99 of a long list")
    assert html_extract.extract("<p>article</p><blockquote>quote</blockquote>", None) == "article quote"
    assert html_extract.extract("<body><article><p>first</p></article><div><div><p>second</p></div></div></body>", None) == "first second"
    split = f"<body><div class=a>{prose}</div><div class=b><p>{'other ' * 50}</p></div></body>"
    pages = [(i, "http://h.example.com/a", page) for i in range(5)] + [(5, "http://h.example.com/b", f"<body><article>{prose}<ul><li>one</ul></article></body>"), (6, "http://h.example.com/c", split)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert html_extract.host_paths(df.withColumn("host", F.lit("h"))).first()["winner"] == "body>article"
    out = {r["page_id"]: r["main_text"] for r in html_extract.extract_pages(df).collect()}
    assert out[0] == text and out[5].startswith("prose") and out[5].endswith("one") and out[6].startswith("prose") and out[6].endswith("other")
    assert html_extract.extract(split, "body>div.b") == out[6]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<body><article><section class="commentary"><p>a</p></section><div id="cookie-recipes">b</div></article></body>', "a b"),
        ('<body><div><section id="related-work">a</section><div id="search-methods">b</div><div id="cookie-recipes">c</div></div></body>', "a b c"),
        ('<article><p class="alert">mind the gap</p><p>text <span class="notice">and more</span> of it</p></article>', "mind the gap text and more of it"),
        ("<article><p>a</p><figure><table><tr><td>1</table><figcaption>b</figcaption></figure><p>c <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>", "a 1 b c x=2"),
        ('<article><p>a</p><div class="related"><a href=x>Other page</a></div><ol class="comments"><li>I disagree<li>me too</ol><div class="newsletter">Mail <input></div><p>b</p></article>', "a b"),
        ('<body><p>a</p><div class="ad">buy</div><div class="leftsidebar">x</div><div id="user-comments">y</div></body>', "a"),
    ],
)
def test_names_alone_take_no_text_from_an_article(page, text):
    assert html_extract.extract(page, None) == text
