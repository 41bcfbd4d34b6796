import re
from collections import Counter

import pytest

import corpus_pipeline
from stratakey.llm import decontaminate, jaccard_join, mixing, quality_classifier
from stratakey.llm.store import materialise

from ..conftest import SF
from .test_operators import brute_components, brute_hits, edge, empty  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert set(stages[0].columns) < set(stages[-1].columns)


def test_classifier_stage(spark, stages):
    net = quality_classifier.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    want = Counter(r["doc_id"] for r in stages[0].collect() if net.score(r["text"]) >= 0.5)
    assert ids(stages[1]) == want and len(want) < stages[0].count()


def test_join_stage_keeps_one_of_each_group(stages):
    docs = stages[1].orderBy("doc_id").collect()
    found = brute_components([r["text"] for r in docs])
    assert ids(stages[2]) == Counter({docs[first]["doc_id"] for _, first in found})


def test_decontamination_stage(spark, stages):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert ids(stages[3]) == Counter(d for (d, _), (_, n_hit, _) in zip(docs, brute_hits(docs, bench)) if not n_hit)


def test_mixing_stage(stages):
    plan = mixing.mix(stages[3]).collect()
    words = Counter()
    for r in stages[4].collect():
        words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert words == Counter({r["doc_id"]: r["taken"] for r in plan if r["taken"]})


def test_sharding_stage(stages):
    assert stages[5].drop("shard", "manifest_version").exceptAll(stages[4]).isEmpty() and stages[5].count() == stages[4].count()


def test_run_is_the_stages(spark, stages):
    a, b = (sorted(map(str, df.select("doc_id", "text", "source").collect())) for df in (corpus_pipeline.run(spark, SF), stages[-1]))
    assert a == b


def test_edge_cases(spark, edge, empty):  # noqa: F811
    assert corpus_pipeline.run(spark, empty).count() == 0
    out, source = corpus_pipeline.run(spark, edge), spark.read.parquet(f"{edge}/documents.parquet")
    assert {"shard_in", "manifest_version", *source.columns} == {*out.columns}
    words = {w for r in source.collect() for w in (r["text"] or "").split()}
    assert all(set(r["text"].split()) <= words for r in out.collect())


def test_repeated_rows_of_a_document_become_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, None), (3, None)], "doc_id long, text string")
    assert ids(jaccard_join.keep_one(df)) == Counter({1: 1, 3: 1})


A, B, C = ("{0}a {0}b {0}c {0}d {0}e {0}f {0}g".format(x) for x in "abc")


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_join_stage_drops_rows_not_ids(spark):
    df = spark.createDataFrame([(1, A), (5, A), (5, B), (None, A), (None, C), (None, None), (7, C), (None, "x y")], "doc_id long, text string")
    assert texts(jaccard_join.keep_one(df)) == sorted([(1, A), (5, B), (7, C), (None, None), (None, "x y")], key=str)
    nulls = spark.createDataFrame([(None, A), (None, A + " "), (None, B)], "doc_id long, text string")
    assert sorted(r["text"].strip() for r in jaccard_join.keep_one(nulls).collect()) == [A, B]


def test_decontamination_drops_rows_not_ids(spark):
    df = spark.createDataFrame([(None, A), (None, B), (1, A), (1, B), (2, None), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(0, A)], "item_id long, text string")
    assert texts(decontaminate.clean_documents(df, bench)) == sorted([(None, B), (1, B), (2, None), (None, None)], key=str)


def test_mixed_rows_are_cut_at_their_own_spans(spark):
    rows = [(i % 3 or None, " ".join(f"t{i}w{k}" for k in range(20 + 7 * i)), f"s{i % 2}") for i in range(12)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, source string")
    plan = mixing.mix(df).collect()
    want, got = Counter(), Counter()
    for r in plan:
        want[(r["doc_id"], r["size"])] += r["taken"]
    size = {t.split("w")[0]: (d, len(t.split())) for d, t, _ in rows}
    for r in mixing.mixed_documents(df).collect():
        words = r["text"].split()
        assert len({w.split("w")[0] for w in words}) == 1 and size[words[0].split("w")[0]][0] == r["doc_id"]
        got[size[words[0].split("w")[0]]] += len(words)
    assert got == Counter({k: v for k, v in want.items() if v})


def test_stages_are_written_with_small_batches(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(i, "a b") for i in range(600)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    sizes = lambda docs: docs.mapInArrow(lambda batches: (b.select([0]) if len(b) <= 250 else 1 / 0 for b in batches), "doc_id long")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", lambda spark, docs, sf: sizes(docs))])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 600
