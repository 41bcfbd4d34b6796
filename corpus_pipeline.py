"""A corpus from raw documents: quality, near copies, benchmark passages, source weights, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. No SQL can express the first stage, so ORACLE_SQL is None; the tests hold the network, the groups of near copies, the benchmark
passages and the words of the mix against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakey.llm import decontaminate, jaccard_join, mixing, quality_classifier, sharding
from stratakey.llm.store import Scratch, documents, small_batches


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    net = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_classifier.score_column(net, F.col("text")) >= 0.5)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to the target weights of their sources: some twice, some in part, some not at all."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stores the mix as shards; adds each row's shard and the version of the manifest."""
    # a reserved name among the input's own columns is passed on under another
    named = {c: f"{c}_in" for c in ("shard", "manifest_version") if c in docs.columns}
    return sharding.shard_documents(docs.withColumnsRenamed(named))


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("ngram_jaccard_join", jaccard_join_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = documents(spark, sf_dir), Scratch(spark)
    for _, stage in STAGES:
        with small_batches(spark):  # whole texts go to Python in the write, too
            docs = scratch.store(stage(spark, docs, sf_dir), "stage")  # in the place of the stage before
    return docs
