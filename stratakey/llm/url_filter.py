"""URL filter: rules first, then naive Bayes over segmented hosts and path tokens.

Host labels are split into words by the best path under a unigram model (Viterbi); multinomial naive Bayes, trained on the
pages that the rules decide, judges the rest. Word counts cover all words of all documents and token counts all tokens of all
decided pages. Both stay Spark tables, whatever their size: a distinct label's substrings meet the words in a join, and a
distinct host's and a distinct path's tokens meet the weights in another. Only url, host and path move. Weights are summed as
decimals, so that a sum doesn't depend on its order.

Defined cases: a null url, or one without "://", has an empty host and path; it has no tokens and gets the class that is more
frequent among decided pages, allow if they are equal or there are none. Repeated rows give repeated results; of equally cheap splits
the one whose last word is longest is taken; a very long url's tokens are rows; columns named url_host, url_path, url_rule or url_verdict are
replaced, others are kept whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .store import ascii_lower, documents, materialise

#: Production rules: the verdict for a host with its subdomains, and the start of the path.
RULES = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def matching_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule that fits, null if none does."""
    fits = []
    for r in sorted(rules, key=lambda r: (-len(r), r)):
        h, _, p = r.partition("/")
        fits.append(F.when(((host == h) | host.endswith("." + h)) & path.startswith("/" + p), F.lit(r)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


#: A fixed value of host names: no label is longer, so no longer word can be in one.
LONGEST = 63


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, n): how often each word that a label can hold occurs."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1))).alias("w"))
    return words.where(F.length("w") <= LONGEST).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


def word_costs(docs: DataFrame) -> tuple[DataFrame, float]:
    """(w, cost), the negative log probability of each word, and the highest cost."""
    counts = materialise(word_counts(docs), "url-words")
    n = counts.agg(F.sum("n").alias("total"), F.min("n").alias("least")).first()
    total = float(n["total"] or 1)
    return counts.select("w", F.log(F.lit(total) / F.col("n")).alias("cost")), math.log(total / n["least"]) if n["least"] else 10.0


def segment(name: str, costs: dict[str, float], longest: int = LONGEST, highest: float | None = None) -> list[str]:
    """The cheapest split of name into words; letters outside all words cost more than any word and are joined.

    costs needs no words but those in name if the highest cost of all is given.
    """
    rare = 2 + (max(costs.values(), default=10.0) if highest is None else highest)
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    for j in range(1, len(name) + 1):
        for i in range(max(0, j - longest), j):
            c = costs.get(name[i:j], rare if j == i + 1 else math.inf)
            if best[i] + c < best[j]:
                best[j], back[j] = best[i] + c, i
    out, j = [], len(name)
    while j:
        i = back[j]
        unknown = name[i:j] not in costs
        if unknown and out and out[-1][1]:
            out[-1] = (name[i:j] + out[-1][0], True)
        else:
            out.append((name[i:j], unknown))
        j = i
    return [w for w, _ in reversed(out)]


@F.pandas_udf(ArrayType(StringType()))
def labels_of(hosts: pd.Series) -> pd.Series:
    return pd.Series([re.findall(r"[^\W\d_]+", h) for h in hosts], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def tokens_of(paths: pd.Series) -> pd.Series:
    return pd.Series([["p:" + re.sub(r"\d+", "0", t) for t in re.findall(r"\w+", p.lower())] for p in paths], dtype=object)


def label_words(labels: DataFrame, costs: DataFrame, highest: float) -> DataFrame:
    """(label, words) of distinct labels."""

    @F.pandas_udf("array<string>")
    def cut(names: pd.Series, words: pd.Series, prices: pd.Series) -> pd.Series:
        return pd.Series([segment(n, {} if w is None else dict(zip(w, p)), highest=highest) for n, w, p in zip(names, words, prices)], dtype=object)

    n = F.length("label")
    starts = labels.select("label", F.explode(F.sequence(F.lit(1), n)).alias("i"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(LONGEST), n - F.col("i") + 1))
    parts = starts.select("label", F.explode(F.transform(lengths, lambda k: F.substring(F.col("label"), F.col("i"), k))).alias("w")).distinct()
    found = parts.join(costs, "w").groupBy("label").agg(F.collect_list(F.struct("w", "cost")).alias("found"))
    return labels.join(found, "label", "left").select("label", cut("label", "found.w", "found.cost").alias("words"))


def host_tokens(hosts: DataFrame, costs: DataFrame, highest: float) -> DataFrame:
    """(host, t): a row for each word of each of the distinct hosts."""
    labels = materialise(hosts.select("host", F.explode(labels_of("host")).alias("label")), "url-labels")
    split = label_words(labels.select("label").distinct(), costs, highest)
    words = F.transform(F.coalesce("words", F.array("label")), lambda w: F.concat(F.lit("h:"), w))
    return labels.join(split, "label", "left").select("host", F.explode(words).alias("t"))


def token_weights(decided: DataFrame, tokens: DataFrame) -> tuple[DataFrame, float]:
    """(t, weight), the log odds for block of each token, and those of the classes. decided has host, path and verdict."""
    block, allow = (F.count(F.when(F.col("verdict") == v, 1)) for v in ("block", "allow"))
    n = decided.agg(block.alias("b"), allow.alias("a")).first()
    if not n["a"] or not n["b"]:
        return decided.sparkSession.createDataFrame([], "t string, weight double"), math.log((n["b"] + 1) / (n["a"] + 1))
    by = lambda c: decided.groupBy(c).agg(block.alias("b"), allow.alias("a"))
    seen = by("host").join(tokens, "host").select("t", "b", "a").unionByName(by("path").select(F.explode(tokens_of("path")).alias("t"), "b", "a"))
    counts = materialise(seen.groupBy("t").agg(F.sum("b").alias("b"), F.sum("a").alias("a")), "url-tokens")
    every = counts.agg((F.sum("b") + F.count(F.lit(1))).alias("b"), (F.sum("a") + F.count(F.lit(1))).alias("a")).first()
    odds = lambda c: F.log((F.col(c) + 1) / F.lit(float(every[c] or 1)))
    return counts.select("t", (odds("b") - odds("a")).alias("weight")), math.log(n["b"] / n["a"])


def bayes_weights(decided: DataFrame, costs: dict[str, float]) -> tuple[dict[str, float], float]:
    """token_weights under a small model, for a look at them on the driver."""
    words = decided.sparkSession.createDataFrame(list(costs.items()), "w string, cost double")
    tokens = host_tokens(decided.select("host").distinct(), words, max(costs.values(), default=10.0))
    weights, prior = token_weights(decided, tokens)
    return {r["t"]: r["weight"] for r in weights.collect()}, prior


#: Hosts whose sums are broadcast at most: a few MB. More are joined by a shuffle.
BROADCAST_HOSTS = 100_000


def judge(pages: DataFrame, docs: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """pages with url_host, url_path, url_rule and url_verdict."""
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col("url"))
    out = pages.withColumns({"url_host": host, "url_path": path})
    out = out.withColumn("url_rule", matching_rule(F.col("url_host"), F.col("url_path"), list(rules)))
    said = F.coalesce(*[F.when(F.col("url_rule") == r, F.lit(v)) for r, v in rules.items()], F.lit(None).cast("string"))
    out = out.withColumn("url_verdict", said)
    urls = out.select(F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_verdict").alias("verdict"))
    decided, undecided = urls.where("verdict is not null"), urls.where("verdict is null")
    costs, highest = word_costs(docs)
    tokens = materialise(host_tokens(urls.select("host").distinct(), costs, highest), "host-tokens")
    weights, prior = token_weights(decided, tokens)

    def sums(of: DataFrame, key: str) -> DataFrame:
        s = of.join(weights.select("t", F.col("weight").cast("decimal(28,18)").alias("weight")), "t")
        return materialise(s.groupBy(F.col(key).alias(f"__{key}")).agg(F.sum("weight").alias(f"__{key}_sum")), f"{key}-sums")

    by_host = sums(tokens, "host")
    by_host = F.broadcast(by_host) if by_host.count() <= BROADCAST_HOSTS else by_host
    by_path = sums(undecided.select("path").distinct().select("path", F.explode(tokens_of("path")).alias("t")), "path")
    out = out.join(by_host, F.col("url_host") == F.col("__host"), "left").join(by_path, F.col("url_path") == F.col("__path"), "left")
    zero = F.lit(0).cast("decimal(28,18)")
    score = F.lit(prior).cast("decimal(28,18)") + F.coalesce("__host_sum", zero) + F.coalesce("__path_sum", zero)
    learned = F.when(score > 0, F.lit("block")).otherwise(F.lit("allow"))
    return out.withColumn("url_verdict", F.coalesce("url_verdict", learned)).drop("__host", "__host_sum", "__path", "__path_sum")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    out = judge(pages, documents(spark, sf_dir))
    return out.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"))
