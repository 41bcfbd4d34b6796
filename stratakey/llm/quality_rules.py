"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in expression over the row's own text, so the operator is a single scan: no shuffle, no user
function, nothing gathered. Rows are independent; repeated rows give repeated results.

Defined cases: a null text counts as an empty one; an empty text has no words and fails the base rules; a null or other language
makes the stop-word rule silent; a very long text is measured in one task; a measure that equals a threshold passes; columns that
carry a measure's name are left alone, because measures travel in one struct column until the caller picks them; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import WS, documents, let

# Function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in is that it for was on are with as be at by this from or an have not but they".split(),
    "de": "der die das und ist nicht ein eine zu von mit den im auf als auch dem sich des für".split(),
    "fr": "le la les de des et en un une du que qui dans pour pas sur au par est ou".split(),
    "es": "el la los las de que y en un una por con para del se al lo su es no".split(),
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= measure <= high; the rule speaks only about texts of at least min_words words, and, with by_language, only
    about those in one of the languages of STOP_WORDS."""

    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0
    by_language: bool = False


#: The production table.
RULES: tuple[Rule, ...] = (
    Rule("n_words", low=10),
    Rule("mean_word_length", low=2, high=15),
    Rule("symbol_ratio", high=0.20),
    Rule("stop_ratio", low=0.03, min_words=30, by_language=True),
    Rule("upper_ratio", high=0.40),
    Rule("dup_line_ratio", high=0.30),
    Rule("bullet_line_ratio", high=0.90),
    Rule("ellipsis_line_ratio", high=0.30),
)


def measures(text: Column) -> Column:
    """One struct of counts and ratios of a text."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(t, F.lit(f"([^{WS}]+)"), F.lit(1))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{WS}]"))
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws})

    def counts(w: Column, ls: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.regexp_replace(t, f"[{WS}]+", "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(w, 5).alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(stops))).cast("long").alias("n_stop"),
            F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
            F.size(F.filter(ls, lambda x: x.rlike(r"^\s*[-*•]"))).cast("long").alias("n_bullets"),
            F.size(F.filter(ls, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("long").alias("n_ellipsis"),
        )

    def ratios(c: Column) -> Column:
        per = lambda a, b: F.coalesce(F.try_divide(c[a].cast("double"), c[b].cast("double")), F.lit(0.0))
        named = {
            "mean_word_length": per("word_chars", "n_words"),
            "symbol_ratio": per("n_symbols", "n_words"),
            "stop_ratio": per("n_stop", "n_words"),
            "upper_ratio": per("n_upper", "word_chars"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "bullet_line_ratio": per("n_bullets", "n_lines"),
            "ellipsis_line_ratio": per("n_ellipsis", "n_lines"),
        }
        kept = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(*[c[k].alias(k) for k in kept], *[v.alias(k) for k, v in named.items()])

    return let(words, lambda w: let(lines, lambda ls: let(counts(w, ls), ratios)))


def repeated_words(words: Column, n: int) -> Column:
    """Words inside n-word windows that occur at least twice, first occurrences included.

    Windows are hashed. Only where some hash is there twice are they sorted with their positions, and those with an equal neighbour
    kept: n log n in the words at most.
    """
    last = F.size(words) - n
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, n)))
    zero = F.lit(0).cast("long")

    def again(s: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
        twice = F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when(same(j, j - 1) | same(j, j + 1), F.get(s, j)["i"])), lambda x: x.isNotNull())
        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end"))
        step = lambda a, x: F.struct((a["total"] + (x + n - F.greatest(x, a["end"]))).cast("long").alias("total"), (x + n).alias("end"))
        return F.aggregate(F.array_sort(twice), start, step, lambda a: a["total"])

    def some(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(let(F.array_sort(placed), again))

    return F.when(last < 1, zero).otherwise(let(hashes, some))


def verdict(m: Column, rules: Sequence[Rule] = RULES, lang: Column | None = None) -> Column:
    """True if the struct of measures passes every rule. lang is the text's language, where it is known."""
    known = F.lit(False) if lang is None else F.coalesce(lang.isin(list(STOP_WORDS)), F.lit(False))
    ok = F.lit(True)
    for r in rules:
        within = F.lit(True)
        if r.low is not None:
            within = within & (m[r.measure] >= r.low)
        if r.high is not None:
            within = within & (m[r.measure] <= r.high)
        within = (m["n_words"] < r.min_words) | within if r.min_words else within
        ok = ok & (~known | within if r.by_language else within)
    return ok


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", out: str = "quality_measures") -> DataFrame:
    """docs with the struct column `out` and the boolean column `passed`; the language is the column lang, if there is one."""
    lang = F.col("lang") if "lang" in docs.columns else None
    return docs.withColumn(out, measures(F.col(text))).withColumn("passed", verdict(F.col(out), rules, lang))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = apply_rules(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    m = F.col("quality_measures")
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return scored.select("doc_id", *[m[k].alias(k) for k in names], failed.alias("base_failed"), (~failed & F.col("passed")).alias("kept"))


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))
_WORD = r"[^\x20\x09-\x0D]+"
OP7_SQL = rf"""
with d as (
  select row_number() over () as rid, doc_id, lang, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls
  from documents),
win as (select rid, i, list_aggregate(w[i:i+4], 'string_agg', ' ') as g from (select rid, w, unnest(range(1, greatest(len(w) - 3, 1)::bigint)) as i from d where len(w) > 4)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from win) where c > 1),
cov as (select rid, sum(least(5, coalesce(nxt - i, 5)))::bigint as n from (select rid, i, lead(i) over (partition by rid order by i) as nxt from rep) group by rid),
m as (
  select d.doc_id, d.lang, len(w)::bigint as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(cov.n, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines,
    len(list_filter(w, lambda x: lower(x) in ({_STOPS})))::bigint as n_stop,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g'))::bigint as n_upper,
    len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*\x{{2022}}]')))::bigint as n_bullets,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})\s*$')))::bigint as n_ellipsis
  from d left join cov using (rid)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and n_words >= 10
   and coalesce(word_chars / nullif(n_words, 0), 0) between 2 and 15
   and coalesce(n_symbols / nullif(n_words, 0), 0) <= 0.20
   and (n_words < 30 or n_stop / n_words >= 0.03 or coalesce(lang not in ('en', 'de', 'fr', 'es'), true))
   and coalesce(n_upper / nullif(word_chars, 0), 0) <= 0.40
   and coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.30
   and coalesce(n_bullets / nullif(n_lines, 0), 0) <= 0.90
   and coalesce(n_ellipsis / nullif(n_lines, 0), 0) <= 0.30) as kept
from b
"""
