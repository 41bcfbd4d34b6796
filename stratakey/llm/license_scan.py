"""License scans: notice phrases and identifier tags found by Aho-Corasick, license expressions read by a shunting-yard parser.

One automaton finds all phrases at once in the text's words (A-Z lower-cased, one space between them), another the tags before
license expressions in the text as it is. The expression after a tag is parsed with the precedence with > and > or and evaluated to its
licenses and to what it asks of a user, its obligation: `and` takes the greater of both sides, `or` the lesser, and an exception
(`with`) makes strong copyleft weak. A text's score is the greatest obligation of all its notices, 0 without any.

A text is one row's work and nothing is shuffled. Defined cases: a null text counts as an empty one, which has no words and no notices; a very
long text is scanned in one task in time and memory linear in its length; repeated rows give repeated results; an expression ends with
its line or where it can't go on, an operator without a right side is left out, a bracket that is never closed ends with the
expression; an unknown identifier counts only after an SPDX tag; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import Any

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, trim

# Phrases that count as base notices.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "isc license": "isc",
    "zlib license": "zlib",
    "cc0 1 0": "cc0",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
FREE, NOTICE, CREDIT, UNKNOWN, WEAK, STRONG, CLOSED = 0.1, 0.25, 0.4, 0.5, 0.6, 0.9, 1.0
OBLIGATION = {
    **dict.fromkeys(("cc0", "unlicense"), FREE),
    **dict.fromkeys(("mit", "bsd", "isc", "zlib", "apache", "bsl"), NOTICE),
    "cc-by": CREDIT,
    **dict.fromkeys(("lgpl", "mpl", "epl"), WEAK),
    **dict.fromkeys(("gpl", "agpl", "cc-by-sa"), STRONG),
    **dict.fromkeys(("cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd", "all-rights-reserved"), CLOSED),
}
# The start of an SPDX identifier and its label; the longest that fits decides.
IDENTIFIERS = {"mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "mpl": "mpl", "epl": "epl", "bsl": "bsl", "zlib": "zlib", "unlicense": "unlicense", "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd"}
#: Tags before an expression, and whether an identifier that isn't known counts after them.
TAGS = {"spdx-license-identifier:": True, "license-expression:": True, '"license":': False, "license:": False}
RANK = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[ \t\"']*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SPACES = re.compile(rb" {2,}")
SCAN = "struct<n_words: bigint, places: array<struct<word: bigint, label: string, base: boolean>>, expressions: array<struct<at: bigint, text: string, labels: array<string>, obligation: double>>>"


def spaced(text: str) -> str:
    """The words of a text, lower-cased, each between two spaces."""
    return _SPACES.sub(b" ", b" " + text.encode().translate(_WORD) + b" ").decode()


@cache
def automata() -> tuple[Any, Any]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for p, label in {**PHRASES, **BASE}.items():
        phrases.add_word(f" {p} ", (len(p) + 2, label, p in BASE))
    for tag, lax in TAGS.items():
        tags.add_word(tag, (len(tag), lax))
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def places(words: str) -> list[tuple[int, str, bool]]:
    """(number of the first word, label, base) of every place of a phrase in spaced words, in order."""
    found = sorted((end - n + 1, label, base) for end, (n, label, base) in automata()[0].iter(words))
    out, at, word = [], 0, 0
    for start, label, base in found:
        word += words.count(" ", at, start)
        at = start
        out.append((word, label, base))
    return out


def license_of(identifier: str) -> str | None:
    """The label of an SPDX identifier with or without a version."""
    parts = identifier.rstrip("+").split("-")
    return next((IDENTIFIERS[head] for i in range(len(parts), 0, -1) if (head := "-".join(parts[:i])) in IDENTIFIERS), None)


def applied(op: str, a: tuple[set, float], b: tuple[set, float]) -> tuple[set, float]:
    """The value of an operator; the smaller set goes into the larger one, so long expressions cost little more than their length."""
    small, large = sorted((a[0], b[0]), key=len)
    large |= small
    if op == "with":
        return large, WEAK if a[1] == STRONG else a[1]
    return large, (max if op == "and" else min)(a[1], b[1])


def read_expression(text: str, at: int, lax: bool) -> tuple[int, list[str], float] | None:
    """The license expression at a place: its end, labels and obligation; None if none stands there."""
    values: list[tuple[set, float]] = []
    ops: list[str] = []
    operand, end = True, at

    def reduce_top() -> None:
        b, a = values.pop(), values.pop()
        values.append(applied(ops.pop(), a, b))

    while m := TOKEN.match(text, end):
        bracket, word = m[1], (m[2] or "").lower().rstrip(".:")
        if operand and bracket == "(":
            ops.append("(")
        elif not operand and bracket == ")":
            if "(" not in ops:
                break
            while ops[-1] != "(":
                reduce_top()
            ops.pop()
        elif not operand and word in RANK:
            while ops and RANK.get(ops[-1], 0) >= RANK[word]:
                reduce_top()
            ops.append(word)
            operand = True
        elif operand and word and word not in RANK:
            label = None if ops and ops[-1] == "with" else license_of(word)
            if label is None and not lax and not (ops and ops[-1] == "with"):
                break
            values.append(({label or word}, OBLIGATION[label] if label else UNKNOWN))
            operand = False
        else:
            break
        end = m.end()
    while operand and ops:  # an operator, or a bracket, without what should follow
        operand = ops.pop() == "("
    while ops:
        if ops[-1] == "(":
            ops.pop()
        else:
            reduce_top()
    return (end, sorted(values[0][0]), values[0][1]) if values else None


def expressions(text: str) -> list[tuple[int, str, list[str], float]]:
    """(place of the tag, expression, labels, obligation) of every expression after a tag; a tag inside an expression opens none."""
    low, out, read = text.encode().lower().decode(), [], 0  # A-Z only, so places stay
    for last, (n, lax) in automata()[1].iter(low):
        start = last - n + 1
        if start < read or (start and low[start].isalpha() and low[start - 1].isalnum()):
            continue
        if found := read_expression(text, last + 1, lax):
            read = found[0]
            out.append((start, text[last + 1 : read].strip(" \t\"'"), found[1], found[2]))
    return out


def scan_text(text: str | None) -> dict[str, Any]:
    words = spaced(text or "")
    n = words.count(" ") - 1 if words != " " else 0
    return {
        "n_words": n,
        "places": [dict(zip(("word", "label", "base"), p)) for p in places(words)],
        "expressions": [dict(zip(("at", "text", "labels", "obligation"), e)) for e in expressions(text or "")],
    }


_TYPE = pa.struct([
    ("n_words", pa.int64()),
    ("places", pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))),
    ("expressions", pa.list_(pa.struct([("at", pa.int64()), ("text", pa.string()), ("labels", pa.list_(pa.string())), ("obligation", pa.float64())]))),
])


def scan(text: Column) -> Column:
    """A struct (SCAN) of a text: its words' number, the places of phrases and the expressions after tags."""

    @F.arrow_udf(SCAN)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([scan_text(t.as_py()) for t in texts], _TYPE)
        trim()

    return run(text)


def labels(found: Column) -> Column:
    """All labels of a scan, each once, in order."""
    return F.array_sort(F.array_distinct(F.concat(found["places"]["label"], F.flatten(found["expressions"]["labels"]))))


def score(found: Column) -> Column:
    """The greatest obligation of a scan's notices, 0 without any."""
    of = F.create_map(*[F.lit(x) for pair in OBLIGATION.items() for x in pair])
    return F.coalesce(F.array_max(F.concat(F.transform(found["places"]["label"], lambda label: of[label]), found["expressions"]["obligation"])), F.lit(0.0))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", scan(F.col("text")).alias("found"))
    base = F.filter("found.places", lambda p: p["base"])
    found = found.select("doc_id", "found", base.alias("base"))
    f, b = F.col("found"), F.col("base")
    return found.select(
        "doc_id", f["n_words"].alias("n_words"), F.size(b).cast("long").alias("n_base"), F.array_min(b["word"]).alias("first_word"), F.array_max(b["word"]).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(b["label"])), ",").alias("base_labels"), F.array_join(labels(f), ",").alias("labels"), score(f).alias("score"),
    )
