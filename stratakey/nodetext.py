"""A self-describing text notation for schemas, attributes and rows.

Scalars: 1, 1u, 1.5, %true, %false, %nan, %inf, %-inf, # (null), "text" with C escapes, or a bare word. Lists [a;b], maps
{k=v;k=v}; any value may be preceded by attributes <k=v>. A separator after the last element is allowed.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from typing import Any

TOKEN = re.compile(r"""\s*(?:(?P<punct>[\[\]{}<>=;])|(?P<quoted>"(?:[^"\\]|\\.)*")|(?P<flag>%[a-z-]+)|(?P<null>\#)|(?P<number>[+-]?\d[\w.+-]*)|(?P<word>[A-Za-z_][\w.\-/]*))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "0": "\0", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}
FLAGS = {"%true": True, "%false": False, "%nan": math.nan, "%inf": math.inf, "%-inf": -math.inf}


class NodeTextError(ValueError):
    pass


class Unsigned(int):
    """An integer written with the suffix u."""


@dataclass
class Attributed:
    value: Any
    attributes: dict[str, Any] = field(default_factory=dict)


def unquote(s: str) -> str:
    def one(m: re.Match) -> str:
        c = m[1]
        return chr(int(c[1:], 16)) if c[0] == "x" else ESCAPES.get(c, c)

    return re.sub(r"\\(x[0-9a-fA-F]{2}|.)", one, s, flags=re.S)


def tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        if not text[at:].strip():
            break
        m = TOKEN.match(text, at)
        if not m:
            raise NodeTextError(f"unexpected text at {at}: {text[at : at + 20]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Reader:
    def __init__(self, text: str):
        self.rest, self.at = tokens(text), 0

    def peek(self) -> tuple[str, str]:
        return self.rest[self.at] if self.at < len(self.rest) else ("end", "")

    def take(self, what: str | None = None) -> tuple[str, str]:
        t = self.peek()
        if t[0] == "end" or what is not None and t != ("punct", what):
            raise NodeTextError(f"expected {what or 'a value'}, found {t[1] or 'the end'}")
        self.at += 1
        return t

    def value(self) -> Any:
        kind, s = self.take()
        if (kind, s) == ("punct", "<"):
            attributes = self.pairs(">")
            return Attributed(self.value(), attributes)
        if (kind, s) == ("punct", "["):
            out = []
            while self.peek() != ("punct", "]"):
                out.append(self.value())
                if self.peek() != ("punct", "]"):
                    self.take(";")
            self.take("]")
            return out
        if (kind, s) == ("punct", "{"):
            return self.pairs("}")
        if kind == "quoted":
            return unquote(s[1:-1])
        if kind == "flag" and s in FLAGS:
            return FLAGS[s]
        if kind == "null":
            return None
        if kind == "number":
            return number(s)
        if kind == "word":
            return s
        raise NodeTextError(f"unexpected {s!r}")

    def pairs(self, end: str) -> dict[str, Any]:
        out = {}
        while self.peek() != ("punct", end):
            kind, s = self.take()
            if kind not in ("quoted", "word", "number"):
                raise NodeTextError(f"{s!r} is no key")
            key = unquote(s[1:-1]) if kind == "quoted" else s
            self.take("=")
            out[key] = self.value()
            if self.peek() != ("punct", end):
                self.take(";")
        self.take(end)
        return out


def number(s: str) -> Any:
    try:
        if s.endswith("u"):
            return Unsigned(s[:-1])
        return int(s) if re.fullmatch(r"[+-]?\d+", s) else float(s)
    except ValueError as e:
        raise NodeTextError(f"{s!r} is no number") from e


def parse(text: str) -> Any:
    """One value; a separator may follow it."""
    r = _Reader(text)
    out = r.value()
    if r.peek() == ("punct", ";"):
        r.take()
    if r.peek()[0] != "end":
        raise NodeTextError(f"{r.peek()[1]!r} follows the value")
    return out


def plain(node: Any) -> Any:
    """The value without attributes, all the way down."""
    if isinstance(node, Attributed):
        return plain(node.value)
    if isinstance(node, list):
        return [plain(x) for x in node]
    if isinstance(node, dict):
        return {k: plain(v) for k, v in node.items()}
    return node


def quote(s: str) -> str:
    named = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\t": "\\t", "\r": "\\r"}
    return '"' + "".join(named.get(c, c if c >= " " else f"\\x{ord(c):02x}") for c in s) + '"'


def dump(node: Any) -> str:
    if isinstance(node, Attributed):
        return "<" + "".join(f"{quote(k)}={dump(v)};" for k, v in node.attributes.items()) + ">" + dump(node.value)
    if node is None:
        return "#"
    if isinstance(node, bool):
        return "%true" if node else "%false"
    if isinstance(node, Unsigned):
        return f"{int(node)}u"
    if isinstance(node, int):
        return str(node)
    if isinstance(node, float):
        return "%nan" if math.isnan(node) else ("%inf" if node > 0 else "%-inf") if math.isinf(node) else repr(node)
    if isinstance(node, str):
        return quote(node)
    if isinstance(node, (list, tuple)):
        return "[" + ";".join(map(dump, node)) + "]"
    if isinstance(node, dict):
        return "{" + ";".join(f"{quote(str(k))}={dump(v)}" for k, v in node.items()) + "}"
    raise NodeTextError(f"no notation for {type(node).__name__}")
