"""Versions and sizes in plain Python, for launchers."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable


def memory_bytes(size: str | int) -> int:
    """4G, 512M, 10KB, 7B or bytes."""
    if isinstance(size, int):
        return size
    m = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]*)\s*", size)
    factor = {"": 0, "b": 0, "bb": 0, "k": 1, "kb": 1, "m": 2, "mb": 2, "g": 3, "gb": 3}.get(m[2].lower()) if m else None
    if factor is None:
        raise ValueError(f"{size!r} is no memory size")
    return int(m[1]) * 1024**factor


@functools.total_ordering
class Version:
    """A semantic version; one without a pre-release sorts after those with one."""

    def __init__(self, text: str):
        m = re.fullmatch(r"\s*v?(\d+)\.(\d+)\.(\d+)(?:-([0-9A-Za-z.-]+))?(?:\+([0-9A-Za-z.-]+))?\s*", text)
        if not m:
            raise ValueError(f"{text!r} is no semantic version")
        parts = tuple((p.isdigit() is False, int(p) if p.isdigit() else 0, p) for p in (m[4] or "").split(".") if p)
        self.text, self.order = text.strip(), (tuple(map(int, m.groups()[:3])), m[4] is None, parts, m[5] or "")

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Version) and self.order == other.order

    def __lt__(self, other: Version) -> bool:
        return self.order < other.order

    def __hash__(self) -> int:
        return hash(self.order)

    def __repr__(self) -> str:
        return f"Version({self.text!r})"


def split_artifact(file_name: str) -> tuple[str, str]:
    """(base name, version): the version begins at the first part after a dash that has a dot."""
    stem = re.sub(r"\.(?:jar|whl|zip)$", "", file_name.rsplit("/", 1)[-1])
    parts = stem.split("-")
    for i in range(1, len(parts)):
        if "." in parts[i]:
            return "-".join(parts[:i]), "-".join(parts[i:])
    raise ValueError(f"{file_name!r} names no version")


UNKNOWN = "0.0.0-UNKNOWN"


def version_of(text: str) -> Version:
    """The version, or one below all others where the text is none."""
    try:
        return Version(text)
    except ValueError:
        return Version(UNKNOWN)


def latest(paths: Iterable[str]) -> dict[str, str]:
    """The path with the greatest version of each base name."""
    best: dict[str, tuple[Version, str]] = {}
    for p in paths:
        base, version = split_artifact(p)
        v = version_of(version)
        if base not in best or best[base][0] < v:
            best[base] = (v, p)
    return {b: p for b, (_, p) in best.items()}
