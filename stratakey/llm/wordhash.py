"""Stable 64-bit hashes of the words of many texts at once, in numpy.

A text is lower-cased (A-Z), cut into words at the bytes of a table, and each word hashed as a polynomial over random bytes
modulo 2**64, mixed at the end; the words of a whole batch take a few passes over its bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: What separates words: white space only, or every ASCII character but letters and digits.
NOT_SPACE = ~SPACE
ALNUM = np.ones(256, bool)
ALNUM[:48] = ALNUM[58:97] = ALNUM[123:128] = False


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = down = _powers(_P, 1)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_P, n), _powers(_P_INV, n)
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words(texts: Sequence[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and the number of words of each text."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    ends_of = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(raw), np.int64)
    low = _LOWER[data]
    inside = table[low]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _Powers.get(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[: len(data)], out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    n = np.diff(np.searchsorted(start, ends_of), prepend=0)
    return h, n


def grams(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """The hash of every k consecutive words; place i is that of words i to i + k - 1."""
    out = np.full(max(0, len(h) - k + 1), salt, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(_P) + h[j : len(h) - k + 1 + j])
    return out


def text_groups(texts: Sequence[str | None], size: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of texts of about `size` characters in all; a longer text is a range of its own."""
    out, first, n = [], 0, 0
    for i, t in enumerate(texts):
        k = len(t or "")
        if n and n + k > size:
            out.append((first, i))
            first, n = i, 0
        n += k
    return [*out, (first, len(texts))] if len(texts) else []
