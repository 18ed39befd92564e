"""Word shingles of a text as 64-bit numbers, and their minhashes."""

from __future__ import annotations

import numpy as np
import xxhash

_MASK = (1 << 64) - 1
_MEMO_WORDS = 1_000_000


class _Words(dict):
    """Word to 64-bit hash, remembered; emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number (the finishing steps of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct ``width``-word shingles of a text, sorted.

    A-Z are lower-cased; words are split at ASCII white space. Fewer words than
    ``width`` make one shingle of them all; no words make an empty set.
    """
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    width, short = min(n, width), n < width
    factors = _odd(width, width)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out += h[k:n - width + 1 + k] * factors[k]
    return np.unique(_mixed(out + np.uint64(n if short else 0)))


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that equal sets share."""
    a = int(np.bitwise_xor.reduce(_mixed(shingles + np.uint64(11)))) if len(shingles) else 0
    b = int(_mixed(shingles ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)) + len(shingles)
    return _signed(a), _signed(b & _MASK)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class MinHasher:
    """``n`` minhashes of a set."""

    def __init__(self, n: int, seed: int = 5):
        self.a, self.b = _odd(seed, n), _odd(seed + 1, n)

    def __call__(self, shingles: np.ndarray, chunk: int = 8192) -> np.ndarray:
        low = np.full(len(self.a), _MASK, np.uint64)
        for i in range(0, len(shingles), chunk):
            part = shingles[i:i + chunk]
            np.minimum(low, (part[:, None] * self.a + self.b).min(axis=0), out=low)
        return low


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
