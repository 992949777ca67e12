"""Vectorised hashing of words and word windows inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words whose hash a task keeps.
CACHED = 400_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _S)
    x = x * _M1
    x = x ^ (x >> _S)
    x = x * _M2
    return x ^ (x >> _S)


def split_words(text: str) -> list[bytes]:
    """Words between spaces, tabs, line feeds, vertical tabs, form feeds and returns."""
    return text.encode().split()


class Words:
    """Hashes of words, with a bounded cache."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        get, out = self.cache.get, []
        for w in words:
            h = get(w)
            if h is None:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                h = xxhash.xxh3_64_intdigest(w)
                if len(w) <= 64:
                    self.cache[w] = h
            out.append(h)
        return np.array(out, dtype=np.uint64)


class Rolling:
    """Polynomial hash of every window of ``k`` consecutive values, modulo 2**64, then mixed."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        def powers(b):
            a = np.full(n + 1, b, np.uint64)
            a[0] = 1
            return np.cumprod(a)
        self.up, self.down, self.n = powers(self.base), powers(self.inverse), n

    def __call__(self, values: np.ndarray, k: int) -> np.ndarray:
        n = len(values)
        if n < k:
            return np.zeros(0, np.uint64)
        if n > self.n:
            self._grow(max(n, min(2 * self.n, 1 << 17)))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=sums[1:])
        return mix((sums[k:] - sums[:n - k + 1]) * self.down[:n - k + 1])


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` consecutive values, by doubling."""
    out, w = values, 1
    while 2 * w <= width:
        out = pick(out[:-w], out[w:])
        w *= 2
    if w < width:
        d = width - w
        out = pick(out[:-d], out[d:])
    return out
