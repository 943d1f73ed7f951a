"""Suffix sorting with hash comparisons, vectorised over many suffixes.

Prefix polynomial hashes (modulo 2^64, bytes mapped to odd random words) give the hash of any substring
in constant time.  The common extension of two suffixes is found by binary search on its length, so
one comparison takes a logarithmic number of hash tests.  ``suffix_order`` is a bottom-up mergesort: in each round every
element finds its place in the neighbouring run by binary search, all elements at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_WORDS = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Hashed:
    """Bytes with their prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data, n = data, len(data)
        p, self.inverse = powers(n)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_WORDS[data] * p[:n], out=self.prefix[1:])

    def grams(self, k: int) -> np.ndarray:
        """Mixed hash of every k-byte substring."""
        n = len(self.data) - k + 1
        return mixed((self.prefix[k:] - self.prefix[:n]) * self.inverse[:n])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def extension(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at a and b, ``limit`` at most."""
        done = np.zeros(len(a), np.int64)
        step = 1 << max(0, int(limit.max(initial=0)).bit_length() - 1)
        while step:
            to = done + step
            ok = to <= limit
            size = np.where(ok, to, 0)
            done = np.where(ok & (self.of(a, size) == self.of(b, size)), to, done)
            step >>= 1
        return done

    def before(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Does suffix a sort before suffix b, by ``depth`` bytes and then by place?"""
        n = len(self.data)
        limit = np.minimum(depth, n - np.maximum(a, b))
        ext = self.extension(a, b, limit)
        split = ext < limit
        x, y = self.data[np.minimum(a + ext, n - 1)], self.data[np.minimum(b + ext, n - 1)]
        return np.where(split, x < y, a < b)

    def suffix_order(self, starts: np.ndarray, depth: int) -> np.ndarray:
        """The suffixes sorted by their first ``depth`` bytes, ties by place."""
        order, width = starts.copy(), 1
        at = np.arange(len(order))
        while width < len(order):
            run = at // width
            sibling = run ^ 1
            lo = np.minimum(sibling * width, len(order))
            first, hi = lo.copy(), np.minimum(lo + width, len(order))
            while True:
                live = np.flatnonzero(lo < hi)
                if not len(live):
                    break
                mid = (lo[live] + hi[live]) >> 1
                less = self.before(order[mid], order[live], depth)
                lo[live] = np.where(less, mid + 1, lo[live])
                hi[live] = np.where(less, hi[live], mid)
            place = np.minimum(run, sibling) * width + (at - run * width) + (lo - first)
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, width * 2
        return order

    def same_bytes(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Collision check: are the substrings equal byte for byte?"""
        ok = np.ones(len(a), bool)
        at = 0
        while at < len(a):
            total = np.cumsum(length[at:])
            to = at + max(1, int(np.searchsorted(total, 1 << 22, "right")))
            size = length[at:to]
            inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            differ = self.data[np.repeat(a[at:to], size) + inner] != self.data[np.repeat(b[at:to], size) + inner]
            ok[at:to] = np.bincount(np.repeat(np.arange(to - at), size), differ, minlength=to - at) == 0
            at = to
        return ok


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[:-(width - size)], values[width - size:]) if size < width else values
