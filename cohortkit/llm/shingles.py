"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15)
CACHE_WORDS = 200_000


class Shingler:
    """Distinct shingles of ``width`` words as sorted 64-bit hashes.

    Words are runs without ASCII white space, A-Z lower-cased.  A text with
    fewer words has its whole sequence as one shingle; without words, none.
    """

    def __init__(self, width: int = 5):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, np.int64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        codes = np.array([known[w] for w in words], np.uint64)
        size = min(self.width, len(codes))
        rolled = codes[:len(codes) - size + 1].copy()
        for i in range(1, size):
            rolled = rolled * _BASE + codes[i:len(codes) - size + 1 + i]
        rolled += np.uint64(size)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            rolled = (rolled ^ (rolled >> np.uint64(shift))) * np.uint64(factor)
        rolled ^= rolled >> np.uint64(31)
        return np.unique(rolled.view(np.int64))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
