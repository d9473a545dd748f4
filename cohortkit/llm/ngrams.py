"""Hashed character n-grams of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def code_points(text: bytes | str | None) -> np.ndarray:
    """Lower-cased code points as uint64."""
    if not text:
        return np.empty(0, np.uint64)
    if isinstance(text, bytes):
        text = text.decode("utf-8", "replace")
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def buckets(codes: np.ndarray, orders: tuple[int, ...], bits: int):
    """For each order n, the bucket (0 to 2**bits - 1) of every n-gram, repeats included."""
    rolling = np.zeros(len(codes) + 1, np.uint64)
    shift = np.uint64(64 - bits)
    for n in range(1, max(orders) + 1):
        if len(codes) < n:
            return
        rolling = rolling[:-1] * _BASE + codes[n - 1:] + np.uint64(n)
        if n in orders:
            yield n, (((rolling ^ (rolling >> np.uint64(31))) * _MULTIPLIER) >> shift).astype(np.int64)


def present(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Distinct buckets of all orders, ascending."""
    parts = [b for _, b in buckets(codes, orders, bits)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)
