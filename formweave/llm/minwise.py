"""Minwise signatures: universal hash permutations over shingle hashes."""

from __future__ import annotations

import numpy as np


def permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` universal hash functions."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    """The minimum of every permutation over all ``values`` (upper 32 bits of
    ``a * x + b`` modulo 2**64); all ones for the empty set.  Blocks bound
    the memory for very long texts."""
    out = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(values), block):
        x = values[at:at + block]
        out = np.minimum(out, ((a[:, None] * x[None, :] + b[:, None]) >> np.uint64(32)).min(axis=1))
    return out.astype(np.uint32)


def signatures(items: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """``signature`` of several sets, one behind the other (set i is
    ``items[offsets[i]:offsets[i + 1]]``), a few sets at a time."""
    out = np.full((len(offsets) - 1, len(a)), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    begin = offsets[full]
    at = 0
    while at < len(full):
        end = max(at + 1, int(np.searchsorted(begin, begin[at] + block)))
        x = items[begin[at]:offsets[full[end - 1] + 1]]
        y = np.empty_like(x)
        for j in range(len(a)):
            np.multiply(x, a[j], out=y)
            y += b[j]
            out[full[at:end], j] = np.minimum.reduceat(y, begin[at:end] - begin[at]) >> np.uint64(32)
        at = end
    return out
