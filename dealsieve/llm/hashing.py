"""Hashes of words and of word sequences, on arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from dealsieve.llm.common import ship_by_value

_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of hashes order at random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive hashes, joined from runs of 1, 2, 4, ... that cover ``n``."""
    total = max(len(hashes) - n + 1, 0)
    run, span, out, used = mixed(hashes + _ODD), 1, None, 0
    while used < n:
        if n & span:
            part = run[used:used + total]
            out = part if out is None else mixed(out[:total] * _ODD + part)
            used += span
        if used < n:
            run = mixed(run[:-span] * _ODD + run[span:]) if len(run) > span else run[:0]
            span *= 2
    return out[:total]


ship_by_value(__name__)
