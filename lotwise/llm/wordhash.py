"""64-bit hashes of words and of word sequences, as numpy arrays; equal on every executor."""

from __future__ import annotations

import numpy as np
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """Hashes of the words of a text; words seen before are remembered, up to a bound."""

    def __init__(self, most: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence where it is shorter."""
    n = len(words)
    if not n:
        return words
    take = min(size, n)
    h = np.full(n - take + 1, np.uint64(take))
    for k in range(take):
        h = h * BASE + words[k:n - take + 1 + k]
    return np.unique(mix(h))
