"""Hashes of words, mixed and joined with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers; any would do.
MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values, one to one."""
    values = (values ^ (values >> np.uint64(30))) * MIX[0]
    values = (values ^ (values >> np.uint64(27))) * MIX[1]
    return values ^ (values >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word; words are what ASCII white space separates."""
    # Hashing a word again is faster than looking it up among very many.
    return np.fromiter(map(xxhash.xxh3_64_intdigest, text.encode().split()), dtype=np.uint64)


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Ascending distinct hashes of all runs of ``size`` words; a shorter text is one run, an empty one none."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    runs = len(words) - size + 1
    joined = words[:runs]
    with np.errstate(over="ignore"):
        for step in range(1, size):
            joined = mixed(joined * np.uint64(3) + words[step : step + runs])
    return np.unique(joined)
