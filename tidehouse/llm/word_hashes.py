"""64-bit hashes of words and of runs of words, in numpy.

Two different runs get one hash with a chance of about 2**-64; results that rest on equal hashes say so.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words a worker remembers.
REMEMBERED = 500_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """The hash of a word, remembered; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of ``length`` words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for k in range(1, length):
        total *= _FACTOR
        total += words[k:k + n]
    return mix(total)
