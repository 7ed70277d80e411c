"""Words of whole texts as arrays of 64-bit hashes, and what is built on them."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

from triad.llm.common import mix

#: Odd multipliers for the places of a window.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                   0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


class Hashes(dict):
    """word -> 64-bit hash, remembered for ``most`` words and then begun anew."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def windows(w: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n``-word window."""
    m = len(w) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = w[:m] * PLACES[0]
    for i in range(1, n):
        out = out + w[i:i + m] * PLACES[i]
    return mix(out)


def shingle_set(w: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct windows; the whole sequence as one if it is shorter."""
    if 0 < len(w) < n:
        return windows(w, len(w)) ^ np.uint64(len(w))
    return np.unique(windows(w, n))
