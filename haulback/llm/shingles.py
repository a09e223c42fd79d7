"""Word shingles as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Word hashes remembered by one Python worker.
KEPT_WORDS = 100_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words: runs without ASCII white space, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words, sorted; fewer words are one shingle, none make an empty set."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(size, len(words))
    found = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        found = found * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - width + 1 + k]
    return np.unique(mixed(found))
