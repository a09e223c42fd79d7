"""An FM-index over word sequences: a wavelet matrix of the Burrows-Wheeler transform, and sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every so many words of a piece, its position is kept.
SAMPLED = 16


class Bits:
    """A bit vector with ranks: 64-bit words, and the ones before each."""

    def __init__(self, words: np.ndarray):
        self.words = words
        counts = np.bitwise_count(words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

    @staticmethod
    def packed(bits: np.ndarray) -> np.ndarray:
        """Bits as 64-bit words, with one word to spare, so that the end has a word too."""
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        flat = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(flat)] = flat
        return words

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def suffix_array(keys: np.ndarray) -> np.ndarray:
    """The places of ``keys`` by what follows from them on, by prefix doubling; keys that end a piece occur once each."""
    n = len(keys)
    bits = max(1, int(keys.max()).bit_length())
    width = max(1, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    for k in range(width):
        key <<= bits
        key[: n - k] |= keys[k:]
    order = np.argsort(key)
    key = key[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))
    open_ = ~(fresh & np.append(fresh[1:], True))
    slots, length = slots[open_], width
    while len(slots):  # only places that share their rank are sorted again
        places = order[slots]
        # a place ``length`` further exists: a piece's end is unique, so no shared prefix reaches it
        key = (rank[places] << 32) | rank[np.minimum(places + length, n - 1)]
        by = np.argsort(key)
        key, places = key[by], places[by]
        order[slots] = places
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[places] = np.maximum.accumulate(np.where(fresh, slots, 0))
        slots = slots[~(fresh & np.append(fresh[1:], True))]
        length *= 2
    return order


class FmIndex:
    """Pieces of word ids (from 1), searched and located together; symbol 0 separates them."""

    def __init__(self, counts: np.ndarray, levels: list[np.ndarray], marks: np.ndarray, samples: np.ndarray):
        self.counts, self.samples = counts, samples
        self.levels = [Bits(x) for x in levels]
        self.marks = Bits(marks)
        n, symbols, depth = int(counts.sum()), len(counts), len(levels)
        self.zeros = [n - int(b.before[-1]) for b in self.levels]
        self.smaller = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        # the lowest level holds equal symbols together, in the order of their bits read backwards
        backwards, rest = np.zeros(symbols, dtype=np.int64), np.arange(symbols)
        for _ in range(depth):
            backwards, rest = backwards << 1 | (rest & 1), rest >> 1
        by = np.argsort(backwards)
        self.first = np.empty(symbols, dtype=np.int64)
        self.first[by] = np.concatenate([[0], np.cumsum(counts[by])[:-1]])

    @classmethod
    def build(cls, pieces: list[np.ndarray], symbols: int) -> tuple[FmIndex, np.ndarray]:
        """The index of at least one piece, and the places where the pieces start; ``symbols`` is the largest id plus 1."""
        sizes = np.array([len(p) for p in pieces])
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        n = int(sizes.sum()) + len(pieces)
        text = np.zeros(n, dtype=np.int32)
        for start, piece in zip(starts.tolist(), pieces, strict=True):
            text[start : start + len(piece)] = piece
        ends = starts + sizes
        keys = text.astype(np.int64) + len(pieces) - 1
        keys[ends] = np.arange(len(pieces))  # every end differs, so that no order depends on the next piece
        order = suffix_array(keys)
        current = text[order - 1]  # before the first place stands the last end
        counts = np.bincount(text, minlength=symbols).astype(np.int32)
        within = np.arange(n) - np.repeat(starts, sizes + 1)
        marked = (within % SAMPLED == 0)[order]
        levels = []
        for bit in reversed(range(max(1, (symbols - 1).bit_length()))):
            ones = (current >> bit & 1).astype(bool)
            levels.append(Bits.packed(ones))
            current = np.concatenate([current[~ones], current[ones]])
        return cls(counts, levels, Bits.packed(marked), order[marked].astype(np.int32)), starts

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Rows of ``symbol`` before ``at``, from all smaller symbols' rows on."""
        for k, level in enumerate(self.levels):
            ones = level.rank(at)
            at = np.where(symbol >> (len(self.levels) - 1 - k) & 1, self.zeros[k] + ones, at - ones)
        return at - self.first[symbol] + self.smaller[symbol]

    def search(self, reversed_phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and the row behind the last of each phrase: rows of ids, last word first, padded with 0."""
        total = int(self.counts.sum())
        low = np.zeros(len(reversed_phrases), dtype=np.int64)
        high = np.full(len(reversed_phrases), total, dtype=np.int64)
        live = np.arange(len(reversed_phrases))
        for k in range(reversed_phrases.shape[1]):
            live = live[reversed_phrases[live, k] > 0]
            if not len(live):
                break
            symbol = reversed_phrases[live, k]
            both = self._down(np.concatenate([low[live], high[live]]), np.concatenate([symbol, symbol]))
            low[live], high[live] = both[: len(live)], both[len(live) :]
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place of each row: back to the next sampled one, word by word."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        live = np.flatnonzero(~self.marks.get(at))
        while len(live):
            here, symbol = at[live], np.zeros(len(live), dtype=np.int64)
            for level, zeros in zip(self.levels, self.zeros, strict=True):
                one, ones = level.get(here), level.rank(here)
                here = np.where(one, zeros + ones, here - ones)
                symbol = symbol << 1 | one
            at[live] = here - self.first[symbol] + self.smaller[symbol]
            steps[live] += 1
            live = live[~self.marks.get(at[live])]
        return self.samples[self.marks.rank(at)] + steps

    def parts(self) -> dict[str, bytes]:
        return {
            "counts": self.counts.tobytes(), "levels": np.concatenate([b.words for b in self.levels]).tobytes(),
            "marks": self.marks.words.tobytes(), "samples": self.samples.tobytes(),
        }

    @classmethod
    def load(cls, counts: bytes, levels: bytes, marks: bytes, samples: bytes) -> FmIndex:
        marked = np.frombuffer(marks, np.uint64)
        return cls(np.frombuffer(counts, np.int32), list(np.frombuffer(levels, np.uint64).reshape(-1, len(marked))), marked, np.frombuffer(samples, np.int32))
