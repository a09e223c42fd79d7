"""Monotone sequences in Elias-Fano code, read straight from a buffer.

The low bits of each value are packed at a fixed width; the high bits are unary in a bit vector, a one for each value
after as many zeros as its high part says. Counts of ones before each 64-bit word make both selections a search of a
word and a look into it. All operations take arrays of queries.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = "<QQQQ"  # values, low bits, words of high bits, words of low bits
#: Place of the k-th one in a byte.
_PLACE = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], dtype=np.uint8)


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of each word."""
    u = np.uint64
    words, k = words.astype(u), k.astype(u)
    # ones of each byte and those before it, all bytes of a word at once
    upto = words - ((words >> u(1)) & u(0x5555555555555555))
    upto = (upto & u(0x3333333333333333)) + ((upto >> u(2)) & u(0x3333333333333333))
    upto = ((upto + (upto >> u(4))) & u(0x0F0F0F0F0F0F0F0F)) * u(0x0101010101010101)
    passed = ((k * u(0x0101010101010101)) | u(0x8080808080808080)) - upto
    shift = ((((passed >> u(7)) & u(0x0101010101010101)) * u(0x0101010101010101)) >> u(56)) << u(3)
    before = ((upto << u(8)) >> shift) & u(0xFF)
    return shift.astype(np.int64) + _PLACE[(words >> shift) & u(0xFF), k - before]


def encode(values: np.ndarray) -> bytes:
    """The code of ascending unsigned 64-bit values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return struct.pack(_HEAD, 0, 0, 0, 0)
    low = max(0, (int(values[-1]) // n).bit_length() - 1)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    n_words = int(high[-1]) // 64 + 1
    bits = np.zeros(64 * n_words, dtype=np.uint8)
    bits[high] = 1
    upper = np.packbits(bits, bitorder="little").view("<u8")
    ones = np.concatenate(([0], np.cumsum(bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)))).astype("<u4")
    lower = np.zeros(n * low // 64 + 2 if low else 0, dtype=np.uint64)
    if low:
        rest = values & np.uint64((1 << low) - 1)
        at = np.arange(n, dtype=np.uint64) * np.uint64(low)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        np.bitwise_or.at(lower, word, rest << shift)
        over = np.flatnonzero(shift.astype(np.int64) + low > 64)
        np.bitwise_or.at(lower, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
    head = struct.pack(_HEAD, n, low, n_words, len(lower))
    pad = b"\0" * (-(4 * len(ones)) % 8)
    return b"".join([head, upper.tobytes(), ones.tobytes(), pad, lower.astype("<u8").tobytes()])


class EliasFano:
    """A code of :func:`encode` in a buffer, from ``at`` on; ``end`` is where it stops."""

    def __init__(self, buffer, at: int = 0):
        self.n, low, n_words, n_lower = struct.unpack_from(_HEAD, buffer, at)
        self.low, at = low, at + struct.calcsize(_HEAD)
        self.upper = np.frombuffer(buffer, "<u8", n_words, at)
        at += 8 * n_words
        n_ones = n_words + 1 if self.n else 0
        self.ones = np.frombuffer(buffer, "<u4", n_ones, at)
        at += 4 * n_ones + (-(4 * n_ones) % 8)
        self.lower = np.frombuffer(buffer, "<u8", n_lower, at)
        self.end = at + 8 * n_lower

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(index), dtype=np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.low)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        found = self.lower[word] >> shift
        next_ = np.where(shift > 0, self.lower[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (found | next_) & np.uint64((1 << self.low) - 1)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = np.asarray(index, dtype=np.int64)
        word = np.searchsorted(self.ones, index, side="right") - 1
        place = 64 * word + _select_in_word(self.upper[word], index - self.ones[word].astype(np.int64))
        return ((place - index).astype(np.uint64) << np.uint64(self.low)) | self._low(index)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``high``: the ones before its first zero run."""
        zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones
        # the high-th zero, from 1, ends the values of high part high - 1
        if not zeros[-1]:
            return np.where(high <= 0, 0, self.n)
        k = np.clip(high - 1, 0, zeros[-1] - 1)
        word = np.searchsorted(zeros, k, side="right") - 1
        place = 64 * word + _select_in_word(~self.upper[word], k - zeros[word])
        return np.where(high <= 0, 0, np.where(high > zeros[-1], self.n, place - k))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value not below each ``x``; the number of values where there's none."""
        x = np.asarray(x, dtype=np.uint64)
        if not self.n:
            return np.zeros(len(x), dtype=np.int64)
        # a high part of more than all bits is beyond any value
        high = np.minimum(x >> np.uint64(self.low), np.uint64(64 * len(self.upper))).astype(np.int64)
        at, end = self._before(high), self._before(high + 1)
        rest = x & np.uint64((1 << self.low) - 1) if self.low else np.zeros(len(x), np.uint64)
        open_ = np.flatnonzero(at < end)
        while len(open_):  # halve the values that share the high part
            mid = (at[open_] + end[open_]) // 2
            below = self._low(mid) < rest[open_]
            at[open_] = np.where(below, mid + 1, at[open_])
            end[open_] = np.where(below, end[open_], mid)
            open_ = open_[at[open_] < end[open_]]
        return at
