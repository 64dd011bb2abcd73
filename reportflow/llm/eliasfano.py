"""Elias-Fano sequences and an n-gram trie made of them, in one flat buffer.

A non-decreasing sequence of n numbers below u keeps the low bits of each number
packed side by side and the high bits in unary, about 2 + log2(u / n) bits a
number.  All parts are views of one buffer, which may be any mapped memory.
"""

from __future__ import annotations

import mmap

import numpy as np


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits (at most 57) side by side in 64-bit words."""
    words = np.zeros((len(values) * width + 63) // 64 + 2, np.uint64)
    if width and len(values):
        bit = np.arange(len(values), dtype=np.int64) * width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        # Shares of a word do not overlap, so adding is the same as or-ing.
        np.add.at(words, word, values << shift)
        spill = shift + np.uint64(width) > 64
        np.add.at(words, word[spill] + 1, values[spill] >> (np.uint64(64) - shift[spill]))
    return words


class EliasFano:
    """Read access to a sequence inside ``words`` (see ``encode``)."""

    def __init__(self, words: np.ndarray):
        self.n, self.low_bits, low_words, high_bytes = (int(x) for x in words[:4])
        self._low = words[4:4 + low_words]
        bits = np.unpackbits(words[4 + low_words:].view(np.uint8)[:high_bytes], bitorder="little")
        # Directory: numbers before each value of the high part.
        zeros = np.flatnonzero(bits == 0)
        self._before = (zeros - np.arange(len(zeros))).astype(np.int64)
        self.size = 4 + low_words + (high_bytes + 7) // 8

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> np.ndarray:
        n = len(values)
        low_bits = max(0, min(57, (universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        low = _pack(values & np.uint64((1 << low_bits) - 1), low_bits)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        top = (universe >> low_bits) + 1
        bits = np.zeros(n + top + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(packed) + 7) // 8 * 8, np.uint8)
        padded[:len(packed)] = packed
        return np.concatenate([np.array([n, low_bits, len(low), len(packed)], np.uint64), low,
                               padded.view(np.uint64)])

    def _low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        x = self._low[word] >> shift
        carry = np.where(shift > 0, self._low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (x | carry) & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        high = np.searchsorted(self._before, i, side="right").astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low_at(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first number not below each x (n if there is none)."""
        x = x.astype(np.uint64)
        high = np.minimum((x >> np.uint64(self.low_bits)).astype(np.int64), len(self._before) - 1)
        lo = np.where(high > 0, self._before[np.maximum(high - 1, 0)], 0)
        hi = self._before[high]
        want = x & np.uint64((1 << self.low_bits) - 1)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low_at(mid) < want[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each x, or -1."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at = self.successor(x)
        inside = np.minimum(at, self.n - 1)
        return np.where((at < self.n) & (self.access(inside) == x.astype(np.uint64)), at, -1)


class Trie:
    """Two levels: contexts, and under each context its successors with a code.

    ``keys`` hold a context in the upper 32 bits and a successor in the lower.
    Successors are stored relative to their context (its number times 2**32 plus
    the successor), which makes the whole level non-decreasing; pointers give
    where a context's successors begin.
    """

    def __init__(self, words: np.ndarray):
        parts, at = [], 1
        for _ in range(3):
            parts.append(EliasFano(words[at:]))
            at += parts[-1].size
        self.contexts, self.pointers, self.successors = parts
        self.codes = words[at:].view(np.uint16)[:self.successors.n]

    @staticmethod
    def build(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Flat words of the trie of sorted distinct keys."""
        context = keys >> np.uint64(32)
        fresh = np.ones(len(keys), bool)
        fresh[1:] = context[1:] != context[:-1]
        first = np.flatnonzero(fresh)
        number = (np.cumsum(fresh) - 1).astype(np.uint64)
        relative = (number << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        padded = np.zeros((len(codes) + 3) // 4 * 4, np.uint16)
        padded[:len(codes)] = codes
        parts = [EliasFano.encode(context[first], 1 << 32),
                 EliasFano.encode(np.append(first, len(keys)), len(keys) + 1),
                 EliasFano.encode(relative, max(len(first), 1) << 32), padded.view(np.uint64)]
        return np.concatenate([np.array([len(keys)], np.uint64), *parts])

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Code of each key, 0 where it is not in the trie."""
        out = np.zeros(len(keys), np.uint16)
        context = self.contexts.find(keys >> np.uint64(32))
        known = np.flatnonzero(context >= 0)
        if not len(known):
            return out
        c = context[known]
        begin, end = self.pointers.access(c).astype(np.int64), self.pointers.access(c + 1).astype(np.int64)
        want = (c.astype(np.uint64) << np.uint64(32)) | (keys[known] & np.uint64(0xFFFFFFFF))
        at = self.successors.successor(want)
        inside = (at >= begin) & (at < end)
        at = np.where(inside, at, begin)
        hit = inside & (self.successors.access(at) == want)
        out[known[hit]] = self.codes[at[hit]]
        return out


def mapped(words: np.ndarray) -> np.ndarray:
    """The words in mapped memory, outside the Python heap."""
    raw = words.tobytes()
    area = mmap.mmap(-1, max(len(raw), 8))
    area.write(raw)
    return np.frombuffer(area, np.uint64, len(words))
