"""Elias-Fano coding of monotone integers, and a two-level n-gram trie built from it.

All arrays are written to one file and memory-mapped; look-ups are vectorised
over many queries.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

# Log-probabilities are kept as 16-bit codes: 0 is "absent", code k stands for 10 ** -((k - 1) * STEP).
STEP = 13 / 65534


def select_in_byte() -> np.ndarray:
    """[byte, k] is the place of the byte's k-th set bit (8: none)."""
    table = np.full((256, 8), 8, np.uint8)
    for byte in range(256):
        places = [i for i in range(8) if byte >> i & 1]
        table[byte, : len(places)] = places
    return table


_PLACES = select_in_byte()


class Bits:
    """Bit vector with select for ones and zeros through a count per 64-bit word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = {1: np.cumsum(ones) - ones, 0: np.cumsum(64 - ones) - (64 - ones)}

    def select(self, rank: np.ndarray, bit: int) -> np.ndarray:
        """Positions of the rank-th bits of a kind, from 0."""
        before = self.before[bit]
        at = np.searchsorted(before, rank, side="right") - 1
        word = np.ascontiguousarray(self.words[at])
        octets = (word if bit else ~word).view(np.uint8).reshape(-1, 8)
        sums = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.int64)
        left = rank - before[at]
        octet = (sums <= left[:, None]).sum(axis=1)
        row = np.arange(len(rank))
        left -= np.where(octet > 0, sums[row, octet - 1], 0)
        return at * 64 + octet * 8 + _PLACES[octets[row, octet], left]


class EliasFano:
    """Non-decreasing integers in about 2 + log2(universe / n) bits each."""

    def __init__(self, values: np.ndarray, universe: int, store) -> None:
        values = values.astype(np.uint64)
        self.n = n = len(values)
        self.low_bits = low = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        self.buckets = (universe >> low) + 1
        positions = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(n + self.buckets + 1) // 64) * 64, np.uint8)
        bits[positions] = 1
        self.high = Bits(store(np.packbits(bits, bitorder="little").view(np.uint64)))
        parts = []
        for at in range(0, n, 1 << 16):  # a multiple of 8, so every part ends on a whole byte
            part = np.ascontiguousarray(values[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
            parts.append(np.packbits(np.unpackbits(part, axis=1, bitorder="little")[:, :low].ravel(), bitorder="little"))
        self.low = store(np.concatenate([*parts, np.zeros(16, np.uint8)]))

    def lows(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low_bits
        octets = self.low[(bit >> 3)[:, None] + np.arange(8)]
        words = np.ascontiguousarray(octets).view(np.uint64).ravel() >> (bit & 7).astype(np.uint64)
        return words & np.uint64((1 << self.low_bits) - 1)

    def access(self, at: np.ndarray) -> np.ndarray:
        high = (self.high.select(at, 1) - at).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | self.lows(at)).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value by successor search among those with its high part, -1 if absent."""
        high = (values >> self.low_bits).astype(np.int64)
        low = values.astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        inside = high < self.buckets
        high = np.where(inside, high, 0)
        begin = np.where(high > 0, self.high.select(np.maximum(high - 1, 0), 0) - (high - 1), 0)
        end = self.high.select(high, 0) - high
        a, b = begin.copy(), end.copy()
        while True:
            todo = np.nonzero(a < b)[0]
            if not len(todo):
                break
            mid = (a[todo] + b[todo]) >> 1
            less = self.lows(mid) < low[todo]
            a[todo] = np.where(less, mid + 1, a[todo])
            b[todo] = np.where(less, b[todo], mid)
        found = np.full(len(values), -1, np.int64)
        has = np.nonzero((a < end) & inside)[0]
        has = has[self.lows(a[has]) == low[has]]
        found[has] = a[has]
        return found


class Trie:
    """Contexts, the words that followed them, and the discounted probabilities of these.

    ``context`` and ``word`` are sorted by both, each pair once; ``share`` is its
    probability. A word is found by successor search relative to its context.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, share: np.ndarray):
        self._folder = tempfile.TemporaryDirectory()
        self._files = 0
        contexts, first = np.unique(context, return_index=True)
        self.span = int(word.max(initial=0)) + 1
        rank = np.repeat(np.arange(len(contexts)), np.diff([*first, len(context)]))
        self.contexts = EliasFano(contexts, int(contexts.max(initial=0)) + 1, self._store)
        self.pointers = EliasFano(np.append(first, len(context)), len(context) + 1, self._store)
        self.words = EliasFano(rank * self.span + word, len(contexts) * self.span + 1, self._store)
        codes = 1 + np.clip(np.rint(-np.log10(share) / STEP), 0, 65534)
        self.codes = self._store(codes.astype(np.uint16))

    def _store(self, array: np.ndarray) -> np.ndarray:
        if not len(array):
            return array
        path = os.path.join(self._folder.name, str(self._files))
        self._files += 1
        array.tofile(path)
        return np.memmap(path, array.dtype, "r")

    def close(self) -> None:
        self._folder.cleanup()

    def query(self, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(code of each word, number of followers of each context); words stand in groups by context."""
        rank = self.contexts.find(contexts)
        known = rank >= 0
        followers = np.zeros(len(contexts), np.int64)
        followers[known] = self.pointers.access(rank[known] + 1) - self.pointers.access(rank[known])
        of = np.repeat(rank, sizes)
        codes = np.zeros(len(words), np.uint16)
        ask = np.nonzero((of >= 0) & (words < self.span))[0]
        at = self.words.find(of[ask] * self.span + words[ask])
        codes[ask[at >= 0]] = self.codes[at[at >= 0]]
        return codes, followers


def share_of(codes: np.ndarray) -> np.ndarray:
    """Probabilities behind codes."""
    return np.where(codes == 0, 0.0, 10.0 ** (-(codes.astype(float) - 1) * STEP))
