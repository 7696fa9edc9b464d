"""FM-index of one shard's symbols: suffix order, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text that ends in its only 0, by prefix doubling.

    The first sort compares as many symbols as fit in 62 bits. Each later round
    doubles the depth and sorts only the suffixes that still tie.
    """
    n, bits = len(text), max(1, int(text.max()).bit_length())
    depth = max(1, min(62 // bits, n))
    key = np.zeros(n, dtype=np.int64)
    for ahead in range(depth):
        key <<= bits
        key[: n - ahead] |= text[ahead:]
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(n, dtype=np.int64)
    slots = np.arange(n)
    while True:
        opens = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        counts = np.diff(np.append(opens, len(slots)))
        rank[order[slots]] = np.repeat(slots[opens], counts)
        slots = slots[np.repeat(counts > 1, counts)]
        if not len(slots):
            return order
        tied = order[slots]
        key = rank[tied] * n + rank[tied + depth]
        by = np.argsort(key)
        key, order[slots] = key[by], tied[by]
        depth *= 2


class Bits:
    """A bit vector with constant-time counts of ones before a place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        whole = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        whole[: len(packed)] = packed
        self.words = whole.view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, low = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << low) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Finds all occurrences of many short patterns in one sequence of symbols >= 1."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = 16):
        """``size`` is one more than the greatest symbol that text or patterns hold."""
        text = np.append(symbols, 0).astype(np.int64)
        order = suffix_order(text)
        last = text[order - 1]
        self.n = len(text)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, (size - 1).bit_length()) - 1, -1, -1):
            ones = (last >> shift) & 1 != 0
            self.levels.append((shift, Bits(ones), self.n - int(ones.sum())))
            last = np.concatenate((last[~ones], last[ones]))
        marked = order % sample == 0
        self.marks, self.sampled = Bits(marked), order[marked]
        symbol = np.arange(size)
        self.base = self._down(symbol, np.zeros(size, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where place ``at`` of the last column comes out at the bottom of the symbol's path."""
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> shift) & 1 != 0, zeros + ones, at - ones)
        return at

    def _before(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """First row of the symbol plus its count in the last column before ``at``."""
        return self.first[symbol] + self._down(symbol, at) - self.base[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all rows of ``patterns``: those found, and their row ranges."""
        alive = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, column]
            low, high = self._before(symbol, low), self._before(symbol, high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back through the text to a sampled position."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            hit = self.marks.get(rows)
            found[open_[hit]] = self.sampled[self.marks.ones(rows[hit])] + steps
            open_, rows = open_[~hit], rows[~hit]
            symbol, at = np.zeros(len(rows), dtype=np.int64), rows
            for shift, bits, zeros in self.levels:
                one, ones = bits.get(at), bits.ones(at)
                symbol |= one.astype(np.int64) << shift
                at = np.where(one, zeros + ones, at - ones)
            rows = self.first[symbol] + at - self.base[symbol]
            steps += 1
        return found
