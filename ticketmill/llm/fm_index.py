"""A compressed full-text index of symbol sequences: backward search over a wavelet matrix.

The index holds the Burrows-Wheeler transform of its sequences, sorted by the first `ORDER` symbols,
which is enough for patterns up to that length. The transform is kept as a wavelet matrix of packed
bits with one count for every 64 of them. Many sequences are streamed past the index at once, one
symbol of each in every step.
"""

from __future__ import annotations

import numpy as np

ORDER = 16
SEPARATOR = 0


class Bits:
    """Packed bits that count the ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Counts any symbol before any place of a sequence, one bit of the symbol a level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for level in reversed(range(max(int(n_symbols - 1).bit_length(), 1))):
            ones = (symbols >> level & 1).astype(bool)
            self.levels.append((level, Bits(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(n_symbols)
        self.first = self._walk(every, np.zeros(n_symbols, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol[i] occurs before place at[i]."""
        return self._walk(symbol, at) - self.first[symbol]


def sorted_by_prefix(symbols: np.ndarray) -> np.ndarray:
    """Places of the sequence in the order of the `ORDER` symbols that begin there."""
    rank, width, order = symbols.astype(np.int64), 1, np.argsort(symbols, kind="stable")
    while width < ORDER:
        after = np.zeros_like(rank)
        after[: max(len(rank) - width, 0)] = rank[width:]
        key = rank * (int(rank.max()) + 1) + after
        order = np.argsort(key)
        steps = np.diff(key[order], prepend=key[order[:1]]) != 0
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(steps)
        width *= 2
    return order


class FMIndex:
    """Index of a sequence of symbols 0 to n_symbols - 1, in which `SEPARATOR` ends every part."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.size = len(symbols)
        self.order = sorted_by_prefix(symbols)
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])[:-1]
        self.transform = WaveletMatrix(symbols[self.order - 1], n_symbols)
        padded = np.concatenate([symbols, np.full(ORDER, SEPARATOR, symbols.dtype)])
        same, self.shared = np.ones(self.size - 1, bool), np.zeros(self.size, np.int8)
        for k in range(ORDER):
            same &= padded[self.order[1:] + k] == padded[self.order[:-1] + k]
            self.shared[1:] += same
        self.begins: dict[int, np.ndarray] = {}

    def groups(self, length: int) -> np.ndarray:
        """The first row of each group of rows that agree in `length` symbols."""
        if length not in self.begins:
            first = self.shared < length
            first[0] = True
            self.begins[length] = np.flatnonzero(first)
        return self.begins[length]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that begin with symbol[i] and go on as rows low[i] to high[i] - 1 do."""
        ends = self.transform.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.counts[symbol] + ends[: len(low)], self.counts[symbol] + ends[len(low) :]

    def shorten(self, low: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that agree with row low[i] in length[i] symbols."""
        first, last = np.zeros_like(low), np.full_like(low, self.size)
        for value in np.unique(length[length > 0]).tolist():
            own, begins = length == value, np.append(self.groups(value), self.size)
            at = np.searchsorted(begins, low[own], "right")
            first[own], last[own] = begins[at - 1], begins[at]
        return first, last

    def matching_statistics(self, symbols: np.ndarray, bounds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the sequences symbols[bounds[i]:bounds[i + 1]]: the length of the longest
        match that begins there, `most` (at most `ORDER`) at most, and the first row of those that match.

        Symbols that the index does not know are `SEPARATOR`; they match nothing.
        """
        length, row = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
        at, stop = bounds[1:] - 1, bounds[:-1]
        low, high, size = np.zeros(len(stop), np.int64), np.full(len(stop), self.size), np.zeros(len(stop), np.int64)
        active = np.flatnonzero(at >= stop)
        while len(active):
            symbol = symbols[at[active]]
            unknown = active[symbol == SEPARATOR]
            low[unknown], high[unknown], size[unknown] = 0, self.size, 0
            left = active[symbol != SEPARATOR]
            full = left[size[left] == most]
            size[full] -= 1
            low[full], high[full] = self.shorten(low[full], size[full])
            while len(left):
                first, last = self.extend(symbols[at[left]], low[left], high[left])
                fits = last > first
                done = left[fits]
                low[done], high[done], size[done] = first[fits], last[fits], size[done] + 1
                left = left[~fits]
                left = left[size[left] > 0]
                size[left] -= 1
                low[left], high[left] = self.shorten(low[left], size[left])
            length[at[active]], row[at[active]] = size[active], low[active]
            at[active] -= 1
            active = active[at[active] >= stop[active]]
        return length, row
