"""A full-text index of symbol runs: backward search over wavelet-matrix ranks.

Published method (Ferragina and Manzini 2000; Claude, Navarro, Ordonez 2015): the
last column of the sorted rotations answers "how many rows up to i hold symbol c",
a phrase is found from its last symbol to its first, and a row's place in the text
follows from the nearest sampled suffix position.
"""

from __future__ import annotations

import numpy as np

from orrery.llm.words import ragged

_SAMPLE = 32
_ONE = np.uint64(1)


class _Bits:
    """A bit array that counts the ones before a position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        part = self.words[i >> 6] & ((_ONE << (i & 63).astype(np.uint64)) - _ONE)
        return self.before[i >> 6] + np.bitwise_count(part)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & _ONE


def sorted_suffixes(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes; the zeros end a suffix and differ by place.

    Prefix doubling: each round sorts by twice as many symbols, and only rows that
    are still tied are sorted again.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    key = symbols.astype(np.int64) + len(ends)
    key[ends] = np.arange(len(ends))
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate(([True], key[order][1:] != key[order][:-1])) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    width = 1
    while True:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            return order
        at = order[rows]
        group, after = rank[at], rank[np.minimum(at + width, n - 1)]
        again = np.lexsort((after, group))
        at, group, after = at[again], group[again], after[again]
        order[rows] = at
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])))
        fresh[rows] = new
        rank[at] = np.maximum.accumulate(np.where(new, rows, 0))
        width *= 2


class FMIndex:
    """Index of `symbols`: 0 separates runs (and must come last), 1 and up are words."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        n = len(symbols)
        self.size = n
        suffixes = sorted_suffixes(symbols)
        before = symbols[suffixes - 1]  # the row of position 0 follows the last zero
        self.starts = np.searchsorted(symbols[suffixes], np.arange(n_symbols + 2))
        self.levels: list[tuple[_Bits, int, int]] = []
        column = before
        for shift in reversed(range(max(1, int(n_symbols).bit_length()))):
            bit = (column >> shift) & 1
            bits = _Bits(bit.astype(np.uint8))
            self.levels.append((bits, n - bits.ones, shift))
            column = np.concatenate((column[bit == 0], column[bit == 1]))
        # a walk backwards ends at a sampled place, and never crosses a separator
        sampled = (suffixes % _SAMPLE == 0) | (before == 0)
        self.sampled = _Bits(sampled.astype(np.uint8))
        self.places = suffixes[sampled]

    def _rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Rows before i whose preceding symbol is `symbol`."""
        low = np.zeros_like(i)
        for bits, zeros, shift in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            i1, low1 = bits.rank(i), bits.rank(low)
            i = np.where(one, zeros + i1, i - i1)
            low = np.where(one, zeros + low1, low - low1)
        return i - low

    def _previous(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        i, symbol = row, np.zeros_like(row)
        for bits, zeros, _ in self.levels:
            one = bits.get(i).astype(bool)
            symbol = symbol * 2 + one
            i1 = bits.rank(i)
            i = np.where(one, zeros + i1, i - i1)
        return self.starts[symbol] + self._rank(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase; `phrases` holds symbols, one phrase to a line."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for step in range(phrases.shape[1] if len(phrases) else 0):
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - 1 - step].astype(np.int64)
            low[live] = self.starts[symbol] + self._rank(symbol, low[live])
            high[live] = self.starts[symbol] + self._rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where in the text the suffixes of these rows begin."""
        place = np.zeros(len(rows), np.int64)
        walking, at, steps = np.arange(len(rows)), rows, 0
        while len(walking):
            found = self.sampled.get(at).astype(bool)
            place[walking[found]] = self.places[self.sampled.rank(at[found])] + steps
            walking, at = walking[~found], at[~found]
            if len(walking):
                at = self._previous(at)
            steps += 1
        return place

    def occurrences(
        self, phrases: np.ndarray, lengths: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence as (number of the phrase, place in the text)."""
        low, high = self.search(phrases, lengths)
        counts = high - low
        found = np.flatnonzero(counts)
        phrase = np.repeat(found, counts[found])
        return phrase, self.locate(np.repeat(low[found], counts[found]) + ragged(counts[found]))
