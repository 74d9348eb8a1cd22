"""Double-array tries over dense symbols: a child's cell is its parent's BASE plus the symbol."""

from __future__ import annotations

import numpy as np

ROOT = 1
#: Places looked at before a node's children go behind all others.
_LOOKS, _AT_ONCE = 64, 4096


class DoubleArray:
    """The trie of the rows of `codes`, sorted so that rows of a common prefix are neighbours.

    Rows are padded with -1. `base` and `check` are indexed by cell; `check` holds the
    parent's cell, 0 where the cell is free.
    """

    def __init__(self, codes: np.ndarray):
        rows, width = codes.shape
        apart = np.ones((rows, width), bool)
        if rows > 1:
            apart[1:] = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
        new = apart & (codes >= 0)
        number = np.zeros((rows, width), np.int64)  # 0 is the root
        number[new] = np.arange(1, new.sum() + 1)
        number = np.maximum.accumulate(number, axis=0)
        above = np.concatenate([np.zeros((rows, 1), np.int64), number[:, :-1]], 1)[new]
        self._pack(above, codes[new].astype(np.int64))

    def _pack(self, above: np.ndarray, code: np.ndarray) -> None:
        """`above` and `code` of node 1, 2, ..; node 0 is the root."""
        edge = np.lexsort((code, above))
        parent, code = above[edge], code[edge]
        first = np.flatnonzero(np.concatenate(([True], np.diff(parent) != 0))[: len(parent)])
        sizes = np.diff(np.append(first, len(parent)))
        self._taken = np.zeros(max(1024, 2 * len(code)), bool)
        self._taken[: ROOT + 1] = True
        self._high, self._cursor = ROOT + 1, ROOT + 1
        cell = np.zeros(len(code), np.int64)
        start = np.zeros(len(first), np.int64)
        several = np.flatnonzero(sizes > 1)
        for i in several[np.argsort(-sizes[several], kind="stable")].tolist():
            own = slice(first[i], first[i] + sizes[i])
            lead = self._place(code[own] - code[own][0])
            start[i] = lead - code[own][0]
            cell[own] = start[i] + code[own]
        # an only child may go anywhere
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~self._taken[: self._high])
        more = np.arange(self._high, self._high + max(len(single) - len(free), 0))
        cell[first[single]] = np.concatenate([free, more])[: len(single)]
        start[single] = cell[first[single]] - code[first[single]]
        cell_of = np.zeros(len(code) + 1, np.int64)
        cell_of[0] = ROOT
        cell_of[edge + 1] = cell
        size = int(cell.max(initial=ROOT)) + 1
        self.base = np.zeros(size, np.int64)
        self.check = np.zeros(size, np.int64)
        self.base[cell_of[parent[first]]] = start
        self.check[cell] = cell_of[parent]
        del self._taken

    def _place(self, shape: np.ndarray) -> int:
        """Take the first places that leave the cells of `shape` (from 0 up) free, from the last on."""
        span, at_once = int(shape[-1]) + 1, max(1, _AT_ONCE // len(shape))
        at = self._cursor
        for look in range(_LOOKS):
            free = at + np.flatnonzero(~self._taken[at : min(at + at_once, self._high)])
            self._room(at + at_once + span)
            fits = ~self._taken[free[:, None] + shape[None, :]].any(1)
            if fits.any():
                at = int(free[fits.argmax()])
                break
            at += at_once
            if at >= self._high:
                at = self._high
                break
        else:
            at = self._high
        self._room(at + span)
        self._taken[at + shape] = True
        self._high = max(self._high, at + span)
        self._cursor = at
        return at

    def _room(self, size: int) -> None:
        if size > len(self._taken):
            self._taken = np.concatenate([self._taken, np.zeros(size, bool)])

    def step(self, cell: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children of these cells under these symbols, 0 where there is none."""
        to = self.base[cell] + code
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(self.check[to] == cell, to, 0)
