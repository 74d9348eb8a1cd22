"""Maximal periodic runs of words, and texts with each run reduced to its first period.

A run is a stretch of consecutive words with smallest period q, at least `TIMES` periods
and `LEAST` words long, that no neighbouring word extends. For periods in [w, 2w), w a
power of two, the runs of 2w - 1 words are hashed and the smallest hash in every window
of w of them is kept. Such a stretch of words holds a whole period, so inside a run it
differs from those at any smaller distance than q: a window's minimum comes back exactly
q words later, and no equal one lies between. Each minimum and the next equal one at a
distance in [w, 2w) seed a run; w + (2w - 1) + q words fit into four periods, so every run
has a seed. A seed is extended both ways by comparing hashes of stretches, and what comes
out is compared word by word. Periods below `DIRECT` are too short for a window and are
scanned at their lag.

All texts of a slice are worked on at once, each followed by a value that nothing equals.
Time is in proportion to words times the logarithm of the longest text's.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orrery.llm.rows import named, with_results
from orrery.llm.words import mix, words_of

LEAST, TIMES = 6, 4
DIRECT = 8
RESULTS = {
    "n_words": "bigint",
    "runs": "array<struct<start:bigint,length:bigint,period:bigint>>",
    "collapsed": "string",
}
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # first place, one past the last, period


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal stretch of true values."""
    edges = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = n - width
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Stretches:
    """Hashes of any stretch of a sequence, from one pass over it."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        power = np.full(n + 1, _BASE, np.uint64)
        back = np.full(n + 1, _BASE_INVERSE, np.uint64)
        power[0] = back[0] = 1
        np.multiply.accumulate(power, out=power)
        self.back = np.multiply.accumulate(back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(x * power[:n], out=self.sums[1:])
        self.x = x

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def all_of(self, length: int) -> np.ndarray:
        n = len(self.x) - length + 1
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n])

    def alike(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from `a` on equal those from `b` on (step 1), or before them (-1)."""
        found = np.zeros(len(a), np.int64)
        width = 1 << int(most.max(initial=1)).bit_length()
        while width:
            may = np.flatnonzero(found + width <= most)
            shift = found[may] if step > 0 else -found[may] - width
            same = self.of(a[may] + shift, width) == self.of(b[may] + shift, width)
            found[may[same]] += width
            width >>= 1
        return found


def _seeded(x: np.ndarray, w: int) -> Runs:
    """Runs with periods in [w, 2w)."""
    gram = 2 * w - 1
    if len(x) < gram + w:
        return _runs([])
    hashed = Stretches(x)
    grams = hashed.all_of(gram)
    least = _sliding(grams, w, np.minimum)
    pad = np.zeros(w - 1, np.uint64)
    most = _sliding(np.concatenate([pad, least, pad]), w, np.maximum)
    minima = np.flatnonzero(grams == most)
    minima = minima[np.argsort(grams[minima], kind="stable")]
    apart = np.diff(minima)
    seeds = (np.diff(grams[minima]) == 0) & (apart >= w) & (apart < 2 * w)
    at, period = minima[:-1][seeds], apart[seeds]
    # along a run each seed ends where the next begins; one of them is enough
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    chained = np.zeros(len(at), bool)
    chained[1:] = (period[1:] == period[:-1]) & (at[1:] - at[:-1] < gram)
    at, period = at[~chained], period[~chained]
    left = hashed.alike(at, at + period, at, -1)
    right = hashed.alike(at, at + period, len(x) - at - period, 1)
    begin, end = at - left, at + right + period
    long = end - begin >= np.maximum(LEAST, TIMES * period)
    found = np.unique(np.stack([begin[long], end[long], period[long], at[long]], 1), axis=0)
    return _runs([_exact(x, *row) for row in found.tolist()])


def _exact(x: np.ndarray, begin: int, end: int, q: int, at: int) -> tuple[int, int, int]:
    """The run as it is, if hashes of stretches should have misled; without words if there is none."""
    same = (
        np.array_equal(x[begin : end - q], x[begin + q : end])
        and (begin == 0 or x[begin - 1] != x[begin - 1 + q])
        and (end == len(x) or x[end] != x[end - q])
    )
    if not same:
        begins, ends = _stretches(x[q:] == x[:-q])
        i = np.searchsorted(begins, at, "right") - 1
        if i < 0 or ends[i] <= at or ends[i] - begins[i] < max(LEAST - q, (TIMES - 1) * q):
            return 0, 0, q
        begin, end = int(begins[i]), int(ends[i]) + q
    return begin, end, q


def _runs(rows: list[tuple[int, int, int]]) -> Runs:
    table = np.array([r for r in rows if r[1]], np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def find_runs(x: np.ndarray, sizes: np.ndarray) -> Runs:
    """Runs of `x`, in which each of the texts of these sizes is followed by a value of its own.

    Sorted by first place, then period. A run found at several lags is told once,
    with its smallest period.
    """
    found: list[Runs] = []
    for q in range(1, min(DIRECT, len(x))):
        begin, end = _stretches(x[q:] == x[:-q])
        long = end - begin >= max(LEAST - q, (TIMES - 1) * q)
        found.append((begin[long], end[long] + q, np.full(int(long.sum()), q)))
    w = DIRECT
    while len(sizes) and TIMES * w <= sizes.max():
        places = np.flatnonzero(np.repeat(sizes >= TIMES * w, sizes + 1))
        begin, end, period = _seeded(x[places], w)
        found.append((places[begin], places[end - 1] + 1, period))
        w *= 2
    begin, end, period = (np.concatenate(c) for c in zip(*found)) if found else _runs([])
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.ones(len(begin), bool)
    first[1:] = (np.diff(begin) != 0) | (np.diff(end) != 0)
    begin, end, period = begin[first], end[first], period[first]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def collapse_runs(docs: DataFrame, keep: list[str], *, text: str = "text") -> DataFrame:
    """The columns `keep`, then n_words, the runs of words, and the text without repeats.

    Words are maximal stretches without ASCII white space, compared as they are. Runs
    are sorted by first word (from 0), then period. `collapsed` is the words that no run
    holds after its first period, joined by one space. A null or blank text has no words,
    no runs and an empty `collapsed`. Repeated rows are told alike, each by itself.
    """

    def prepare():
        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            words = words_of(columns[0])
            sizes = np.diff(words.first)
            n = len(words.starts)
            # words are even numbers, the ends of texts odd ones, each its own
            x = np.empty(n + len(sizes), np.uint64)
            ends = np.cumsum(sizes + 1) - 1
            of_word = np.ones(len(x), bool)
            of_word[ends] = False
            x[of_word] = words.hashes() << np.uint64(1)
            x[ends] = np.arange(1, 2 * len(sizes), 2, dtype=np.uint64)
            begin, end, period = find_runs(x, sizes)
            steps = np.zeros(len(x) + 1, np.int64)
            np.add.at(steps, begin + period, 1)
            np.add.at(steps, end, -1)
            kept = (np.cumsum(steps[:-1]) == 0)[of_word].tolist()
            first = words.first.tolist()
            collapsed = [
                b" ".join(compress((t or b"").split(), kept[a:b]))
                for t, a, b in zip(columns[0].cast(pa.binary()).to_pylist(), first, first[1:])
            ]
            owner = np.searchsorted(ends, begin)
            offsets = np.searchsorted(owner, np.arange(len(sizes) + 1)).astype(np.int32)
            start = begin - (ends - sizes)[owner] if len(begin) else begin
            table = pa.StructArray.from_arrays(
                [pa.array(start), pa.array(end - begin), pa.array(period)],
                ["start", "length", "period"],
            )
            return [
                pa.array(sizes.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), table),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]

        return compute

    return with_results(docs, keep, [named(docs, text)], RESULTS, prepare)
