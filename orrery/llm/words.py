"""Words of a batch of texts as byte positions and 64-bit hashes, without an object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_LONG = 256
_PAD = 8
_M1, _M2, _M3 = (
    np.uint64(0x9E3779B97F4A7C15),
    np.uint64(0xBF58476D1CE4E5B9),
    np.uint64(0x94D049BB133111EB),
)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)


def byte_table(lower: bool = False, only_alphanumeric: bool = False) -> np.ndarray:
    """What each byte becomes before splitting: itself, lower case, or a blank."""
    out = np.arange(256, dtype=np.uint8)
    if lower:
        out[65:91] += 32
    if only_alphanumeric:
        out[[c for c in range(128) if not chr(c).isalnum()]] = 32
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (Steele, Lea, Flood 2014)."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary())  # a batch holds less than 2 GB
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    data: np.ndarray  # translated bytes and a pad
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # one past its last byte
    first: np.ndarray  # number of each text's first word, then the number of words

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; the same in every task."""
        lengths = self.ends - self.starts
        eights = np.ndarray((len(self.data) - _PAD + 1,), "<u8", self.data, strides=(1,))
        h = mix((lengths.astype(np.uint64) + np.uint64(seed)) * _M1)
        active, at, rest = None, self.starts, lengths
        while len(at):
            part = eights[at] & _MASKS[np.minimum(rest, 8)]
            if active is None:
                h = mix(h ^ part)
            else:
                h[active] = mix(h[active] * _M1 ^ part)
            on = np.flatnonzero((rest > 8) & (rest <= _LONG) if active is None else rest > 8)
            active = on if active is None else active[on]
            at, rest = at[on] + 8, rest[on] - 8
        for i in np.flatnonzero(lengths > _LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), seed)
        return h

    def text_of_word(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(column: pa.Array, table: np.ndarray | None = None) -> Words:
    """Words are maximal runs of other bytes than ASCII white space, inside one text."""
    raw, offsets = text_bytes(column)
    n = len(raw)
    data = np.zeros(n + _PAD, np.uint8)
    data[:n] = raw if table is None else table[raw]
    inside = np.zeros(n + 2, bool)
    blank = np.zeros(256, bool)
    blank[list(SPACES)] = True
    inside[1 : n + 1] = ~blank[data[:n]]
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]  # two texts may touch without a blank
    touching = cuts[inside[cuts] & inside[cuts + 1]]
    begins[touching] = True
    stops[touching] = True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. inside each of the groups of these lengths."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
