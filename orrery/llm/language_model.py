"""Log-probabilities of texts from n-gram counts in a log-frequency Bloom filter.

Published structure (Talbot and Osborne 2007): an n-gram with count c is entered once
for every level j with 2^j <= c. Its count is read back by asking level after level
until one is missing; a false answer only ever adds a level.

A filter of all n-grams of a corpus grows with it and outgrows any broadcast, so it lies
in parts, one for each range of keys. Their number follows the bytes of the training
texts, the size of each its entries; nothing is left out at any size.

1. One pass over the training texts counts words and pairs of words. A task sends its
   counts as sorted runs, one for each range. Where a range is owned its runs are merged,
   and all its words and pairs, also those seen once, are entered in its part of the
   filter. The exact counts of words are kept beside it.
2. The texts are cut into slices of some megabytes, and stored as word numbers. A slice asks
   each range for its distinct words and pairs. The parts go to the tasks that answer for
   their ranges, and the answers, a byte each, go back to the slice.
3. A pair's share of its first word's count is interpolated with the add-one probability
   of its second word (Jelinek and Mercer), all read from the filter. The exact counts
   serve the exact add-one score alone.

However often a word comes, a slice asks for it once, so no range is hot. A word is known
by 64 bits of its hash, a pair by 48.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.rows import named, slices
from orrery.llm.shipping import ship
from orrery.llm.words import Words, byte_table, mix, words_of
from orrery.workspace import materialise

PAIR_BITS = 48
#: Bytes of training text for each range of keys.
RANGE_BYTES = 32 << 20
BITS_AN_ENTRY, LEAST_BITS = 10, 1 << 12
PROBES = 6
TOP_LEVEL = 40
PAIR_WEIGHT = 0.4
_KEYS_AT_ONCE = 1 << 21
_LOOKED_UP_AT_ONCE = 1 << 18
#: Bytes of text in a slice; a longer document is one alone.
SLICE_BYTES = 4 << 20
_TABLE = byte_table(lower=True)
_BEGIN, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_WORD, _PAIR = 0, 1
_RUN = "kind int, shard int, steps binary, counts binary"
_PART = "shard int, steps binary, counts binary, bits binary, tokens bigint, words bigint, ends bigint"


@dataclass
class Tokens:
    token: np.ndarray  # word hashes, and an end after each text
    before: np.ndarray  # the token before, or the beginning
    first: np.ndarray  # each text's first token, then their number


def tokens_of(words: Words) -> Tokens:
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    token = np.empty(int(first[-1]), np.uint64)
    token[first[1:] - 1] = _END
    token[np.arange(len(words.starts)) + words.text_of_word()] = words.hashes()
    before = np.concatenate(([_BEGIN], token[:-1])) if len(token) else token
    before[first[:-1]] = _BEGIN
    return Tokens(token, before, first)


def word_key(token: np.ndarray) -> np.ndarray:
    return mix(token) >> np.uint64(64 - PAIR_BITS)


def pair_key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return mix(mix(before + np.uint64(1)) + token) >> np.uint64(64 - PAIR_BITS)


def _cuts(keys: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Where each range of the sorted keys begins, and their number."""
    owner = keys >> np.uint64(bits - ranges.bit_length() + 1) if ranges > 1 else np.zeros(len(keys), np.uint64)
    return np.searchsorted(owner, np.arange(ranges + 1, dtype=np.uint64))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which lets any block compression drop the empty ones."""
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _run(kind: int, shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
    steps = np.diff(keys, prepend=np.uint64(0))
    return kind, shard, _planes(steps), _planes(counts.astype(np.uint64))


def _open(steps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_from_planes(steps, "<u8")), _from_planes(counts, "<u8")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "shard", "steps", "counts"]
    )


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[new], np.add.reduceat(counts, new) if len(new) else counts


def _levels(counts: np.ndarray) -> np.ndarray:
    """The highest j with 2^j <= count."""
    return np.frexp(counts.astype(np.float64))[1] - 1


def _place(key: np.ndarray, level: int, probe: int, n_bits: int) -> np.ndarray:
    turn = np.uint64((level * PROBES + probe + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return (mix(key + turn) & np.uint64(n_bits - 1)).astype(np.int64)


def filter_of(keys: np.ndarray, counts: np.ndarray, bits_an_entry: int = BITS_AN_ENTRY) -> np.ndarray:
    """The filter that holds these counts (at least 1), as bytes; its size is a power of two."""
    level = _levels(counts)
    wanted = max(int((level + 1).sum()) * bits_an_entry, LEAST_BITS)
    on = np.zeros(1 << (wanted - 1).bit_length(), bool)
    for i in range(0, len(keys), _LOOKED_UP_AT_ONCE):
        some, own = keys[i : i + _LOOKED_UP_AT_ONCE], level[i : i + _LOOKED_UP_AT_ONCE]
        for j in range(int(own.max()) + 1):
            here = some[own >= j]
            for probe in range(PROBES):
                on[_place(here, j, probe, len(on))] = True
    return np.packbits(on, bitorder="little")


def levels_in(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One more than the highest level found for each key, level after level; 0 if none is."""
    out = np.zeros(len(key), np.uint8)
    for i in range(0, len(key), _LOOKED_UP_AT_ONCE):
        some = key[i : i + _LOOKED_UP_AT_ONCE]
        rows = np.arange(len(some))
        for level in range(TOP_LEVEL):
            for probe in range(PROBES):
                at = _place(some[rows], level, probe, 8 * len(bits))
                rows = rows[(bits[at >> 3] >> (at & 7)) & 1 > 0]
            if not len(rows):
                break
            out[i + rows] = level + 1
    return out


def middles(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level: 0 for none, then 1, 2.5, 5.5 and so on."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels.astype(np.int64) - 1) - 0.5, 0.0)


def count_ngrams(texts: DataFrame, ranges: int, bits_an_entry: int = BITS_AN_ENTRY) -> DataFrame:
    """One row for each range of keys that has any: exact words, filter, totals.

    `texts` has the column t, `ranges` is a power of two.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {_WORD: [], _PAIR: []}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, bits in ((_WORD, 64), (_PAIR, PAIR_BITS)):
                keys, counts = np.unique(np.concatenate(held[kind]), return_counts=True)
                cuts = _cuts(keys, bits, ranges)
                own = np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
                yield _batch([_run(kind, r, keys[cuts[r] : cuts[r + 1]], counts[cuts[r] : cuts[r + 1]]) for r in own])
                held[kind].clear()

        for batch in batches:
            for piece in slices(batch, 0):
                found = tokens_of(words_of(piece.column(0), _TABLE))
                if not len(found.token):
                    continue
                held[_WORD].append(found.token)
                held[_PAIR].append(pair_key(found.before, found.token))
                size += len(found.token)
                if size >= _KEYS_AT_ONCE:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def take(kind: int) -> None:
            if len(held[kind]) > 1:
                keys, counts = zip(*held[kind])
                held[kind] = [_summed(np.concatenate(keys), np.concatenate(counts))]

        def add(kind: int, run: tuple[np.ndarray, np.ndarray]) -> None:
            """Runs join the merged one when they are as long as it, so little more than it is held."""
            held[kind].append(run)
            waiting = sum(len(keys) for keys, _ in held[kind][1:])
            if waiting >= max(len(held[kind][0][0]), _LOOKED_UP_AT_ONCE):
                take(kind)

        def done() -> pa.RecordBatch:
            take(_WORD)
            take(_PAIR)
            none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
            (word, n), (pair, m) = [held[kind][0] if held[kind] else none for kind in (_WORD, _PAIR)]
            held.clear()
            bits = filter_of(np.concatenate((word_key(word), pair)), np.concatenate((n, m)), bits_an_entry)
            _, _, steps, counts = _run(_WORD, now, word, n)
            row = [now, steps, counts, bits.tobytes(), int(n.sum()), len(word), int(n[word == _END].sum())]
            kinds = [pa.int32(), *[pa.binary()] * 3, *[pa.int64()] * 3]
            names = ["shard", "steps", "counts", "bits", "tokens", "words", "ends"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for i in range(batch.num_rows):
                kind, shard = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if now != shard:
                    if now is not None:
                        yield done()
                    now, held = shard, {_WORD: [], _PAIR: []}
                add(kind, _open(*[c[i].as_buffer() for c in batch.columns[2:]]))
        if now is not None:
            yield done()

    ship(texts.sparkSession)
    return (
        texts.mapInArrow(count, _RUN)
        # a task for every range: Spark hands a task's runs over at once
        .repartitionById(ranges, "shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(merge, _PART)
    )


def ranges_for(texts: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """The number of ranges of keys for texts (one column t): a power of two, in proportion to their bytes."""
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    return 1 << max(0, (size - 1) // range_bytes).bit_length()


@dataclass
class Totals:
    tokens: int  # N, ends included
    vocabulary: int  # V, the end included
    texts: int

    def add_one(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1.0) / (self.tokens + self.vocabulary + 1.0)


def _ints(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(data, kind)


def _ascending(keys: np.ndarray) -> bytes:
    """Ascending keys as the steps between them."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _from_ascending(data: bytes | None) -> np.ndarray:
    return np.cumsum(_from_planes(data or b"", "<u8"), dtype=np.uint64)


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The stretches of an array between cuts, as rows of bytes."""
    width = values.dtype.itemsize
    offsets = pa.py_buffer((cuts * width).astype(np.int32))
    return pa.Array.from_buffers(
        pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))]
    )


_SLICE = "slice bigint, kept binary, first binary, which binary, words binary"
_ASK = "shard int, slice bigint, words binary, pairs binary"
_ANSWER = "slice bigint, shard int, exact binary, word_levels binary, pair_levels binary"


def _sliced(read: DataFrame, kept: int) -> DataFrame:
    """Slices of a table whose columns are the kept ones, then the text t."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in slices(batch, kept, SLICE_BYTES):
                found = tokens_of(words_of(piece.column(kept), _TABLE))
                words, which = np.unique(found.token, return_inverse=True)
                own = pa.RecordBatch.from_arrays(
                    piece.columns[:kept] or [pa.nulls(piece.num_rows)], [f"k{i}" for i in range(max(kept, 1))]
                )
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as stream:
                    stream.write_batch(own)
                parts = [sink.getvalue().to_pybytes(), found.first.astype(np.int64).tobytes()]
                numbers = _planes(which.astype(np.uint32))
                parts += [pa.compress(numbers, "zstd", asbytes=True), _ascending(words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), *[pa.array([p], pa.binary()) for p in parts]],
                    ["slice", "kept", "first", "which", "words"],
                )
                number += 1

    return read.mapInArrow(cut, _SLICE)


def _slice_tokens(first: bytes, which: bytes, words: bytes) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """The tokens of a slice, its distinct words, and which of them each token is."""
    start, names = _ints(first, np.int64), _from_ascending(words)
    place = _from_planes(pa.decompress(which, 4 * int(start[-1]), "zstd", asbytes=True), "<u4")
    token = names[place]
    before = np.concatenate(([_BEGIN], token[:-1]))
    before[start[:-1]] = _BEGIN
    return Tokens(token, before, start), names, place


def _asks(sliced: DataFrame, ranges: int) -> DataFrame:
    """What each slice asks of each range: its distinct words and pairs, ascending."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *parts in zip(*[c.to_pylist() for c in batch.columns]):
                found, words, _ = _slice_tokens(*parts)
                pairs = np.unique(pair_key(found.before, found.token))
                word_cuts, pair_cuts = _cuts(words, 64, ranges), _cuts(pairs, PAIR_BITS, ranges)
                asked = (word_cuts[1:] > word_cuts[:-1]) | (pair_cuts[1:] > pair_cuts[:-1])
                own = np.flatnonzero(asked)
                parts = [
                    pa.array([_ascending(v[c[r] : c[r + 1]]) for r in own.tolist()], pa.binary())
                    for v, c in ((words, word_cuts), (pairs, pair_cuts))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.astype(np.int32)),
                        pa.array(np.full(len(own), number, np.int64)),
                        *parts,
                    ],
                    ["shard", "slice", "words", "pairs"],
                )

    return sliced.select("slice", "first", "which", "words").mapInArrow(ask, _ASK)


def _answers(parts: DataFrame, asks: DataFrame, ranges: int) -> DataFrame:
    """For each asking row the exact counts of its words, and the levels of its words and pairs."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, bits = -1, *[np.zeros(0, np.uint64)] * 2, np.zeros(LEAST_BITS // 8, np.uint8)
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            number, words, pairs = zip(*held)
            word, pair = np.concatenate(words), np.concatenate(pairs)
            exact = np.zeros(len(word), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, word), len(keys) - 1)
                exact = np.where(keys[at] == word, counts[at], 0).astype(np.int64)
            word_cuts, pair_cuts = (np.cumsum([0, *map(len, v)]) for v in (words, pairs))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(number, pa.int64()),
                    pa.array([now] * len(number), pa.int32()),
                    pa.array([_planes(exact[a:b]) for a, b in zip(word_cuts, word_cuts[1:])], pa.binary()),
                    _binaries(levels_in(bits, word_key(word)), word_cuts),
                    _binaries(levels_in(bits, pair), pair_cuts),
                ],
                ["slice", "shard", "exact", "word_levels", "pair_levels"],
            )

        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard, number, words, pairs, *own = [c[i].as_py() for c in batch.columns]
                if held and (shard != now or size >= _LOOKED_UP_AT_ONCE):
                    yield done()
                    size = 0
                if shard != now:
                    now, keys, counts = shard, *[np.zeros(0, np.uint64)] * 2
                    bits = np.zeros(LEAST_BITS // 8, np.uint8)
                if number < 0:  # a range's own part stands before the rows that ask it
                    keys, counts = _open(*own[:2])
                    bits = _ints(own[2], np.uint8)
                else:
                    held.append((number, _from_ascending(words), _from_ascending(pairs)))
                    size += len(held[-1][1]) + len(held[-1][2])
        if held:
            yield done()

    own = parts.select("shard", F.lit(-1).cast("long").alias("slice"), "steps", "counts", "bits")
    return (
        asks.unionByName(own, allowMissingColumns=True)
        .repartitionById(ranges, "shard")
        .sortWithinPartitions("shard", "slice")
        .select("shard", "slice", "words", "pairs", "steps", "counts", "bits")
        .mapInArrow(answer, _ANSWER)
    )


def _scores(first, which, words, exact, word_levels, pair_levels, totals: Totals) -> list[np.ndarray]:
    """Of each text of a slice: tokens, known ones, base score and score."""
    found, _, place = _slice_tokens(first, which, words)
    begin = found.first[:-1]
    _, pair = np.unique(pair_key(found.before, found.token), return_inverse=True)
    rough = middles(word_levels)[place]
    # the history's count: that of the token before, or of the texts at a beginning
    history = np.concatenate(([0.0], rough[:-1]))
    history[begin] = totals.texts
    both = np.minimum(middles(pair_levels)[pair], history)
    chance = PAIR_WEIGHT * both / np.maximum(history, 1) + (1 - PAIR_WEIGHT) * totals.add_one(rough)
    count = exact[place]
    return [
        np.diff(found.first),
        np.add.reduceat((count > 0).astype(np.int64), begin),
        np.add.reduceat(np.log10(totals.add_one(count)), begin),
        np.add.reduceat(np.log10(chance), begin),
    ]


def score_texts(
    docs: DataFrame,
    learn: Column,
    keep: list[str],
    *,
    text: str = "text",
    range_bytes: int = RANGE_BYTES,
    bits_an_entry: int = BITS_AN_ENTRY,
) -> DataFrame:
    """The columns `keep`, then n_tokens, n_known, train_tokens, base_score and score.

    The model and the counts are of the rows for which `learn` holds. Words are runs
    without ASCII white space, A-Z lower-cased, and every text, also a null or empty
    one, has one end as its last token. `base_score` is the exact add-one score of
    its words alone, `score` the log10 probability by the filter's words and pairs.
    Without any training row all counts are 0. Repeated rows are counted and scored each;
    the input's other columns play no part.
    """
    ship(docs.sparkSession)
    body = named(docs, text)
    training = docs.where(learn).select(body.alias("t"))
    ranges = ranges_for(training, range_bytes)
    parts = materialise(count_ngrams(training, ranges, bits_an_entry), "ngram-parts")
    sums = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "words", "ends")]).first()
    totals = Totals(*[int(x) for x in sums])

    kept = [f"k{i}" for i in range(len(keep))]
    read = docs.select(*[named(docs, c).alias(k) for c, k in zip(keep, kept)], body.alias("t"))
    # stored, as the numbers of slices must not change
    sliced = materialise(_sliced(read, len(keep)), "word-slices")
    answers = _answers(parts, _asks(sliced, ranges), ranges)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []

        def done() -> pa.RecordBatch:
            own, *numbers = now
            counts, *levels = zip(*asked)
            exact = np.concatenate([_from_planes(c, "<i8") for c in counts])
            word, pair = [_ints(b"".join(parts), np.uint8) for parts in levels]
            rows = pa.ipc.open_stream(own).read_next_batch()
            found = _scores(*numbers, exact, word, pair, totals)
            columns = [*rows.columns[: len(kept)], *[pa.array(x) for x in found]]
            return pa.RecordBatch.from_arrays(columns, [*kept, "r0", "r1", "r2", "r3"])

        for batch in batches:
            for i in range(batch.num_rows):
                _, shard, *values = [c[i].as_py() for c in batch.columns]
                if shard < 0:  # the slice itself stands before its answers
                    if now:
                        yield done()
                    now, asked = values[:4], []
                else:
                    asked.append(values[4:])
        if now:
            yield done()

    own = ["kept", "first", "which", "words"]
    kinds = [f"{k} {read.schema[k].dataType.simpleString()}" for k in kept]
    scored = (
        answers.unionByName(sliced.withColumn("shard", F.lit(-1)), allowMissingColumns=True)
        .repartition("slice")
        .sortWithinPartitions("slice", "shard")
        .select("slice", "shard", *own, "exact", "word_levels", "pair_levels")
        .mapInArrow(finish, ", ".join([*kinds, "r0 bigint, r1 bigint, r2 double, r3 double"]))
    )
    return scored.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)],
        F.col("r0").alias("n_tokens"),
        F.col("r1").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        F.col("r2").alias("base_score"),
        F.col("r3").alias("score"),
    )


def seventh_is_held_out(id: Column) -> Column:
    """Whether the id's checksum leaves 2 when divided by 7; never for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 7 == 2, F.lit(False))
