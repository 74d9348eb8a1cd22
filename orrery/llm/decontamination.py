"""Benchmark decontamination by a full-text index of every shard of the training texts.

A task indexes its documents shard by shard and searches all phrases of the
benchmark backwards. No document moves; only the benchmark is sent out, in blocks
of at most `BLOCK_PHRASES` phrases, so what a task holds has a fixed bound and a
larger benchmark only means more blocks.

Words that no benchmark item holds separate runs, since no phrase can cross one,
and runs shorter than the shortest phrase are left out of the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orrery.llm.fm_index import FMIndex
from orrery.llm.rows import named, with_results
from orrery.llm.words import byte_table, ragged, words_of

WINDOW = 13
BLOCK_PHRASES = 200_000
_TABLE = byte_table(lower=True, only_alphanumeric=True)
RESULTS = {
    "n_words": "bigint",
    "n_hit": "bigint",
    "items": "array<bigint>",  # or of what item ids are
    "spans": "array<struct<begin:int,end:int>>",
}


class Phrases:
    """Distinct windows of benchmark items, as word numbers, with the items they are from."""

    def __init__(self, items: list[tuple], window: int, kind: pa.DataType):
        texts = words_of(pa.array([t for _, t in items], pa.string()), _TABLE)
        self.vocabulary, word = np.unique(texts.hashes(), return_inverse=True)
        counts = np.diff(texts.first)
        windows = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(items)), windows)
        begin = texts.first[:-1][item] + ragged(windows)
        length = np.minimum(counts[item], window)
        at = np.minimum(begin[:, None] + np.arange(window), max(len(word) - 1, 0))
        inside = np.arange(window) < length[:, None]
        symbols = np.where(inside, word[at] + 1, 0) if len(word) else np.zeros(at.shape, int)
        self.symbols, which = np.unique(symbols.astype(np.int32), axis=0, return_inverse=True)
        self.lengths = (self.symbols > 0).sum(1)
        distinct = sorted({i for i, _ in items})
        self.ids = pa.array(distinct, kind)  # items go by their place in this list
        place = {i: n for n, i in enumerate(distinct)}
        of_row = np.array([place[i] for i, _ in items], np.int64)
        pairs = np.unique(np.stack([which.reshape(-1), of_row[item]], 1), axis=0)
        self.item = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(self.symbols) + 1))


def _blocks(
    benchmark: DataFrame, window: int, limit: int, kind: pa.DataType
) -> Iterator[tuple[Phrases, bool]]:
    """The benchmark in parts of bounded size, and whether another follows; one at least."""
    block, size = [], 0
    for item, text in benchmark.toLocalIterator():
        if size >= limit:
            yield Phrases(block, window, kind), True
            block, size = [], 0
        block.append((item, text))
        size += len(text) // 2 + 1
    yield Phrases(block, window, kind), False


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    """Lists by owner, from values sorted by owner."""
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), values
    )


def search_shard(columns: list[pa.Array], phrases: Phrases) -> list[pa.Array]:
    """Index these texts, search the phrases, and merge what they cover.

    After the texts, `columns` may hold the items and spans that earlier blocks found.
    """
    column, *earlier = columns
    words, n = words_of(column, _TABLE), len(column)
    counts, total = np.diff(words.first), len(words.starts)
    hit = np.zeros(total + 1, np.int64)
    doc_of_item = np.zeros((0, 2), np.int64)
    if total and len(phrases.symbols):
        hashes = words.hashes()
        place = np.minimum(
            np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1
        )
        known = phrases.vocabulary[place] == hashes
        # runs of known words inside one text
        text = words.text_of_word()
        joined = known[1:] & known[:-1] & (text[1:] == text[:-1])
        begins = np.flatnonzero(known & np.concatenate(([True], ~joined)))
        stops = np.flatnonzero(known & np.concatenate((~joined, [True]))) + 1
        long = stops - begins >= phrases.lengths.min()
        begins, lengths = begins[long], (stops - begins)[long]
        if len(begins):
            into = np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths) + ragged(lengths)
            origin = np.repeat(begins, lengths) + ragged(lengths)
            symbols = np.zeros(int((lengths + 1).sum()), np.int64)
            symbols[into] = place[origin] + 1
            back = np.zeros(len(symbols), np.int64)
            back[into] = origin
            index = FMIndex(symbols, len(phrases.vocabulary))
            phrase, at = index.occurrences(phrases.symbols, phrases.lengths)
            at = back[at]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + phrases.lengths[phrase], -1)
            pairs = np.unique(np.stack([text[at], phrase], 1), axis=0)
            many = np.diff(phrases.first)[pairs[:, 1]]
            item = phrases.item[np.repeat(phrases.first[pairs[:, 1]], many) + ragged(many)]
            doc_of_item = np.stack([np.repeat(pairs[:, 0], many), item], 1)
    doc_of_item = np.unique(doc_of_item, axis=0)
    items = _lists(phrases.ids.take(pa.array(doc_of_item[:, 1])), doc_of_item[:, 0], n)
    if earlier:
        old, spans = earlier
        both = zip(items.to_pylist(), old.to_pylist())
        items = pa.array([sorted({*a, *b}) if a and b else a or b for a, b in both], items.type)
        base = words.first[np.repeat(np.arange(n), np.asarray(spans.value_lengths()))]
        flat = spans.flatten()
        np.add.at(hit, base + np.asarray(flat.field("begin")), 1)
        np.add.at(hit, base + np.asarray(flat.field("end")), -1)
    covered = np.cumsum(hit[:-1]) > 0
    sums = np.concatenate(([0], np.cumsum(covered)))
    doc = words.text_of_word()
    same = covered[1:] & covered[:-1] & (doc[1:] == doc[:-1])
    begins = np.flatnonzero(covered & np.concatenate(([True], ~same))) if total else doc
    stops = np.flatnonzero(covered & np.concatenate((~same, [True]))) + 1 if total else doc
    base = words.first[doc[begins]]
    spans = pa.StructArray.from_arrays(
        [pa.array((begins - base).astype(np.int32)), pa.array((stops - base).astype(np.int32))],
        ["begin", "end"],
    )
    return [
        pa.array(counts.astype(np.int64)),
        pa.array((sums[words.first[1:]] - sums[words.first[:-1]]).astype(np.int64)),
        items,
        _lists(spans, doc[begins], n),
    ]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """The columns `keep`, then n_words, n_hit, items and spans of every document.

    Words are runs of letters and digits (every byte beyond ASCII counts as a
    letter), A-Z lower-cased. Each `window` words of an item are a phrase; an item
    with fewer words is one phrase. `spans` are the merged word ranges that phrases
    cover, `n_hit` the words in them, `items` the sorted ids of items with an
    occurrence, of the type they have. A null or empty text has no words. Items without id, text or words
    occur nowhere; rows of one item id count as one item. Repeated documents each
    get their own row. With an empty benchmark nothing is hit.

    A benchmark beyond `block_phrases` is searched block by block, and the blocks'
    spans are merged per document.
    """
    stated = benchmark.select(
        named(benchmark, item_id).alias("i"), named(benchmark, item_text).alias("t")
    ).where("i is not null and t is not null")
    id_type = stated.schema["i"].dataType
    results = RESULTS | {"items": f"array<{id_type.simpleString()}>"}
    kept = [f"k{i}" for i in range(len(keep))]
    found = docs.select(
        *[named(docs, c).alias(k) for c, k in zip(keep, kept)], named(docs, text).alias("t")
    )
    earlier: list[str] = []
    for phrases, more in _blocks(stated, window, block_phrases, to_arrow_type(id_type)):
        sent = docs.sparkSession.sparkContext.broadcast(phrases)

        def prepare(sent=sent):
            return lambda columns: search_shard(columns, sent.value)

        found = with_results(
            found,
            kept + ["t"] * more,
            [F.col("t"), *[F.col(c) for c in earlier]],
            results,
            prepare,
        )
        earlier = ["items", "spans"]
    return found.select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)], *[F.col(r) for r in RESULTS]
    )


def is_contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """At least one word in `share` is covered by benchmark phrases."""
    return (n_hit > 0) & (F.lit(share) * n_hit >= n_words)
