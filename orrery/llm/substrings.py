"""Removal of word passages that repeat anywhere in the corpus, behind a count-min prefilter.

A window is `WINDOW` consecutive words. Its anchor is the smallest hash among the
`ANCHOR`-word runs inside it, so neighbouring windows share an anchor and equal
windows always do: an anchor occurs at least as often as any of its windows.

1. Every task sketches its anchors; the partition sketches are merged, block by block,
   into one count-min sketch of which only "twice or more" matters, one bit a cell.
   A window whose anchor both cells call repeated may repeat; any other cannot.
2. Windows estimated repeated are counted exactly under 128 bits (anchor and digest
   of all words). Partial counts meet, so a passage in a third of all texts is one row a task.
3. Bits of those counted twice tell nearly all other windows at once. What passes is cut
   into segments, consecutive windows under one anchor, each known by a digest of its
   words. Equal segments are looked up once, window by window, each meeting at most one
   row; what was found goes back to the places of the segment, one row to one row.
4. Bits of the marked texts tell which texts are surely whole; only the others travel to
   their marks.

Shuffle files of the steps before the last go as each step ends.

The sketch is sized from the bytes of the whole corpus, up to `MOST_CELLS` cells (128 MB
of bits), and is broadcast. A corpus beyond that size fills the sketch: then more
windows are counted exactly, and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.periodic_runs import Stretches
from orrery.llm.rows import named, slices, with_results
from orrery.llm.shipping import ship
from orrery.llm.words import mix, words_of
from orrery.workspace import materialise, shuffles_dropped

WINDOW, ANCHOR = 35, 8
BLOCK_CELLS = 1 << 18
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 30
#: Text bytes to a cell; an anchor comes about every hundred bytes and fills two cells.
BYTES_A_CELL = 12
#: Windows of a segment at most; a run of one word would have one anchor all along.
SEGMENT = 64
_BASE = 0x9E3779B97F4A7C15 | 1


def _joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes, from hashes of runs of powers of two."""
    done, out, run, width = 0, None, hashes, 1
    while width <= n:
        if n & width:
            if out is None:
                out = run
            else:  # the shorter run comes first
                size = len(hashes) - done - width + 1
                power = np.uint64(pow(_BASE, width, 1 << 64))
                out = out[:size] * power + run[done : done + size]
            done += width
        size = max(len(hashes) - 2 * width + 1, 0)
        power = np.uint64(pow(_BASE, width, 1 << 64))
        run = run[:size] * power + run[width : width + size]
        width *= 2
    return mix(out[: max(len(hashes) - n + 1, 0)])


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) of each n consecutive values."""
    width = 1
    while 2 * width <= n:
        values = pick(values[:-width], values[width:])
        width *= 2
    rest = n - width
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """Anchors and windows of a batch of texts."""

    def __init__(self, column: pa.Array, window: int, anchor: int):
        words = words_of(column)
        self.words = words
        span = window - anchor + 1
        n = len(words.starts) - window + 1
        if n <= 0:
            self.start = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            self.places = np.zeros(0, np.uint64)
            return
        self.hashes = words.hashes()
        text = words.text_of_word()
        grams = _joined(self.hashes, anchor)
        least = _sliding(grams, span, np.minimum)
        inside = text[:n] == text[window - 1 :]
        self.start = np.flatnonzero(inside)
        self.anchor = least[self.start]
        # places whose run is the anchor of some window that holds them
        pad = np.zeros(span - 1, np.uint64)
        most = _sliding(np.concatenate([pad, np.where(inside, least, 0), pad]), span, np.maximum)
        self.places = grams[(grams == most) & (most > 0)]

    def digests(self, window: int) -> np.ndarray:
        return _joined(self.hashes, window)[self.start] if len(self.start) else self.anchor


def cells_of(anchors: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(cells - 1)
    return (anchors & mask).astype(np.int64), (mix(anchors) & mask).astype(np.int64)


def sketch(rows: DataFrame, keys: Callable, cells: int, enough: int) -> np.ndarray:
    """Bits of the cells that keys of `rows` fall into once at least, or twice (`enough`).

    `keys` gives the keys of a batch of rows; each falls into two cells. Sketches leave a
    task as the cells they count, once or more often, and are summed in the task that
    owns the block of cells.
    """
    spark = ship(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [keys(p) for b in batches for p in slices(b, 0)]
        if not found:
            return
        hit, n = np.unique(np.concatenate(cells_of(np.concatenate(found), cells)), return_counts=True)
        block = hit // BLOCK_CELLS
        own, first = np.unique(block, return_index=True)
        ends = [*first[1:], len(hit)]
        inner = (hit % BLOCK_CELLS).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(own.astype(np.int32)),
                pa.array([np.diff(inner[a:b], prepend=np.uint32(0)).tobytes() for a, b in zip(first, ends)], pa.binary()),
                pa.array([np.packbits(n[a:b] > 1).tobytes() for a, b in zip(first, ends)], pa.binary()),
            ],
            ["block", "steps", "often"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, steps, often in zip(*[c.to_pylist() for c in batch.columns]):
                at = np.cumsum(np.frombuffer(steps, np.uint32), dtype=np.int64)
                more = np.unpackbits(np.frombuffer(often, np.uint8), count=len(at))
                total = sums.setdefault(block, np.zeros(BLOCK_CELLS, np.uint8))
                total[at] = np.minimum(total[at] + 1 + more, 2)
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int32()),
                    pa.array([np.packbits(total >= enough, bitorder="little").tobytes()], pa.binary()),
                ],
                ["block", "bits"],
            )

    merged = (
        rows.mapInArrow(count, "block int, steps binary, often binary")
        .repartition("block")
        .mapInArrow(merge, "block int, bits binary")
    )
    bits = np.zeros(cells // 8, np.uint8)
    width = min(BLOCK_CELLS, cells) // 8
    for row in merged.collect():  # at most the cells of the sketch
        bits[row.block * width : (row.block + 1) * width] = np.frombuffer(row.bits, np.uint8)[:width]
    return bits


def _maybe_in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    one, two = cells_of(keys, 8 * len(bits))
    return ((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1).astype(bool)


def _bits_of(keys: DataFrame) -> np.ndarray:
    """Bits that tell which numbers are surely not in the only column of `keys`."""

    def numbers(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(batch.column(0)).view(np.uint64)

    cells = min(max(1 << (16 * keys.count()).bit_length(), LEAST_CELLS), MOST_CELLS)
    return sketch(keys, numbers, cells, 1)


def _marks(docs: DataFrame, window: int, anchor: int, cells: int | None) -> DataFrame:
    """Covered ranges of the texts `t` that have any, by the keys `h` and `g` of a text."""
    spark = docs.sparkSession
    texts = docs.select("t")
    if cells is None:
        size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        cells = 1 << (size // BYTES_A_CELL).bit_length()
    cells = min(max(cells, LEAST_CELLS), MOST_CELLS)

    def places(batch: pa.RecordBatch) -> np.ndarray:
        return Windows(batch.column(0), window, anchor).places

    bits = spark.sparkContext.broadcast(sketch(texts, places, cells, 2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch_bits = bits.value
        for batch in batches:
            for piece in slices(batch, 0):
                found = Windows(piece.column(0), window, anchor)
                keep = _maybe_in(sketch_bits, found.anchor)
                a, d = found.anchor[keep].view(np.int64), found.digests(window)[keep].view(np.int64)
                order = np.lexsort((d, a))
                a, d = a[order], d[order]
                new = np.flatnonzero(
                    np.concatenate(([True], (a[1:] != a[:-1]) | (d[1:] != d[:-1])))[: len(a)]
                )
                n = np.minimum(np.diff(np.append(new, len(a))), 2).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[new]), pa.array(d[new]), pa.array(n)], ["a", "d", "n"]
                )

    pairs = materialise(
        texts.mapInArrow(count, "a bigint, d bigint, n tinyint")
        .groupBy("a", "d")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select("a", "d"),
        "repeated-windows",
    )
    known = spark.sparkContext.broadcast(_bits_of(pairs.select("d")))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_bits, window_bits = bits.value, known.value
        for batch in batches:
            for piece in slices(batch, 2):
                found = Windows(piece.column(2), window, anchor)
                keep = np.flatnonzero(_maybe_in(anchor_bits, found.anchor))
                digest = found.digests(window)[keep]
                likely = _maybe_in(window_bits, digest)
                keep, digest = keep[likely], digest[likely].view(np.int64)
                if not len(keep):
                    continue
                start, a = found.start[keep], found.anchor[keep]
                row = found.words.text_of_word()[start]
                cut = (np.diff(start) != 1) | (a[1:] != a[:-1]) | (row[1:] != row[:-1])
                new = np.flatnonzero(np.concatenate(([True], cut)))
                along = np.arange(len(a)) - np.repeat(new, np.diff(np.append(new, len(a))))
                new = np.flatnonzero(along % SEGMENT == 0)
                n = np.diff(np.append(new, len(a)))
                words = mix(Stretches(found.hashes).of(start[new], n + window - 1)).view(np.int64)
                a = a[new].view(np.int64)
                # of equal segments in a slice, one tells its windows
                order = np.lexsort((n, words, a))
                other = np.concatenate(
                    ([True], (np.diff(a[order]) != 0) | (np.diff(words[order]) != 0) | (np.diff(n[order]) != 0))
                )
                silent = np.ones(len(new), bool)
                silent[order[other]] = False
                at = pa.array(row[new])
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(keep)).astype(np.int32)), pa.array(digest))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(at),
                        piece.column(1).take(at),
                        pa.array((start - found.words.first[row])[new].astype(np.int32)),
                        pa.array(a),
                        pa.array(words),
                        pa.array(n.astype(np.int32)),
                        pc.if_else(pa.array(silent), pa.nulls(len(new), lists.type), lists),
                    ],
                    ["h", "g", "start", "a", "s", "n", "windows"],
                )

    segment = ["a", "s", "n"]
    cut = materialise(
        docs.select("h", "g", "t").mapInArrow(
            segments, "h bigint, g int, start int, a bigint, s bigint, n int, windows array<bigint>"
        ),
        "segments",
    )
    for asked in (bits, known):  # each executor holds a copy on disk
        asked.destroy()
    found = (
        cut.where("windows is not null")
        .groupBy(*segment)
        .agg(F.first("windows").alias("windows"))
        .select(*segment, F.posexplode("windows").alias("at", "d"))
        .join(pairs, ["a", "d"], "left_semi")
        .groupBy(*segment)
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("hits"))  # a bit for each of SEGMENT windows
    )
    hits = F.filter(F.sequence(F.lit(0), F.lit(SEGMENT - 1)), lambda i: F.bit_get("hits", i) == 1)
    # the words that a segment's repeated windows cover, as ranges from its first word on
    covered = F.aggregate(
        hits,
        F.lit(None).cast("array<struct<begin:int,end:int>>"),
        lambda done, at: F.when(
            F.element_at(done, -1)["end"] >= at,
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["begin"].alias("begin"), (at + window).alias("end"))),
            ),
        ).otherwise(
            F.concat(
                F.coalesce(done, F.lit([]).cast("array<struct<begin:int,end:int>>")),
                F.array(F.struct(at.alias("begin"), (at + window).alias("end"))),
            )
        ),
    )
    return materialise(
        cut.select("h", "g", "start", *segment)
        .join(materialise(found.select(*segment, covered.alias("ranges")), "covered-segments"), segment)
        .groupBy("h", "g")  # ranges of one text, fewer than its words
        .agg(F.collect_set(F.struct("start", "ranges")).alias("marks")),
        "marks",
    )


def repeated_passages(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    cells: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_words, spans, n_removed, kept text.

    Words are runs without ASCII white space, unchanged. `spans` are the merged word
    ranges covered by windows whose words also start anywhere else, in the same
    document or another, judged on the input; `kept` is the rest, joined by one
    space. A null text has no words and an empty `kept`; a text below `window` words
    keeps all. Repeated rows are two documents that repeat each other.
    """
    if anchor > window:
        raise ValueError("an anchor must fit into a window")
    spark = docs.sparkSession
    body = named(docs, text)
    # equal for rows of equal id and text only, whose passages are the same
    keys = [F.xxhash64(named(docs, id), body).alias("h"), F.hash(named(docs, id), body).alias("g")]
    docs = docs.select(named(docs, id).alias("doc_id"), body.alias("t"), *keys)
    with shuffles_dropped(spark):
        marks = _marks(docs, window, anchor, cells)
        marked = spark.sparkContext.broadcast(_bits_of(marks.select("h")))

    def tell(texts: pa.Array, marks: list, known: list) -> list[pa.Array]:
        out: list[list] = [[], [], [], []]
        for t, ranges, told in zip(texts.cast(pa.binary()).to_pylist(), marks, known):
            if not told:
                for values in out:
                    values.append(None)
                continue
            words = (t or b"").split()
            merged: list[dict] = []
            places = ((m["start"] + r["begin"], m["start"] + r["end"]) for m in ranges or [] for r in m["ranges"])
            for begin, end in sorted(places):
                if merged and begin <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], end)
                else:
                    merged.append({"begin": begin, "end": end})
            kept, at = [], 0
            for r in merged:
                kept += words[at : r["begin"]]
                at = r["end"]
            kept += words[at:]
            for values, x in zip(out, (len(words), len(words) - len(kept), merged, b" ".join(kept))):
                values.append(x)
        return [
            pa.array(out[0], pa.int64()),
            pa.array(out[1], pa.int64()),
            pa.array(out[2], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            pa.array(out[3], pa.binary()).cast(pa.string()),
        ]

    def may_be_marked(h: pa.Array) -> np.ndarray:
        return _maybe_in(marked.value, np.asarray(h).view(np.uint64))

    def unmarked():
        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            sure = ~may_be_marked(columns[1])
            return [*tell(columns[0], [None] * len(sure), sure.tolist()), pa.array(sure)]

        return compute

    def joined():
        return lambda columns: tell(columns[0], columns[1].to_pylist(), [True] * len(columns[0]))

    def only_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1):
                yield piece.filter(pa.array(may_be_marked(piece.column(2))))

    results = {
        "n_words": "bigint",
        "n_removed": "bigint",
        "spans": "array<struct<begin:int,end:int>>",
        "kept": "string",
    }
    # only texts that may be marked travel to their marks; the others stay in their tasks
    whole = with_results(docs, ["doc_id"], [F.col("t"), F.col("h")], results | {"sure": "boolean"}, unmarked)
    met = docs.mapInArrow(only_marked, docs.schema).join(marks, ["h", "g"], "left")
    return (
        whole.where("sure")
        .drop("sure")
        .unionByName(with_results(met, ["doc_id"], [F.col("t"), F.col("marks")], results, joined))
    )
