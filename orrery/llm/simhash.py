"""SimHash near-duplicates: vantage-point trees over the blocks of 64-bit fingerprints.

Fingerprints that differ in at most `RADIUS` bits differ in at most one bit of some
16-bit block (four blocks, at most four bits). So four forests of vantage-point
trees, one per block, find every pair with a search radius of one bit:

* The upper levels of a tree divide the 65,536 values a block can take by Hamming
  distance to vantage points. Their leaves are the shards. A fingerprint lives in
  one shard per block and is asked in all shards that the triangle bound cannot
  rule out, which are those whose boundary its ball of one bit overlaps.
* Inside a shard the tree goes on down to single values, pruning the same way, and
  the pairs left are compared in full.

The tree depends only on the width of a block, so every task builds the same one.
Equal fingerprints are one class before the search. A shard's load is counted, and
a crowded one is dealt out in tiles of at most `TILE` fingerprints by `TILE`
questions; every tile holds its own part of all pairs, so nothing is left out.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.components import Forest, component_of
from orrery.llm.rows import named, with_results
from orrery.llm.shipping import ship
from orrery.llm.words import byte_table
from orrery.workspace import materialise

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS, BLOCK_BITS = 4, 16
SHARD_LEVELS = 6
TILE = 16_384
_PAIRS_AT_ONCE = 1 << 21
_LOWER = byte_table(lower=True).tobytes()
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' XXH64; zero for a text without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(joined, SEED)
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begins = np.concatenate(([0], stops[:-shingle])).tolist()
        ends = (stops[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_digest
        digests = b"".join([digest(joined[a:b], SEED) for a, b in zip(begins, ends)])
    columns = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.concatenate(
        [np.bincount(columns[:, i], minlength=256) @ _BIT_OF_BYTE for i in range(8)]
    )
    return int.from_bytes(np.packbits(2 * counts > len(columns)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], *, text: str = "text") -> DataFrame:
    """The columns `keep` and the fingerprint of every text, as a signed 64-bit number."""

    def prepare():
        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            values = columns[0].cast(pa.binary()).to_pylist()
            codes = np.fromiter((fingerprint(t or b"") for t in values), np.uint64, len(values))
            return [pa.array(codes.view(np.int64))]

        return compute

    return with_results(docs, keep, [named(docs, text)], {"code": "bigint"}, prepare)


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Node:
    """A vantage point, the distance that halves its values, and the two halves."""

    __slots__ = ("shard", "values", "vantage", "bound", "near", "far")

    def __init__(self, values: np.ndarray, level: int, shards: list):
        self.shard = -1
        if level == 0:
            self.shard = len(shards)
            shards.append(self)
        self.values = values
        self.near = None
        if len(values) <= 4:
            return
        self.vantage = values[0]
        distance = _distance(values, self.vantage)
        self.bound = int(np.median(distance))
        if (distance <= self.bound).all():
            self.bound -= 1
        near = distance <= self.bound
        if near.all() or not near.any():
            return
        self.near = Node(values[near], level - 1, shards)
        self.far = Node(values[~near], level - 1, shards)

    def leaves(self, asked: np.ndarray, rows: np.ndarray, radius: int, to_shard: bool):
        """(leaf, rows of `asked`) for each leaf that the triangle bound leaves over."""
        if not len(rows):
            return
        if self.near is None or to_shard and self.shard >= 0:
            yield self, rows
            return
        distance = _distance(asked[rows], self.vantage)
        yield from self.near.leaves(asked, rows[distance - radius <= self.bound], radius, to_shard)
        yield from self.far.leaves(asked, rows[distance + radius > self.bound], radius, to_shard)


@cache
def tree() -> tuple[Node, list[Node]]:
    """The tree over all values of a block, and its shards."""
    shards: list[Node] = []
    # vantage points are the first of the values, so mix their order by a fixed rule
    values = (np.arange(1 << BLOCK_BITS, dtype=np.uint64) * np.uint64(40503)) & np.uint64(0xFFFF)
    return Node(values, SHARD_LEVELS, shards), shards


@cache
def routes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By block value: its own shard; and the shards to ask, as one list with offsets."""
    root, shards = tree()
    values = np.arange(1 << BLOCK_BITS, dtype=np.uint64)
    home = np.zeros(len(values), np.int64)
    for leaf, rows in root.leaves(values, np.arange(len(values)), 0, True):
        home[rows] = leaf.shard
    value, shard = [], []
    for leaf, rows in root.leaves(values, np.arange(len(values)), 1, True):
        value.append(rows)
        shard.append(np.full(len(rows), leaf.shard))
    value, shard = np.concatenate(value), np.concatenate(shard)
    order = np.lexsort((shard, value))
    return home, shard[order], np.searchsorted(value[order], np.arange(len(values) + 1))


def block_of(codes: np.ndarray, block: int) -> np.ndarray:
    return (codes >> np.uint64(BLOCK_BITS * block)) & np.uint64(0xFFFF)


def search_tile(block: int, shard: int, homes: np.ndarray, asked: np.ndarray, radius: int):
    """Pairs (home, asked), home below asked, within `radius` bits; in parts of bounded size."""
    _, shards = tree()
    home_value, home_at = np.unique(block_of(homes, block), return_inverse=True)
    ask_value, ask_at = np.unique(block_of(asked, block), return_inverse=True)
    home_rows, ask_rows = np.argsort(home_at, kind="stable"), np.argsort(ask_at, kind="stable")
    home_first = np.searchsorted(home_at[home_rows], np.arange(len(home_value) + 1))
    ask_first = np.searchsorted(ask_at[ask_rows], np.arange(len(ask_value) + 1))
    asks_, homes_ = [], []
    for leaf, rows in shards[shard].leaves(ask_value, np.arange(len(ask_value)), 1, False):
        here = np.flatnonzero(np.isin(home_value, leaf.values))
        close = _distance(ask_value[rows][:, None], home_value[here][None, :]) <= 1
        q, h = np.nonzero(close)
        asks_.append(rows[q])
        homes_.append(here[h])
    if not asks_:
        return
    q, h = np.concatenate(asks_), np.concatenate(homes_)
    if not len(q):
        return
    n_ask, n_home = np.diff(ask_first)[q], np.diff(home_first)[h]
    # rows of two values against each other: many small pairs of values at once, a large one in parts
    group = np.cumsum(n_ask * n_home) // _PAIRS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(q)]
    for i, j in zip(cuts, cuts[1:]):
        size = n_ask[i:j] * n_home[i:j]
        end = np.cumsum(size)
        for at in range(0, int(end[-1]), _PAIRS_AT_ONCE):
            stop = min(at + _PAIRS_AT_ONCE, int(end[-1]))
            # the pairs of values that this part meets, the first and last perhaps in part only
            lo, hi = np.searchsorted(end, [at, stop - 1], side="right") + [0, 1]
            take = np.minimum(end[lo:hi], stop) - np.maximum((end - size)[lo:hi], at)
            part = np.repeat(np.arange(lo, hi), take)
            inner = np.arange(at, stop) - (end - size)[part]
            part += i
            mine = homes[home_rows[home_first[h[part]] + inner // n_ask[part]]]
            theirs = asked[ask_rows[ask_first[q[part]] + inner % n_ask[part]]]
            near = (mine < theirs) & (np.bitwise_count(mine ^ theirs) <= radius)
            if near.any():
                yield mine[near], theirs[near]


def linked(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join the distinct `code`s into the components of all close pairs.

    Each tile sends only the links of a spanning forest of its pairs.
    """
    if not 0 <= radius <= 2 * BLOCKS - 1:
        raise ValueError("four blocks searched at one bit find pairs of up to seven bits")
    spark = ship(codes.sparkSession)

    def place(frames):
        home, shard, first = routes()
        for frame in frames:
            value = frame["code"].to_numpy().view(np.uint64)
            for block in range(BLOCKS):
                part = block_of(value, block).astype(np.int64)
                many = first[part + 1] - first[part]
                row = np.repeat(np.arange(len(part)), many)
                at = first[part][row] + np.arange(len(row)) - (np.cumsum(many) - many)[row]
                shard_of = np.concatenate([home[part], shard[at]])
                yield pd.DataFrame(
                    {
                        "unit": shard_of * BLOCKS + block,
                        "asks": np.repeat([False, True], [len(part), len(row)]),
                        "code": np.concatenate([frame["code"].to_numpy(), frame["code"].to_numpy()[row]]),
                    }
                )

    placed = materialise(
        codes.mapInPandas(place, "unit long, asks boolean, code long"), "fingerprint-shards"
    )
    # at most two counts for each of the shards, whose number is fixed
    load = {
        (r.unit, r.asks): -(-r["count"] // TILE)
        for r in placed.groupBy("unit", "asks").count().collect()
    }
    tiles = spark.createDataFrame(
        [
            (unit, asks, n, load.get((unit, not asks), 0))
            for (unit, asks), n in load.items()
        ],
        "unit long, asks boolean, own long, other long",
    )
    dealt = (
        placed.join(F.broadcast(tiles), ["unit", "asks"])
        .withColumn("mine", F.pmod(F.xxhash64("code"), "own"))
        .where("other > 0")
        .withColumn("theirs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other") - 1)))
        .select(
            "unit",
            F.expr("if(asks, theirs, mine)").alias("h"),
            F.expr("if(asks, mine, theirs)").alias("q"),
            "asks",
            "code",
        )
    )

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        unit = int(frame["unit"].iloc[0])
        value = frame["code"].to_numpy().view(np.uint64)
        asks = frame["asks"].to_numpy(bool)
        forest = Forest(value.view(np.int64))
        for a, b in search_tile(unit % BLOCKS, unit // BLOCKS, value[~asks], value[asks], radius):
            forest.join(a.view(np.int64), b.view(np.int64))
        a, b = forest.links()
        return pd.DataFrame({"a": a, "b": b})

    return dealt.groupBy("unit", "h", "q").applyInPandas(search, "a long, b long")


def row_key(id: Column, text: Column) -> tuple[Column, Column]:
    """96 bits that are equal for rows of equal id and text, nulls included."""
    return F.xxhash64(id, text), F.hash(id, text)


def near_duplicates(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
) -> DataFrame:
    """One row per document: doc_id, code (signed fingerprint), component_id, its `row_key`, component_code.

    Words are runs without ASCII white space, A-Z lower-cased; shingles are
    `SHINGLE` words joined by a space, repeats included; a shorter text is one
    shingle, a null, empty or blank text has the fingerprint zero and links like
    any other. Documents whose fingerprints differ in at most `radius` bits are
    linked, and a component is named after the smallest id that links reach. A
    null id never names a component unless no other id is in it; component_code, the
    smallest fingerprint of a component, tells those apart too. Rows that repeat an id
    each get their row.
    """
    read = docs.select(
        named(docs, id).alias("doc_id"),
        named(docs, text).alias("t"),
        *[c.alias(f"key{i}") for i, c in enumerate(row_key(named(docs, id), named(docs, text)))],
    )
    stored = materialise(fingerprints(read, ["doc_id", "key0", "key1"], text="t"), "fingerprints")
    classes = stored.groupBy("code").agg(F.min("doc_id").alias("doc_id"))
    edges = linked(classes.select("code"), radius)
    found = component_of(edges)  # only codes with a link
    named_by = (
        found.join(classes, found.node == classes.code)
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
    )
    linked_codes = found.join(named_by, "component").select("node", "component", "component_id")
    # stored, so that both sides of the last join are exchanges whose hot codes can be split
    every = materialise(
        classes.join(linked_codes, classes.code == linked_codes.node, "left").select(
            "code",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce("component", "code").alias("component_code"),
        ),
        "fingerprint-components",
    )
    return stored.join(every, "code").select(
        "doc_id", "code", "component_id", "key0", "key1", "component_code"
    )
