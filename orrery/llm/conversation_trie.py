"""The prefix trie of all conversations, built as double arrays over shards of prefixes.

1. Conversations are cut into slabs of `SLAB` turns, so that none is ever held whole. A
   slab is known by its root, a 128-bit digest of all turns before it, and by the
   digests of its turns. Equal slabs are counted, not repeated.
2. Slabs are sorted by root, then turns, and dealt out in ranges: a shard of prefixes,
   however many conversations begin alike. A task numbers the turns of a block of
   slabs, packs the block's trie into BASE and CHECK arrays, and walks every slab
   through them to sum up the nodes.
3. A node may be in two shards only if it is on the first or last slab of a block.
   Those upper nodes, at most two paths a block, are merged over all shards.
4. What a node needs from its subtree comes without walking it. A node is named after its
   smallest member, and the nodes named after one conversation are a chain that ends with
   its last turn and hangs on one node of another chain. All chains above a chain are
   found by doubling; there are never more than it has turns. Totals of chains are
   added where they hang, and summed from the bottom of each chain up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.double_array import ROOT, DoubleArray
from orrery.llm.rows import named
from orrery.llm.running import running
from orrery.llm.shipping import ship
from orrery.llm.words import mix
from orrery.workspace import materialise

SLAB = 32
#: Slabs whose trie a task holds at once.
BLOCK_SLABS = 1 << 15
_DIGEST = 16
_NODE = (
    "key_a bigint, key_b bigint, depth bigint, n_convs bigint, conv_id bigint, bytes bigint,"
    " above_a bigint, above_b bigint, turn_digest binary, shared boolean, parent_conv_id bigint"
)


def turn_digest(role, text):
    """128 bits that tell a turn: its role and its text."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * _DIGEST))


def ordered_turns(
    turns: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, position from 1, digest, bytes) of every turn of a conversation with an id.

    Turns are in the order of `turn`, null first; equal ones by role, the first 32
    characters of the text, then the digest, and repeated rows are turns of their own.
    A null role or text is empty. Rows without a conversation's id are in none.
    """
    said, by = F.coalesce(named(turns, text), F.lit("")), F.coalesce(named(turns, role), F.lit(""))
    rows = turns.select(
        named(turns, conv).cast("long").alias("conv_id"),
        named(turns, turn).alias("turn"),
        F.left(by, F.lit(32)).alias("role"),
        F.left(said, F.lit(32)).alias("begins"),
        turn_digest(by, said).alias("digest"),
        F.octet_length(said).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),  # lets equal rows be dealt apart
    ).where("conv_id is not null")
    order = [F.col("turn").asc_nulls_first(), "role", "begins", "digest", "row"]
    return running(rows, "conv_id", order, ["one"], _ones).select(
        "conv_id", F.col("one_run").alias("position"), "digest", "bytes"
    )


def _ones(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.ones(batch.num_rows, np.int64)]


def _terms(digests: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """For each turn (row of two numbers) at a depth two numbers whose exclusive ors tell prefixes."""
    salt = mix(depth.astype(np.uint64))
    return np.stack([mix(digests[:, 0] + salt), mix(digests[:, 1] ^ mix(salt))], 1)


def _turns_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The digests of all slabs' turns as rows of two numbers, and the number of each slab's."""
    values = column.to_pylist()
    lengths = np.array([len(v) // _DIGEST for v in values], np.int64)
    return np.frombuffer(b"".join(values), ">u8").astype(np.uint64).reshape(-1, 2), lengths


def _within(lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _slab_digests(batch: pa.RecordBatch) -> list[np.ndarray]:
    turns, lengths = _turns_of(batch.column("path"))
    slab = np.asarray(batch.column("slab")).astype(np.int64)
    terms = _terms(turns, np.repeat(slab * SLAB, lengths) + _within(lengths) + 1)
    starts = np.cumsum(lengths) - lengths  # no slab is empty
    return list(np.bitwise_xor.reduceat(terms, starts, axis=0).view(np.int64).T.copy())


def _block(rows: pa.Table) -> pa.RecordBatch:
    """The nodes of the trie of a block of sorted, distinct slabs."""
    turns, lengths = _turns_of(rows.column("path").combine_chunks())
    n = len(lengths)
    root = np.stack([np.asarray(rows.column(c)).astype(np.int64).view(np.uint64) for c in ("root_a", "root_b")], 1)
    slab = np.asarray(rows.column("slab")).astype(np.int64)
    # dense numbers of roots and of turns
    _, root_code = np.unique(root, axis=0, return_inverse=True)
    _, turn_code = np.unique(turns, axis=0, return_inverse=True)
    code = np.full((n, 1 + int(lengths.max())), -1, np.int64)
    row, column = np.repeat(np.arange(n), lengths), _within(lengths)
    code[:, 0] = root_code.ravel()
    code[row, column + 1] = turn_code.ravel() + 1 + root_code.max()
    trie = DoubleArray(code)

    cells = len(trie.check)
    terms = np.zeros((n, code.shape[1], 2), np.uint64)
    terms[row, column + 1] = _terms(turns, slab[row] * SLAB + column + 1)
    terms[:, 0] = root
    keys = np.bitwise_xor.accumulate(terms, axis=1)
    sizes = np.zeros(code.shape, np.int64)
    sizes[row, column + 1] = np.asarray(rows.column("sizes").combine_chunks().flatten())
    flat = np.zeros(code.shape, np.int64)
    flat[row, column + 1] = np.arange(len(row))
    members = np.asarray(rows.column("n")).astype(np.int64)
    least = np.asarray(rows.column("conv_id")).astype(np.int64)
    n_convs = np.zeros(cells, np.int64)
    conv = np.full(cells, np.iinfo(np.int64).max)
    depth, size, turn = np.zeros((3, cells), np.int64)
    key, shared = np.zeros((cells, 2), np.uint64), np.zeros(cells, bool)
    is_root = np.zeros(cells, bool)
    at = np.full(n, ROOT)
    for d in range(code.shape[1]):
        on = np.flatnonzero(code[:, d] >= 0)
        at[on] = trie.step(at[on], code[on, d])
        here = at[on]
        np.add.at(n_convs, here, members[on])
        np.minimum.at(conv, here, least[on])
        key[here], size[here], turn[here] = keys[on, d], sizes[on, d], flat[on, d]
        depth[here] = slab[on] * SLAB + d
        shared[at[[0, -1]][code[[0, -1], d] >= 0]] = True
        is_root[here] = d == 0
    found = np.flatnonzero((trie.check > 0) & ~is_root)
    above = trie.check[found]
    known = ~shared[above] & ~is_root[above]
    digests = np.ascontiguousarray(turns[turn[found]].astype(">u8")).tobytes()
    signed = key.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            *[pa.array(x) for x in (signed[found, 0], signed[found, 1], depth[found], n_convs[found], conv[found], size[found])],
            pa.array(signed[above, 0]),
            pa.array(signed[above, 1]),
            pa.array([digests[i : i + _DIGEST] for i in range(0, len(digests), _DIGEST)], pa.binary()),
            pa.array(shared[found]),
            pa.array(conv[above], mask=~known),
        ],
        [c.split()[0] for c in _NODE.split(", ")],
    )


def _tries(size: int):
    """Turns sorted slabs into the nodes of one trie for every `size` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, room = [], size
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, room)
                block.append(part)
                batch, room = batch.slice(part.num_rows), room - part.num_rows
                if not room:
                    yield _block(pa.Table.from_batches(block))
                    block, room = [], size
        if block:
            yield _block(pa.Table.from_batches(block))

    return run


def _slabs(turns: DataFrame) -> DataFrame:
    """(conv_id, slab, path, sizes) and digests: of the slab, and of all turns to its end (_run)."""
    slabs = (
        turns.groupBy("conv_id", F.expr(f"(depth - 1) div {SLAB}").alias("slab"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("turns"))
        .select(
            "conv_id",
            "slab",
            F.aggregate("turns", F.lit(b""), lambda path, t: F.concat(path, t["digest"])).alias("path"),
            F.transform("turns", lambda t: t["bytes"]).alias("sizes"),
        )
    )
    return running(slabs, "conv_id", ["slab"], ["a", "b"], _slab_digests, xor=True)


def _nodes(slabs: DataFrame, conversations: int, smallest: int | None, block: int) -> DataFrame:
    """All nodes with the smallest member of their parents."""
    spark = ship(slabs.sparkSession)
    order = ["slab", "root_a", "root_b", "path"]
    paths = (
        slabs.select(
            "conv_id",
            "slab",
            F.col("a_run").bitwiseXOR(F.col("a")).alias("root_a"),
            F.col("b_run").bitwiseXOR(F.col("b")).alias("root_b"),
            "path",
            "sizes",
        )
        .groupBy(*order)
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("sizes").alias("sizes"))
    )
    found = materialise(
        paths.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_tries(block), _NODE), "trie-shards"
    )
    rest = ["depth", "bytes", "above_a", "above_b", "turn_digest", "shared", "parent_conv_id"]
    merged = (
        found.where("shared")
        .groupBy("key_a", "key_b")
        .agg(
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            *[F.first(c).alias(c) for c in rest],
        )
        .select(found.columns)
    )
    nodes = materialise(found.where("not shared").union(merged), "trie-nodes")
    known = nodes.where(f"shared or depth % {SLAB} = 0").select(
        F.col("key_a").alias("above_a"), F.col("key_b").alias("above_b"), F.col("conv_id").alias("found")
    )
    open_nodes = nodes.where("depth > 1 and parent_conv_id is null")
    told = open_nodes.join(known, ["above_a", "above_b"]).withColumn("parent_conv_id", F.col("found"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "bytes", "turn_digest", "key_a", "key_b"]
    first = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(smallest).cast("long"))
    rest = nodes.where("parent_conv_id is not null")
    root = spark.createDataFrame(
        [(smallest, 0, None, conversations, 0, None, 0, 0)],
        "conv_id long, depth long, parent_conv_id long, n_convs long, bytes long,"
        " turn_digest binary, key_a long, key_b long",
    )
    return materialise(
        root.union(first.select(columns)).union(rest.select(columns)).union(told.select(columns)), "trie"
    )


def _above(tops: DataFrame) -> DataFrame:
    """(r, p, a): all chains p that chain r hangs on, directly or not, and the depth it hangs at."""
    all_above = jump = tops
    while True:
        beyond = jump.selectExpr("r as s", "p as r")
        if beyond.join(tops.select("r"), "r", "left_semi").isEmpty():
            return all_above
        more = beyond.join(all_above, "r").selectExpr("s as r", "p", "a")
        longer = beyond.join(jump, "r").selectExpr("s as r", "p", "a")
        all_above = materialise(all_above.union(more), "chains-above")
        jump = materialise(longer, "chain-jumps")


def trie(
    turns: DataFrame, conversations: DataFrame, *, block: int = BLOCK_SLABS
) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of all conversations, and each conversation's last node.

    `turns` are (conv_id, depth, digest, bytes) with depths 1, 2, .. in each
    conversation; `conversations` has each conv_id once, also those without a turn,
    which end at the root. Nodes are conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved (bytes of last turns that more than one member
    has, once less than members, summed over the subtree), turn_digest, key_a, key_b;
    conv_id and depth tell a node, and so do both keys. Last nodes are conv_id, key_a,
    key_b. Without conversations there is no node, not even the root. A task builds one
    trie for every `block` slabs.
    """
    count, smallest = conversations.agg(F.count("*"), F.min("conv_id")).first()
    slabs = _slabs(turns)
    last = (
        slabs.selectExpr("conv_id", "slab", "a_run as key_a", "b_run as key_b")
        .union(conversations.selectExpr("conv_id", "-1L", "0L", "0L"))
        .groupBy("conv_id")
        .agg(F.max(F.struct("slab", "key_a", "key_b")).alias("last"))
        .select("conv_id", "last.key_a", "last.key_b")
    )
    nodes = _nodes(slabs, count, smallest, block)
    if not count:
        nodes = nodes.limit(0)
    saved = F.expr("(n_convs - 1) * bytes")
    tops = materialise(
        nodes.where("parent_conv_id <> conv_id").selectExpr("conv_id as r", "parent_conv_id as p", "depth - 1 as a"),
        "chain-tops",
    )
    chains = materialise(
        nodes.select("conv_id", saved.alias("saved"), "depth", F.lit(None).cast("long").alias("hung"))
        .union(tops.selectExpr("p", "0L", "null", "a"))
        .groupBy("conv_id")
        .agg(F.sum("saved").alias("saved"), F.max("depth").alias("end"), F.max("hung").alias("hung"))
        .select("conv_id", "saved", "end", F.expr("if(hung = end, 0L, 1L)").alias("leaves")),
        "chains",
    )
    hanging = _above(tops).join(chains, F.col("r") == F.col("conv_id")).select("p", "a", chains["saved"], "leaves")

    def parts(df, conv, depth, saved="0L", leaves="0L", children="0L"):
        none = ["null", "null", "null", "null", "null"]
        return df.selectExpr(conv, depth, saved, leaves, children, *none)

    own = nodes.select(
        "conv_id", "depth", saved.alias("saved"), F.lit(0).cast("long").alias("leaves"),
        F.lit(0).cast("long").alias("n_children"), "parent_conv_id", "n_convs", "turn_digest", "key_a", "key_b",
    )
    summed = (
        own.union(parts(nodes.where("depth > 0"), "parent_conv_id", "depth - 1", children="1L"))
        .union(parts(chains, "conv_id", "end", leaves="leaves"))
        .union(parts(hanging, "p", "a", "saved", "leaves"))
        .groupBy("conv_id", "depth")
        .agg(
            *[F.sum(c).alias(c) for c in ("saved", "leaves", "n_children")],
            *[F.max(c).alias(c) for c in ("parent_conv_id", "n_convs", "turn_digest", "key_a", "key_b")],
        )
        .withColumnsRenamed({"saved": "here", "leaves": "leaves_here"})
    )

    def totals(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [np.asarray(batch.column(c)).astype(np.int64) for c in ("here", "leaves_here")]

    upward = running(summed, "conv_id", [F.col("depth").desc()], ["saved", "leaves"], totals)
    return upward.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("leaves_run").alias("n_leaves"), F.col("saved_run").alias("saved"), "turn_digest", "key_a", "key_b",
    ), last


def last_turns(nodes: DataFrame, turns: DataFrame, *, role: str = "role", text: str = "text") -> DataFrame:
    """The nodes with role and text of their last turn, taken from `turns`; null at the root."""
    said, by = F.coalesce(named(turns, text), F.lit("")), F.coalesce(named(turns, role), F.lit(""))
    told = turns.select(turn_digest(by, said).alias("turn_digest"), by.alias("role"), said.alias("text"))
    distinct = told.groupBy("turn_digest").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    return nodes.join(distinct, "turn_digest", "left")
