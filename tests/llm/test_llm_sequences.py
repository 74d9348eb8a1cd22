"""Conversation tries, token counts and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orrery.llm import conversation_trie, periodic_runs, queries, token_counts
from orrery.llm.double_array import ROOT, DoubleArray
from orrery.llm.listed_digests import PART, listed_digests
from orrery.llm.running import running

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- conversation tries


def plain_trie(paths):
    """{(conv_id, depth): the rest of a node's row} of {conv_id: [(role, text), ..]}."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = {}
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        out[min(inside), len(node)] = (
            min(members[node[:-1]]) if node else None,
            len(inside),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) == len(n) + 1 and m[:-1] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            sha(",".join(map(str, sorted(c for c in inside if len(paths[c]) == len(node))))),
        )
    return out


def nodes_of(spark, paths, block=conversation_trie.BLOCK_SLABS):
    rows = [(c, i, r, t) for c, path in paths.items() for i, (r, t) in enumerate(path)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    ordered = conversation_trie.ordered_turns(turns).withColumnRenamed("position", "depth")
    nodes, last = conversation_trie.trie(ordered, ids, block=block)
    ends = listed_digests(last, ("key_a", "key_b"), "conv_id", "ends")
    found = nodes.join(ends, ["key_a", "key_b"], "left").collect()
    out = {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, r.ends or sha(""))
        for r in found
    }
    assert len(out) == len(found)
    return out


def test_trie_of_branching_conversations(spark):
    rng = random.Random(4)
    paths = {c: [("u", rng.choice("ab")) for _ in range(rng.randint(0, 7))] for c in range(40, 160)}
    assert nodes_of(spark, paths) == plain_trie(paths)
    assert nodes_of(spark, paths, block=3) == plain_trie(paths)


def test_trie_of_conversations_longer_than_a_slab(spark):
    """Branches hang on branches over several slabs, one of them ends where a slab does."""
    rng = random.Random(9)
    paths = {7: [("u", f"é{i % 3}") for i in range(3 * conversation_trie.SLAB)]}
    for c in range(8, 24):
        old = paths[rng.choice(list(paths))]
        cut = rng.choice([rng.randint(0, len(old)), min(len(old), conversation_trie.SLAB)])
        paths[c] = old[:cut] + [("a", f"{c}-{i}") for i in range(rng.choice([0, 1, 40]))]
    paths[30] = []
    assert nodes_of(spark, paths, block=2) == plain_trie(paths)


def test_trie_without_turns_or_conversations(spark):
    assert nodes_of(spark, {5: [], 3: []}) == {(3, 0): (None, 2, 0, 1, 0, sha("3,5"))}
    assert nodes_of(spark, {}) == {}


def test_last_turns_of_nodes(spark):
    turns = spark.createDataFrame(
        [(1, 0, "u", "hi"), (1, 1, None, None)], "conv_id long, turn long, role string, text string"
    )
    ordered = conversation_trie.ordered_turns(turns).withColumnRenamed("position", "depth")
    nodes, _ = conversation_trie.trie(ordered, turns.select("conv_id").distinct())
    told = conversation_trie.last_turns(nodes, turns).orderBy("depth").select("role", "text").collect()
    assert [tuple(r) for r in told] == [(None, None), ("u", "hi"), ("", "")]


def test_query_on_null_tied_and_repeated_turns(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for c in [0, 1, 2, 3, 4, 6, 7, 11, 20, 23, None]:
        for _ in range(rng.randint(1, 12)):
            rows.append((c, rng.choice([None, 0, 1, 2]), rng.choice([None, "u"]), rng.choice([None, "", "x", "yy"]), 1, 2))
    rows += rows[:6]
    schema = "conv_id long, turn long, role string, text string, depth int, one int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}

    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    found = queries.op11_conversation_trie(spark, str(tmp_path)).collect()
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in found}
    assert len(got) == len(found) and got == plain_trie(paths)
    empty = spark.createDataFrame([], schema)
    empty.write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert queries.op11_conversation_trie(spark, f"{tmp_path}/none").count() == 0


def test_double_array_tells_all_rows_apart():
    rng = np.random.default_rng(3)
    for symbols in (2, 40, 5000):
        rows = np.unique(rng.integers(0, symbols, (600, 5)), axis=0)
        rows[np.arange(5)[None, :] >= rng.integers(1, 6, len(rows))[:, None]] = -1
        rows = np.unique(rows, axis=0)
        trie = DoubleArray(rows)
        prefixes = {tuple(r[: d + 1]) for r in rows.tolist() for d in range(5) if r[d] >= 0}
        cells = set()
        for prefix in prefixes:
            cell = np.array([ROOT])
            for code in prefix:
                cell = trie.step(cell, np.array([code]))
            cells.add(int(cell[0]))
        assert 0 not in cells and len(cells) == len(prefixes) == (trie.check > 0).sum()
        assert not trie.step(np.array([ROOT]), np.array([symbols + 7]))[0]


@pytest.mark.parametrize("xor", [False, True])
def test_running_totals_of_a_hot_group(spark, xor):
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, id % 40, 7L) as g", "id as o", "id * 7919 as v").repartition(6)

    def values(batch):
        return [np.asarray(batch.column("v")).astype(np.int64)]

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running(rows, "g", ["o"], ["x"], values, xor=xor).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    total = {}
    for r in sorted(found, key=lambda r: (r.g, r.o)):
        old = total.get(r.g, 0)
        total[r.g] = old ^ r.x if xor else old + r.x
        assert r.x == r.v and r.x_run == total[r.g]
    assert len(found) == 4000


def test_digests_of_long_lists(spark):
    n = 3 * PART + 5
    rows = spark.range(n).selectExpr("1L as a", "if(id < 2, id, 5L) as b", "id as c").repartition(5)
    found = {r.b: r.d for r in listed_digests(rows, ("a", "b"), "c", "d").collect()}
    assert found == {0: sha("0"), 1: sha("1"), 5: sha(",".join(map(str, range(2, n))))}


# --- token counts

ODD_TEXTS = [
    "<|endoftext|>", "a<|endoftext|>b<|startoftext|><|endo", "ΑΣ ΣΑΣ", "é é ́ x́y", "日本語のテキスト" * 20,
    "🙂🙂 \x00 \x1c a\x1cb c", "don't we'll I'M 'S", "aaa aaaaa aaaaaaa", "İstanbul ǅ ﬁ", "　a\u0085b", "4５６",
]


def test_token_counts_equal_the_library(spark, documents, odd):
    library = Tokenizer.from_file(token_counts.MODEL)
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    docs = documents.select("doc_id", "text").union(odd.select("doc_id", "text")).union(extra)
    found = token_counts.count_tokens(docs, ["doc_id", "text"]).collect()
    assert len(found) == docs.count()
    for r in found:
        text = r.text or ""
        assert r.n_bytes == len(text.encode())
        assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_merging_in_step_equals_one_pair_at_a_time():
    words = token_counts.vocabulary(token_counts.read_model())
    rank = dict(zip(words.pair.tolist(), words.rank.tolist()))
    rng = random.Random(8)
    rows = [[rng.randrange(64, 90) for _ in range(rng.randint(0, 30))] for _ in range(300)] + [[70] * 29, []]

    def plain(row):
        while len(row) > 1:
            ranks = [rank.get(a * words.size + b, 1 << 40) for a, b in zip(row, row[1:])]
            if min(ranks) == 1 << 40:
                break
            i = ranks.index(min(ranks))
            row = [*row[:i], int(words.made[ranks[i]]), *row[i + 2 :]]
        return len(row)

    flat = np.array([s for r in rows for s in r], np.int64)
    assert words.merged(flat, np.array([len(r) for r in rows])).tolist() == [plain(r) for r in rows]


def test_token_counts_keep_columns_and_take_no_rows(spark, odd):
    found = token_counts.count_tokens(odd, odd.columns)
    assert found.columns == [*odd.columns, "n_bytes", "n_tokens"] and found.count() == odd.count()
    assert token_counts.count_tokens(odd.where("false"), ["doc_id"]).count() == 0


# --- periodic runs


def plain_runs(words):
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                seen.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e - s) for (s, e), q in seen.items())


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    told = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(runs), *told, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(kept))


def test_periodic_run_query_equals_plain_search(spark, documents, tmp_path):
    rng = random.Random(6)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect() if len(r.text or "") < 4000]
    for i in range(10_000, 10_080):
        k = rng.choice([1, 2, 3, 60])
        words = [f"w{rng.randrange(k)}" for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            unit = [f"w{rng.randrange(k)}" for _ in range(rng.randint(1, 45))]
            at = rng.randint(0, len(words))
            words[at:at] = (unit * 6)[: rng.randint(1, 6) * len(unit) + rng.randint(0, 2)]
        rows.append((i, "\t".join(words)))
    rows += [(None, None), (None, "a b " * 9), (1, None), (2, ""), (3, " \n"), rows[0], (4, "é " * 3000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(plain_row(*r)) for r in rows)
    assert sum(r.n_runs > 0 for r in found) > 60


def test_planted_runs_are_found_in_whole_documents(spark):
    found = queries.op13_periodic_runs(spark, SMALL)
    planted = found.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    assert planted.where("exponent_milli >= 4000").count() >= 0.5 * planted.count() > 0


def test_runs_are_planted_without_a_list_of_words(spark):
    """Texts of 20,000 words were lists of strings in the executors, twice over."""
    chosen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = ["a", " a\t\x0b b ", "\u00a0 é\x0c\x0d\x1c z ", "x y z", " ".join(f"w{j}" for j in range(20_000))]
    rows = [(i, " " * (k % 3) + " \n".join([texts[k % 5], *"bcdefghi"[: k % 9]])) for k, i in enumerate(chosen)]
    rows += [(chosen[0], None), (chosen[1], ""), (chosen[2], " \t"), (1, " not  chosen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = queries.with_planted_runs(docs)

    def planted(i, text):
        words, h = (text or "").encode().split(), zlib.crc32(str(i).encode())
        if h % 10 or not words:
            return text
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        return b" ".join(words[j if j < a else a + (j - a) % p] for j in range(len(words))).decode()

    assert sorted(repr(tuple(r)) for r in found.collect()) == sorted(repr((i, planted(i, t))) for i, t in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("regexp_extract_all|transform|split|lambda", plan)


def test_runs_survive_misleading_hashes():
    x = np.array([2, 4, 6, 2, 4, 6, 2, 4, 6, 2, 4, 6, 8], np.uint64)
    assert periodic_runs._exact(x, 0, 12, 3, 1) == (0, 12, 3)
    assert periodic_runs._exact(x, 0, 13, 3, 1) == (0, 12, 3)
    assert periodic_runs._exact(x, 0, 13, 5, 1) == (0, 0, 5)


def test_long_runs_take_little_time():
    for x in (np.tile(np.arange(1, 1001), 300), np.full(300_000, 4), np.arange(300_000)):
        x = np.append(x.astype(np.uint64) * np.uint64(2), np.uint64(1))
        begin, end, period = periodic_runs.find_runs(x, np.array([300_000]))
        assert len(begin) <= 1 and (end - begin >= 300_000 - 1).all()


def test_runs_keep_columns_and_take_no_rows(spark, odd):
    found = periodic_runs.collapse_runs(odd, odd.columns)
    assert found.columns == [*odd.columns, "n_words", "runs", "collapsed"] and found.count() == odd.count()
    assert periodic_runs.collapse_runs(odd.where("false"), ["doc_id"]).count() == 0
