"""Numbers of byte-pair tokens, by merging the arrays of many pre-tokens in step.

Pre-tokens lie one after another in one array of symbols. In a round, every pre-token
looks up the ranks of its neighbouring pairs, and all places of its lowest rank are
merged at once, left before right where they overlap; pre-tokens without a known pair
are done, and their symbols are counted. A merged symbol only takes part in merges of
higher rank than its own, which `Vocabulary` checks, so this is the order in which a
queue of pairs would merge.

Where no pre-token crosses a blank, a text falls into chunks at ASCII white space; equal
chunks are counted once, and a worker remembers short ones. Rules of
normalising and splitting come from the vocabulary's own file through its library.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from orrery.llm.rows import named, with_results

MODEL = public_tokenizers.path("word_bpe_49k.json")
#: Chunks of texts whose counts a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST = 400_000, 48
RESULTS = {"n_bytes": "bigint", "n_tokens": "bigint"}
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Symbols, ranks of pairs and rules of a file of the tokenizers library."""

    def __init__(self, serialized: str):
        spec = json.loads(serialized)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-pair vocabularies are read")
        if model.get("unk_token") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("vocabularies with an unknown token or whole-word look-up are not read")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = 1 + max(self.ids.values())
        left = np.array([self.ids[a] for a, _ in merges], np.int64)
        right = np.array([self.ids[b] for _, b in merges], np.int64)
        made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        born = np.full(self.size, -1)
        born[made] = np.arange(len(made))
        rank = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (born[left] >= rank).any() or (born[right] >= rank).any():
            raise ValueError("a symbol that is merged before it is made has no order of ranks")
        pair = left * self.size + right
        order = np.argsort(pair)
        self.pair, self.rank, self.made = pair[order], order.astype(np.int32), made
        self.inner, self.final = self._table(""), self._table(self.suffix)
        tokenizer = Tokenizer.from_str(serialized)
        if tokenizer.pre_tokenizer is None:
            raise ValueError("vocabularies without a rule to split texts are not read")
        self.normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        for added in spec["added_tokens"]:
            if any(added[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError("added tokens are only read where they stand as they are")
            if added["content"].split() != [added["content"]]:
                raise ValueError("an added token holds white space")
        added = sorted((a["content"] for a in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.remembered: dict[bytes, int] = {}
        self.apart = self._pieces("a b") == self._pieces("a") + self._pieces("b")

    def _pieces(self, text: str) -> list[str]:
        return [piece for piece, _ in self.split(self.normal(text))]

    def _table(self, suffix: str) -> np.ndarray:
        """The id of each character followed by the suffix, by code point; -1 where there is none."""
        n = len(suffix)
        single = {ord(s[0]): i for s, i in self.ids.items() if len(s) == n + 1 and s.endswith(suffix)}
        table = np.full(1 + max(single, default=0), -1, np.int64)
        table[list(single)] = list(single.values())
        return table

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, pair), max(len(self.pair) - 1, 0))
        if not len(self.pair):
            return np.full(len(pair), _NONE, np.int32)
        return np.where(self.pair[at] == pair, self.rank[at], _NONE).astype(np.int32)

    def sizes(self, tokens: list[str]) -> np.ndarray:
        """How many symbols are left of each pre-token.

        Symbols are its characters, the last one with the end of a word; a character
        without an id has none.
        """
        lengths = np.array([len(t) for t in tokens], np.int64)
        points = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols = self._ids(points, self.inner)
        last = np.cumsum(lengths) - 1
        symbols[last] = self._ids(points[last], self.final)
        known = symbols >= 0
        owner = np.repeat(np.arange(len(tokens)), lengths)
        return self.merged(symbols[known], np.bincount(owner[known], minlength=len(tokens)))

    @staticmethod
    def _ids(points: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.where(points < len(table), table[np.minimum(points, len(table) - 1)], -1)

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Lengths of the ragged rows of `symbols` after all merges."""
        out = lengths.copy()
        row = np.flatnonzero(lengths > 1)
        symbols = symbols[np.repeat(lengths > 1, lengths)]
        lengths = lengths[row]
        ranks = self._open(symbols, lengths)
        while len(row):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == _NONE
            if done.any():
                out[row[done]] = lengths[done]
                stay = np.repeat(~done, lengths)
                symbols, ranks = symbols[stay], ranks[stay]
                row, lengths, lowest = row[~done], lengths[~done], lowest[~done]
                if not len(row):
                    break
            hit = ranks == np.repeat(lowest, lengths)
            hit &= ranks != _NONE
            at = np.flatnonzero(hit)
            # of places that share a symbol, every second one from the left
            chain = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
            along = np.arange(len(at)) - np.repeat(chain, np.diff(np.append(chain, len(at))))
            at = at[along % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            where = np.cumsum(stay) - 1
            lengths = lengths - np.bincount(
                np.repeat(np.arange(len(row)), lengths)[at], minlength=len(row)
            )
            # the slot of a pair is its left symbol; the last slot of a row has none
            new = where[at]
            symbols, ranks = symbols[stay], ranks[stay]
            last = np.cumsum(lengths) - 1
            ends_row = np.zeros(len(symbols), bool)
            ends_row[last] = True
            changed = np.unique(np.concatenate((new, new[new > 0] - 1)))
            changed = changed[~ends_row[changed]]
            ranks[changed] = self.ranks(symbols[changed], symbols[changed + 1])
            ranks[last] = _NONE
        return out

    def _open(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ranks = np.full(len(symbols), _NONE, np.int32)
        if len(symbols):
            ranks[:-1] = self.ranks(symbols[:-1], symbols[1:])
            ranks[np.cumsum(lengths) - 1] = _NONE
        return ranks

    def count_chunks(self, chunks: list[bytes]) -> np.ndarray:
        """Tokens of each chunk, a text without ASCII white space."""
        added = np.zeros(len(chunks), np.int64)
        tokens: dict[str, int] = {}
        owner: list[int] = []
        token: list[int] = []
        plain: list[int] = []
        for i, chunk in enumerate(chunks):
            text = chunk.decode()
            if self.apart and text.isascii() and not (self.added and self.added.search(text)):
                plain.append(i)
                continue
            parts = [text]
            if self.added and (found := self.added.findall(text)):
                added[i] = len(found)
                parts = self.added.split(text)
            for piece in (x for part in parts if part for x in self._pieces(part)):
                owner.append(i)
                token.append(tokens.setdefault(piece, len(tokens)))
        # all chunks of ASCII as one text; what is before a blank belongs to the chunk before it
        joined = self.normal(" ".join([chunks[i].decode() for i in plain])) if plain else ""
        ends = [m.start() for m in re.finditer(" ", joined)]
        found = self.split(joined) if joined else []
        of_plain = np.searchsorted(np.array(ends, np.int64), [a for _, (a, _) in found])
        owners = np.concatenate((np.array(owner, np.int64), np.array(plain, np.int64)[of_plain]))
        token += [tokens.setdefault(piece, len(tokens)) for piece, _ in found]
        sizes = self.sizes(list(tokens))[np.array(token, np.int64)]
        return added + np.bincount(owners, sizes, len(chunks)).astype(np.int64)

    def count_texts(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts] if self.apart else [[t] for t in texts]
        known = self.remembered
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self.count_chunks(new).tolist()))
        totals = [sum(map(known.__getitem__, words)) for words in split]
        for chunk in new:
            if len(chunk) > LONGEST:
                del known[chunk]
        return totals


@lru_cache(maxsize=4)
def vocabulary(serialized: str) -> Vocabulary:
    return Vocabulary(serialized)


def read_model(path: str = MODEL) -> str:
    """The vocabulary's file, read on the driver: a few megabytes, sent to every worker."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def count_tokens(
    docs: DataFrame, keep: list[str], *, text: str = "text", model_path: str = MODEL
) -> DataFrame:
    """The columns `keep`, the UTF-8 bytes and the tokens of every text.

    Tokens are those of the library for the file at `model_path`, without a begin or
    end; the vocabulary's special strings inside a text are one token each. A null or
    empty text has none, and so has white space. Repeated rows are counted each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def prepare():
        words = vocabulary(sent.value)

        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            texts = [t or b"" for t in columns[0].cast(pa.binary()).to_pylist()]
            return [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(words.count_texts(texts), pa.int64()),
            ]

        return compute

    return with_results(docs, keep, [named(docs, text)], RESULTS, prepare)
