"""Encoding to and from the pieces of a SentencePiece vocabulary.

An Aho-Corasick automaton over all pieces reads a text once; at each position its
output links give every piece that ends there, longest first, and each relaxes the
best score of that position. The best segmentation is the one whose piece scores
have the largest sum, also for a vocabulary that was made by merges.

Blanks are written as the piece mark and one blank is put in front of a text, as
SentencePiece does. A character without a piece, the mark itself included, becomes
its UTF-8 bytes, so decoding restores every text exactly. No piece holds the mark
after another character, so a text falls into independent parts before each run of
blanks; equal parts are scored once. A vocabulary with other pieces is read whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from orrery.llm.rows import named, with_results

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Parts of texts whose pieces a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 500_000, 48
#: How much worse than the worst piece a character without a piece is.
UNKNOWN_PENALTY = 10.0
RESULTS = {"ids": "array<int>", "n_tokens": "bigint", "round_trip": "boolean"}


class Pieces:
    def __init__(self, serialized: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=serialized)
        self.automaton = ahocorasick.Automaton()
        self.byte_ids: list[int] = [-1] * 256
        self.spelling: list[bytes] = []
        worst = 0.0
        normal: list[str] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.spelling.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.spelling.append(b"")
            else:
                self.spelling.append(piece.replace(MARK, " ").encode())
                score = model.get_score(i)
                self.automaton.add_word(piece, (i, len(piece), score))
                normal.append(piece)
                if score > -1e8:
                    worst = min(worst, score)
        if -1 in self.byte_ids:
            raise ValueError("the vocabulary has no pieces for single bytes")
        self.automaton.make_automaton()
        self.single = {p for p in normal if len(p) == 1}
        self.unknown = worst - UNKNOWN_PENALTY
        apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal)
        alone = "".join(c for c in "\n\t" if not any(c in p for p in normal))
        rest = f"[^ {alone}]"
        self.parts = re.compile(f" *{rest}+| +|[{alone}]" if alone else f" *{rest}+| +") if apart else None
        self.remembered: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """The ids of the best segmentation of `text`, in which blanks stand for the mark.

        Of equal scores the longest last piece wins. Only a character without a
        piece of its own may be left to its bytes.
        """
        n = len(text)
        score = [0.0] + [float("-inf")] * n
        back: list[tuple | None] = [None] * (n + 1)
        # the mark as a character has no piece, so it must not meet the blank's
        marked = text.replace(MARK, "\0").replace(" ", MARK)
        bare = [i for i, c in enumerate(marked) if c not in self.single]
        bare.append(n)
        next_bare = 0
        for end, item in self.automaton.iter(marked):
            while bare[next_bare] <= end:  # pieces that end before it are all done
                self._leave(bare[next_bare], score, back)
                next_bare += 1
            length = item[1]
            if (s := score[end + 1 - length] + item[2]) > score[end + 1]:
                score[end + 1] = s
                back[end + 1] = item
        for i in bare[next_bare:-1]:
            self._leave(i, score, back)
        out: list[int] = []
        while n:
            item = back[n]
            if item is None:
                out.extend(self.byte_ids[b] for b in reversed(text[n - 1].encode()))
                n -= 1
            else:
                out.append(item[0])
                n -= item[1]
        out.reverse()
        return out

    def _leave(self, i: int, score: list[float], back: list) -> None:
        """Let the character at i be its bytes, unless a piece will cover it better."""
        score[i + 1] = score[i] + self.unknown
        back[i + 1] = None

    def _packed(self, part: str) -> bytes:
        known = self.remembered
        if (ids := known.get(part)) is None:
            ids = np.array(self.best(part), np.int32).tobytes()
            if len(part) <= LONGEST:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        text = " " + text
        if self.parts is None:
            return np.array(self.best(text), np.int32)
        known = self.remembered
        parts = self.parts.findall(text)
        packed = [known.get(p) or self._packed(p) for p in parts]
        return np.frombuffer(b"".join(packed), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        spelling = self.spelling
        return b"".join([spelling[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=4)
def _pieces(serialized: bytes) -> Pieces:
    return Pieces(serialized)


def read_model(path: str = MODEL) -> bytes:
    """The vocabulary file, read on the driver; it is far below a megabyte and is broadcast."""
    with open(path, "rb") as file:
        return file.read()


def tokenise(
    docs: DataFrame, keep: list[str], *, text: str = "text", model_path: str = MODEL
) -> DataFrame:
    """The columns `keep`, the piece ids of every text, their number, and whether they decode to it.

    An empty text has the one piece of the blank in front; a null text has null
    ids, no tokens and a null round_trip.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def prepare():
        pieces = _pieces(sent.value)

        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            texts = columns[0].to_pylist()
            ids = [None if t is None else pieces.encode(t) for t in texts]
            sizes = [0 if i is None else len(i) for i in ids]
            missing = np.array([i is None for i in ids], bool)
            values = np.concatenate([i for i in ids if i is not None] or [np.zeros(0, np.int32)])
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, mask=np.concatenate((missing, [False]))), pa.array(values)
            )
            exact = [None if i is None else pieces.decode(i) == t for i, t in zip(ids, texts)]
            return [lists, pa.array(sizes, pa.int64()), pa.array(exact, pa.bool_())]

        return compute

    return with_results(docs, keep, [named(docs, text)], RESULTS, prepare)


def decode_ids(docs: DataFrame, keep: list[str], *, ids: str = "ids", model_path: str = MODEL) -> DataFrame:
    """The columns `keep` and the text of every list of ids; a null list gives null."""
    sent = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def prepare():
        pieces = _pieces(sent.value)

        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            lists = columns[0].to_pylist()
            return [
                pa.array(
                    [None if i is None else pieces.decode(np.array(i, np.int32)) for i in lists],
                    pa.string(),
                )
            ]

        return compute

    return with_results(docs, keep, [named(docs, ids)], {"decoded": "string"}, prepare)
