"""Language identification with bit-sliced Bloom filters of byte n-grams.

Every slot of the filter holds one bit for each language, so a single lookup gives
the set of all languages that contain an n-gram. A language's filter takes the
n-grams that make up at least `MIN_SHARE` of its training text; so it holds at most
1 / MIN_SHARE of them, whatever the corpus, and may be sent to all workers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.rows import named, with_results
from orrery.llm.words import byte_table, mix, text_bytes

GRAM = 4
MIN_SHARE = 2e-5
SLOTS = 1 << 20
HASHES = 3
#: About so many documents of each language are learned from: those whose id has the smallest hash.
SAMPLE_PER_LANGUAGE = 2000
UNKNOWN = "und"
_PAD = GRAM - 1
_TABLE = byte_table(lower=True)
_TABLE[[c for c in range(128) if not chr(c).isalpha()]] = 32
_BLANK = int.from_bytes(b" " * GRAM, "little")


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text between blanks, and the number of the text each is of."""
    raw, offsets = text_bytes(column)
    text = np.repeat(np.arange(len(column)), np.diff(offsets))
    data = np.full(len(raw) + _PAD * (len(column) + 1), 32, np.uint8)
    data[np.arange(len(raw)) + _PAD * (text + 1)] = _TABLE[raw]
    if len(data) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.ndarray((len(data) - GRAM + 1,), "<u4", data, strides=(1,))
    owner = np.repeat(np.arange(len(column)), np.diff(offsets) + _PAD)
    keep = np.flatnonzero(code != _BLANK)
    return code[keep].astype(np.uint64), owner[keep]


@dataclass
class Model:
    languages: list[str]  # the most frequent first, which decides ties
    slots: np.ndarray  # (SLOTS, words) of language bits
    false_share: np.ndarray  # of absent n-grams that a language's filter holds by chance

    def places(self, code: np.ndarray) -> list[np.ndarray]:
        one = mix(code + np.uint64(0x5851F42D4C957F2D))
        step = mix(one) | np.uint64(1)
        return [
            ((one + np.uint64(j) * step) & np.uint64(len(self.slots) - 1)).astype(np.int64)
            for j in range(HASHES)
        ]

    def members(self, code: np.ndarray) -> np.ndarray:
        """Language bits of each n-gram."""
        first, *rest = self.places(code)
        found = self.slots[first]
        for place in rest:
            found &= self.slots[place]
        return found

    def decide(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text, and the share of its n-grams that are of it."""
        code, owner = grams(column)
        n = np.bincount(owner, minlength=len(column)).astype(float)
        found = self.members(code)
        share = np.zeros((len(self.languages), len(column)))
        for i, wrong in enumerate(self.false_share):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            seen = np.bincount(owner, weights=bit, minlength=len(column))
            share[i] = (seen - n * wrong) / (1 - wrong) / np.maximum(n, 1)
        best = share.argmax(0)
        return best, np.clip(share[best, np.arange(len(column))], 0, 1)


def build(languages: list[str], held: list[np.ndarray]) -> Model:
    """The filter from each language's n-grams."""
    words = max(1, -(-len(languages) // 64))
    model = Model(languages, np.zeros((SLOTS, words), np.uint64), np.zeros(len(languages)))
    for i, codes in enumerate(held):
        on = np.zeros(SLOTS, bool)
        for place in model.places(codes.astype(np.uint64)):
            on[place] = True
        model.slots[on, i // 64] |= np.uint64(1 << (i % 64))
        model.false_share[i] = on.mean() ** HASHES
    return model


def fit(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE,
    min_share: float = MIN_SHARE,
) -> Model:
    """Learn from `docs`, whole texts of about `sample` documents of each language.

    Rows with a null language or text are not learned from. No usable row gives a
    model without languages.
    """
    rows = docs.select(
        named(docs, id).alias("id"), named(docs, text).alias("t"), named(docs, language).alias("l")
    ).where("t is not null and l is not null")
    sizes = {r.l: r["count"] for r in rows.groupBy("l").count().collect()}
    if not sizes:
        return build([], [])
    names = sorted(sizes, key=lambda name: (-sizes[name], name))
    limits = F.create_map(
        *[F.lit(x) for name in names for x in (name, int(1e6 * min(1, sample / sizes[name])))]
    )
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < limits[F.col("l")])

    def prepare():
        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            text, language = columns
            code, owner = grams(text)
            spoken = language.dictionary_encode()
            which = np.asarray(spoken.indices)[owner].astype(np.uint64)
            pairs, n = np.unique(which << np.uint64(32) | code, return_counts=True)
            whose = (pairs >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(whose, np.arange(len(spoken.dictionary) + 1))
            parts: list[list] = [[[], []] for _ in range(len(text))]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):  # one row of the batch a language
                parts[i] = [(pairs[a:b] & np.uint64(0xFFFFFFFF)).astype(np.int64), n[a:b]]
            labels = spoken.dictionary.to_pylist() + [None] * (len(text) - len(cuts) + 1)
            return [
                pa.array(labels, pa.string()),
                pa.array([p[0] for p in parts], pa.list_(pa.int64())),
                pa.array([p[1] for p in parts], pa.list_(pa.int64())),
            ]

        return compute

    counted = (
        with_results(
            chosen,
            [],
            [F.col("t"), F.col("l")],
            {"l": "string", "grams": "array<bigint>", "n": "array<bigint>"},
            prepare,
        )
        .where("l is not null")
        .select("l", F.explode(F.arrays_zip("grams", "n")).alias("g"))
        .groupBy("l", F.col("g.grams").alias("gram"))
        .agg(F.sum("g.n").alias("n"))
    )
    totals = counted.groupBy("l").agg(F.sum("n").alias("total"))
    frequent = counted.join(F.broadcast(totals), "l").where(F.col("n") >= F.col("total") * min_share)
    held = frequent.select("l", "gram").toPandas()  # at most 1 / min_share rows a language
    return build(names, [held.loc[held["l"] == name, "gram"].to_numpy(np.int64) for name in names])


def predict(docs: DataFrame, model: Model, keep: list[str], *, text: str = "text") -> DataFrame:
    """The columns `keep`, lang_pred and score (0 to 1) of every text.

    A null text, one without any letter, and any text under a model without
    languages is `und` with score 0. A text none of whose n-grams is known gets
    the most frequent language of the training rows with score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def prepare():
        model = sent.value

        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            column = columns[0]
            if not model.languages:
                n = len(column)
                return [pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n))]
            best, score = model.decide(column)
            raw, offsets = text_bytes(column)
            ascii_letter = np.concatenate(([0], np.cumsum((_TABLE[raw] > 32) & (raw < 128))))
            lettered = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
            for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)).tolist():
                lettered[i] = any(c.isalpha() for c in column[i].as_py() or "")
            names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            return [pa.array(names, pa.string()), pa.array(np.where(lettered, score, 0.0))]

        return compute

    return with_results(
        docs, keep, [named(docs, text)], {"lang_pred": "string", "score": "double"}, prepare
    )


def third_is_held_out(id: Column) -> Column:
    """Whether the id's checksum leaves 1 when divided by 3; never for a null id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """The documents that may be learned from; those without an id may not."""
    return docs.where(named(docs, id).isNotNull() & ~third_is_held_out(named(docs, id)))
