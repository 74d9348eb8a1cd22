"""Documents to clean, tokenised training text, stage by stage.

Every stage reads all rows that the stage before it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import decontamination, language_id, pieces, pii, simhash
from orrery.llm.rows import named, table
from orrery.workspace import materialise

#: Share of a document's n-grams that its best language must know.
MIN_SCORE = 0.15

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _numbered(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def _restored(df: DataFrame, columns: list[str]) -> DataFrame:
    """The first columns of a numbered frame, under these names."""
    return df.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def in_a_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or with hardly any n-gram of a known language.

    The model learns from the labelled documents given. Without any label nothing
    can be told, and only documents without a letter go.
    """
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.coalesce(named(docs, "text").rlike(r"\p{L}"), F.lit(False)))
    found = _numbered(language_id.predict(docs, model, docs.columns))
    n = len(docs.columns)
    known = (F.col(f"c{n}") != language_id.UNKNOWN) & (F.col(f"c{n + 1}") >= MIN_SCORE)
    return _restored(found.where(known), docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep, of documents linked by near-equal fingerprints, the one with the smallest id.

    Of several texts with that id, and where no document of a group has an id, the one
    whose hash is the smallest stays. Rows that repeat the kept one's id and text are the
    same document and stay as one row.
    """
    found = simhash.near_duplicates(docs)
    first = (
        found.groupBy("component_code")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key0", "key1")).alias("first"))
        .select("first.key0", "first.key1")
    )
    n = len(docs.columns)
    rows = _numbered(
        docs.select("*", *simhash.row_key(named(docs, "doc_id"), named(docs, "text")))
    )
    keys = (F.col(f"c{n}") == F.col("key0")) & (F.col(f"c{n + 1}") == F.col("key1"))
    kept = rows.join(first, keys, "left_semi").dropDuplicates([f"c{n}", f"c{n + 1}"])
    return _restored(kept, docs.columns)


def without_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents; one with fewer hits stays as it is."""
    found = _numbered(
        decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    )
    n = len(docs.columns)
    dirty = decontamination.is_contaminated(F.col(f"c{n + 1}"), F.col(f"c{n}"))
    return _restored(found.where(~dirty), docs.columns)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the pseudonymised text in place of the text, and its length in place of the length."""
    found = _numbered(pii.pseudonymise(docs))
    text = F.col(f"c{len(docs.columns)}")
    put = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(
        *[put.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)]
    )


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids; every text decodes from them again."""
    keep = [c for c in docs.columns if c not in pieces.RESULTS]
    return pieces.tokenise(docs, keep)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", in_a_known_language),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark_text),
    ("pii_pseudonyms", with_pseudonyms),
    ("sentencepiece", as_pieces),
]

#: Fingerprints, a fitted language model and tokens are beyond SQL; a brute-force test compares.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
