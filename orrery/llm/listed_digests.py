"""SHA-256 of long lists of numbers that never meet in one row or in memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from orrery.llm.shipping import ship

#: Numbers of a list that are joined to one row.
PART = 8192


def listed_digests(df: DataFrame, keys: tuple[str, str], number: str, name: str) -> DataFrame:
    """(keys, `name`): lowercase hex digest of each key's numbers, ascending, comma-joined.

    Both keys and the number are bigint and not null. Rows are sorted by ranges of keys and
    numbers, so a long list lies in many tasks, which send it on in parts of `PART`
    numbers; a digest can only be taken in order, and reads the parts one after another.
    """
    spark = ship(df.sparkSession)
    one, two = keys

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, numbers = batch.columns
            n = batch.num_rows
            if not n:
                continue
            x, y = np.asarray(a), np.asarray(b)
            new = np.flatnonzero(np.concatenate(([True], (np.diff(x) != 0) | (np.diff(y) != 0))))
            cuts = np.unique(np.concatenate((new, np.arange(0, n, PART), [n]))).astype(np.int32)
            texts = pa.ListArray.from_arrays(pa.array(cuts), numbers.cast(pa.string()))
            at = pa.array(cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [a.take(at), b.take(at), numbers.take(at), pc.binary_join(texts, ",")], ["a", "b", "first", "part"]
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done: list[tuple] = []
            for a, b, _, part in zip(*[c.to_pylist() for c in batch.columns]):
                if (a, b) == key:
                    sha.update(b"," + part.encode())
                    continue
                if sha:
                    done.append((*key, sha.hexdigest()))
                key, sha = (a, b), hashlib.sha256(part.encode())
            yield _rows(done)
        if sha:
            yield _rows([(*key, sha.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        a, b, found = zip(*done) if done else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(found, pa.string())], [one, two, name]
        )

    return (
        df.select(one, two, number)
        .repartitionByRange(one, two, number)
        .sortWithinPartitions(one, two, number)
        .mapInArrow(join, "a bigint, b bigint, first bigint, part string")
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "first")
        .mapInArrow(digest, f"{one} bigint, {two} bigint, {name} string")
    )
