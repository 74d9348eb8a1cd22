"""Running a column function over Arrow batches, whatever the input's other columns are called."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.shipping import ship

#: Bytes of text handled at once inside a task; a longer document is handled alone.
CHUNK_BYTES = 1 << 20

Compute = Callable[[list[pa.Array]], list[pa.Array]]


def named(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return df["`" + name.replace("`", "``") + "`"]


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def slices(batch: pa.RecordBatch, at: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `limit` bytes of its column `at`, rows kept whole."""
    column = batch.column(at)
    if not batch.num_rows:
        return
    sizes = np.zeros(batch.num_rows, np.int64)
    kind = column.type
    if any(is_(kind) for is_ in (T.is_string, T.is_binary, T.is_large_string, T.is_large_binary)):
        sizes = np.asarray(pc.binary_length(column).fill_null(0), np.int64)
    piece = np.cumsum(sizes + 16) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


def with_results(
    df: DataFrame,
    keep: list[str],
    inputs: list[Column],
    results: dict[str, str],
    prepare: Callable[[], Compute],
) -> DataFrame:
    """The columns `keep` of `df`, then the columns `results` (name to type) computed from `inputs`.

    `prepare` runs once in every task and gives the function from input arrays to
    result arrays. Columns travel under numbers, so no name can clash on the way;
    a result whose name is also kept must be chosen by position by the caller.
    """
    ship(df.sparkSession)
    sent = df.select(
        *[named(df, c).alias(f"k{i}") for i, c in enumerate(keep)],
        *[c.alias(f"i{i}") for i, c in enumerate(inputs)],
    )
    kept = len(keep)
    names = [f"k{i}" for i in range(kept)] + [f"r{i}" for i in range(len(results))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = prepare()
        for batch in batches:
            for piece in slices(batch, kept):
                columns = piece.columns
                yield pa.RecordBatch.from_arrays(
                    [*columns[:kept], *compute(columns[kept:])], names
                )

    kinds = [f"k{i} {sent.schema[i].dataType.simpleString()}" for i in range(kept)]
    kinds += [f"r{i} {kind}" for i, kind in enumerate(results.values())]
    out = sent.mapInArrow(run, ", ".join(kinds))
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(f"r{i}").alias(c) for i, c in enumerate(results)],
    )
