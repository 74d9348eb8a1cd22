"""Id-interval batches of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK_SIZE = 20_000
#: Batches whose facts share a folder. A batch is a number in a column, not a folder.
BATCHES_A_BLOCK = 500


def require_chunk_size(size: int) -> int:
    if size <= 0:
        raise ValueError(f"chunk size must be positive, got {size}")
    return size


def chunk_plan(src: DataFrame, chunk_size: int) -> DataFrame:
    """chunk_no from 1, and the interval ]from_id, to_id] of each batch.

    Intervals have equal width, so a batch over ids with gaps is short; the last
    interval may reach beyond the highest id; no source row means no batch.
    """
    require_chunk_size(chunk_size)
    highest = src.agg(F.max("order_line_id")).first()[0] or 0
    return src.sparkSession.range(0, max(highest, 0), chunk_size).select(
        (F.call_function("div", F.col("id"), F.lit(chunk_size).cast("long")) + 1).alias("chunk_no"),
        F.col("id").alias("from_id"),
        (F.col("id") + chunk_size).alias("to_id"),
    )


def chunk_number(line_id: Column, chunk_size: int) -> Column:
    """The batch a line id falls into: ]0,size] is 1, ]size,2*size] is 2, ..."""
    require_chunk_size(chunk_size)
    return F.call_function("div", line_id - 1, F.lit(chunk_size).cast("long")) + 1


def block_number(chunk_no: Column, batches_a_block: int) -> Column:
    """The block of a batch: 1 to batches_a_block are block 1, and so on."""
    return F.call_function("div", chunk_no - 1, F.lit(batches_a_block).cast("long")) + 1


def in_interval(src: DataFrame, from_id: int | None, to_id: int | None) -> DataFrame:
    """Lines with from_id < id <= to_id; a plain comparison, so it reaches the file scan."""
    if from_id is not None:
        src = src.filter(F.col("order_line_id") > F.lit(from_id).cast("long"))
    if to_id is not None:
        src = src.filter(F.col("order_line_id") <= F.lit(to_id).cast("long"))
    return src
