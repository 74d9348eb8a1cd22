"""Dense, repeatable numbers 1..n over a table of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.workspace import materialise

_ROW_BITS = 33


def dense_key(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str,
    first: int = 1,
    keep: Sequence[str] | None = None,
    spread: bool = True,
) -> DataFrame:
    """Add `name` = rank of the row under `order_by`, without gaps.

    A window without partitions would pull every row into one task. Here the rows
    are spread by ranges of the sort columns (all of them, so one hot leading value
    still splits), sorted inside each range, and written with their place in it.
    Only the row count of each range is summed up across the table: one row per
    written range, which is what makes the broadcast below bounded.

    Only the columns `keep` (all by default) are written. Without `spread` the rows lie in
    ranges of a leading part of the sort columns already, equal values together.

    The ranges are written before they are counted, so both readers see the same
    split even if an executor is lost in between.
    """
    kept = list(df.columns if keep is None else keep)
    ranges = df.repartitionByRange(*order_by) if spread else df
    placed = materialise(
        ranges.sortWithinPartitions(*order_by).select(
            *kept, F.monotonically_increasing_id().alias("_place")
        ),
        f"key-{name}",
    )
    in_range = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(in_range.alias("_range")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_range", in_range)
        .join(F.broadcast(starts), "_range")
        .select(*kept, (F.col("_start") + position + first).alias(name))
    )
