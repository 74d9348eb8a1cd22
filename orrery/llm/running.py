"""Running totals inside groups of any size, spread over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.shipping import ship
from orrery.workspace import materialise

Values = Callable[[pa.RecordBatch], list[np.ndarray]]


def _restarting(values: np.ndarray, starts: np.ndarray, xor: bool) -> np.ndarray:
    """Totals from the start of each stretch on."""
    if xor:
        total = np.bitwise_xor.accumulate(values)
        before = np.where(starts > 0, total[np.maximum(starts, 1) - 1], 0)
        return total ^ np.repeat(before, np.diff(np.append(starts, len(values))))
    total = np.cumsum(values)
    before = np.where(starts > 0, total[np.maximum(starts, 1) - 1], 0)
    return total - np.repeat(before, np.diff(np.append(starts, len(values))))


def running(
    df: DataFrame,
    group: str,
    order: list[str | Column],
    names: list[str],
    values: Values,
    *,
    xor: bool = False,
) -> DataFrame:
    """`df` with, for each of `names`, its value and its total so far (name_run), this row included.

    `values` gives the values of a batch of rows. Totals are sums, or exclusive ors,
    over the rows of the same `group`, which is never null, in the order of `order`.

    Rows are spread by ranges of the group and all of the order, so a group with a
    third of all rows lies in many tasks. Each writes its own totals; the last total of
    every written range, one row each, then tells what goes in front of the next one.
    """
    spark = ship(df.sparkSession)
    key_at = df.columns.index(group)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        last_key, totals, in_first = None, [np.int64(0)] * len(names), True
        held: list | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key_at)
            new = np.zeros(n, bool)
            new[1:] = np.asarray(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)))
            first_key = keys[0].as_py()
            goes_on = last_key is not None and first_key == last_key
            in_first = in_first and (goes_on or last_key is None)
            starts = np.concatenate(([0], np.flatnonzero(new)))
            first_stretch = np.arange(n) < (starts[1] if len(starts) > 1 else n)
            raw = values(batch)
            sums = []
            for i, value in enumerate(raw):
                total = _restarting(value, starts, xor)
                if goes_on:
                    carried = total[first_stretch]
                    total[first_stretch] = carried ^ totals[i] if xor else carried + totals[i]
                totals[i] = total[-1]
                sums.append(total)
            head = first_stretch & in_first
            in_first = in_first and len(starts) == 1
            last_key = keys[n - 1].as_py()
            if held:
                yield _batch(held, False)
            held = [batch, raw, sums, head, place]
        if held:
            yield _batch(held, True)

    columns = [*df.columns, *names, *[f"{x}_run" for x in names], "_head", "_place", "_tail"]

    def _batch(held: list, last: bool) -> pa.RecordBatch:
        batch, raw, sums, head, place = held
        tail = np.zeros(batch.num_rows, bool)
        tail[-1] = last
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                *[pa.array(x) for x in [*raw, *sums, head]],
                pa.array(np.full(batch.num_rows, place, np.int32)),
                pa.array(tail),
            ],
            columns,
        )

    added = [T.StructField(x, T.LongType()) for x in [*names, *[f"{x}_run" for x in names]]]
    added += [T.StructField("_head", T.BooleanType()), T.StructField("_place", T.IntegerType())]
    schema = T.StructType([*df.schema.fields, *added, T.StructField("_tail", T.BooleanType())])
    stored = materialise(
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .mapInArrow(scan, schema),
        "running",
    )
    runs = [f"{x}_run" for x in names]
    tails = stored.where("_tail").select("_place", group, "_head", *runs).collect()  # one a range
    front, key, totals = [], None, [0] * len(names)
    for row in sorted(tails, key=lambda r: r["_place"]):
        if key is not None:
            front.append((row["_place"], key, *totals))
        goes_on = row["_head"] and row[group] == key
        more = [row[r] for r in runs]
        if goes_on:
            more = [a ^ b if xor else a + b for a, b in zip(totals, more)]
        key, totals = row[group], more
    kind = T.StructType(
        [T.StructField("_at", T.IntegerType()), T.StructField("_key", df.schema[group].dataType)]
        + [T.StructField(f"_{r}", T.LongType()) for r in runs]
    )
    fronts = F.broadcast(spark.createDataFrame(front, kind))
    joined = stored.join(
        fronts, (F.col("_place") == F.col("_at")) & (F.col(group) == F.col("_key")) & F.col("_head"), "left"
    )

    def whole(run: str) -> Column:
        before = F.coalesce(F.col(f"_{run}"), F.lit(0))
        return (F.col(run).bitwiseXOR(before) if xor else F.col(run) + before).alias(run)

    return joined.select(*df.columns, *names, *[whole(r) for r in runs])
