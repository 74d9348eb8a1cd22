"""Fact builder: surrogate-key lookups and the computed amount."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.calendar import date_key
from orrery.functions.money import line_amount
from orrery.functions.rules import project
from orrery.operators.batches import in_interval
from orrery.operators.checks import enforce
from orrery.operators.dims import CUSTOMER, PRODUCT, SALESREP, DimSpec
from orrery.schemas import FACT_SALES, Table
from orrery.workspace import BROADCAST_LIMIT_BYTES, broadcast_if_bounded, fits


@dataclass(frozen=True)
class FactSpec:
    """A fact: its table, the dimensions it looks up and the rule of each other column."""

    table: Table
    lookups: tuple[DimSpec, ...]
    rules: Mapping[str, Column | str]


def sales_fact() -> FactSpec:
    return FactSpec(
        FACT_SALES,
        (CUSTOMER, SALESREP, PRODUCT),
        {
            "order_line_id": "order_line_id",
            "order_id": "order_id",
            "date_key": date_key(F.col("order_date")),
            "quantity": "quantity",
            "unit_price": "unit_price",
            "amount": line_amount(F.col("quantity"), F.col("unit_price")),
            "loaded_at": F.current_timestamp(),
        },
    )


def lookup_key(
    rows: DataFrame,
    dim: DataFrame,
    spec: DimSpec,
    dim_rows: int | None = None,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Bring the surrogate key of a business code to each row; unknown codes drop out.

    Only code and key travel. With the row count known, their widest size is known
    too, and a dimension under the limit is broadcast: rows stay where they are and
    a hot code does no harm. A larger one, or one of unknown size, is joined without
    a hint, where adaptive execution splits the partition of a hot code; for that the
    dimension has to be a stored table, as it is in a load.
    """
    pairs = dim.select(spec.code, spec.key)
    if dim_rows is not None:
        pairs = broadcast_if_bounded(pairs, dim_rows, _code_length(spec), limit)
    return rows.join(pairs, spec.code, "inner")


def _code_length(spec: DimSpec) -> dict[str, int]:
    return {spec.code: spec.table.column(spec.code).max_length}


def _bounded(spec: DimSpec, dim_rows: int, limit: int) -> bool:
    """Whether the lookup of a dimension is small enough to be broadcast."""
    pairs = T.StructType(
        [T.StructField(spec.code, T.StringType()), T.StructField(spec.key, T.IntegerType())]
    )
    return fits(pairs, dim_rows, _code_length(spec), limit)


def dimensions_bounded(dim_rows: Mapping[str, int], limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether every lookup of the sales fact is small enough to be broadcast."""
    return all(_bounded(spec, dim_rows[spec.table.name], limit) for spec in sales_fact().lookups)


def build_fact(
    src: DataFrame,
    dims: Mapping[str, DataFrame],
    from_id: int | None = None,
    to_id: int | None = None,
    dim_rows: Mapping[str, int] | None = None,
    spec: FactSpec | None = None,
    limit: int = BROADCAST_LIMIT_BYTES,
    spread: Column | None = None,
) -> DataFrame:
    """Fact rows of the lines in ]from_id, to_id] (of all lines by default).

    Lookups that are broadcast come first: the others then shuffle their short keys. Rows are
    rebalanced by `spread`, if given, before the rules add their columns.
    """
    spec = spec or sales_fact()
    rows = in_interval(src, from_id, to_id)
    known = {dim: (dim_rows or {}).get(dim.table.name) for dim in spec.lookups}
    for dim in sorted(known, key=lambda d: known[d] is None or not _bounded(d, known[d], limit)):
        rows = lookup_key(rows, dims[dim.table.name], dim, known[dim], limit)
    if spread is not None:
        rows = rows.withColumn("_spread", spread).hint("rebalance", "_spread")
    rules = {**spec.rules, **{dim.key: dim.key for dim in spec.lookups}}
    return enforce(project(rows, rules), spec.table)
