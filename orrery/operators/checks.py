"""Integrity rules: keys, NOT NULL, text length, references, amounts.

`enforce` puts the row-local rules into the plan of a write, where they cost no
extra pass. The `check_*` functions return the violating rows; `*_report` count
them per column in one pass over the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column as SqlColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.money import line_amount
from orrery.operators.batches import chunk_number
from orrery.schemas import TOTAL, Column, Table, assert_schema


class IntegrityError(RuntimeError):
    """A table breaks one of its declared rules."""


def _guarded(table: Table, column: Column) -> str:
    """SQL text of a column that raises where its rule is broken."""

    def fail(what: str) -> str:
        return f"raise_error('{table.name}: {what}')"

    name, cases = column.name, ""
    if not column.nullable:
        cases += f" when {name} is null then {fail(f'null value in {name}')}"
    if column.max_length is not None:
        too_long = fail(f"value too long for {name} ({column.max_length})")
        cases += f" when length({name}) > {column.max_length} then {too_long}"
    value = f"case{cases} else {name} end" if cases else name
    return f"cast({value} as {column.dtype.simpleString()}) as {name}"


def enforce(df: DataFrame, table: Table) -> DataFrame:
    """Make a NULL or an over-long text fail the job that writes `df`."""
    return assert_schema(df, table).selectExpr(*[_guarded(table, c) for c in table.columns])


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, with how often. NULL is not a value."""
    present = df
    for name in columns:
        present = present.filter(F.col(name).isNotNull())
    return present.groupBy(*columns).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_not_null(df: DataFrame, table: Table) -> DataFrame:
    """Rows with a NULL where the table allows none."""
    broken = F.lit(False)
    for column in table.columns:
        if not column.nullable and column.name in df.columns:
            broken = broken | F.col(column.name).isNull()
    return df.filter(broken)


def check_length(df: DataFrame, table: Table) -> DataFrame:
    """Rows with a text longer than its column allows."""
    broken = F.lit(False)
    for column in table.columns:
        if column.max_length is not None and column.name in df.columns:
            broken = broken | (
                F.coalesce(F.length(column.name), F.lit(0)) > column.max_length
            )
    return df.filter(broken)


def check_foreign_key(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent row. A NULL key refers to nothing and passes."""
    parents = parent.select(F.col(key).alias(column))
    return df.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def duplicate_report(tables: Mapping[str, DataFrame], unique: Mapping[str, str]) -> DataFrame:
    """Per table: rows, distinct values of its unique column, values that repeat."""
    parts = []
    for name, df in tables.items():
        column = unique[name]
        parts.append(
            df.groupBy(F.col(column).alias("value"))
            .agg(F.count("*").alias("copies"))
            .agg(
                F.coalesce(F.sum("copies"), F.lit(0)).alias("checked_rows"),
                F.count("value").alias("distinct_values"),
                F.count(F.when(F.col("value").isNotNull() & (F.col("copies") > 1), 1)).alias(
                    "repeated_values"
                ),
            )
            .select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "*")
        )
    return _stacked(parts)


def _stacked(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _per_column(df: DataFrame, table: Table, columns: list[str], measures: dict) -> DataFrame:
    """One aggregate row over the whole table, then one output row per column."""
    wide = df.agg(
        *[
            measure(F.col(name), table.column(name)).alias(f"{name}__{label}")
            for name in columns
            for label, measure in measures.items()
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table.name).alias("table_name"),
                F.lit(name).alias("column_name"),
                *[F.col(f"{name}__{label}").alias(label) for label in measures],
            )
            for name in columns
        ]
    )
    return wide.select(F.inline(rows))


def null_report(df: DataFrame, table: Table) -> DataFrame:
    """Per NOT NULL column: rows looked at and NULLs found, in one pass."""
    columns = [c.name for c in table.columns if not c.nullable and c.name in df.columns]
    return _per_column(
        df,
        table,
        columns,
        {
            "checked_rows": lambda value, column: F.count(F.lit(1)),
            "violations": lambda value, column: F.count(F.when(value.isNull(), 1)),
        },
    )


def length_report(df: DataFrame, table: Table) -> DataFrame:
    """Per limited text column: the limit, the longest text and the texts beyond the limit."""
    columns = [c.name for c in table.columns if c.max_length is not None and c.name in df.columns]
    return _per_column(
        df,
        table,
        columns,
        {
            "max_length": lambda value, column: F.max(F.lit(column.max_length)),
            "longest": lambda value, column: F.max(F.length(value)),
            "violations": lambda value, column: F.count(
                F.when(F.length(value) > column.max_length, 1)
            ),
        },
    )


def orphan_report(fact: DataFrame, dims: Mapping[str, DataFrame], table: Table) -> DataFrame:
    """Per reference: fact rows, distinct keys used, and keys and rows without a parent.

    The fact is reduced to one row per key before it meets the dimension, so a hot
    key costs one row in the join.
    """
    parts = []
    for link in table.foreign_keys:
        used = fact.groupBy(F.col(link.column).alias("key")).agg(F.count("*").alias("rows"))
        parents = dims[link.table].select(
            F.col(link.key).alias("key"), F.lit(True).alias("found")
        )
        missing = F.col("found").isNull()
        parts.append(
            used.join(parents, "key", "left").agg(
                F.lit(link.column).alias("column_name"),
                F.lit(link.table).alias("parent_table"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("checked_rows"),
                F.count("key").alias("keys_used"),
                F.count(F.when(missing, 1)).alias("orphan_keys"),
                F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
            )
        )
    return _stacked(parts)


def _amounts_compared(src: DataFrame, fact: DataFrame) -> DataFrame:
    """One row for each line id of either side: how often it is there, and its amounts.

    Each side is first reduced to a row for each id, so a repeated id cannot multiply.
    """
    amount = line_amount(F.col("quantity"), F.col("unit_price"))
    expected = (
        src.select("order_line_id", amount.alias("amount"))
        .groupBy("order_line_id")
        .agg(F.count("*").alias("lines"), F.sum("amount").cast(TOTAL).alias("expected"))
    )
    loaded = fact.groupBy("order_line_id").agg(
        F.count("*").alias("facts"), F.sum("amount").cast(TOTAL).alias("amount")
    )
    return expected.join(loaded, "order_line_id", "full").withColumn(
        "differs",
        ~(F.col("expected").eqNullSafe(F.col("amount")) & F.col("lines").eqNullSafe(F.col("facts"))),
    )


def amount_mismatches(src: DataFrame, fact: DataFrame) -> DataFrame:
    """Line ids whose facts are missing, too many, or of another amount than their lines.

    A fact without a source line is one too: its `expected` is NULL.
    """
    return (
        _amounts_compared(src, fact)
        .filter("differs")
        .select("order_line_id", "lines", "facts", "expected", "amount")
    )


def amount_check(src: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: ids compared, ids that differ, and the summed difference."""
    gap = F.coalesce(F.col("amount"), F.lit(0)) - F.coalesce(F.col("expected"), F.lit(0))
    return _amounts_compared(src, fact).agg(
        F.count("*").alias("lines_checked"),
        F.count(F.when(F.col("differs"), 1)).alias("mismatches"),
        F.coalesce(F.sum(gap), F.lit(0)).cast("decimal(38,2)").alias("difference"),
    )


def _digests(rows: DataFrame, amount: SqlColumn, chunk_size: int) -> DataFrame:
    """One row for each batch: a digest of ids and amounts that no order of rows changes."""
    told = F.xxhash64("order_line_id", amount.cast(TOTAL))
    return rows.groupBy(chunk_number(F.col("order_line_id"), chunk_size).alias("chunk_no")).agg(
        F.struct(F.count("*"), F.sum(told.cast("decimal(38,0)"))).alias("digest")
    )


def changed_batches(src: DataFrame, fact: DataFrame, chunk_size: int) -> DataFrame:
    """(chunk_no) of the batches whose lines and facts differ in an id or an amount.

    Each side is read once, two or three columns of it, and reduced to one row a batch
    where it lies. Batches that differ may be told equal with a chance of 1 in 2^64.
    """
    lines = _digests(src, line_amount(F.col("quantity"), F.col("unit_price")), chunk_size)
    facts = _digests(fact, F.col("amount"), chunk_size).withColumnRenamed("digest", "_digest")
    same = F.col("digest").eqNullSafe(F.col("_digest"))
    return lines.join(facts, "chunk_no", "full").filter(~same).select("chunk_no")


def amount_differences(src: DataFrame, fact: DataFrame, chunk_size: int) -> DataFrame:
    """`amount_mismatches`, compared line by line only in batches whose digests differ.

    The lines of equal batches do not move, so two tables that agree cost one narrow
    aggregate each. Ids that are NULL are of no batch and not compared.
    """
    batches = changed_batches(src, fact, chunk_size)
    chunk = chunk_number(F.col("order_line_id"), chunk_size)

    def within(rows: DataFrame) -> DataFrame:
        return rows.join(batches, chunk == batches["chunk_no"], "left_semi")

    lines = within(src.select("order_line_id", "quantity", "unit_price"))
    return amount_mismatches(lines, within(fact.select("order_line_id", "amount")))
