"""Whole-table figures: counts, source totals and profile, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.money import total
from orrery.schemas import TOTAL
from orrery.sources.storage import relation_size


def _source_amount() -> Column:
    return F.sum(F.col("quantity") * F.col("unit_price")).cast(TOTAL)


def _one_row(df: DataFrame, **figures: Column) -> DataFrame:
    """A single row of scalar subqueries; each runs once, as its own small job."""
    one = df.sparkSession.range(1)
    return one.select(*[figure.alias(name) for name, figure in figures.items()])


def _rows(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def star_counts(
    src: DataFrame,
    star: Mapping[str, DataFrame],
    stop_requested: DataFrame | None = None,
    folders: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows per table, the loaded amount, the stop flag and sizes on storage.

    `folders` names where `src` and `fact` are stored; a side that is not named has
    no size column.
    """
    fact = star["fact_sales"]
    figures = {
        "src_rows": _rows(src),
        **{
            name: _rows(star[name])
            for name in ("dim_date", "dim_customer", "dim_salesrep", "dim_product")
        },
        "fact_rows": _rows(fact),
        "fact_amount": F.coalesce(fact.agg(total(F.col("amount"))).scalar(), F.lit(0).cast(TOTAL)),
    }
    for side, folder in (folders or {}).items():
        size = relation_size(src.sparkSession, folder).select("size").scalar()
        figures[f"{side}_size"] = size
    if stop_requested is not None:
        figures["stop_requested"] = stop_requested.scalar()
    return _one_row(src, **figures)


def source_max_id(src: DataFrame) -> DataFrame:
    return src.agg(F.max("order_line_id").alias("max_id"), F.count("*").alias("row_count"))


def source_totals(src: DataFrame) -> DataFrame:
    """Lines, amount, orders and period of the source.

    Grouping by order first leaves one row per order and task to shuffle; a hot
    order is summed where it lies.
    """
    per_order = src.groupBy("order_id").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("amount"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    )
    return per_order.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("src_rows"),
        F.sum("amount").cast(TOTAL).alias("src_amount"),
        F.count("order_id").alias("src_orders"),
        F.min("first_day").alias("date_min"),
        F.max("last_day").alias("date_max"),
    )


def source_profile(src: DataFrame) -> DataFrame:
    """Rows, distinct orders, customers, sales reps, products and days, and the period.

    Each distinct count is its own scan of one column. Together in one aggregate,
    Spark would copy every row once per distinct column before aggregating.
    """

    def distinct(column: str) -> Column:
        values = src.select(column).filter(F.col(column).isNotNull()).distinct()
        return _rows(values)

    return _one_row(
        src,
        row_count=_rows(src),
        orders=distinct("order_id"),
        customers=distinct("customer_code"),
        salesreps=distinct("salesrep_code"),
        products=distinct("product_code"),
        days=distinct("order_date"),
        date_min=src.agg(F.min("order_date")).scalar(),
        date_max=src.agg(F.max("order_date")).scalar(),
    )


def reconcile_source(src: DataFrame) -> DataFrame:
    """Rows and amount of the lines: one row."""
    return src.agg(F.count("*").alias("row_count"), _source_amount().alias("total_amount"))


def reconcile(src: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows and amount on both sides: two rows, which must agree."""
    source = reconcile_source(src)
    loaded = fact.agg(
        F.count("*").alias("row_count"), total(F.col("amount")).alias("total_amount")
    )
    return source.select(F.lit("staging_orders").alias("table_name"), "*").unionByName(
        loaded.select(F.lit("fact_sales").alias("table_name"), "*")
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
