"""Small looks at large tables: first or last rows, next source rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DIMENSION_COLUMNS = {
    "date": (
        "date_key", "full_date", "year_num", "quarter_label",
        "year_month", "year_week", "day_name", "is_weekend",
    ),
    "customer": ("customer_key", "customer_code", "customer_name", "city", "dept", "segment"),
    "salesrep": ("salesrep_key", "salesrep_code", "salesrep_name", "region"),
    "product": ("product_key", "product_code", "product_name", "category", "brand"),
}

_NEXT_COLUMNS = (
    "order_line_id", "order_id", "order_date", "customer_code", "customer_name", "customer_city",
    "customer_segment", "salesrep_code", "salesrep_name", "product_code", "product_name",
    "product_category", "quantity", "unit_price",
)


def dimension_rows(star: Mapping[str, DataFrame], name: str, n: int = 12) -> DataFrame:
    """First n rows of a dimension by key."""
    if name not in _DIMENSION_COLUMNS:
        raise ValueError("unknown dimension")
    columns = _DIMENSION_COLUMNS[name]
    return star[f"dim_{name}"].select(*columns).orderBy(columns[0]).limit(n)


def dimension_sample(star: Mapping[str, DataFrame], n: int = 3) -> DataFrame:
    """Last n calendar rows as (dim, key, label)."""
    last = star["dim_date"].orderBy(F.col("date_key").desc()).limit(n)
    return last.select(
        F.lit("dim_date").alias("dim"),
        F.col("date_key").cast("string").alias("key"),
        F.concat_ws(" ", "quarter_label", "day_name", F.col("full_date").cast("string")).alias(
            "label"
        ),
    )


def fact_preview(star: Mapping[str, DataFrame], n: int = 6) -> DataFrame:
    """Last n fact rows with the names of their dimension rows.

    The n rows are picked before the joins, which is safe because every key has its
    dimension row, and are the side that is broadcast: n is their bound.
    """
    rows = (
        star["fact_sales"]
        .select(
            "order_line_id", "order_id", "date_key", "customer_key", "salesrep_key",
            "product_key", "quantity", "unit_price", "amount",
        )
        .orderBy(F.col("order_line_id").desc())
        .limit(n)
    )
    for dim, key, shown in (
        ("dim_date", "date_key", "full_date"),
        ("dim_customer", "customer_key", "customer_name"),
        ("dim_salesrep", "salesrep_key", "salesrep_name"),
        ("dim_product", "product_key", "product_name"),
    ):
        rows = star[dim].select(key, shown).join(F.broadcast(rows), key)
    return rows.select(
        "order_line_id", "order_id", "date_key", "customer_key", "salesrep_key", "product_key",
        "full_date", "customer_name", "salesrep_name", "product_name",
        "quantity", "unit_price", "amount",
    ).orderBy(F.col("order_line_id").desc())


def source_next(src: DataFrame, fact: DataFrame, n: int = 6) -> DataFrame:
    """The first n source lines above the highest loaded id."""
    loaded = F.coalesce(fact.agg(F.max("order_line_id")).scalar(), F.lit(0).cast("long"))
    return (
        src.filter(F.col("order_line_id") > loaded)
        .select(*_NEXT_COLUMNS)
        .orderBy("order_line_id")
        .limit(n)
    )
