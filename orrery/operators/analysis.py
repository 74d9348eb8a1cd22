"""Axis analyses of the star: revenue, quantity, lines and mean line amount by label."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.money import mean_from_total
from orrery.schemas import TOTAL


@dataclass(frozen=True)
class Axis:
    dim: str
    key: str
    label: str
    order_by: str | None = None  # a dimension column; None = by amount, largest first
    limit: int | None = None


AXES: dict[str, Axis] = {
    "year": Axis("dim_date", "date_key", "year_num", order_by="year_num"),
    "quarter": Axis("dim_date", "date_key", "quarter_label", order_by="quarter_label"),
    "month": Axis("dim_date", "date_key", "year_month", order_by="year_month"),
    "week": Axis("dim_date", "date_key", "year_week", order_by="year_week"),
    "weekday": Axis("dim_date", "date_key", "day_name", order_by="day_of_week"),
    "segment": Axis("dim_customer", "customer_key", "segment"),
    "dept": Axis("dim_customer", "customer_key", "dept", limit=15),
    "customer": Axis("dim_customer", "customer_key", "customer_name", limit=10),
    "region": Axis("dim_salesrep", "salesrep_key", "region"),
    "salesrep": Axis("dim_salesrep", "salesrep_key", "salesrep_name", limit=10),
    "category": Axis("dim_product", "product_key", "category"),
    "brand": Axis("dim_product", "product_key", "brand"),
    "product": Axis("dim_product", "product_key", "product_name", limit=10),
}


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    """Totals per surrogate key: the fact is reduced to one row per key before any join."""
    return fact.groupBy(key).agg(
        F.sum("amount").alias("amount"),
        F.sum("quantity").alias("quantity"),
        F.count("*").alias("lines"),
    )


def totals_by(star: Mapping[str, DataFrame], axis: Axis) -> DataFrame:
    """Unordered totals per label.

    Sums and counts add up, so totals per key can be joined to the dimension and
    summed again. Only per-key rows are shuffled: neither a large dimension nor a
    hot key makes the fact move.
    """
    columns = [axis.label] if axis.order_by in (None, axis.label) else [axis.order_by, axis.label]
    per_key = _per_key(star["fact_sales"], axis.key)
    return (
        per_key.join(star[axis.dim].select(axis.key, *columns), axis.key)
        .groupBy(*columns)
        .agg(
            F.sum("amount").cast(TOTAL).alias("amount"),
            F.sum("quantity").alias("quantity"),
            F.sum("lines").alias("lines"),
        )
    )


def analyze(star: Mapping[str, DataFrame], axis: str) -> DataFrame:
    """label, amount, quantity, lines, avg_amount for one of the thirteen axes.

    Top-n axes break ties by label, so the answer is the same on every run.
    """
    if axis not in AXES:
        raise ValueError("unknown axis")
    spec = AXES[axis]
    rows = totals_by(star, spec)
    if spec.order_by is None:
        order = [F.col("amount").desc(), F.col(spec.label).asc_nulls_last()]
    else:
        order = [F.col(spec.order_by).asc_nulls_last()]
    rows = rows.orderBy(*order)
    if spec.limit is not None:
        rows = rows.limit(spec.limit)
    return rows.select(
        F.col(spec.label).cast("string").alias("label"),
        "amount",
        "quantity",
        "lines",
        mean_from_total(F.col("amount"), F.col("lines")).alias("avg_amount"),
    )


def sales_by_month(star: Mapping[str, DataFrame]) -> DataFrame:
    """Revenue and lines per month, oldest first."""
    return totals_by(star, AXES["month"]).select("year_month", "amount", "lines").orderBy(
        "year_month"
    )
