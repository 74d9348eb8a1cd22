"""Dimension builders: declared attributes, dense keys, and the calendar."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.calendar import calendar_columns
from orrery.operators.checks import IntegrityError, check_unique, enforce
from orrery.operators.keys import dense_key
from orrery.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_SALESREP, Table, assert_schema


@dataclass(frozen=True)
class DimSpec:
    """A dimension: its table, surrogate key, business code and renamed attributes."""

    table: Table
    key: str
    code: str
    attributes: tuple[tuple[str, str], ...]  # (target column, source column)

    @property
    def mapping(self) -> tuple[tuple[str, str], ...]:
        return ((self.code, self.code), *self.attributes)


CUSTOMER = DimSpec(
    DIM_CUSTOMER,
    "customer_key",
    "customer_code",
    (
        ("customer_name", "customer_name"),
        ("city", "customer_city"),
        ("dept", "customer_dept"),
        ("segment", "customer_segment"),
    ),
)
SALESREP = DimSpec(
    DIM_SALESREP,
    "salesrep_key",
    "salesrep_code",
    (("salesrep_name", "salesrep_name"), ("region", "salesrep_region")),
)
PRODUCT = DimSpec(
    DIM_PRODUCT,
    "product_key",
    "product_code",
    (
        ("product_name", "product_name"),
        ("category", "product_category"),
        ("brand", "product_brand"),
    ),
)
DIM_SPECS = (CUSTOMER, SALESREP, PRODUCT)


def extract_dimension(src: DataFrame, spec: DimSpec) -> DataFrame:
    """Distinct attribute tuples of the source; repeats collapse before the shuffle."""
    return src.select(*[F.col(source).alias(target) for target, source in spec.mapping]).distinct()


def build_dimension(src: DataFrame, spec: DimSpec) -> DataFrame:
    """The dimension with keys 1..n in code order.

    A code with two different attribute tuples appears twice; `require_unique`
    refuses such a table before it is published.
    """
    keyed = dense_key(extract_dimension(src, spec), [spec.code], spec.key)
    return enforce(keyed.withColumn(spec.key, F.col(spec.key).cast("int")), spec.table)


def build_dim_date(src: DataFrame, date_col: str = "order_date", lang: str = "en") -> DataFrame:
    """Calendar rows for the dates that occur in the source."""
    days = src.select(F.col(date_col).alias("day")).distinct()
    return enforce(
        assert_schema(days.select(*calendar_columns(F.col("day"), lang)), DIM_DATE), DIM_DATE
    )


def require_unique(df: DataFrame, column: str, name: str) -> int:
    """The row count of `df`, which must not repeat a value of `column`."""
    copies = df.groupBy(column).agg(F.count("*").alias("copies"))
    found = copies.agg(F.sum("copies").alias("rows"), F.count("*").alias("values")).first()
    if (found.rows or 0) != found["values"]:
        repeated = check_unique(df, column).limit(3).collect()
        values = ", ".join(str(row[0]) for row in repeated)
        raise IntegrityError(f"{name}: duplicate {column} (such as {values})")
    return found.rows or 0
