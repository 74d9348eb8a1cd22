"""Table definitions: the flat source, the star, the run log and the control table.

Spark does not enforce keys, lengths or NOT NULL on files, so every rule that a
database would keep is declared here once and checked by `operators.checks`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
AMOUNT = T.DecimalType(14, 2)
TOTAL = T.DecimalType(38, 2)


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    nullable: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name} has no column {name}")


def _text(name: str, length: int, nullable: bool = False) -> Column:
    return Column(name, T.StringType(), nullable, length)


def _int(name: str, nullable: bool = False) -> Column:
    return Column(name, T.IntegerType(), nullable)


def _short(name: str) -> Column:
    return Column(name, T.ShortType())


def _long(name: str, nullable: bool = False) -> Column:
    return Column(name, T.LongType(), nullable)


STAGING_ORDERS = Table(
    "staging_orders",
    (
        _long("order_line_id"),
        _text("order_id", 12),
        Column("order_date", T.DateType()),
        _text("customer_code", 10),
        _text("customer_name", 80),
        _text("customer_city", 60, nullable=True),
        _text("customer_dept", 3, nullable=True),
        _text("customer_segment", 30, nullable=True),
        _text("salesrep_code", 10),
        _text("salesrep_name", 80),
        _text("salesrep_region", 40, nullable=True),
        _text("product_code", 12),
        _text("product_name", 100),
        _text("product_category", 40, nullable=True),
        _text("product_brand", 40, nullable=True),
        _int("quantity"),
        Column("unit_price", MONEY),
    ),
    unique=("order_line_id",),
)

DIM_DATE = Table(
    "dim_date",
    (
        _int("date_key"),
        Column("full_date", T.DateType()),
        _short("year_num"),
        _short("quarter_num"),
        _text("quarter_label", 7),
        _short("month_num"),
        _text("month_name", 12),
        _text("year_month", 7),
        _short("week_of_year"),
        _text("year_week", 8, nullable=True),
        _short("day_of_month"),
        _short("day_of_week"),
        _text("day_name", 10),
        Column("is_weekend", T.BooleanType()),
    ),
    unique=("date_key", "full_date"),
)

DIM_CUSTOMER = Table(
    "dim_customer",
    (
        _int("customer_key"),
        _text("customer_code", 10),
        _text("customer_name", 80),
        _text("city", 60, nullable=True),
        _text("dept", 3, nullable=True),
        _text("segment", 30, nullable=True),
    ),
    unique=("customer_key", "customer_code"),
)

DIM_SALESREP = Table(
    "dim_salesrep",
    (
        _int("salesrep_key"),
        _text("salesrep_code", 10),
        _text("salesrep_name", 80),
        _text("region", 40, nullable=True),
    ),
    unique=("salesrep_key", "salesrep_code"),
)

DIM_PRODUCT = Table(
    "dim_product",
    (
        _int("product_key"),
        _text("product_code", 12),
        _text("product_name", 100),
        _text("category", 40, nullable=True),
        _text("brand", 40, nullable=True),
    ),
    unique=("product_key", "product_code"),
)

FACT_SALES = Table(
    "fact_sales",
    (
        _long("order_line_id"),
        _text("order_id", 12),
        _int("date_key"),
        _int("customer_key"),
        _int("salesrep_key"),
        _int("product_key"),
        _int("quantity"),
        Column("unit_price", MONEY),
        Column("amount", AMOUNT),
        Column("loaded_at", T.TimestampType()),
    ),
    unique=("order_line_id",),
    foreign_keys=(
        ForeignKey("date_key", "dim_date", "date_key"),
        ForeignKey("customer_key", "dim_customer", "customer_key"),
        ForeignKey("salesrep_key", "dim_salesrep", "salesrep_key"),
        ForeignKey("product_key", "dim_product", "product_key"),
    ),
)

RUN_LOG = Table(
    "etl_run_log",
    (
        _long("log_id"),
        _text("run_id", 40),
        _text("step_name", 60),
        Column("started_at", T.TimestampType()),
        Column("ended_at", T.TimestampType(), nullable=True),
        _long("row_count", nullable=True),
        _long("duration_ms", nullable=True),
        _text("status", 20),
        _text("message", 500, nullable=True),
    ),
    unique=("log_id",),
)

CONTROL = Table(
    "etl_control",
    (_text("ctl_key", 40), _text("ctl_value", 200)),
    unique=("ctl_key",),
)

DIMENSIONS = {t.name: t for t in (DIM_DATE, DIM_CUSTOMER, DIM_SALESREP, DIM_PRODUCT)}
STAR = {**DIMENSIONS, FACT_SALES.name: FACT_SALES}


class SchemaMismatch(ValueError):
    """A frame does not carry the columns a table declares."""


def assert_schema(df, table: Table):
    """Return `df` with the table's columns, taken by name, in declared order.

    Missing, extra or differently typed columns are refused: rows are never
    aligned by position.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = {c.name: c.dtype for c in table.columns}
    missing = [n for n in wanted if n not in found]
    extra = [n for n in found if n not in wanted]
    typed = [
        f"{n}: {found[n].simpleString()} instead of {wanted[n].simpleString()}"
        for n in wanted
        if n in found and found[n] != wanted[n]
    ]
    if missing or extra or typed:
        raise SchemaMismatch(
            f"{table.name}: missing {missing}, unexpected {extra}, wrong type {typed}"
        )
    return df.select(*table.names)
