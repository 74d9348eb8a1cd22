"""Column lineage of the star as rows, taken from the declarations that build it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.calendar import calendar_columns
from orrery.operators.dims import DIM_SPECS
from orrery.operators.fact import sales_fact
from orrery.schemas import CONTROL, DIM_DATE, RUN_LOG, STAGING_ORDERS, STAR, Table

# Fixed value: words in a table name that mark it as technical.
TECHNICAL_TABLES = r"(?i)(^|[._])(log|logs|journal|control|audit)($|[._])"

_SCHEMA = (
    "target_table string, target_column string, rule string, "
    "source_table string, source_column string"
)


def _origins(rule: DataFrame) -> tuple[str, list[str]]:
    """The text of a one-column rule, and the columns it reads, as Spark has resolved them."""
    plan = rule._jdf.queryExecution().analyzed()
    found, read = plan.references().iterator(), []
    while found.hasNext():
        read.append(found.next().name())
    target = rule.columns[0]
    return "copy" if read == [target] else plan.expressions().head().sql(), sorted(read)


def lineage_edges(spark: SparkSession) -> DataFrame:
    """One row per target column and source column; technical tables are left out.

    Everything is read off the declarations that build the tables, so it cannot drift
    from them.
    """
    source = STAGING_ORDERS.name
    lines = spark.createDataFrame([], STAGING_ORDERS.schema)
    fact = sales_fact()
    rules = [(DIM_DATE.name, lines.select(c)) for c in calendar_columns(F.col("order_date"))]
    rules += [
        (spec.table.name, lines.select(F.col(origin).alias(target)))
        for spec in DIM_SPECS
        for target, origin in spec.mapping
    ]
    rules += [
        (fact.table.name, lines.select((F.col(r) if isinstance(r, str) else r).alias(target)))
        for target, r in fact.rules.items()
    ]
    rows = []
    for table, rule in rules:
        told, read = _origins(rule)
        rows += [(table, rule.columns[0], told, source, origin) for origin in read]
    for spec in fact.lookups:
        told = f"key of {spec.table.name} by {spec.code}"
        rows.append((fact.table.name, spec.key, told, source, spec.code))
        rows.append((fact.table.name, spec.key, told, spec.table.name, spec.key))
    return without_technical(spark.createDataFrame(rows, _SCHEMA), "target_table")


def without_technical(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~F.col(column).rlike(TECHNICAL_TABLES))


def declared_columns(spark: SparkSession, tables: list[Table] | None = None) -> DataFrame:
    """Every column of the target tables, as (table_name, column_name)."""
    tables = tables or [*STAR.values(), RUN_LOG, CONTROL]
    rows = [(t.name, c.name) for t in tables for c in t.columns]
    frame = spark.createDataFrame(rows, "table_name string, column_name string")
    return without_technical(frame, "table_name")


def unfed_columns(declared: DataFrame, lineage: DataFrame) -> DataFrame:
    """Declared columns that no source column feeds: generated keys and defaults."""
    fed = lineage.select(
        F.col("target_table").alias("table_name"), F.col("target_column").alias("column_name")
    ).distinct()
    return declared.join(fed, ["table_name", "column_name"], "left_anti")


def column_nodes(lineage: DataFrame) -> DataFrame:
    """Lineage as (src, dst) edges between table.column nodes, for `operators.graph`."""
    return lineage.select(
        F.concat_ws(".", "source_table", "source_column").alias("src"),
        F.concat_ws(".", "target_table", "target_column").alias("dst"),
    ).distinct()


def line_edges(src: DataFrame) -> DataFrame:
    """Row lineage of order lines: customer -> order -> line -> product."""
    customer = F.concat(F.lit("customer:"), "customer_code")
    order = F.concat(F.lit("order:"), "order_id")
    line = F.concat(F.lit("line:"), F.col("order_line_id").cast("string"))
    product = F.concat(F.lit("product:"), "product_code")
    headers = src.select(customer.alias("src"), order.alias("dst")).distinct()
    lines = src.select(order.alias("src"), line.alias("dst"))
    products = src.select(line.alias("src"), product.alias("dst"))
    return headers.unionByName(lines).unionByName(products)


def rebate_edges(src: DataFrame, large: int = 40, largest: int = 50) -> DataFrame:
    """Row lineage with rebates, which run in circles.

    A line of `large` pieces or more sets the rebate of its order, and an order with a
    line of `largest` that of its customer.
    """
    customer = F.concat(F.lit("customer:"), "customer_code")
    order = F.concat(F.lit("order:"), "order_id")
    line = F.concat(F.lit("line:"), F.col("order_line_id").cast("string"))
    by_line = src.filter(F.col("quantity") >= large).select(line.alias("src"), order.alias("dst"))
    by_order = src.filter(F.col("quantity") >= largest).select(order.alias("src"), customer.alias("dst"))
    return line_edges(src).unionByName(by_line).unionByName(by_order.distinct())


def line_calls(src: DataFrame) -> DataFrame:
    """Who refers to what, once per line: customer to order, order to product, customer to product."""
    customer = F.concat(F.lit("customer:"), "customer_code")
    order = F.concat(F.lit("order:"), "order_id")
    product = F.concat(F.lit("product:"), "product_code")
    pairs = ((customer, order), (order, product), (customer, product))
    calls = F.array(*[F.struct(a.alias("caller"), b.alias("callee")) for a, b in pairs])
    return src.select(F.inline(calls))
