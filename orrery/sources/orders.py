"""The flat order-line source: stored Parquet, JDBC, or lines derived from normalised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.rules import numbered_code
from orrery.operators.keys import dense_key
from orrery.schemas import STAGING_ORDERS, assert_schema
from orrery.workspace import broadcast_if_bounded


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Stored order lines, with the declared schema instead of an inferred one."""
    return spark.read.schema(STAGING_ORDERS.schema).parquet(path)


def jdbc_options(
    url: str,
    table: str,
    lowest_id: int,
    highest_id: int,
    partitions: int,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Reader options that split a database table by order line id over `partitions` tasks."""
    if partitions < 1 or highest_id < lowest_id:
        raise ValueError("a partitioned read needs partitions >= 1 and highest_id >= lowest_id")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": "order_line_id",
        "lowerBound": str(lowest_id),
        "upperBound": str(highest_id),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        **connection,
    }


def read_orders_jdbc(spark: SparkSession, **options) -> DataFrame:
    """Order lines from a database; takes the arguments of `jdbc_options`."""
    rows = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return assert_schema(
        rows.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in STAGING_ORDERS.columns]),
        STAGING_ORDERS,
    )


#: So few that a task sorts them in a fourth of the memory that an executor of 10 GB has for each of 4.
ROWS_PER_FILE = 1_000_000


def _intervals(spark: SparkSession, highest_id: int) -> tuple[int, Column]:
    """How many equal intervals the ids 1 to `highest_id` are cut into, and the one a line falls into, from 0."""
    parts = max(spark.sparkContext.defaultParallelism, -(-highest_id // ROWS_PER_FILE))
    width = max(-(-highest_id // parts), 1)
    part = F.call_function("div", F.col("order_line_id") - 1, F.lit(width).cast("long"))
    return parts, part.cast("int")


def write_orders(
    df: DataFrame, path: str, highest_id: int | None = None, spread: bool = True
) -> DataFrame:
    """Store order lines clustered by id, so an id interval touches few files.

    Ids are unique, hence the intervals come out even whatever customer, product or
    order is hot. With the highest id of dense ids known, each line is sent straight
    to its interval; otherwise Spark samples the ids first, which computes `df` twice.
    Without `spread` the lines lie in intervals already, sorted in each.
    """
    rows = assert_schema(df, STAGING_ORDERS)
    if spread:
        if highest_id is None:
            rows = rows.repartitionByRange("order_line_id")
        else:
            rows = rows.repartitionById(*_intervals(df.sparkSession, highest_id))
        rows = rows.sortWithinPartitions("order_line_id")
    rows.write.mode("overwrite").parquet(path)
    return read_orders(df.sparkSession, path)


_LINE_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def orders_from_normalised(spark: SparkSession, folder: str) -> DataFrame:
    """Flat order lines joined from the normalised order tables in `folder`, in intervals of ids.

    The line id is the rank of the line over all its columns. Sellers are broadcast while
    they are bounded, so that lines are not shuffled for them. No other join is hinted:
    the small tables fall under the optimizer's own size check, the large ones are
    shuffled and split by adaptive execution where a key is hot.

    A line meets its product and seller while it is narrow, then goes to the interval of its
    id once, where the headers of the interval's orders come to it. A header is sent to the
    intervals from the first line of its order to the last; as ids follow the orders, that is
    one for nearly all. Codes are spelled out after that: numbers are shuffled.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    parts, part = _intervals(spark, table("lineitem").count())
    needed = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    lines = dense_key(table("lineitem").select(*_LINE_ORDER), _LINE_ORDER, "order_line_id", keep=needed)
    customer_nation = table("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_city")
    )
    orders = table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    headers = (
        lines.groupBy("l_orderkey").agg(F.min(part).alias("_first"), F.max(part).alias("_last"))
        .join(orders, "l_orderkey")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(customer_nation, "c_nationkey")
        .select(
            F.explode(F.sequence("_first", "_last")).alias("_part"),
            "l_orderkey",
            F.col("o_orderdate").cast("date").alias("order_date"),
            "c_custkey",
            F.col("c_name").alias("customer_name"),
            "customer_city",
            "c_nationkey",
            F.col("c_mktsegment").alias("customer_segment"),
        )
        .repartitionById(parts, "_part")
    )
    sellers = (
        table("supplier")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("l_suppkey"),
            F.col("s_name").alias("salesrep_name"),
            F.col("r_name").alias("salesrep_region"),
        )
    )
    products = table("part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_brand"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("_price"),
    )
    lengths = {name: STAGING_ORDERS.column(name).max_length for name in ("salesrep_name", "salesrep_region")}
    sellers = broadcast_if_bounded(sellers, sellers.count(), lengths)
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return (
        lines.join(products, "l_partkey")
        .join(sellers, "l_suppkey")
        .withColumn("_part", part)
        .repartitionById(parts, "_part")
        .join(headers, ["_part", "l_orderkey"])
        .sortWithinPartitions("order_line_id")
        .withColumns(
            {
                "order_id": numbered_code("CMD", F.col("l_orderkey"), 8),
                "customer_code": numbered_code("C", F.col("c_custkey"), 6),
                "customer_dept": F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                "salesrep_code": numbered_code("REP", F.col("l_suppkey"), 5),
                "product_code": numbered_code("P", F.col("l_partkey"), 6),
                "quantity": F.col("l_quantity").cast("int"),
                "unit_price": F.round(F.col("_price") * kept, 2).cast("decimal(12,2)"),
            }
        )
        .select(*STAGING_ORDERS.names)
    )
