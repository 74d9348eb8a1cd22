"""Synthetic order lines of any size, the same for a seed on any cluster.

All attributes of a customer, sales rep or product are functions of its number, so the
tables are generated side by side without reading one another. Orders are shuffled while
they are narrow, and lines numbered in the ranges their orders lie in. Lines are joined to
customers by number, drawn evenly, so the join has no hot key, and get their product's
attributes where they lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.draws import pick, product, scale_rounded, with_draws
from orrery.functions.rules import numbered_code
from orrery.operators.keys import dense_key
from orrery.schemas import STAGING_ORDERS, assert_schema
from orrery.sources import vocabulary as V

# What is drawn for each kind of row, in order.
DRAWS = {
    "customer": ("_city", "_form", "_surname", "_place", "_segment", "_style"),
    "salesrep": ("_first", "_last"),
    "product": ("_prefix", "_base", "_brand", "_price"),
    "order": ("_customer", "_day", "_lines"),
    "line": ("_product", "_quantity", "_quantity_again", "_discount"),
}

LINE_SLOTS = 8  # line number = order number x slots + line, unique as orders have at most 7 lines


def _constant(value) -> str:
    """SQL text of a fixed word, number or tuple of those."""
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(_constant, value))})"
    if isinstance(value, int):
        return str(value)
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _choose(entries: Sequence, position: Column) -> Column:
    """The entry at a 0-based position of a fixed list, which is one constant in the plan."""
    return F.element_at(F.expr(_constant(entries)), (position + 1).cast("int"))


def words_of(lang: str) -> V.Words:
    if lang not in V.WORDS:
        raise ValueError(f"unknown language {lang!r}, expected one of {sorted(V.WORDS)}")
    return V.WORDS[lang]


def region_names() -> list[str]:
    """The regions in alphabetical order, accents ignored."""
    return sorted({region for _, _, region in V.CITIES}, key=lambda r: r.replace("Î", "I"))


# -- word tables -----------------------------------------------------------------


def city_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *city) for i, city in enumerate(V.CITIES, start=1)]
    return spark.createDataFrame(rows, "city_id long, city string, dept string, region string")


def category_table(spark: SparkSession, lang: str = "en") -> DataFrame:
    rows = [
        (i, category, list(names), low, high)
        for i, ((category, names), (low, high)) in enumerate(
            zip(words_of(lang).categories, V.PRICE_BOUNDS), start=1
        )
    ]
    return spark.createDataFrame(
        rows,
        "category_id long, category string, names array<string>, low long, high long",
    )


def generate_salesreps(spark: SparkSession, seed: int = 0) -> DataFrame:
    """Twelve sales reps per region, numbered region by region."""
    regions = list(enumerate(region_names(), start=1))
    each = F.explode(F.sequence(F.lit(1), F.lit(V.REPS_PER_REGION))).alias("k")
    reps = spark.createDataFrame(regions, "region_no long, region string").select(
        "region_no", "region", each
    )
    return with_salesrep(reps, "region_no", "k", seed).select(
        (((F.col("region_no") - 1) * V.REPS_PER_REGION) + F.col("k")).alias("id"),
        "salesrep_code",
        "salesrep_name",
        "region",
        "k",
    )


# -- customers, sales reps and products by number ----------------------------------


def with_salesrep(df: DataFrame, region_no: str, rep_no: str, seed: int = 0) -> DataFrame:
    """Add code and name of the rep with the given number (from 1) in a region (from 1)."""
    draws = DRAWS["salesrep"]
    first = _choose(V.FIRST_NAMES, pick("_first", len(V.FIRST_NAMES)))
    last = _choose(V.SURNAMES, pick("_last", len(V.SURNAMES)))
    rep_id = (F.col(region_no) - 1) * V.REPS_PER_REGION + F.col(rep_no)
    return (
        with_draws(df.withColumn("_rep", rep_id), "_rep", "salesrep", draws, seed)
        .withColumn("salesrep_code", numbered_code("REP", F.col("_rep"), 3))
        .withColumn("salesrep_name", F.concat_ws(" ", first, last))
        .drop("_rep", *draws)
    )


def with_customer(df: DataFrame, number: str, seed: int = 0, lang: str = "en") -> DataFrame:
    """Add the attributes of the customer with the given number."""
    words = words_of(lang)
    draws = DRAWS["customer"]
    form = _choose(words.legal_forms, pick("_form", len(words.legal_forms)))
    surname = _choose(V.SURNAMES, pick("_surname", len(V.SURNAMES)))
    place = _choose(V.PLACES, pick("_place", len(V.PLACES)))
    owner = F.when(pick("_style", 2) == 0, surname).otherwise(place)
    segment = _choose(words.segments, pick("_segment", len(words.segments)))
    cities, depts, regions = zip(*V.CITIES)
    numbers = [region_names().index(region) + 1 for region in regions]
    place_in_list = F.col("_city_no")
    return (
        with_draws(df, number, "customer", draws, seed)
        .withColumn("_city_no", pick("_city", len(V.CITIES)))
        .withColumn("customer_city", _choose(cities, place_in_list))
        .withColumn("customer_dept", _choose(depts, place_in_list))
        .withColumn("region", _choose(regions, place_in_list))
        .withColumn("region_no", _choose(numbers, place_in_list).cast("long"))
        .withColumn("customer_code", numbered_code("C", F.col(number), 6))
        .withColumn(
            "customer_name", F.concat(form, F.lit(" "), owner, F.lit(" - "), "customer_city")
        )
        .withColumn("customer_segment", segment)
        .drop("_city_no", *draws)
    )


def with_product(df: DataFrame, number: str, seed: int = 0, lang: str = "en") -> DataFrame:
    """Add the attributes and list price of the product with the given number."""
    words = words_of(lang)
    n = F.col(number)
    draws = DRAWS["product"]
    category_names, product_names = zip(*words.categories)
    lows, highs = zip(*V.PRICE_BOUNDS)
    category = F.col("_category")
    low, high = _choose(lows, category).cast("long"), _choose(highs, category).cast("long")
    cents = (high - low) * 100
    above_low = scale_rounded("_price", cents)
    prefix = _choose(words.prefixes, pick("_prefix", len(words.prefixes)))
    base = F.element_at("_names", (pick("_base", F.size("_names")) + 1).cast("int"))
    list_price = (low * 100 + above_low).cast("decimal(12,0)") / 100
    return (
        with_draws(df, number, "product", draws, seed)
        .withColumn("_category", (n - 1) % len(words.categories))
        .withColumn("_names", _choose(product_names, category))
        .withColumn("product_code", numbered_code("P", n, 6))
        .withColumn("product_name", F.concat(prefix, base))
        .withColumn("product_category", _choose(category_names, category))
        .withColumn("product_brand", _choose(V.BRANDS, pick("_brand", len(V.BRANDS))))
        .withColumn("list_price", list_price.cast("decimal(12,2)"))
        .drop("_category", "_names", *draws)
    )


def generate_customers(ids: DataFrame, seed: int = 0, lang: str = "en") -> DataFrame:
    """One customer per row of `ids` (column `id`, counted from 1)."""
    return with_customer(ids.select(F.col("id").cast("long")), "id", seed, lang).select(
        "id", "customer_code", "customer_name", "customer_city", "customer_dept", "region",
        "customer_segment",
    )


def generate_products(ids: DataFrame, seed: int = 0, lang: str = "en") -> DataFrame:
    """One product per row of `ids` (column `id`, counted from 1)."""
    return with_product(ids.select(F.col("id").cast("long")), "id", seed, lang).select(
        "id", "product_code", "product_name", "product_category", "product_brand", "list_price"
    )


# -- orders and lines --------------------------------------------------------------


def generate_headers(
    ids: DataFrame,
    customers: int,
    seed: int = 0,
    first_day: str = V.FIRST_DAY,
    days: int = V.DAYS,
) -> DataFrame:
    """One order per row of `ids`: customer number, date and number of lines."""
    start = F.lit(date.fromisoformat(first_day))
    return with_draws(ids, "id", "order", DRAWS["order"], seed).select(
        F.col("id").cast("long").alias("order_no"),
        (pick("_customer", customers) + 1).alias("customer_no"),
        F.date_add(start, pick("_day", days).cast("int")).alias("order_date"),
        (pick("_lines", V.MOST_LINES_PER_ORDER) + 1).cast("int").alias("n_lines"),
    )


def expand_lines(df: DataFrame, count: str, line_no: str = "line_no") -> DataFrame:
    """Repeat each row `count` times, numbered from 1; rows with no line vanish."""
    lines = F.when(F.col(count) >= 1, F.sequence(F.lit(1), F.col(count)))
    return df.withColumn(line_no, F.explode(lines))


def generate_lines(
    headers: DataFrame, customers: int, products: int, seed: int = 0, lang: str = "en"
) -> DataFrame:
    """Order lines in the flat source layout, numbered 1..n by order and line.

    The optimizer knows how many customers there are and broadcasts them while they are
    small. A product's attributes take one digest, less than a join; they are made in place,
    so no wide row is shuffled.
    """
    spark = headers.sparkSession
    slots = expand_lines(headers.repartitionByRange("order_no"), "n_lines").withColumn(
        "slot", F.col("order_no") * LINE_SLOTS + F.col("line_no")
    )
    percent = F.element_at(
        F.array(*[F.lit(p) for p in V.DISCOUNT_PERCENTS]),
        (pick("_discount", len(V.DISCOUNT_PERCENTS)) + 1).cast("int"),
    )
    kept = ["order_no", "order_date", "customer_no", "slot"]
    slots = dense_key(slots, ["order_no", "line_no"], "order_line_id", keep=kept, spread=False)
    lines = with_draws(slots, "slot", "line", DRAWS["line"], seed).select(
        "order_line_id",
        "order_no",
        "order_date",
        "customer_no",
        (pick("_product", products) + 1).alias("product_no"),
        (pick(product("_quantity", "_quantity_again"), V.QUANTITY_SPAN) + 1)
        .cast("int")
        .alias("quantity"),
        (F.lit(100) - percent).cast("decimal(3,0)").alias("kept"),
    )
    buyers = with_customer(spark.range(1, customers + 1), "id", seed, lang).withColumn(
        "rep_no", F.col("id") % V.REPS_PER_REGION + 1
    )
    buyers = with_salesrep(buyers, "region_no", "rep_no", seed).withColumnsRenamed(
        {"id": "customer_no", "region": "salesrep_region"}
    )
    bought = lines.filter(F.col("product_no") <= products).join(buyers, "customer_no")
    unit_price = F.round(F.col("list_price") * F.col("kept") / 100, 2)
    rows = (
        with_product(bought, "product_no", seed, lang)
        .withColumn("order_id", numbered_code("CMD", F.col("order_no"), 8))
        .withColumn("unit_price", unit_price.cast("decimal(12,2)"))
    )
    return assert_schema(rows.select(*STAGING_ORDERS.names), STAGING_ORDERS)


def generate_orders(
    spark: SparkSession,
    orders: int = 250_000,
    customers: int = 5_000,
    products: int = 2_000,
    seed: int = 0,
    lang: str = "en",
) -> DataFrame:
    """Flat order lines of `orders` orders, one to seven lines each."""
    headers = generate_headers(spark.range(1, orders + 1), customers, seed)
    return generate_lines(headers, customers, products, seed, lang)
