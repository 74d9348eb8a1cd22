"""Every operator as a query over the given tables.

The flat source is derived from the normalised tables and stored once per session
and folder; the star is loaded from it once. Queries then read the stored tables,
as a user of the library does.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.rules import (
    branch_on_expressions,
    branch_on_value,
    default_if_absent,
    project,
    slice_text,
    stamp_text,
)
from orrery.functions.calendar import date_key, is_weekend, iso_day
from orrery.functions.money import line_amount
from orrery.operators import analysis, batches, checks, graph, idsets, previews, totals
from orrery.operators.dims import DIM_SPECS, build_dim_date
from orrery.plans import control, lineage, runlog
from orrery.plans.growth import load_new_lines
from orrery.plans.load import LoadParams, load_star, replay_batch
from orrery.plans.warehouse import Warehouse
from orrery.schemas import AMOUNT, DIMENSIONS, FACT_SALES, STAGING_ORDERS
from orrery.sources import generator
from orrery.sources.orders import orders_from_normalised, write_orders
from orrery.functions.display import pretty_size
from orrery.sources.storage import relation_size
from orrery.streaming.facts import stream_fact_load, stream_sales_by_month
from orrery.workspace import new_folder, shuffles_dropped, tables_dropped

CHUNK_SIZE = 20_000
_COMPARED_FACT = [name for name in FACT_SALES.names if name != "loaded_at"]

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Prepared:
    """Stored source and loaded star of one folder of tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def source_path(self) -> str:
        path = new_folder(self.spark, "staging-orders")
        with shuffles_dropped(self.spark), tables_dropped(self.spark):
            write_orders(orders_from_normalised(self.spark, self.folder), path, spread=False)
        return path

    @cached_property
    def source(self) -> DataFrame:
        return self.spark.read.schema(STAGING_ORDERS.schema).parquet(self.source_path)

    @cached_property
    def root(self) -> str:
        return self.load(LoadParams(chunk_size=CHUNK_SIZE, source_clustered=True))

    def load(self, params: LoadParams) -> str:
        root = new_folder(self.spark, "star")
        load_star(self.source, root, params).require_done()
        return root

    @property
    def warehouse(self) -> Warehouse:
        return Warehouse(self.spark, self.root)

    @cached_property
    def run_id(self) -> str:
        return self.warehouse.published_run()

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return self.warehouse.star(self.run_id)

    @cached_property
    def batches(self) -> DataFrame:
        return self.warehouse.batches(self.run_id)

    @cached_property
    def dim_rows(self) -> dict[str, int]:
        return {spec.table.name: self.star[spec.table.name].count() for spec in DIM_SPECS}

    def event_log(self) -> DataFrame:
        """The event table read as a run log: users are runs, event types are batches."""
        spent = F.floor(F.col("value") * 1000).cast("long")
        events = self.table("events")
        return events.select(
            F.col("event_id").alias("log_id"),
            F.col("user_id").cast("string").alias("run_id"),
            F.concat(F.lit("FACT_CHUNK_"), "event_type").alias("step_name"),
            F.col("ts").alias("started_at"),
            F.timestamp_add("MILLISECOND", spent, F.col("ts")).alias("ended_at"),
            F.floor("value").cast("long").alias("row_count"),
            spent.alias("duration_ms"),
            F.lit("DONE").alias("status"),
            F.col("props").alias("message"),
        )


_prepared: dict[tuple[str, str], Prepared] = {}
_lock = threading.Lock()


def prepared(spark: SparkSession, folder: str) -> Prepared:
    key = (spark.conf.get("spark.app.id", ""), folder.rstrip("/"))
    with _lock:
        if key not in _prepared:
            _prepared[key] = Prepared(spark, key[1])
        return _prepared[key]


# -- queries -----------------------------------------------------------------------


def _staging_orders(p: Prepared) -> DataFrame:
    return p.source


def _facts(p: Prepared) -> DataFrame:
    return p.star[FACT_SALES.name].select(*_COMPARED_FACT)


def _fact_chunk(p: Prepared) -> DataFrame:
    return p.batches.select("chunk_no", *_COMPARED_FACT)


def _source_next(p: Prepared) -> DataFrame:
    """As a load sees it that has every batch behind it but the last."""
    numbered = p.batches
    last = numbered.agg(F.max("chunk_no")).scalar()
    return previews.source_next(p.source, numbered.filter(F.col("chunk_no") < last))


def _star_counts(p: Prepared) -> DataFrame:
    flag = p.warehouse.control.value(control.STOP_REQUESTED)
    return totals.star_counts(p.source, p.star, flag)


def _relation_size(p: Prepared) -> DataFrame:
    facts = p.warehouse.table_path(p.run_id, FACT_SALES.name)
    return (
        relation_size(p.spark, p.source_path)
        .select(F.lit("staging_orders").alias("table_name"), "*")
        .union(relation_size(p.spark, facts).select(F.lit("fact_sales"), "*"))
    )


def _size_display(p: Prepared) -> DataFrame:
    """Readable sizes over many orders of magnitude, from the lengths of documents."""
    size = F.expr("shiftleft(n_chars, cast(doc_id % 36 as int))")
    return p.table("documents").select("doc_id", pretty_size(size).alias("size"))


def _step_row_counts(p: Prepared) -> DataFrame:
    return runlog.last_run_log(p.warehouse.log.read()).select(
        "step_name", "row_count", "status", "message"
    ).filter("step_name not like 'PIPELINE%'")


def _duplicate_codes(p: Prepared) -> DataFrame:
    unique = {spec.table.name: spec.code for spec in DIM_SPECS}
    dims = {name: p.star[name] for name in unique}
    return checks.duplicate_report(
        {**dims, "part": p.table("part")}, {**unique, "part": "p_name"}
    )


def _broken_source(p: Prepared) -> DataFrame:
    """Order lines with gaps and texts beyond their limits in some of them."""
    line = F.col("order_line_id")
    return p.source.withColumns(
        {
            "order_id": F.when(line % 10 != 3, F.col("order_id")),
            "quantity": F.nullif(F.col("quantity"), F.lit(7)),
            "product_code": F.when(line % 100 != 50, F.col("product_code")).otherwise(
                F.concat("product_code", F.lit("-"), line.cast("string"))
            ),
            "customer_name": F.when(line % 50 != 1, F.col("customer_name")).otherwise(
                F.repeat("customer_name", 6)
            ),
        }
    )


def _null_violations(p: Prepared) -> DataFrame:
    star = p.star
    tables = [*DIMENSIONS.values(), FACT_SALES]
    parts = [checks.null_report(star[t.name], t) for t in tables]
    parts.append(checks.null_report(_broken_source(p), STAGING_ORDERS))
    return _union(parts)


def _length_violations(p: Prepared) -> DataFrame:
    star = p.star
    tables = [*DIMENSIONS.values(), FACT_SALES]
    parts = [checks.length_report(star[t.name], t) for t in tables]
    parts.append(checks.length_report(_broken_source(p), STAGING_ORDERS))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _orphan_keys(p: Prepared) -> DataFrame:
    """References of the facts to dimensions in which some rows are missing."""
    star = p.star
    fewer = {
        **star,
        "dim_product": star["dim_product"].filter("product_key % 7 <> 3"),
        "dim_date": star["dim_date"].filter("day_of_month <> 29"),
    }
    return checks.orphan_report(star[FACT_SALES.name], fewer, FACT_SALES)


def _altered_facts(p: Prepared) -> DataFrame:
    """Stored facts of which some are lost, some changed, and some not of any line."""
    facts, line = p.star[FACT_SALES.name].select("order_line_id", "amount"), F.col("order_line_id")
    changed = facts.filter(line % 997 != 5).withColumn(
        "amount",
        F.when(line % 499 == 1, F.col("amount") + F.lit(1)).otherwise(F.col("amount")).cast(AMOUNT),
    )
    return changed.unionByName(
        facts.filter(line % 983 == 2).withColumn("order_line_id", -line)
    ).unionByName(facts.filter(line % 991 == 7))


def _fact_projection(p: Prepared) -> DataFrame:
    return project(
        p.source,
        {
            "line": "order_line_id",
            "date_key": date_key(F.col("order_date")),
            "quantity": "quantity",
            "unit_price": "unit_price",
            "amount": line_amount(F.col("quantity"), F.col("unit_price")),
        },
    )


def _default_values(p: Prepared) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return p.table("customer").select(
        "c_custkey",
        default_if_absent(segment, "UNKNOWN").alias("segment"),
        default_if_absent(segment, F.col("c_name")).alias("segment_or_name"),
    )


def _weekend_flag(p: Prepared) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    flag = branch_on_value(iso_day(day), {6: "true", 7: "true"}, default="false")
    return p.table("orders").select(
        "o_orderkey", flag.alias("weekend_text"), is_weekend(day).alias("is_weekend")
    )


def _branch_expr(p: Prepared) -> DataFrame:
    quantity = F.col("l_quantity")
    by_range = branch_on_expressions(
        [(quantity < 10, "small"), (quantity < 30, "medium")], default="large"
    )
    returned = F.nullif(F.col("l_returnflag"), F.lit("A"))
    by_value = branch_on_value(
        returned, {"R": "returned", "N": "kept"}, default="other", when_null="none"
    )
    return (
        p.table("lineitem")
        .groupBy(by_range.alias("size_class"), by_value.alias("return_class"))
        .agg(F.count("*").alias("lines"), F.sum(quantity.cast("long")).alias("quantity"))
    )


def _expand_lines(p: Prepared) -> DataFrame:
    orders = p.table("orders").select(
        "o_orderkey", (F.col("o_orderkey") % 7 + 1).cast("int").alias("n_lines")
    )
    return generator.expand_lines(orders, "n_lines")


def _str_split_timestamp(p: Prepared) -> DataFrame:
    text = stamp_text(F.col("ts"))
    return p.table("events").select(
        "event_id",
        slice_text(text, 0, 10).alias("run_date"),
        slice_text(text, 11, 19).alias("run_time"),
    )


def _run_throughput(p: Prepared) -> DataFrame:
    log = p.event_log()
    return runlog.throughput(log, p.source.agg(F.count("*")).scalar())


def _control_upsert(p: Prepared) -> DataFrame:
    existing = p.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("ctl_key"), F.col("s_name").alias("ctl_value")
    )
    # orders and lines name a customer and a part many times over: keys repeat
    seed = p.table("orders").select(
        F.col("o_custkey").cast("string").alias("ctl_key"), F.col("o_orderpriority").alias("ctl_value")
    )
    updates = p.table("lineitem").select(
        F.col("l_partkey").cast("string").alias("ctl_key"), F.col("l_returnflag").alias("ctl_value")
    )
    return control.set_values(control.insert_if_absent(existing, seed), updates)


def _star_load(p: Prepared) -> DataFrame:
    root = p.load(LoadParams(chunk_size=CHUNK_SIZE, source_clustered=True))
    return totals.table_sizes(Warehouse(p.spark, root).star())


def _fact_replay(p: Prepared) -> DataFrame:
    """Loaded block by block, two at a time, then with its first batch run again."""
    root = p.load(LoadParams(chunk_size=CHUNK_SIZE, batches_a_block=2, threads=2))
    replay_batch(p.source, root, 1)
    return Warehouse(p.spark, root).star()[FACT_SALES.name].select(*_COMPARED_FACT)


def _grown(p: Prepared) -> dict[str, DataFrame]:
    """A star of the first tenth of the lines, to which the others are added in two steps."""
    root, highest = new_folder(p.spark, "star"), p.source.agg(F.max("order_line_id")).first()[0] or 0
    line = F.col("order_line_id")
    first = p.source.filter(line <= highest // 10)
    load_star(first, root, LoadParams(chunk_size=CHUNK_SIZE)).require_done()
    load_new_lines(p.source.filter(line <= highest // 2), root)
    load_new_lines(p.source, root)
    return Warehouse(p.spark, root).star()


def _growth_keys(p: Prepared) -> DataFrame:
    """Keys of codes, of which the later ones were met later."""
    star = _grown(p)
    parts = [
        star[s.table.name].select(
            F.lit(s.table.name).alias("table_name"), F.col(s.key).alias("key"), F.col(s.code).alias("code")
        )
        for s in DIM_SPECS
    ]
    return _union(parts)


def _growth_facts(p: Prepared) -> DataFrame:
    """Facts with codes and dates in place of keys."""
    star = _grown(p)
    facts = star[FACT_SALES.name]
    for spec in DIM_SPECS:
        facts = facts.join(star[spec.table.name].select(spec.key, spec.code), spec.key)
    facts = facts.join(star["dim_date"].select("date_key", "full_date"), "date_key")
    codes = [spec.code for spec in DIM_SPECS]
    return facts.select("order_line_id", "order_id", "full_date", *codes, "quantity", "unit_price", "amount")


def _repeated_line_ids(p: Prepared) -> DataFrame:
    """Line ids of a delivery in which some lines come twice and some three times."""
    ids, line = p.source.select("order_line_id"), F.col("order_line_id")
    more = ids.filter(line % 997 == 5).union(ids.filter(line % 499 == 5))
    return idsets.repeated_ids(ids.union(more), "order_line_id")


def _shared_order_keys(p: Prepared) -> DataFrame:
    """Orders of one priority that have a returned line, by bitmaps of both tables' keys."""
    returned = p.table("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    urgent = p.table("orders").filter("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("id"))
    return idsets.ids_in_common(returned, urgent, "id")


def _stream_redelivered(p: Prepared) -> DataFrame:
    """All lines by one stream, and all of them once more by another one into the same table."""
    out = new_folder(p.spark, "stream-facts")
    for _ in range(2):
        state = new_folder(p.spark, "stream-state")
        facts = stream_fact_load(p.spark, p.source_path, p.star, out, state, p.dim_rows)
    return facts.select(*_COMPARED_FACT)


def _numbers(p: Prepared, table: str, key: str) -> DataFrame:
    return p.table(table).select((F.col(key) + 1).alias("id"))


def _gen_headers(p: Prepared) -> DataFrame:
    customers = p.table("customer").count()
    return generator.generate_headers(_numbers(p, "orders", "o_orderkey"), customers, seed=7)


def _gen_orders(p: Prepared, lang: str) -> DataFrame:
    customers, products = p.table("customer").count(), p.table("part").count()
    return generator.generate_lines(_gen_headers(p), customers, products, seed=7, lang=lang)


def _lineage_upstream(p: Prepared) -> DataFrame:
    """Everything behind each product sold."""
    edges = lineage.line_edges(p.source)
    products = edges.filter(F.col("dst").startswith("product:")).select(
        F.col("dst").alias("target")
    )
    return graph.upstream(edges, products)


def _utility_callees(p: Prepared) -> DataFrame:
    """The package's own services are the customers, and the products of one brand in two."""
    brand = F.substring("product_brand", -1, 1).cast("int") % 2 == 0
    customers = p.source.select(F.concat(F.lit("customer:"), "customer_code").alias("service"))
    products = p.source.filter(brand).select(F.concat(F.lit("product:"), "product_code"))
    services = customers.union(products).distinct()
    return graph.utility_callees(lineage.line_calls(p.source), services)


def _unfed_columns(p: Prepared) -> DataFrame:
    """Orders of the order table that no line feeds."""
    declared = p.table("orders").select(F.col("o_orderkey").cast("string").alias("node"))
    feeds = p.table("lineitem").select(
        F.col("l_linenumber").cast("string").alias("src"),
        F.col("l_orderkey").cast("string").alias("dst"),
    )
    return graph.unfed(declared, feeds)


def _stream_fact_load(p: Prepared) -> DataFrame:
    facts = stream_fact_load(
        p.spark,
        p.source_path,
        p.star,
        new_folder(p.spark, "stream-facts"),
        new_folder(p.spark, "stream-state"),
        p.dim_rows,
        files_per_batch=2,
    )
    return facts.select(*_COMPARED_FACT)


def _stream_sales_by_month(p: Prepared) -> DataFrame:
    return stream_sales_by_month(
        p.spark,
        p.source_path,
        new_folder(p.spark, "stream-months"),
        new_folder(p.spark, "stream-state"),
        files_per_batch=2,
    )


_QUERIES: dict[str, Callable[[Prepared], DataFrame]] = {
    "staging_orders": _staging_orders,
    "dim_date": lambda p: p.star["dim_date"],
    "dim_date_fr": lambda p: build_dim_date(p.source, lang="fr"),
    "dim_customer": lambda p: p.star["dim_customer"],
    "dim_salesrep": lambda p: p.star["dim_salesrep"],
    "dim_product": lambda p: p.star["dim_product"],
    "fact_sales": _facts,
    "fact_chunk": _fact_chunk,
    "chunk_plan": lambda p: batches.chunk_plan(p.source, CHUNK_SIZE),
    "source_next": _source_next,
    "source_max_id": lambda p: totals.source_max_id(p.source),
    "source_totals": lambda p: totals.source_totals(p.source),
    "source_profile": lambda p: totals.source_profile(p.source),
    "star_counts": _star_counts,
    "relation_size": _relation_size,
    "size_display": _size_display,
    "dim_date_rows": lambda p: previews.dimension_rows(p.star, "date"),
    "dim_customer_rows": lambda p: previews.dimension_rows(p.star, "customer"),
    "dim_salesrep_rows": lambda p: previews.dimension_rows(p.star, "salesrep"),
    "dim_product_rows": lambda p: previews.dimension_rows(p.star, "product"),
    "dim_sample": lambda p: previews.dimension_sample(p.star),
    "fact_preview": lambda p: previews.fact_preview(p.star),
    **{
        f"an_{axis}": (lambda p, axis=axis: analysis.analyze(p.star, axis))
        for axis in analysis.AXES
    },
    "sales_by_month": lambda p: analysis.sales_by_month(p.star),
    "reconciliation": lambda p: totals.reconcile(p.source, p.star[FACT_SALES.name]),
    "amount_mismatches": lambda p: checks.amount_mismatches(p.source, _altered_facts(p)),
    "amount_check": lambda p: checks.amount_check(p.source, _altered_facts(p)),
    "step_row_counts": _step_row_counts,
    "duplicate_codes": _duplicate_codes,
    "null_violations": _null_violations,
    "length_violations": _length_violations,
    "orphan_keys": _orphan_keys,
    "fact_projection": _fact_projection,
    "default_values": _default_values,
    "weekend_flag": _weekend_flag,
    "branch_expr": _branch_expr,
    "expand_lines": _expand_lines,
    "str_split_timestamp": _str_split_timestamp,
    "run_log_latest": lambda p: runlog.run_log_latest(p.event_log()),
    "last_run_log": lambda p: runlog.last_run(p.event_log()),
    "run_log_display": lambda p: runlog.run_log_display(runlog.last_run(p.event_log())),
    "run_throughput": _run_throughput,
    "control_upsert": _control_upsert,
    "star_load": _star_load,
    "fact_replay": _fact_replay,
    "growth_keys": _growth_keys,
    "growth_facts": _growth_facts,
    "repeated_line_ids": _repeated_line_ids,
    "shared_order_keys": _shared_order_keys,
    "amount_differences": lambda p: checks.amount_differences(
        p.source, _altered_facts(p), CHUNK_SIZE
    ),
    "gen_customers": lambda p: generator.generate_customers(
        _numbers(p, "customer", "c_custkey"), seed=7
    ),
    "gen_products": lambda p: generator.generate_products(_numbers(p, "part", "p_partkey"), seed=7),
    "gen_headers": _gen_headers,
    "gen_orders": lambda p: _gen_orders(p, "en"),
    "gen_orders_fr": lambda p: _gen_orders(p, "fr"),
    "lineage_edges": lambda p: lineage.line_edges(p.source),
    "lineage_upstream": _lineage_upstream,
    "dependency_layers": lambda p: graph.dependency_layers(lineage.line_edges(p.source)),
    "circles": lambda p: graph.circles(lineage.rebate_edges(p.source)),
    "layers_of_circles": lambda p: graph.layers_of_circles(lineage.rebate_edges(p.source)),
    "exclusive_callees": lambda p: graph.exclusive_callees(lineage.line_calls(p.source)),
    "utility_callees": _utility_callees,
    "unfed_columns": _unfed_columns,
    "stream_fact_load": _stream_fact_load,
    "stream_redelivered": _stream_redelivered,
    "stream_sales_by_month": _stream_sales_by_month,
}


def queries() -> dict[str, Query]:
    return {
        name: (lambda spark, folder, run=run: run(prepared(spark, folder)))
        for name, run in _QUERIES.items()
    }
