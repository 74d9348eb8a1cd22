import random

import pytest
from pyspark.sql import functions as F

from orrery.operators import analysis, batches, checks, graph, previews
from orrery.operators.dims import CUSTOMER, build_dimension, require_unique
from orrery.operators.fact import build_fact, dimensions_bounded
from orrery.operators.keys import dense_key
from orrery.plans import control, lineage
from orrery.schemas import (
    DIM_CUSTOMER,
    FACT_SALES,
    STAGING_ORDERS,
    SchemaMismatch,
    assert_schema,
)
from orrery.sources.orders import jdbc_options
from orrery.workspace import broadcast_if_bounded, materialise, widest_row_bytes


# -- keys ---------------------------------------------------------------------------


def test_dense_key_with_a_hot_leading_value(spark):
    rows = spark.range(0, 30_000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 1000).alias("a"),
        ((F.col("id") * 7919) % 30_000).alias("b"),
    )
    numbered = dense_key(rows, ["a", "b"], "k").collect()
    assert sorted(r.k for r in numbered) == list(range(1, 30_001))
    by_key = [(r.a, r.b) for r in sorted(numbered, key=lambda r: r.k)]
    assert by_key == sorted(by_key)


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), ["id"], "k").collect() == []


# -- schema, checks -----------------------------------------------------------------


def test_columns_are_taken_by_name(orders):
    shuffled = orders.select(*reversed(STAGING_ORDERS.names))
    assert assert_schema(shuffled, STAGING_ORDERS).columns == STAGING_ORDERS.names
    with pytest.raises(SchemaMismatch, match="quantity"):
        assert_schema(orders.withColumn("quantity", F.lit("1")), STAGING_ORDERS)
    with pytest.raises(SchemaMismatch, match="missing"):
        assert_schema(orders.drop("quantity"), STAGING_ORDERS)


def _customers(spark, rows):
    return spark.createDataFrame(rows, DIM_CUSTOMER.schema)


def test_violations_are_found(spark):
    good = (1, "C000001", "A", None, "22", None)
    twice = (2, "C000001", "B", None, None, None)
    null_name = (3, "C000003", None, None, None, None)
    long_code = (4, "C0000000004", "D", None, None, None)
    df = _customers(spark, [good, twice, null_name, long_code])
    assert [r.customer_code for r in checks.check_unique(df, "customer_code").collect()] == [
        "C000001"
    ]
    assert [r.customer_key for r in checks.check_not_null(df, DIM_CUSTOMER).collect()] == [3]
    assert [r.customer_key for r in checks.check_length(df, DIM_CUSTOMER).collect()] == [4]
    child = spark.createDataFrame([(1,), (9,), (None,)], "customer_key int")
    orphans = checks.check_foreign_key(child, "customer_key", df, "customer_key").collect()
    assert [r.customer_key for r in orphans] == [9]
    with pytest.raises(checks.IntegrityError, match="duplicate customer_code"):
        require_unique(df, "customer_code", "dim_customer")


@pytest.mark.parametrize(
    "row,message",
    [
        ((1, "C1", None, None, None, None), "null value in customer_name"),
        ((1, "C1234567890", "A", None, None, None), "value too long for customer_code"),
        ((1, "C1", "A", None, "1234", None), "value too long for dept"),
    ],
)
def test_enforced_rules_fail_the_job(spark, row, message):
    with pytest.raises(Exception, match=message):
        checks.enforce(_customers(spark, [row]), DIM_CUSTOMER).collect()


def test_enforced_rows_pass_unchanged(spark):
    row = (1, "C1", "A", None, "123", None)
    assert [tuple(r) for r in checks.enforce(_customers(spark, [row]), DIM_CUSTOMER).collect()] == [
        row
    ]


# -- dimensions and facts --------------------------------------------------------------


def test_null_attributes_stay_and_keys_follow_codes(spark, orders):
    changed = orders.withColumn(
        "customer_city", F.when(F.col("customer_code") > "C000010", F.col("customer_city"))
    )
    rows = build_dimension(changed, CUSTOMER).orderBy("customer_key").collect()
    codes = [r.customer_code for r in rows]
    assert codes == sorted(codes) and [r.customer_key for r in rows] == list(range(1, len(rows) + 1))
    assert all(r.city is None for r in rows if r.customer_code <= "C000010")


def _dims(orders):
    from orrery.operators.dims import DIM_SPECS

    return {spec.table.name: build_dimension(orders, spec) for spec in DIM_SPECS}


def test_unknown_code_drops_the_line_and_the_report_shows_it(spark, orders):
    dims = _dims(orders)
    known = dims["dim_customer"].filter("customer_key > 1")
    facts = build_fact(orders, {**dims, "dim_customer": known})
    lost = orders.count() - facts.count()
    assert lost == orders.filter("customer_code = 'C000001'").count() > 0
    full = build_fact(orders, dims)
    report = checks.orphan_report(
        full,
        {**dims, "dim_customer": known, "dim_date": full.select("date_key").distinct()},
        FACT_SALES,
    )
    by_column = {r.column_name: r for r in report.collect()}
    assert by_column["customer_key"].orphan_rows == lost
    assert by_column["product_key"].orphan_rows == 0


def test_interval_reaches_the_file_scan(orders):
    dims = _dims(orders)
    facts = build_fact(orders, dims, 100, 200, {name: df.count() for name, df in dims.items()})
    ids = [r.order_line_id for r in facts.select("order_line_id").collect()]
    assert sorted(ids) == list(range(101, 201))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(order_line_id,100)" in plan
    assert "LessThanOrEqual(order_line_id,200)" in plan
    assert "SortMergeJoin" not in plan


def test_dimension_beyond_the_limit_is_not_hinted(orders):
    rows = {"dim_customer": 40, "dim_salesrep": 40, "dim_product": 30}
    assert dimensions_bounded(rows)
    assert not dimensions_bounded({**rows, "dim_customer": 10**9})
    lengths = {"customer_code": 10}
    pairs = orders.select("customer_code", "quantity")
    assert widest_row_bytes(pairs.schema, lengths) == 32 + 8 + 40 + 8
    assert widest_row_bytes(pairs.schema, {}) is None
    assert "hint" not in broadcast_if_bounded(pairs, 10**8, lengths)._jdf.logicalPlan().toString()


def test_hot_code_is_split_when_nothing_is_broadcast(spark, orders):
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("C000001"))
        .otherwise(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string")))
        .alias("customer_code"),
        F.col("id").alias("order_line_id"),
        F.repeat(F.lit("x"), 60).alias("pad"),
    )
    codes = hot.select("customer_code").distinct()
    dim = materialise(codes.withColumn("customer_key", F.xxhash64("customer_code")), "dim")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        from orrery.operators.fact import lookup_key

        joined = lookup_key(hot, dim, CUSTOMER)
        assert len(joined.collect()) == 200_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- batches -----------------------------------------------------------------------------


@pytest.mark.parametrize("highest,size", [(1, 10), (10, 10), (11, 10), (1234, 100), (5, 1)])
def test_chunk_plan_covers_every_id_once(spark, highest, size):
    src = spark.range(1, highest + 1).withColumnRenamed("id", "order_line_id")
    rows = batches.chunk_plan(src, size).orderBy("chunk_no").collect()
    assert [r.from_id for r in rows] == list(range(0, highest, size))
    assert [r.chunk_no for r in rows] == list(range(1, len(rows) + 1))
    assert all(r.to_id == r.from_id + size for r in rows)
    numbered = src.select(
        "order_line_id", batches.chunk_number(F.col("order_line_id"), size).alias("n")
    )
    for r in numbered.collect():
        assert rows[r.n - 1].from_id < r.order_line_id <= rows[r.n - 1].to_id


def test_chunk_plan_edges(spark):
    empty = spark.range(0).withColumnRenamed("id", "order_line_id")
    assert batches.chunk_plan(empty, 10).count() == 0
    with pytest.raises(ValueError, match="positive"):
        batches.chunk_plan(empty, 0)
    assert batches.DEFAULT_CHUNK_SIZE == 20_000


# -- analyses and previews -----------------------------------------------------------------


def test_unknown_names_are_refused():
    with pytest.raises(ValueError, match="unknown axis"):
        analysis.analyze({}, "bogus")
    with pytest.raises(ValueError, match="unknown dimension"):
        previews.dimension_rows({}, "bogus")


def test_null_labels_form_a_group_and_ties_are_ordered(spark):
    star = {
        "dim_customer": spark.createDataFrame(
            [(1, None), (2, "b"), (3, "a")], "customer_key int, segment string"
        ),
        "fact_sales": spark.createDataFrame(
            [(1, 5, 1), (2, 5, 1), (3, 5, 1), (3, 0, 1)],
            "customer_key int, amount int, quantity int",
        ).withColumn("amount", F.col("amount").cast("decimal(14,2)")),
    }
    rows = analysis.analyze(star, "segment").collect()
    assert [(r.label, r.lines) for r in rows] == [("a", 2), ("b", 1), (None, 1)]


def test_fact_is_reduced_before_the_dimension_join(orders):
    dims = _dims(orders)
    star = {**dims, "fact_sales": build_fact(orders, dims)}
    plan = analysis.totals_by(star, analysis.AXES["brand"])._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    join = text.index("Join Inner")
    assert "Aggregate [product_key" in text[join:]


def test_jdbc_read_is_split_by_id():
    options = jdbc_options("jdbc:x", "staging.orders", 1, 1000, 4, user="u")
    assert options["partitionColumn"] == "order_line_id" and options["numPartitions"] == "4"
    assert options["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", 5, 1, 4)


# -- graph ---------------------------------------------------------------------------------


def _random_dag(seed, nodes=16, edges=30):
    rng = random.Random(seed)
    pairs = set()
    while len(pairs) < edges:
        a, b = sorted(rng.sample(range(nodes), 2))
        pairs.add((f"n{a}", f"n{b}"))
    return sorted(pairs)


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_against_brute_force(spark, seed):
    pairs = _random_dag(seed)
    edges = spark.createDataFrame(pairs, "src string, dst string")
    feeders = {}
    for a, b in pairs:
        feeders.setdefault(b, set()).add(a)

    def above(node):
        seen, todo = set(), [node]
        while todo:
            for f in feeders.get(todo.pop(), ()):
                if f not in seen:
                    seen.add(f)
                    todo.append(f)
        return seen

    def longest_walk(end):
        """Edges of the longest of all walks that end here, each listed in full."""
        walks, longest = [[end]], 0
        while walks:
            walk = walks.pop()
            longest = max(longest, len(walk) - 1)
            walks += [[feeder, *walk] for feeder in feeders.get(walk[0], ())]
        return longest

    targets = ["n15", "n9", "n7"]
    got = graph.upstream(edges, spark.createDataFrame([(t,) for t in targets], "target string"))
    assert sorted(map(tuple, got.collect())) == sorted((t, u) for t in targets for u in above(t))
    nodes = {n for pair in pairs for n in pair}
    layers = {r.node: r.layer for r in graph.dependency_layers(edges).collect()}
    assert layers == {n: longest_walk(n) for n in nodes}


def test_layers_of_a_long_chain(spark):
    pairs = [(f"c{i}", f"c{i + 1}") for i in range(50)] + [("c0", f"x{i}") for i in range(30)]
    chain = spark.createDataFrame(pairs, "src string, dst string")
    layers = {r.node: r.layer for r in graph.dependency_layers(chain).collect()}
    assert layers == {f"c{i}": i for i in range(51)} | {f"x{i}": 1 for i in range(30)}


def test_circles(spark):
    circle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b")], "src string, dst string")
    with pytest.raises(graph.CycleError):
        graph.dependency_layers(circle)
    target = spark.createDataFrame([("c",)], "target string")
    found = {r.upstream for r in graph.upstream(circle, target).collect()}
    assert found == {"a", "b", "c"}


@pytest.mark.parametrize("seed,nodes,edges", [(2, 20, 26), (3, 30, 60)])
def test_layers_of_circles_against_brute_force(spark, seed, nodes, edges):
    rng = random.Random(seed)
    pairs = [(f"n{rng.randrange(nodes):02}", f"n{rng.randrange(nodes):02}") for _ in range(edges)]
    every = sorted({n for pair in pairs for n in pair})
    reach = {n: {b for a, b in pairs if a == n} for n in every}
    for middle in every:
        for a in every:
            if middle in reach[a]:
                reach[a] |= reach[middle]
    component = {n: min([n, *(m for m in reach[n] if n in reach[m])]) for n in every}
    between = {(component[a], component[b]) for a, b in pairs if component[a] != component[b]}

    def longest(end):
        return max((1 + longest(a) for a, b in between if b == end), default=0)

    rows = [*pairs, *pairs[:3], (None, "n00"), ("n01", None)]
    frame = spark.createDataFrame(rows, "src string, dst string")
    on_circles = {r.node: r.component for r in graph.circles(frame).collect()}
    assert on_circles == {n: component[n] for n in every if n in reach[n]}
    got = sorted((r.node, r.component, r.layer) for r in graph.layers_of_circles(frame).collect())
    assert got == [(n, component[n], longest(component[n])) for n in every]


def test_circles_inside_one_colour(spark):
    """The first search finds the smallest circle only; those it feeds need a search of their own."""
    ring = lambda name, n: [(f"{name}{i}", f"{name}{(i + 1) % n}") for i in range(n)]
    pairs = ring("a", 3) + ring("b", 4) + ring("c", 2) + [("a1", "b0"), ("b2", "c1"), ("c0", "d"), ("z", "a0")]
    frame = spark.createDataFrame(pairs, "src string, dst string")
    got = {r.node: (r.component, r.layer) for r in graph.layers_of_circles(frame).collect()}
    layer = {"z": 0, "a": 1, "b": 2, "c": 3, "d": 4}
    name = {"z": "z", "a": "a0", "b": "b0", "c": "c0", "d": "d"}
    assert got == {n: (name[n[0]], layer[n[0]]) for pair in pairs for n in pair}
    assert graph.layers_of_circles(frame.limit(0)).count() == 0


def test_rounds_read_only_what_the_last_one_left(spark):
    """Leaves of a hub go in the first round and are not read again on the way along a chain."""
    pairs = [("hub", f"leaf{i}") for i in range(500)] + [("hub", "c0")] + [(f"c{i}", f"c{i + 1}") for i in range(6)]
    frame = spark.createDataFrame(pairs, "src string, dst string")
    stored, rounds, kept = graph._peeled(frame)
    assert [r["count"] for r in stored.groupBy("round").count().orderBy("round").collect()] == [507, 6, 5, 4, 3, 2, 1]
    assert (rounds, kept) == (7, 0)
    stored, rounds, kept = graph._peeled(frame.union(frame.limit(1).selectExpr("'c6' as src", "'c4' as dst")), "dst", "src")
    assert kept == 10 and rounds == 2  # all edges of the chain, and the one that closes its circle
    assert {r.node for r in graph.circles(frame.unionByName(frame.limit(1).selectExpr("'c6' as src", "'c4' as dst"))).collect()} == {"c4", "c5", "c6"}


def test_callees(spark):
    calls = [("f", c) for c in "pqrs"] + [("g", "t"), ("g", "u"), ("f", "u"), ("g", "t"), ("p", "z")]
    frame = spark.createDataFrame(calls, "caller string, callee string")
    rows = {r.callee: (r.caller, r.grouped) for r in graph.exclusive_callees(frame).collect()}
    assert rows == {
        **{c: ("f", True) for c in "pqrs"},
        "t": ("g", False),
        "z": ("p", False),
    }
    services = spark.createDataFrame([(s,) for s in "fgpqrstu"], "service string")
    assert [r.callee for r in graph.utility_callees(frame, services).collect()] == ["t"]


def test_a_service_that_calls_only_adapters_is_a_utility(spark):
    calls = [("load", "log"), ("load", "log"), ("load", "step"), ("load", "step"), ("log", "insert_row")]
    calls += [("step", "log"), ("load", "insert_row"), ("load", "insert_row")]
    frame = spark.createDataFrame(calls, "caller string, callee string")
    services = spark.createDataFrame([("load",), ("log",), ("step",)], "service string")
    found = graph.utility_callees(frame, services).collect()
    assert [(r.callee, r.most_calls, r.calls) for r in found] == [("log", 2, 3)]


def test_control_values_have_one_row_a_key(spark):
    pairs = lambda *rows: spark.createDataFrame(rows, "ctl_key string, ctl_value string")
    merged = control.insert_if_absent(pairs(("a", "1"), ("a", "0")), pairs(("b", "2"), ("b", "3"), ("a", "9")))
    assert sorted(map(tuple, merged.collect())) == [("a", "1"), ("b", "3")]
    changed = control.set_values(merged, pairs(("a", "5"), ("a", "7"), ("c", "1"), ("b", None)))
    assert sorted(map(tuple, changed.collect())) == [("a", "7"), ("b", None)]


def test_amounts_are_compared_from_both_sides(spark):
    src = spark.createDataFrame(
        [(1, 2, "1.50"), (2, 1, "1.00"), (3, 1, "2.00"), (4, 1, "1.00")],
        "order_line_id long, quantity int, unit_price string",
    ).withColumn("unit_price", F.col("unit_price").cast("decimal(12,2)"))
    fact = spark.createDataFrame(
        [(1, "3.00"), (2, "1.01"), (4, "0.50"), (4, "0.50"), (9, "5.00")], "order_line_id long, amount string"
    ).withColumn("amount", F.col("amount").cast("decimal(14,2)"))
    ids = sorted(r.order_line_id for r in checks.amount_mismatches(src, fact).collect())
    assert ids == [2, 3, 4, 9]
    row = checks.amount_check(src, fact).first()
    assert (row.lines_checked, row.mismatches, str(row.difference)) == (5, 4, "3.01")


def test_column_lineage(spark):
    edges = lineage.lineage_edges(spark)
    fed = lineage.unfed_columns(lineage.declared_columns(spark), edges)
    assert sorted(tuple(r) for r in fed.collect()) == [
        ("dim_customer", "customer_key"),
        ("dim_product", "product_key"),
        ("dim_salesrep", "salesrep_key"),
        ("fact_sales", "loaded_at"),
    ]
    targets = spark.createDataFrame([("fact_sales.amount",)], "target string")
    found = {r.upstream for r in graph.upstream(lineage.column_nodes(edges), targets).collect()}
    assert found == {"staging_orders.quantity", "staging_orders.unit_price"}
    assert edges.filter("target_table = 'dim_date'").count() == 14
    assert edges.filter("target_table like '%log%'").count() == 0
