"""What building the source and loading the star leave on disk, and how wide the rows are that they shuffle."""

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from orrery.catalogue import Prepared
from orrery.operators.dims import DIM_SPECS
from orrery.operators.fact import build_fact
from orrery.plans import load as L
from orrery.plans.load import LoadParams, load_star
from orrery.plans.warehouse import Warehouse, open_star
from orrery.sources import orders as O
from orrery.workspace import materialise, shared_root, shuffles_dropped, stored_names, tables_dropped

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {name for name in names if name.startswith("shuffle_")}


def new_shuffle_files(spark, before):
    """Those that stay: files go a moment after their step."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            return left
        time.sleep(0.1)
    return left


def key_tables(spark):
    return {n for n in stored_names(spark, f"{shared_root(spark)}/orrery") if n.startswith("key-")}


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def unhinted(spark):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


def test_building_the_source_leaves_nothing_but_the_source(spark):
    shuffled, keys = shuffle_files(spark), key_tables(spark)
    with unhinted(spark):
        stored = Prepared(spark, SMALL).source
    assert stored.count() == 6000
    spark.sql("select 1").collect()
    assert key_tables(spark) == keys
    # the count above has one of its own
    assert len({name.split("_")[1] for name in new_shuffle_files(spark, shuffled)}) <= 1


def test_a_load_leaves_nothing_but_the_star(spark, orders, folder, monkeypatch):
    keys, left, before = key_tables(spark), [], []
    original, prepare = Warehouse.publish, L._Run.prepare
    monkeypatch.setattr(L._Run, "prepare", lambda self: before.append(shuffle_files(spark)) or prepare(self))
    monkeypatch.setattr(
        Warehouse, "publish", lambda self, *a: left.append(new_shuffle_files(spark, before[0])) or original(self, *a)
    )
    load_star(orders, folder("star"), LoadParams(chunk_size=400, broadcast_limit=0)).require_done()
    assert left == [set()]
    assert key_tables(spark) == keys


def test_steps_side_by_side_set_the_setting_back(spark):
    before = spark.conf.get(SETTING)

    def step(seconds):
        with shuffles_dropped(spark):
            time.sleep(seconds)
            return spark.conf.get(SETTING)

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(step, (0.1, 0.6, 0.3))) == ["true"] * 3
    assert spark.conf.get(SETTING) == before
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(SETTING) == before


def test_tables_of_a_failed_step_go_too(spark):
    keys = key_tables(spark)
    with pytest.raises(ValueError), tables_dropped(spark):
        assert materialise(spark.range(5), "key-test").count() == 5
        assert len(key_tables(spark) - keys) == 1
        raise ValueError
    assert key_tables(spark) == keys
    assert materialise(spark.range(5), "test").count() == 5


# -- the source ----------------------------------------------------------------------------


def _interval_of_files(lines):
    by_file = lines.groupBy(F.input_file_name().alias("file")).agg(
        F.min("order_line_id").alias("low"), F.max("order_line_id").alias("high"), F.count("*").alias("rows")
    )
    return sorted((r.low, r.high, r.rows) for r in by_file.collect())


def _apart(files):
    return all(a[1] < b[0] for a, b in zip(files, files[1:]))


def test_wide_lines_are_not_shuffled(spark, folder, monkeypatch):
    """Lines reach their interval before the names of customers, and as numbers instead of codes."""
    monkeypatch.setattr(O, "ROWS_PER_FILE", 500)
    with unhinted(spark), tables_dropped(spark):
        lines = O.orders_from_normalised(spark, SMALL)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        over = plan[: plan.index("SortMergeJoin [_part")]
        assert "Exchange" not in over
        exchanged = plan.split("Exchange ")[1:]
        assert sum(text.startswith("shufflepartitionidpassthrough") for text in exchanged) == 2
        assert "BroadcastHashJoin [l_suppkey" in plan and "hashpartitioning(l_suppkey" not in plan
        stored = O.write_orders(lines, folder("orders"), spread=False)
    files = _interval_of_files(stored)
    assert files == [(i * 500 + 1, (i + 1) * 500, 500) for i in range(12)]
    for path in stored.inputFiles():
        ids = pq.read_table(path.removeprefix("file:"), columns=["order_line_id"])[0].to_pylist()
        assert ids == sorted(ids)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_an_order_over_many_intervals(spark, tmp_path, folder, monkeypatch, threshold):
    """2,400 of 3,000 lines are of one order; some lines name an order, product or seller that is not there."""
    monkeypatch.setattr(O, "ROWS_PER_FILE", 200)
    n, day = 3000, datetime(2024, 5, 1)
    order = [7 if i % 5 else i % 40 for i in range(n)]
    tables = {
        "region": {"r_regionkey": [0], "r_name": ["ASIA"]},
        "nation": {"n_nationkey": [0], "n_name": ["N0"], "n_regionkey": [0]},
        "customer": {"c_custkey": [1, 2], "c_name": ["A", "B"], "c_nationkey": [0, 0], "c_mktsegment": ["X", "Y"]},
        "supplier": {"s_suppkey": [5], "s_name": ["S"], "s_nationkey": [0]},
        "part": {
            "p_partkey": [3], "p_name": ["P"], "p_type": ["T"], "p_brand": ["B"], "p_retailprice": [10.0],
        },
        "orders": {"o_orderkey": list(range(30)), "o_custkey": [i % 3 for i in range(30)], "o_orderdate": [day] * 30},
        "lineitem": {
            "l_orderkey": order, "l_linenumber": list(range(n)), "l_partkey": [3 if i % 11 else 4 for i in range(n)],
            "l_suppkey": [5 if i % 13 else 6 for i in range(n)], "l_quantity": [float(i % 9) for i in range(n)],
            "l_extendedprice": [1.0] * n, "l_discount": [0.25] * n, "l_tax": [0.0] * n,
            "l_returnflag": ["N"] * n, "l_linestatus": ["O"] * n, "l_shipdate": [day] * n,
        },
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": threshold}):
        stored = O.write_orders(O.orders_from_normalised(spark, str(tmp_path)), folder("orders"), spread=False)
    want, ranked = [], sorted(range(n), key=lambda i: (order[i], i))
    for rank, i in enumerate(ranked, 1):
        if order[i] < 30 and order[i] % 3 and i % 11 and i % 13:
            who = "A" if order[i] % 3 == 1 else "B"
            want.append((rank, f"CMD{order[i]:08}", who, f"C{order[i] % 3:06}", "REP00005", "P000003", i % 9))
    got = stored.select(
        "order_line_id", "order_id", "customer_name", "customer_code", "salesrep_code", "product_code", "quantity"
    )
    assert sorted(map(tuple, got.collect())) == want
    files = _interval_of_files(stored)
    assert _apart(files) and max(rows for *_, rows in files) <= 200


# -- the load ------------------------------------------------------------------------------


def test_ids_do_not_move_when_none_repeats(orders, folder, monkeypatch):
    def moved(*_):
        raise AssertionError("ids were shuffled")

    monkeypatch.setattr(L, "repeated_ids", moved)
    assert load_star(orders, folder("star"), LoadParams(chunk_size=400)).status == "DONE"


def test_rows_are_rebalanced_before_their_rules(spark, orders, folder):
    root = folder("star")
    load_star(orders, root, LoadParams(chunk_size=400)).require_done()
    star = open_star(spark, root)
    sizes = {spec.table.name: star[spec.table.name].count() for spec in DIM_SPECS}
    sizes |= {"dim_customer": 10**8, "dim_product": 10**8}
    with unhinted(spark):
        facts = build_fact(orders, star, dim_rows=sizes, spread=F.col("order_line_id") % 3)
        plan = facts._jdf.queryExecution().optimizedPlan().toString()
    over, under = plan.split("RebalancePartitions")
    assert "raise_error" in over and "raise_error" not in under and "amount" not in under
    joins = [line for line in under.splitlines() if "Join Inner" in line]
    assert ["salesrep_code" in line for line in joins] == [False, False, True]  # the innermost one is broadcast
    assert "order_line_id" in facts.columns and "_spread" not in facts.columns
    plain = build_fact(orders, star, dim_rows=sizes)
    assert facts.drop("loaded_at").exceptAll(plain.drop("loaded_at")).isEmpty()
    assert facts.count() == orders.count()
