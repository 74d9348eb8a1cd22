import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from orrery.operators.checks import IntegrityError
from orrery.operators.dims import DIM_SPECS
from orrery.operators.fact import build_fact
from orrery.plans import load as L
from orrery.plans import runlog
from orrery.plans.control import STOP_REQUESTED
from orrery.plans.load import LoadParams, load_star, replay_batch, request_stop, reset, start_load
from orrery.plans.status import status
from orrery.plans.warehouse import MissingRun, Warehouse, drop_runs, open_star
from orrery.schemas import FACT_SALES
from orrery.sources.orders import write_orders
from orrery.streaming.facts import read_stream_facts, stream_fact_load, stream_sales_by_month
from orrery.workspace import discard, stored_names

COMPARED = [n for n in FACT_SALES.names if n != "loaded_at"]


def facts(spark, root):
    return sorted(map(tuple, open_star(spark, root)["fact_sales"].select(*COMPARED).collect()))


def steps(warehouse):
    rows = runlog.last_run_log(warehouse.log.read()).collect()
    return {r.step_name: r for r in rows}, [r.step_name for r in rows]


@pytest.fixture(scope="module")
def loaded(spark, orders):
    from orrery.workspace import new_folder

    root = new_folder(spark, "test-star")
    result = load_star(orders, root, LoadParams(chunk_size=400, source_clustered=True))
    return root, result


def test_load_and_log(spark, orders, loaded):
    root, result = loaded
    n = orders.count()
    assert (result.status, result.total_rows, result.message) == ("DONE", n, None)
    rows, order = steps(Warehouse(spark, root))
    chunks = -(-n // 400)
    assert order == [
        "PIPELINE", "TRUNCATE_STAR", "DIM_DATE", "DIM_CUSTOMER", "DIM_SALESREP", "DIM_PRODUCT",
        *[f"FACT_CHUNK_{i}" for i in range(1, chunks + 1)], "PIPELINE_END",
    ]
    assert rows["PIPELINE"].status == "DONE" and rows["PIPELINE"].row_count == n
    assert rows["FACT_CHUNK_2"].message == "order_line_id 400-800"
    assert rows["FACT_CHUNK_2"].row_count == 400
    assert rows["DIM_SALESREP"].row_count == orders.select("salesrep_code").distinct().count()
    assert sum(r.row_count for s, r in rows.items() if s.startswith("FACT_CHUNK")) == n


@pytest.mark.parametrize("size,threads", [(400, 1), (500, 2), (333, 4)])
def test_batches_give_the_same_star(spark, orders, loaded, folder, size, threads):
    root = folder("star")
    params = LoadParams(chunk_size=size, batches_a_block=threads, threads=threads)
    result = load_star(orders, root, params)
    assert result.status == "DONE"
    assert facts(spark, root) == facts(spark, loaded[0])


def test_many_blocks_take_a_bounded_number_of_jobs(spark, orders, loaded, folder, monkeypatch):
    written, original = [], L.StopWatch.ends
    monkeypatch.setattr(L.StopWatch, "ends", lambda self, write: written.append(1) or original(self, write))
    root = folder("star")
    load_star(orders, root, LoadParams(chunk_size=10, batches_a_block=2, threads=2)).require_done()
    warehouse = Warehouse(spark, root)
    assert 1 < len(written) <= L.JOBS_A_LOAD < warehouse.plan(warehouse.published_run()).blocks
    assert facts(spark, root) == facts(spark, loaded[0])
    rows, order = steps(warehouse)
    assert sum(name.startswith("FACT_CHUNK_") for name in order) == -(-orders.count() // 10)
    assert all(row.row_count in (10, orders.count() % 10) for name, row in rows.items() if "CHUNK" in name)


def test_replay_changes_nothing(spark, orders, loaded):
    root = loaded[0]
    before = facts(spark, root)
    opened = open_star(spark, root)["fact_sales"]
    assert replay_batch(orders, root, 2, 400) == 400
    assert replay_batch(orders, root, 2) == 400
    assert facts(spark, root) == before
    assert opened.count() == len(before)
    with pytest.raises(ValueError, match="batches of 400"):
        replay_batch(orders, root, 2, 500)
    with pytest.raises(ValueError, match="has batches 1 to"):
        replay_batch(orders, root, 99)
    assert facts(spark, root) == before
    rows, order = steps(Warehouse(spark, root))
    assert rows["FACT_CHUNK_2"].row_count == 400


@pytest.mark.parametrize(
    "change,told",
    [
        ({"product_code": "'P-NONE'"}, "reconciliation"),
        ({"order_date": "date '1999-01-01'"}, "date_key 19990101 is not in dim_date"),
        ({"order_line_id": "450L"}, "duplicate order_line_id"),
    ],
)
def test_a_replay_that_fails_its_check_changes_nothing(spark, orders, loaded, change, told):
    root = loaded[0]
    before = facts(spark, root)
    broken = orders
    for column, value in change.items():
        hit = F.col("order_line_id").between(440, 460)
        broken = broken.withColumn(column, F.when(hit, F.expr(value)).otherwise(F.col(column)))
    with pytest.raises(IntegrityError, match=told):
        replay_batch(broken, root, 2)
    assert facts(spark, root) == before


def test_replay_after_lines_vanished(spark, orders, folder):
    root = folder("star")
    load_star(orders, root, LoadParams(chunk_size=400))
    fewer = orders.filter("order_line_id <= 400 or order_line_id > 800")
    assert replay_batch(fewer, root, 2) == 0
    assert len(facts(spark, root)) == fewer.count()


def test_unclustered_source_and_unhinted_joins(spark, orders, loaded, folder):
    root = folder("star")
    params = LoadParams(chunk_size=400, broadcast_limit=0)
    assert load_star(orders.orderBy(F.rand(1)), root, params).status == "DONE"
    assert facts(spark, root) == facts(spark, loaded[0])


def test_bounded_lookups_do_not_shuffle_the_fact(spark, orders, loaded):
    star = open_star(spark, loaded[0])
    sizes = {spec.table.name: star[spec.table.name].count() for spec in DIM_SPECS}
    built = build_fact(orders, star, dim_rows=sizes)
    assert len(built.collect()) == orders.count()
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "ShuffleQueryStage" not in plan


def test_french_calendar(spark, orders, folder):
    root = folder("star")
    load_star(orders, root, LoadParams(lang="fr"))
    row = open_star(spark, root)["dim_date"].orderBy("date_key").first()
    assert "-T" in row.quarter_label and row.month_name in ("janvier", "février")


def test_empty_source(spark, orders, folder):
    for threads in (None, 2):
        root = folder("star")
        result = load_star(orders.limit(0), root, LoadParams(threads=threads))
        assert (result.status, result.total_rows) == ("DONE", 0)
        assert facts(spark, root) == []


def test_stop_between_batches(spark, orders, folder, monkeypatch):
    root = folder("star")
    load_star(orders, root, LoadParams(chunk_size=400))
    before = facts(spark, root)
    original = L.write_block

    def stop_after_first(warehouse, *rest):
        original(warehouse, *rest)
        warehouse.control.set(STOP_REQUESTED, "true")

    monkeypatch.setattr(L, "write_block", stop_after_first)
    result = start_load(orders, root, LoadParams(chunk_size=400, batches_a_block=1, threads=1))
    assert (result.status, result.total_rows) == ("STOPPED", 400)
    # readers keep the complete star; the stopped one is there by name, and told as such
    assert facts(spark, root) == before
    assert open_star(spark, root, result.run_id)["fact_sales"].count() == 400
    told = [(r.status, r.rows) for r in Warehouse(spark, root).publications().collect()]
    assert told == [("DONE", len(before)), ("STOPPED", 400)]
    rows, order = steps(Warehouse(spark, root))
    assert "FACT_CHUNK_1" in order and "FACT_CHUNK_2" not in order
    assert rows["PIPELINE"].status == "STOPPED"


@pytest.mark.parametrize("threads, kept", [(None, [0]), (2, [0, 400, 800])])
def test_stop_ends_a_running_write(spark, orders, folder, threads, kept):
    """Lines from 801 on take long; the flag is raised while they are written."""
    slow = F.udf(lambda q, line: (time.sleep(0.5 if line > 800 else 0), q)[1], "int")
    source = orders.withColumn("quantity", slow("quantity", "order_line_id"))
    root = folder("star")
    params = LoadParams(chunk_size=400, batches_a_block=1, threads=threads)
    with ThreadPoolExecutor(1) as pool:
        load = pool.submit(load_star, source, root, params)
        while not stored_names(spark, f"{root}/runs"):
            time.sleep(0.2)
        run = stored_names(spark, f"{root}/runs")[0]
        before_facts = {"batch_plan", "dim_date", "dim_customer", "dim_salesrep", "dim_product"}
        while not before_facts <= set(stored_names(spark, f"{root}/runs/{run}")):
            time.sleep(0.2)
        while Warehouse(spark, root).log.read().filter("step_name = 'DIM_PRODUCT'").isEmpty():
            time.sleep(0.2)
        time.sleep(6 if threads else 2)
        begun = time.monotonic()
        request_stop(spark, root)
        result = load.result()
    assert result.status == "STOPPED" and result.total_rows in kept
    assert time.monotonic() - begun < 60
    assert open_star(spark, root, run)["fact_sales"].count() == result.total_rows
    assert open_star(spark, root)["fact_sales"].isEmpty()


def test_stop_flag_up_from_the_start(spark, orders, folder):
    root = folder("star")
    request_stop(spark, root)
    result = load_star(orders, root, LoadParams(chunk_size=400))
    assert (result.status, result.total_rows) == ("STOPPED", 0)
    assert start_load(orders, root, LoadParams(chunk_size=400)).status == "DONE"


def test_duplicate_code_fails_and_keeps_the_published_star(spark, orders, folder):
    root = folder("star")
    load_star(orders, root, LoadParams(chunk_size=400))
    before = facts(spark, root)
    renamed = orders.withColumn(
        "customer_name",
        F.when(F.col("order_line_id") == 7, F.lit("Other")).otherwise(F.col("customer_name")),
    )
    result = load_star(renamed, root, LoadParams(chunk_size=400))
    assert result.status == "FAILED" and result.total_rows == 0
    assert result.message.startswith("DIM_CUSTOMER: dim_customer: duplicate customer_code")
    assert facts(spark, root) == before
    rows, order = steps(Warehouse(spark, root))
    assert "DIM_CUSTOMER" not in order and rows["PIPELINE"].status == "FAILED"
    with pytest.raises(RuntimeError):
        result.require_done()


@pytest.mark.parametrize(
    "column,value,message",
    [
        ("customer_code", None, "null value in customer_code"),
        ("product_code", "P123456789012", "value too long for product_code"),
        ("order_id", None, "null value in order_id"),
        ("quantity", None, "null value in quantity"),
    ],
)
def test_broken_rows_fail_the_load(spark, orders, folder, column, value, message):
    kind = orders.schema[column].dataType
    broken = orders.withColumn(
        column,
        F.when(F.col("order_line_id") == 5, F.lit(value).cast(kind)).otherwise(F.col(column)),
    )
    result = load_star(broken, folder("star"), LoadParams(chunk_size=400))
    assert result.status == "FAILED" and message in result.message


def test_repeated_line_id_fails(orders, folder):
    twice = orders.unionByName(orders.filter("order_line_id = 9"))
    result = load_star(twice, folder("star"), LoadParams(chunk_size=400))
    assert result.status == "FAILED" and "duplicate order_line_id (such as 9)" in result.message


def test_failed_batch_cancels_the_rest(spark, orders, folder):
    broken = orders.withColumn(
        "quantity", F.when(F.col("order_line_id") != 450, F.col("quantity"))
    )
    root = folder("star")
    result = load_star(broken, root, LoadParams(chunk_size=400, batches_a_block=1, threads=1))
    assert result.status == "FAILED" and result.message.startswith("FACT_CHUNK_2:")
    _, order = steps(Warehouse(spark, root))
    assert "FACT_CHUNK_1" in order and "FACT_CHUNK_3" not in order
    logged = Warehouse(spark, root).log.read().filter("step_name = 'PIPELINE' and status = 'FAILED'")
    assert logged.first().message == result.message
    log = Warehouse(spark, root).log
    log.event("RUN-x", "STEP", "FAILED", datetime.now(timezone.utc), message="m" * 900)
    log.flush()
    assert log.read().filter("run_id = 'RUN-x'").first().message == "m" * 900


def test_ids_below_one_are_refused(orders, folder):
    zero = orders.withColumn("order_line_id", F.col("order_line_id") - 1)
    for threads in (None, 1):
        result = load_star(zero, folder("star"), LoadParams(chunk_size=400, threads=threads))
        assert result.status == "FAILED" and "order_line_id 0 is below 1" in result.message


def test_a_missing_run_or_table_is_told(spark, orders, folder):
    root = folder("star")
    run = load_star(orders, root, LoadParams(chunk_size=400)).run_id
    with pytest.raises(MissingRun, match="RUN-nope"):
        open_star(spark, root, "RUN-nope")
    discard(spark, Warehouse(spark, root).table_path(run, "fact_sales"))
    with pytest.raises(MissingRun, match="fact_sales"):
        open_star(spark, root)


def test_old_runs_are_dropped_and_reset_frees_all(spark, orders, folder):
    root = folder("star")
    runs = [load_star(orders, root, LoadParams(chunk_size=400)).run_id for _ in range(3)]
    warehouse = Warehouse(spark, root)
    assert len(set(runs)) == 3 and warehouse.stored_runs() == sorted(runs)
    assert drop_runs(spark, root, keep=2) == [runs[0]]
    assert warehouse.stored_runs() == sorted(runs[1:]) and len(facts(spark, root)) == orders.count()
    with pytest.raises(ValueError):
        drop_runs(spark, root, keep=0)
    reset(spark, root)
    assert warehouse.stored_runs() == [] and facts(spark, root) == []


def test_status_follows_a_running_load(spark, orders, folder, monkeypatch):
    root, seen = folder("star"), []
    original = L.write_block

    def look_after(warehouse, *rest):
        original(warehouse, *rest)
        warehouse.log.flush()
        seen.append(status(orders, root)["counts"].first())

    monkeypatch.setattr(L, "write_block", look_after)
    load_star(orders, root, LoadParams(chunk_size=400, batches_a_block=1, threads=1))
    assert [c.fact_rows for c in seen] == [400, 800, orders.count()]
    assert seen[0].fact_size.endswith(("bytes", "kB"))


def test_guard_reset_and_status(spark, orders, folder):
    root = folder("star")
    warehouse = Warehouse(spark, root).create()
    warehouse.log.event("RUN-1", "PIPELINE", "RUNNING", datetime.now(timezone.utc))
    warehouse.log.flush()
    with pytest.raises(L.LoadAlreadyRunning):
        start_load(orders, root)
    reset(spark, root)
    assert start_load(orders, root, LoadParams(chunk_size=400)).status == "DONE"
    now = status(orders, root)
    counts = now["counts"].first()
    assert counts.fact_rows == counts.src_rows == orders.count()
    assert counts.stop_requested == "false"
    assert now["preview"].first().order_line_id == orders.count()
    assert now["source_next"].count() == 0 and now["run_log"].count() > 6
    request_stop(spark, root)
    reset(spark, root)
    assert facts(spark, root) == []
    empty = status(orders, root)
    assert empty["counts"].first().stop_requested == "false"
    assert empty["counts"].first().fact_amount == 0
    assert empty["source_next"].count() == 6 and empty["run_log"].count() == 0


def test_parameters_are_checked():
    with pytest.raises(ValueError, match="threads"):
        LoadParams(threads=3)
    with pytest.raises(ValueError, match="positive"):
        LoadParams(chunk_size=0)


def test_stream_equals_batch_and_takes_new_files(spark, orders, loaded, folder):
    path, out, state = folder("in"), folder("out"), folder("state")
    star = open_star(spark, loaded[0])
    sizes = {spec.table.name: star[spec.table.name].count() for spec in DIM_SPECS}
    half = orders.count() // 2
    write_orders(orders.filter(F.col("order_line_id") <= half), path)
    first = stream_fact_load(spark, path, star, out, state, sizes, files_per_batch=2)
    assert first.count() == half
    again = stream_fact_load(spark, path, star, out, state, sizes, files_per_batch=2)
    assert again.count() == half
    orders.filter(F.col("order_line_id") > half).write.mode("append").parquet(path)
    full = stream_fact_load(spark, path, star, out, state, sizes, files_per_batch=2)
    assert sorted(map(tuple, full.select(*COMPARED).collect())) == facts(spark, loaded[0])
    months = stream_sales_by_month(spark, path, folder("months"), folder("state"), 1)
    assert months.agg(F.sum("lines")).first()[0] == orders.count()


def test_stream_takes_each_line_once(spark, orders, loaded, folder):
    path, out, state = folder("in"), folder("out"), folder("state")
    star = open_star(spark, loaded[0])
    assert stream_fact_load(spark, path, star, out, state).count() == 0
    orders.filter("order_line_id <= 500").write.parquet(path)
    assert stream_fact_load(spark, path, star, out, state).count() == 500
    again = orders.filter("order_line_id between 491 and 520")
    again.union(again.limit(3)).coalesce(1).write.mode("append").parquet(path)
    got = stream_fact_load(spark, path, star, out, state)
    assert sorted(r[0] for r in got.select("order_line_id").collect()) == list(range(1, 521))


@pytest.mark.parametrize(
    "column,value,told",
    [
        ("order_date", "date '1999-01-01'", "not in the calendar"),
        ("product_code", "'P-NONE'", "facts"),
        ("order_line_id", "7L", "order_line_id"),
    ],
)
def test_a_refused_stream_batch_stays_unread(spark, orders, loaded, folder, column, value, told):
    path, out, state = folder("in"), folder("out"), folder("state")
    star = open_star(spark, loaded[0])
    orders.filter("order_line_id <= 300").write.parquet(path)
    assert stream_fact_load(spark, path, star, out, state).count() == 300
    hit = F.col("order_line_id").between(340, 350)
    later = orders.filter("order_line_id between 301 and 400")
    later = later.withColumn(column, F.when(hit, F.expr(value)).otherwise(F.col(column)))
    later.write.mode("append").parquet(path)
    with pytest.raises(Exception, match=told):
        stream_fact_load(spark, path, star, out, state)
    assert read_stream_facts(spark, out).count() == 300


def test_stream_refuses_unknown_codes(spark, orders, orders_path, loaded, folder):
    star = open_star(spark, loaded[0])
    known = {**star, "dim_product": star["dim_product"].filter("product_key > 1")}
    with pytest.raises(Exception, match="facts"):
        stream_fact_load(spark, orders_path, known, folder("out"), folder("state"))
