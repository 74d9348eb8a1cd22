"""Commit log, id bitmaps, parallel replays, incremental loads and several streams into one table."""

import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from orrery.operators import checks, idsets
from orrery.operators.checks import IntegrityError
from orrery.plans.commits import CommitLog, ConcurrentChange
from orrery.plans.growth import load_new_lines
from orrery.plans.load import LoadParams, load_star, merge_block, replay_batch
from orrery.plans.warehouse import Warehouse, open_star
from orrery.schemas import FACT_SALES
from orrery.streaming.facts import StreamFacts, read_stream_facts, stream_fact_load
from orrery.workspace import stored_names

COMPARED = [n for n in FACT_SALES.names if n != "loaded_at"]


def facts(spark, root):
    return sorted(map(tuple, open_star(spark, root)["fact_sales"].select(*COMPARED).collect()))


@pytest.fixture(scope="module")
def loaded(spark, orders):
    from orrery.workspace import new_folder

    root = new_folder(spark, "test-star")
    load_star(orders, root, LoadParams(chunk_size=400, batches_a_block=2)).require_done()
    return root


# --- the log


def test_each_number_is_entered_once(spark, folder):
    path = folder("log")
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda i: CommitLog(spark, path, "who long").commit({"who": i}), range(24)))
    assert sorted(numbers) == list(range(1, 25))
    log = CommitLog(spark, path, "who long")
    assert sorted(tuple(r) for r in log.read().collect()) == sorted(zip(range(24), numbers))


def test_a_writer_sees_what_others_entered(spark, folder):
    log = CommitLog(spark, folder("log"), "who long")
    assert log.last() == 0 and log.read().count() == 0
    assert log.commit({"who": 1}) == 1
    seen = []
    assert log.commit({"who": 2}, 0, seen.extend) == 2
    assert [(e.who, e.version) for e in seen] == [(1, 1)]

    def refuse(entries):
        raise ConcurrentChange("no")

    with pytest.raises(ConcurrentChange):
        log.commit({"who": 3}, 1, refuse)
    assert log.commit({"who": 4}, 2, refuse) == 3


def test_merged_entries_are_read_and_numbers_are_not_used_again(spark, folder):
    log = CommitLog(spark, folder("log"), "who long")
    for generation in range(3):
        for _ in range(3):
            log.commit({"who": generation})
        opened = log.read()
        log.tidy(least=3)
    assert opened.count() == 9
    assert sorted(r.version for r in log.read().collect()) == list(range(1, 10))
    assert len(stored_names(spark, f"{log.path}/entries")) < 9
    assert not CommitLog.last(log) < 9
    # a writer that comes back with a number whose file was freed
    log.last = lambda numbers=iter([0, 0, 9]): next(numbers)
    assert log.commit({"who": 9}) == 10


# --- sets of ids


def test_bitmaps_find_repeated_and_shared_ids(spark):
    rng = random.Random(5)
    ids = [rng.choice([1, 40_000, 2**40]) + rng.randrange(50) for _ in range(90)] + [None]
    rows = spark.createDataFrame([(i,) for i in ids], "line long").repartition(4)
    want = {i: n for i, n in Counter(ids).items() if n > 1 and i is not None}
    assert {r.line: r.copies for r in idsets.repeated_ids(rows, "line").collect()} == want
    others = spark.createDataFrame([(i,) for i in (*range(20, 30), 2**40 + 3, 7**20, 32_768)], "line long")
    shared = {r.line for r in idsets.ids_in_common(rows, others, "line").collect()}
    assert shared == set(ids) & {*range(20, 30), 2**40 + 3}
    assert idsets.repeated_ids(rows.limit(0), "line").count() == 0


def test_bitmaps_shuffle_a_bit_for_an_id(spark):
    rows = spark.range(1, 400_001, 1, 2)
    bitmaps = idsets.id_bitmaps(rows, "id").collect()
    assert len(bitmaps) == 13 and sum(r.n for r in bitmaps) == 400_000
    assert idsets.repeated_ids(rows, "id").isEmpty()


def test_equal_batches_are_not_compared_line_by_line(spark, orders, loaded):
    stored = open_star(spark, loaded)["fact_sales"]
    assert checks.amount_differences(orders, stored, 100).isEmpty()
    line = F.col("order_line_id")
    changed = stored.filter(line != 17).withColumn(
        "amount", F.when(line == 250, F.lit(None)).otherwise(F.col("amount"))
    )
    assert sorted(r[0] for r in checks.changed_batches(orders, changed, 100).collect()) == [1, 3]
    found = checks.amount_differences(orders, changed, 100).collect()
    assert {(r.order_line_id, r.facts) for r in found} == {(17, None), (250, 1)}


# --- replays


def test_replays_at_the_same_time_all_succeed(spark, orders, loaded):
    before = facts(spark, loaded)
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(replay_batch, orders, loaded, n) for n in (1, 1, 2)]
        assert [j.result() for j in jobs] == [400, 400, 400]
    assert facts(spark, loaded) == before
    warehouse = Warehouse(spark, loaded)
    run = warehouse.published_run()
    versions = [r.version for r in warehouse.changes(run).read().collect()]
    assert len(versions) == len(set(versions)) >= 3


def test_a_replay_writes_its_batch_only_and_blocks_can_be_merged(spark, orders, loaded):
    before = facts(spark, loaded)
    warehouse = Warehouse(spark, loaded)
    run = warehouse.published_run()
    replay_batch(orders, loaded, 2)
    newest = warehouse.changes(run).read().orderBy(F.col("version").desc()).first()
    assert spark.read.parquet(warehouse.block_path(run, 1, newest.attempt)).count() == 400
    assert merge_block(spark, loaded, 1) == 800
    assert facts(spark, loaded) == before
    replay_batch(orders, loaded, 1)
    assert facts(spark, loaded) == before
    with pytest.raises(ValueError, match="blocks 1 to"):
        merge_block(spark, loaded, 99)


# --- incremental loads


def meaning(star):
    """Facts with codes and dates in place of keys."""
    rows = star["fact_sales"]
    for name, key, shown in (
        ("dim_customer", "customer_key", ["customer_code", "customer_name", "city"]),
        ("dim_salesrep", "salesrep_key", ["salesrep_code"]),
        ("dim_product", "product_key", ["product_code", "brand"]),
        ("dim_date", "date_key", ["full_date", "month_name"]),
    ):
        rows = rows.join(star[name].select(key, *shown), key)
    left_out = ("loaded_at", "customer_key", "salesrep_key", "product_key")
    return sorted(map(repr, rows.select(*sorted(c for c in rows.columns if c not in left_out)).collect()))


def test_new_lines_equal_a_full_load_and_keep_keys(spark, orders, folder):
    root, whole = folder("star"), folder("star")
    load_star(orders.filter("order_line_id <= 250"), root, LoadParams(chunk_size=100, batches_a_block=2, lang="fr"))
    old = open_star(spark, root)
    kept = {n: old[n].collect() for n in old}
    assert load_new_lines(orders.filter("order_line_id <= 700"), root).total_rows == 450
    n = orders.count()
    assert load_new_lines(orders, root).total_rows == n - 700
    assert load_new_lines(orders, root).total_rows == 0
    load_star(orders, whole, LoadParams(lang="fr"))
    star, full = open_star(spark, root), open_star(spark, whole)
    assert meaning(star) == meaning(full)
    for name, rows in kept.items():
        assert set(rows) <= set(star[name].collect())
        assert star[name].count() == full[name].count()
        assert old[name].count() == len(rows)  # who opened the star before sees it as it was
    for name, key in (("dim_customer", "customer_key"), ("dim_product", "product_key")):
        assert sorted(r[0] for r in star[name].select(key).collect()) == list(range(1, star[name].count() + 1))
    replay_batch(orders, root, 3)
    assert meaning(open_star(spark, root)) == meaning(full)


@pytest.mark.parametrize(
    "change,told",
    [
        ({"customer_city": "'Elsewhere'"}, "customer_code with other attributes"),
        ({"order_line_id": "450L"}, "duplicate order_line_id"),
        ({"quantity": "cast(null as int)"}, "null value in quantity"),
    ],
)
def test_new_lines_that_break_a_rule_change_nothing(spark, orders, folder, change, told):
    root = folder("star")
    load_star(orders.filter("order_line_id <= 400"), root, LoadParams(chunk_size=100))
    before = facts(spark, root)
    broken = orders.filter("order_line_id <= 500")
    for column, value in change.items():
        hit = F.col("order_line_id").between(440, 460)
        broken = broken.withColumn(column, F.when(hit, F.expr(value)).otherwise(F.col(column)))
    with pytest.raises(Exception, match=told):
        load_new_lines(broken, root)
    assert facts(spark, root) == before
    assert load_new_lines(orders.filter("order_line_id <= 500"), root).total_rows == 100


def test_loads_of_new_lines_at_the_same_time(spark, orders, folder):
    root = folder("star")
    load_star(orders.filter("order_line_id <= 400"), root, LoadParams(chunk_size=100))
    with ThreadPoolExecutor(2) as pool:
        parts = [orders.filter("order_line_id <= 600"), orders.filter("order_line_id <= 800")]
        done = [job.result().total_rows for job in [pool.submit(load_new_lines, p, root) for p in parts]]
    assert sum(done) == 400
    assert [f[0] for f in facts(spark, root)] == list(range(1, 801))


# --- streams


def test_two_checkpoints_into_one_table_lose_nothing(spark, orders, loaded, folder):
    one, two, out = folder("in"), folder("in"), folder("out")
    star = open_star(spark, loaded)
    orders.filter("order_line_id <= 300").write.parquet(one)
    orders.filter("order_line_id between 301 and 600").write.parquet(two)
    stream_fact_load(spark, one, star, out, folder("state"))
    assert stream_fact_load(spark, two, star, out, folder("state")).count() == 600
    assert read_stream_facts(spark, out).select("order_line_id").distinct().count() == 600


def test_streams_at_the_same_time(spark, orders, loaded, folder):
    out = folder("out")
    star = open_star(spark, loaded)
    paths = [folder("in") for _ in range(3)]
    for i, path in enumerate(paths):  # neighbours deliver some of the same lines
        orders.filter(F.col("order_line_id").between(200 * i + 1, 200 * i + 250)).coalesce(2).write.parquet(path)
    states = [folder("state") for _ in paths]
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(stream_fact_load, spark, p, star, out, s, None, 1) for p, s in zip(paths, states)]
        for job in jobs:
            job.result()
    ids = sorted(r[0] for r in read_stream_facts(spark, out).select("order_line_id").collect())
    assert ids == list(range(1, 651))


def test_a_changed_line_is_refused_by_name(spark, orders, loaded, folder):
    path, out, state = folder("in"), folder("out"), folder("state")
    star = open_star(spark, loaded)
    orders.filter("order_line_id <= 300").write.parquet(path)
    stream_fact_load(spark, path, star, out, state)
    before = sorted(map(tuple, read_stream_facts(spark, out).collect()))
    again = orders.filter("order_line_id between 290 and 310").withColumn(
        "quantity", F.when(F.col("order_line_id") == 295, F.col("quantity") + 1).otherwise(F.col("quantity"))
    )
    again.write.mode("append").parquet(path)
    with pytest.raises(Exception, match="order_line_id 295 delivered again with other values"):
        stream_fact_load(spark, path, star, out, state)
    assert sorted(map(tuple, read_stream_facts(spark, out).collect())) == before


def test_a_batch_that_was_entered_is_not_taken_again(spark, orders, loaded, folder):
    target = StreamFacts(spark, folder("out"))
    star, lines = open_star(spark, loaded), orders.filter("order_line_id <= 50")
    for _ in range(2):
        target.add(lines, "stream-a", 0, star)
    target.add(lines, "stream-b", 0, star)
    entries = target.log.read().orderBy("version").collect()
    assert [(e.stream, e.rows, e.arrived) for e in entries] == [("stream-a", 50, 50), ("stream-b", 0, 50)]
    assert target.facts().count() == 50
    with pytest.raises(IntegrityError, match="below 1"):
        target.add(lines.withColumn("order_line_id", F.col("order_line_id") - 5), "stream-a", 1, star)
