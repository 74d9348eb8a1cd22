import pytest
from pyspark.sql import functions as F

from orrery.functions.draws import pick, with_draws
from orrery.sources import generator as G
from orrery.sources import vocabulary as V


def test_shape_of_the_data(spark):
    rows = G.generate_orders(spark, orders=2000, customers=200, products=80, seed=1).cache()
    n = rows.count()
    stats = rows.agg(
        F.min("order_line_id"), F.max("order_line_id"), F.count_distinct("order_line_id"),
        F.count_distinct("order_id"), F.min("order_date"), F.max("order_date"),
        F.min("quantity"), F.max("quantity"), F.min("unit_price"), F.max("unit_price"),
        F.avg("quantity"),
    ).first()
    assert (stats[0], stats[1], stats[2], stats[3]) == (1, n, n, 2000)
    assert 3.7 < n / 2000 < 4.3
    assert str(stats[4]) >= "2023-01-01" and str(stats[5]) <= "2025-12-31"
    assert stats[6] == 1 and stats[7] <= 30 and 7 < stats[10] < 9
    assert stats[8] >= 4 and stats[9] <= 2500
    per_order = rows.groupBy("order_id").agg(
        F.count("*").alias("lines"), F.count_distinct("customer_code").alias("customers"),
        F.count_distinct("salesrep_code").alias("reps"), F.min("order_line_id").alias("low"),
        F.max("order_line_id").alias("high"),
    )
    assert per_order.filter("lines > 7 or customers > 1 or reps > 1").count() == 0
    assert per_order.filter("high - low + 1 <> lines").count() == 0
    reps = rows.groupBy("customer_code").agg(F.count_distinct("salesrep_code").alias("n"))
    assert reps.filter("n <> 1").count() == 0


def test_salesreps(spark):
    reps = G.generate_salesreps(spark).collect()
    assert len(reps) == 144 and {r.id for r in reps} == set(range(1, 145))
    assert len({r.region for r in reps}) == 12
    assert G.city_table(spark).count() == 100 and G.category_table(spark, "fr").count() == 8


def test_same_rows_however_they_are_spread(spark):
    ids = spark.range(1, 501)
    one = G.generate_headers(ids.coalesce(1), 50, seed=5)
    many = G.generate_headers(ids.repartition(13), 50, seed=5)
    assert one.exceptAll(many).count() == 0 and one.count() == many.count()
    other = G.generate_headers(ids, 50, seed=6)
    assert one.exceptAll(other).count() > 400


def test_languages_share_structure(spark):
    english = G.generate_orders(spark, 50, 20, 10, seed=2)
    french = G.generate_orders(spark, 50, 20, 10, seed=2, lang="fr")
    shared = ["order_line_id", "order_id", "customer_code", "product_code", "quantity", "unit_price"]
    assert english.select(shared).exceptAll(french.select(shared)).count() == 0
    categories = {r[0] for r in french.select("product_category").distinct().collect()}
    assert categories <= {name for name, _ in V.FRENCH.categories}
    with pytest.raises(ValueError, match="unknown language"):
        G.words_of("de")


def test_draws_are_even(spark):
    drawn = with_draws(spark.range(20_000), "id", "x", ["a", "b", "c", "d", "e"], seed=9)
    for name in "abcde":
        counts = [r["count"] for r in drawn.groupBy(pick(name, 10)).count().collect()]
        assert len(counts) == 10 and max(counts) < 2200 and min(counts) > 1800
    assert abs(drawn.agg(F.corr("a", "b")).first()[0]) < 0.03
    assert abs(drawn.agg(F.corr("a", "e")).first()[0]) < 0.03


def test_expand_lines_drops_rows_without_lines(spark):
    rows = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "id int, n int")
    got = [(r.id, r.line_no) for r in G.expand_lines(rows, "n").collect()]
    assert sorted(got) == [(1, 1), (1, 2), (3, 1)]


def test_lines_are_numbered_where_their_orders_lie(spark):
    """Repeated orders and unknown customers are treated as by joins on sorted lines."""
    headers = G.generate_headers(spark.range(1, 200).union(spark.range(1, 20)), 30, seed=3)
    rows = G.generate_lines(headers, 20, 25, seed=3)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2  # starts of ranges and customers, no products
    found = rows.collect()
    total = sum(r.n_lines * (r.customer_no <= 20) for r in headers.collect())
    assert len(found) == total and len({r.order_line_id for r in found}) == total
    in_order = [r.order_id for r in sorted(found, key=lambda r: r.order_line_id)]
    assert in_order == sorted(in_order) and all(int(r.customer_code[1:]) <= 20 for r in found)
