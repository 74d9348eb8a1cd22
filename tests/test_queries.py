"""Every registered query against its SQL, computed by another engine on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import SMALL
from orrery import catalogue, oracles

QUERIES = catalogue.queries()
ORACLES = oracles.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    got = _normal(frame.collect(), frame.columns)
    if name not in ORACLES:
        assert got
        return
    relation = duck.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert got == _normal(relation.fetchall(), relation.columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"relation_size"}


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize(
    "name", ["null_violations", "length_violations", "orphan_keys", "amount_mismatches"]
)
def test_reports_see_broken_input(spark, name):
    frame = QUERIES[name](spark, SMALL)
    told = {"orphan_keys": "orphan_rows > 0", "amount_mismatches": "true"}
    assert frame.filter(told.get(name, "violations > 0")).count() > 0


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() == 5


def test_golden_totals(spark):
    row = QUERIES["source_totals"](spark, SMALL).first()
    assert (row.src_rows, str(row.src_amount), row.src_orders) == (6000, "131498620.81", 1473)
    assert (str(row.date_min), str(row.date_max)) == ("1995-01-01", "2001-08-01")
    profile = QUERIES["source_profile"](spark, SMALL).first()
    assert (profile.customers, profile.salesreps, profile.products, profile.days) == (
        150,
        10,
        200,
        1084,
    )
