"""The registered queries: SQL where it can tell the answer, and what removal must leave whole."""

import ast
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from orrery.llm import oracles, queries

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from '{file}'")
    frame = queries.QUERIES[name](spark, SMALL)
    relation = duck.sql(oracles.ORACLES[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert normal(frame.collect(), frame.columns) == normal(relation.fetchall(), relation.columns)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert "pipeline" in names and set(oracles.ORACLES) <= set(entry_points.oracle_sql())


def test_nothing_else_imports_this_package():
    for path in (ROOT / "orrery").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            modules = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            modules += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in m or "corpus_pipeline" in m for m in modules), path


def test_entry_works_without_this_package(tmp_path):
    """The rest of the library, seen through links that leave this package out."""
    (tmp_path / "orrery").mkdir()
    for path in (ROOT / "orrery").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (tmp_path / "orrery" / path.name).symlink_to(path)
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"
    out = subprocess.run(
        [sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    number, there, _ = out.stdout.split()
    assert there == "False" and int(number) == len(entry_points.queries()) - len(queries.QUERIES) - 1
