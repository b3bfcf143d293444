"""Every registered query: its rows against DuckDB, and the shape of its plan."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, rows_of
from checks.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
# Work that must not be in a plan: products of two sides, Python per row.
FORBIDDEN = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|"
    r"FlatMapGroupsInPandas"
)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and len(frame.columns) == 25


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(SQL[name])
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    assert sorted(frame.columns) == sorted(d[0] for d in result.description)
    assert sum(expected.values()) > 0
    assert found == expected
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN.findall(plan)
