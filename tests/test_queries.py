"""Every registered query against its SQL, value by value, on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans import oracle, registry

QUERIES = registry.QUERIES
ORACLES = oracle.oracle_sql()
TABLES = ["lineitem", "orders", "events"]


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def _rows(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([r[i] for i in order]) for r in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = _rows(cursor.fetchall(), names)
    got = _rows(df.collect(), df.columns)
    assert got == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|InPandas", plan)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "spend_cv3" in df.columns
