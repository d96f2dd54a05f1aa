"""Every query over whole tables: against its SQL where there is one, else that it gives its rows."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.llm import queries

#: rows of a result: (a count in SQL, more)
ROWS = {
    "op4_warc": ("SELECT count(DISTINCT page_id) FROM pages", 0),
    "op5_chat_formatting": ("SELECT count(DISTINCT conv_id) FROM conversations", 1),
    "op12_filter_audit": ("SELECT 600 * count(DISTINCT coalesce(source, '')) FROM documents", 0),
    "op13_phrases": ("SELECT NULL", 0),
}


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, con, name):
    df = queries.QUERIES[name](spark, sf_dir)
    rows, order = df.collect(), sorted(df.columns)
    sql, more = ROWS.get(name, ("SELECT count(DISTINCT doc_id) FROM documents", 0))
    expected_rows = con.execute(sql).fetchall()[0][0]
    assert expected_rows is None or len(rows) == expected_rows + more
    if name in queries.ORACLE_SQL:
        cursor = con.execute(queries.ORACLE_SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == order
        expected = sorted(repr([r[names.index(c)] for c in order]) for r in cursor.fetchall())
        assert sorted(repr([r[c] for c in order]) for r in rows) == expected


def test_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(queries.ORACLE_SQL) <= set(entry_points.oracle_sql())
