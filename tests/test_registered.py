"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registered
from conftest import SMALL_TABLES

SQL = registered._text_sql()
WITHOUT_SQL = set()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "events", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL_TABLES}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    own = {name for name, query in registered.queries().items() if query.__module__ == registered.__name__}
    assert own - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= own


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    frame = registered.queries()[name](spark, SMALL_TABLES)
    columns = sorted(frame.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == columns
    wanted = sorted(expected.select(*(f'"{c}"' for c in columns)).fetchall(), key=repr)
    found = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    assert found == wanted
    assert found


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["rank", "id", "title", "url", "relevance"]
    assert len(frame.collect()) == 10


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_cross_join_and_no_python(spark, name):
    if name.startswith("saved_"):
        pytest.skip("writes an index; covered by test_saved_index")
    plan = registered.queries()[name](spark, SMALL_TABLES)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan
