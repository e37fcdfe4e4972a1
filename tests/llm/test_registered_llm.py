"""Every query of the subpackage that has SQL, against it, on small tables."""

import duckdb
import pytest

from termloom.llm import registered

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "benchmark")
SQL = registered.oracle_sql()


def comparable(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = registered.queries()[name](spark, SMALL)
    columns = sorted(frame.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == columns
    wanted = expected.select(*(f'"{c}"' for c in columns)).fetchall()
    found = [tuple(r) for r in frame.select(*columns).collect()]
    assert comparable(found) == comparable(wanted)
    assert found


@pytest.mark.parametrize("name", ["op4_quality", "op8_mixing"])
def test_native_queries_run_no_python(spark, name):
    if name not in registered.queries():
        pytest.skip("not registered")
    plan = registered.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
