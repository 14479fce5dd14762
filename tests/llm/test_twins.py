"""The queries that SQL can express, against their DuckDB texts over whole tables."""

import duckdb
import pytest

from boardsmith import llm


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    told = con.execute(llm.oracle_sql()[name])
    columns = [c[0] for c in told.description]
    got = llm.queries()[name](spark, sf)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(told.fetchall(), key=repr)
