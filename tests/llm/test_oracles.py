"""The corpus queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from fieldloom.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for view in ("documents", "pages"):
        con.execute(f"create view {view} as select * from read_parquet('{SF}/{view}.parquet')")
    want = con.sql(oracle_sql()[name])
    got = queries()[name](spark, SF).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
