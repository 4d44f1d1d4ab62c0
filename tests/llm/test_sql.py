"""Queries of the training-data operators that SQL can express give the rows that DuckDB gives."""

import glob
import os

import duckdb
import pytest

from sievemill.llm import catalog


def plain(v):
    return f"{v:.10g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = con.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert found and found == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
