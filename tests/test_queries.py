"""Every query with SQL gives the rows that DuckDB gives; the others give rows of a stable schema."""

import decimal
import glob
import math
import os

import duckdb
import pytest

from sievemill.plans import catalog


def plain(v):
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    return str(v)


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert found == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    if name not in {"resume_anti_join", "zero_checks", "requested_ids", "containment_join", "copy_group_digests"}:
        assert found


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0
