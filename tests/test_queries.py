"""Every registered query of the core against its DuckDB SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from lakeops.registry import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("set TimeZone = 'UTC'")
    for name in os.listdir(TABLES):
        connection.sql(f"create view {name.removesuffix('.parquet')} as select * from '{TABLES}/{name}'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    return None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, TABLES)
    columns = sorted(got.columns)
    rows = sorted([tuple(comparable(r[c]) for c in columns) for r in got.collect()], key=str)
    if name not in SQL:
        assert rows
        return
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    assert rows == sorted([tuple(comparable(r[i]) for i in order) for r in want.fetchall()], key=str)
