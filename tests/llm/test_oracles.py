"""Registered check SQL against the queries, as DuckDB runs it."""

import duckdb
import pytest

from starloom.llm.queries import ORACLES, QUERIES

FOLDERS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


@pytest.mark.parametrize("folder", FOLDERS)
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_check(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    check = connection.execute(ORACLES[name])
    columns = [column[0] for column in check.description]
    expected = sorted(map(repr, check.fetchall()))
    ours = QUERIES[name](spark, folder)
    assert sorted(ours.columns) == sorted(columns)
    assert sorted(repr(tuple(row)) for row in ours.select(columns).collect()) == expected
    kinds = {row[0]: row[1] for row in connection.execute(f"describe {ORACLES[name]}").fetchall()}
    types = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    assert kinds == {column: types[kind] for column, kind in ours.dtypes}
