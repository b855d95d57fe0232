"""The registered queries of this package against their DuckDB statements, value by value."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from remitwise.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_statement(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    result = con.execute(queries.ORACLE[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    df = queries.QUERIES[name](spark, SF_DIR)
    assert rows_of(df.columns, map(tuple, df.collect())) == want
    assert sorted(df.columns) == sorted(d[0] for d in result.description)
    assert want
