"""Every query against its DuckDB statement, value by value."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows)


def test_every_query_has_a_statement():
    audit = {name for name in contract.queries() if not (contract.llm and (
        name in contract.llm.QUERIES or name == "pipeline"))}
    assert audit == set(contract.statements.ORACLE)


@pytest.mark.parametrize("name", sorted(contract.statements.ORACLE))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert got == want
    assert got, "a query that returns nothing proves nothing"


def test_entry(spark):
    assert contract.entry(spark).count() == 12
