"""Registered queries of this subpackage against their SQL."""

import os

import duckdb
import pytest

from tests.test_registry import rows_of
from textloom.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"
WITH_SQL = sorted(name for name, (_, sql) in QUERIES.items() if sql)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{DIR}/{file}')")
    return con


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, duck, name):
    query, sql = QUERIES[name]
    df = query(spark, DIR)
    want = duck.execute(sql)
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())
