"""Every registered query against its SQL, on the smallest tables."""

import decimal
import os

import pytest

import __spark_entry__ as entry
from textloom.catalog import registry

DIR = "/root/testdata/sf0.001"
SLOW = {"dedup_counters", "lsh_buckets", "encode_corpus", "compression_fertility"}  # as SQL; kin of others here
QUERIES = {name: pair[0] for name, pair in registry.all_queries().items()}
SQL = {name: pair[1] for name, pair in registry.all_queries().items() if pair[1]}


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{DIR}/{file}')")
    return con


def test_names():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    want = duck.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "variant", "reason"] and df.count() > 0
