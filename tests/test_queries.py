"""Every registered query gives the rows of its SQL on the smallest tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemark.testbed.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return float(f"{float(value):.10g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table(df.columns, df.collect())
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == table(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
