"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


OWN = sorted(n for n in entry.queries() if n in entry.plain_queries())


def test_every_query_has_sql():
    assert set(OWN) <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, folder, duck, name):
    df = entry.queries()[name](spark, folder)
    cursor = duck.execute(entry.oracle_sql()[name])
    theirs = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(theirs)
    expected = sorted(cursor.fetchall(), key=repr)
    got = sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in theirs)).collect()), key=repr)
    assert got == expected


def test_entry(spark, folder):
    assert entry.entry(spark).columns == ["year_month", "country", "net_revenue", "gross_margin", "items"]
