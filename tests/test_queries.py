"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if value is None:
        return ""
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


def in_order(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(entry_points.QUERIES))
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, FOLDER)
    want = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert in_order(got.columns, got.collect()) == in_order(columns, want.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert entry_points.QUERIES.keys() == entry_points.ORACLE.keys()
    assert entry_points.queries().keys() >= entry_points.oracle_sql().keys()
