"""Queries of the training-data operators against their SQL."""

import os

import duckdb
import pytest

from ledgerloom.llm.oracle import ORACLE
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = duck.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    key = lambda row: [str(v) for v in row]
    found = sorted((tuple(r) for r in got.select(*columns).collect()), key=key)
    assert found == sorted(want.fetchall(), key=key)
