"""Every registered query with SQL gives the rows of that SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows_as_sql(spark, db, key):
    df = QUERIES[key](spark, SF)
    result = db.execute(ORACLES[key])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["o_orderkey", "split", "target", "feature_0", "feature_1", "feature_2"] and df.count() == 1500
