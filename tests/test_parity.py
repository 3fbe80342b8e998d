"""Every registered query runs on the smallest tables, and those with SQL give the same rows as DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    found = queries()[name](spark, FOLDER)
    rows = rows_of(found.columns, found.collect())
    if name in oracle_sql():
        result = db.sql(oracle_sql()[name])
        assert sorted(found.columns) == sorted(result.columns)
        assert rows == rows_of(result.columns, result.fetchall())
    else:
        assert rows


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
