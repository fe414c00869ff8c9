"""Every registered query against its oracle SQL in DuckDB."""

import os
import re

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from check_queries import TABLES, compare

# queries of the optional subpackage have tests of their own
QUERIES = {name: run for name, run in entry.queries().items() if not re.match(r"op\d+_|pipeline$", name)}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
FOLDER = os.environ.get("CARELAKE_ORACLE_SF", SF)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    message, good = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert good, message


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    assert entry.entry(spark).columns
