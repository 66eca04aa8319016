"""Every registered query against the same query in SQL, on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tellerloom.oracle import ORACLE
from tellerloom.queries import QUERIES
from tests.comparing import rows, spark_rows

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer orders".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')"
        )
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    expected = rows(columns, cursor.fetchall())
    got_columns, got = spark_rows(contract.queries()[name](spark, FOLDER))
    assert got_columns == sorted(columns)
    assert len(expected) > 0
    assert len(got) == len(expected)
    assert got == expected


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 45
