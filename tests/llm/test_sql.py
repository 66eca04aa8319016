"""The queries of the folder that have SQL, on whole tables."""

import duckdb
import pytest

from tellerloom.llm.queries import ORACLE, QUERIES
from tests.comparing import rows, spark_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    expected = rows(columns, cursor.fetchall())
    got_columns, got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got_columns == sorted(columns)
    assert expected and got == expected
