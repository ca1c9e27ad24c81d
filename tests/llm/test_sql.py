"""Each query that SQL can express against its SQL, on all columns."""

from __future__ import annotations

import duckdb
import pytest
from tools.check_oracle import rows_of

from dialogeval.llm.oracle import ORACLES
from dialogeval.llm.queries import QUERIES

TABLES = ("documents", "pages", "benchmark")


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_sql(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    result = database.execute(ORACLES[name])
    expected = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(df.columns, df.collect()) == expected
    assert expected[1]
