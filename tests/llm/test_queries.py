"""The registered queries against SQL, on whole tables (``TEST_SF_DIR``)."""

import os
from pathlib import Path

import duckdb
import pytest

from tests.test_oracles import TABLES, _sorted_rows
from tickerloom.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    result = queries.QUERIES[name](spark, SF_DIR)
    mine = _sorted_rows(result.columns, [tuple(row) for row in result.collect()])
    cursor = duck.execute(queries.ORACLE_SQL[name])
    columns = [column[0] for column in cursor.description]
    expected = _sorted_rows(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert len(mine) == len(expected) > 0
    for left, right in zip(mine, expected):
        assert left == right
        assert [type(value) for value in left] == [type(value) for value in right]
