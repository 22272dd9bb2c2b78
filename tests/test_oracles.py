"""Every registered query against its SQL, on whole tables (``TEST_SF_DIR``)."""

import os
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


# The corpus operators are tested in their own folder.
OWN = [n for n in entry_point.queries() if n != "pipeline" and not re.match(r"op\d+_", n)]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    mine = _sorted_rows(result.columns, [tuple(row) for row in result.collect()])
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    expected = _sorted_rows(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert len(mine) == len(expected)
    assert mine, "the comparison should not be of nothing"
    for left, right in zip(mine, expected):
        assert left == right
        assert [type(value) for value in left] == [type(value) for value in right]


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["date", "asset", "close", "volume"]
