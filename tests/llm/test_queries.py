"""The training-data queries that SQL can express, against their SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

from checks.compare import duck, rows_of
from ordersight.llm.catalog import EXPECTED_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_sql_has_a_query():
    assert set(EXPECTED_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(EXPECTED_SQL))
def test_query_matches_sql(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    found = connection.execute(EXPECTED_SQL[name])
    columns = [column[0] for column in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(row) for row in df.collect()]) == rows_of(columns, found.fetchall())
