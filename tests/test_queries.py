"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from checks.expected_sql import EXPECTED_SQL
from checks.query_catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_contract():
    assert set(QUERIES) == set(EXPECTED_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert difference(spark, connection, name, FOLDER) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["segment", "total_customers", "percentage"]
    assert sum(row.total_customers for row in result.collect()) == 75
