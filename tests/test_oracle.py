"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tests.oracle_check import difference, duck
from yearbook.catalog.oracle import ORACLE_SQL
from yearbook.catalog.queries import QUERIES

SF = os.environ.get("YEARBOOK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, connection, name):
    assert difference(spark, QUERIES[name], ORACLE_SQL[name], SF, connection) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() == 70
