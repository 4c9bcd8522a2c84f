"""Queries against their SQL in DuckDB, and the registry."""

from __future__ import annotations

import os
import re

import pytest
from tests.oracle_check import difference, duck

import __spark_entry__ as entry_points
from yearbook.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("YEARBOOK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(m[1]) for name in QUERIES if (m := re.match(r"op(\d+)_", name)))
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries()) and set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, connection, name):
    assert difference(spark, QUERIES[name], ORACLE_SQL[name], SF, connection) is None
