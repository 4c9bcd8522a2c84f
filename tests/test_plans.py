"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from yearbook.catalog import tables
from yearbook.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in ("normalize_name", "match_entity_exact"):  # both bring names to one form
        assert "EvalPython" not in text and "InPandas" not in text


def test_scan_reads_only_what_is_needed(spark):
    text = plan(QUERIES["count_distinct_entities"](spark, SF))
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_entity_filter_reaches_the_scan(spark):
    text = plan(QUERIES["filter_entity"](spark, SF))
    assert "EqualTo(l_suppkey,7)" in text


def test_json_is_parsed_once(spark):
    text = plan(QUERIES["check_snapshots"](spark, SF))
    assert text.count("parseJson(") <= 1


@pytest.mark.parametrize("name", ["company_year_mart", "nest_periods", "manifest_counts", "join_latest_facts", "join_sources_left"])
def test_order_lines_are_read_once(spark, monkeypatch, name):
    read, table = [], tables.table
    monkeypatch.setattr(tables, "table", lambda spark, sf, name: read.append(name) or table(spark, sf, name))
    text = plan(QUERIES[name](spark, SF))
    assert read.count("lineitem") == 1 and "lineitem.parquet" not in text  # what is left reads the stored periods


def test_no_sort_where_a_hash_will_do(spark):
    for name in ("latest_period", "latest_cards"):
        assert "SortAggregate" not in plan(QUERIES[name](spark, SF))
    text = plan(QUERIES["dedupe_snapshots"](spark, SF))
    for part in text.split("SortAggregate")[2::2]:  # partial ones: over the repeated keys only
        assert "LeftSemi" in part
