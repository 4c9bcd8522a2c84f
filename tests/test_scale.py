"""Work that must be spread over the cores, and done once for each row."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from yearbook.catalog import tables
from yearbook.catalog.queries import QUERIES
from yearbook.functions import variants as V
from yearbook.operators import inspection, quality
from yearbook.plans import warehouse


@pytest.fixture
def one_group(spark, tmp_path):
    """Orders and customers as files of one row group, which one task reads."""
    day, names = dt.datetime(1997, 3, 4), ("AUTOMOBILE", "BUILDING", "MACHINERY")
    orders = [(k, k % 7, "FOP"[k % 3], 100.0 + k, day, ("1-URGENT", "2-HIGH", "5-LOW")[k % 3]) for k in range(400)]
    customers = [(k, f"Customer#{k}", k % 5, k - 9.5, names[k % 3]) for k in range(400)]
    found = {
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, rows in found.items():
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def tasks_with_rows(df) -> int:
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def test_documents_of_one_row_group_are_made_in_many_tasks(spark, one_group):
    documents = tables.raw_documents(spark, one_group)
    assert documents.count() == 400 and tasks_with_rows(documents) >= spark.sparkContext.defaultParallelism


def test_companies_of_one_row_group_are_checked_in_many_tasks(spark, one_group):
    assert tasks_with_rows(QUERIES["check_companies"](spark, one_group)) >= spark.sparkContext.defaultParallelism


def test_rules_of_companies_run_once(spark, one_group):
    text = QUERIES["check_companies"](spark, one_group)._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson(") == 1


BODY = """{"data": [
  {"fiscal_year": 2001, "revenue": 9223372036854775807, "doc_id": "a"},
  {"fiscal_year": 2002.0, "revenue": 100.0, "net_income": 1200.00, "roe_official": null, "doc_id": 7},
  {"fiscal_year": 2003, "revenue": "12", "operating_income": 1.5, "total_assets": null, "roe_official": "x"},
  {"fiscal_year": 3000000000, "revenue": 1e400, "net_income": 922337203685470000, "doc_id": null},
  null, 5
], "meta": {"edinet_code": "E1", "period": "annual"}}"""


@pytest.fixture
def decoded(spark):
    row = spark.createDataFrame([(1, "T", "f", "E1", "n", dt.datetime(2002, 1, 1), "s", BODY)], "company_order int, ticker string, raw_file string, edinet_code string, file_name string, fetched_at timestamp, sha256 string, body string")
    return row.withColumn("payload", V.decode_json(F.col("body"))).drop("body")


def one_pass(df) -> bool:
    """No member of a period row is looked up by a path of its own, which walks the row again."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return not any(f"$.{name}" in text for name in ("revenue", "cf_operating", "doc_id"))


def test_odd_rows_break_their_rules(decoded):
    checked = quality.check_snapshots(decoded)
    found = {(r.field, r.rule, r.value) for r in quality.list_violations(checked).collect()}
    assert one_pass(checked)
    assert {("data", "row_object", "null"), ("data", "row_object", "5"), ("data", "row_count", "6")} <= found
    assert {f for f in found if f[1] == "year_type"} == {("fiscal_year", "year_type", "2002"), ("fiscal_year", "year_type", "3000000000")}
    assert {f[:2] for f in found if f[1] in ("money", "ratio", "optional_string")} == {
        ("revenue", "money"), ("operating_income", "money"), ("roe_official", "ratio"), ("doc_id", "optional_string"),
    }
    assert {f[2] for f in found if f[1] == "money"} >= {"9223372036854775807", '"12"', "1.5"}


def test_members_of_periods_are_read_in_one_pass(decoded):
    good = decoded.withColumn("payload", F.parse_json(F.lit('{"data": [{"fiscal_year": 2001, "revenue": 7, "doc_id": "d"}, {"fiscal_year": 2002}]}')))
    periods = warehouse.normalize_fields(good)
    assert one_pass(periods)
    assert {(r.fiscal_year, r.revenue, r.document_id) for r in periods.collect()} == {(2001, 7, "d"), (2002, None, None)}
    report = inspection.inspect_snapshots(good)
    assert one_pass(report)
    row = report.collect()[0]
    assert row.fiscal_years == [2001, 2002] and row.missing_values["revenue"] == [2002] and row.zero_values["revenue"] == []


@pytest.fixture
def order_lines(spark, tmp_path):
    """Two customers with three orders each, two lines an order; the last order has no line."""
    orders = [(k, k % 2, "F", 10.0 * k, dt.datetime(1997, 1, 1 + k), "1-URGENT") for k in range(7)]
    lines = [(k, 1, 1, n, 2.0, 10.0 * k + n, 0.1, 0.0, "N", "F", dt.datetime(1997, 2, n)) for k in range(6) for n in (1, 2)]
    found = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "customer": ([(k, f"Customer#{k}", 1, 1.0, "BUILDING") for k in range(2)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (rows, schema) in found.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_tasks_for_order_lines_grow_with_the_table(spark, order_lines, monkeypatch):
    lines = tables.table(spark, order_lines, "lineitem")
    assert tables.line_tasks(lines) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tables, "LINES_PER_TASK", 1)
    text = tables.order_periods(spark, order_lines)._jdf.queryExecution().executedPlan().toString()
    assert tables.line_tasks(lines) == 12 and "12), REPARTITION_BY_NUM" in text


@pytest.mark.parametrize("name", ["company_year_mart", "nest_periods", "manifest_counts", "join_sources_left", "join_latest_facts"])
def test_older_orders_are_dropped_before_there_are_facts(spark, order_lines, monkeypatch, name):
    kept, stored = [], tables.stored
    monkeypatch.setattr(tables, "stored", lambda df: kept.append(stored(df)) or kept[-1])  # the newest orders' lines
    found = QUERIES[name](spark, order_lines).collect()
    assert {r.o_orderkey for r in kept[-1].collect()} == ({5} if name == "join_sources_left" else {4, 5})
    assert len(found) == {"company_year_mart": 4, "nest_periods": 4, "manifest_counts": 1, "join_sources_left": 2, "join_latest_facts": 32}[name]
    if name == "manifest_counts":
        assert found[0].asDict() == {"snapshot_count": 6, "financial_fact_count": 96, "source_document_count": 12, "latest_company_year_count": 4}
