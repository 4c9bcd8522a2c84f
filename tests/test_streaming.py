from __future__ import annotations

from tests.fixtures import companies_file, payload, write_snapshot
from yearbook.plans.build import load_companies
from yearbook.plans.warehouse import build_mart
from yearbook.sources.companies import build_dimension
from yearbook.streaming.ingest import ingest


def test_files_are_taken_in_once(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "out")
    companies = load_companies(spark, str(companies_file(tmp_path / "c.json")))
    write_snapshot(raw, "1111_t", "20260720T000000Z", payload(revenue=1))
    write_snapshot(raw, "2222_t", "20260720T000000Z", payload("E00002", revenue="bad"))
    ingest(spark, str(raw), companies, base).awaitTermination(120)
    write_snapshot(raw, "1111_t", "20260721T000000Z", payload())
    ingest(spark, str(raw), companies, base).awaitTermination(120)

    history = spark.read.parquet(f"{base}/financial_history").drop("batch")
    assert history.count() == 80
    assert {r.rule for r in spark.read.parquet(f"{base}/quarantine").collect()} == {"money"}
    sources = spark.read.parquet(f"{base}/source_documents_history").drop("batch")
    mart = build_mart(history, build_dimension(companies), sources)
    assert mart.count() == 5 and mart.agg({"revenue": "min"}).first()[0] == 46630 * 10**6


def test_files_wait_for_their_company(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "out")
    early = load_companies(spark, str(companies_file(tmp_path / "a.json")))
    later = load_companies(spark, str(companies_file(tmp_path / "b.json", **{"3333.T": {"name": "Third", "edinet_code": "E00003"}})))
    write_snapshot(raw, "3333_t", "20260720T000000Z", payload("E00003"))
    for day, companies in ((21, early), (22, early), (23, later)):
        write_snapshot(raw, "1111_t", f"202607{day}T000000Z", payload())
        ingest(spark, str(raw), companies, base).awaitTermination(120)
    history = spark.read.parquet(f"{base}/financial_history")
    assert history.filter("ticker = '3333.T'").count() == 40
    assert spark.read.parquet(f"{base}/pending").filter("batch = 2").count() == 0


def test_waiting_files_come_with_their_company_alone(spark, tmp_path):
    """No new file: adding the company brings what waits, once; the rest goes on waiting."""
    raw, base = tmp_path / "raw", str(tmp_path / "out")
    third, fourth = {"name": "Third", "edinet_code": "E00003"}, {"name": "Fourth", "edinet_code": "E00004"}
    dimensions = [{}, {"3333.T": third}, {"3333.T": third}, {"3333.T": third, "4444.T": fourth}]
    write_snapshot(raw, "3333_t", "20260720T000000Z", payload("E00003"))
    write_snapshot(raw, "4444_t", "20260720T000000Z", payload("E00004"))
    counts = []
    for i, entries in enumerate(dimensions):
        companies = load_companies(spark, str(companies_file(tmp_path / f"{i}.json", **entries)))
        ingest(spark, str(raw), companies, base).awaitTermination(120)
        counts.append(spark.read.parquet(f"{base}/financial_history").count())
    write_snapshot(raw, "1111_t", "20260721T000000Z", payload())
    ingest(spark, str(raw), companies, base).awaitTermination(120)
    history = spark.read.parquet(f"{base}/financial_history")
    assert counts == [0, 40, 40, 80] and history.count() == 120 and history.select("ticker").distinct().count() == 3


def test_conflicting_files_of_a_batch_are_not_used(spark, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "out")
    companies = load_companies(spark, str(companies_file(tmp_path / "c.json")))
    write_snapshot(raw / "x", "1111_t", "20260720T000000Z", payload())
    write_snapshot(raw / "y", "1111_t", "20260720T000000Z", payload(revenue=7))
    write_snapshot(raw / "x", "2222_t", "20260720T000000Z", payload("E00002"))
    ingest(spark, str(raw / "*"), companies, base).awaitTermination(120)
    assert {r.ticker for r in spark.read.parquet(f"{base}/financial_history").collect()} == {"2222.T"}
    assert {r.rule for r in spark.read.parquet(f"{base}/quarantine").collect()} == {"snapshot_conflict"}
