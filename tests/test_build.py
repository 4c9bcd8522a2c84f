"""The full build on generated snapshots, and what must stop it."""

from __future__ import annotations

import datetime
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.fixtures import MILLION, SERIES, companies_file, payload, period, write_json, write_snapshot
from yearbook import session, sinks
from yearbook.errors import YearbookError
from yearbook.operators import inspection, quality
from yearbook.plans.build import BuildConfig, build, load_companies
from yearbook.plans.sql import run_sql
from yearbook.sources import companies as C
from yearbook.sources import snapshots as S
from yearbook.sources import warehouse as W
from yearbook.sources.schemas import RAW_LANDING


@pytest.fixture
def place(tmp_path):
    """Two direct companies; the first has two snapshots, one with other numbers."""
    raw = tmp_path / "raw"
    write_snapshot(raw, "1111_t", "20260720T000000Z", payload(revenue=1))
    write_snapshot(raw, "1111_t", "20260722T000000Z", payload(years=(2026, 2022, 2025, 2023, 2024)))
    write_snapshot(raw, "2222_t", "20260721T000000Z", payload("E00002", cf_investing=None, accounting_standard="IFRS"))
    write_snapshot(raw, "unknown", "20260721T000000Z", "{not json")
    (raw / "2222_t__financials__notes.json").write_text("ignored")
    companies_file(tmp_path / "companies.json")
    write_json(tmp_path / "pairs.json", {"schema_version": "1.0", "pairs": [{"id": "one-two", "left": "1111.T", "right": "2222.T"}]})
    return tmp_path


def config(place, build_id="b1", **changes):
    base = dict(
        companies=str(place / "companies.json"),
        snapshots=str(place / "raw"),
        base=str(place / "out"),
        build_id=build_id,
        comparisons=str(place / "pairs.json"),
    )
    return BuildConfig(**{**base, **changes})


def read_lines(spark, folder):
    return [json.loads(r.value) for r in spark.read.text(folder).collect()]


def test_full_build(spark, place):
    stage = build(spark, config(place))
    assert W.published_path(spark, str(place / "out")) == stage
    tables = W.scan_warehouse(spark, stage)
    assert tables["financial_history"].count() == 120
    assert tables["financial_history"].schema["value"].dataType.simpleString() == "decimal(38,4)"
    mart = W.scan_mart(spark, stage).collect()
    assert [(r.company_order, r.ticker) for r in mart] == [(0, "2222.T")] * 5 + [(1, "1111.T")] * 5
    first = [r for r in mart if r.ticker == "1111.T"]
    assert [r.fiscal_year for r in first] == sorted(SERIES)
    assert [r.revenue for r in first] == [SERIES[y][0] * MILLION for y in sorted(SERIES)]
    assert [r.revenue_yoy_pct for r in first] == [None, 5.9469, -8.7065, 15.7795, 11.9045]
    assert [r.operating_margin_pct for r in first] == [20.5974, 17.3111, 15.0139, 20.7639, 22.1419]
    assert [r.free_cash_flow // MILLION for r in first] == [8734, 3616, -2776, 11452, 5823]
    assert [r.revenue_cagr_3y_pct for r in first] == [None, None, None, 3.8453, 5.7564]
    assert [r.roe_pct for r in first] == [12.1, 9.8, 8.3, 13.4, 15.7]
    assert first[0].equity == 70000 * MILLION and first[0].source_filed_at == datetime.date(2022, 6, 30)
    assert {r.free_cash_flow for r in mart if r.ticker == "2222.T"} == {None}
    assert {r.accounting_standard for r in mart if r.ticker == "2222.T"} == {"IFRS"}

    manifest = read_lines(spark, f"{stage}/build_manifest")[0]
    assert manifest == {
        "schema_version": "1.0", "pipeline_version": "1.0", "generated_at": "2026-07-22T00:00:00Z",
        "snapshot_count": 3, "financial_fact_count": 120, "source_document_count": 15, "latest_company_year_count": 10,
    }
    document = [d for d in read_lines(spark, f"{stage}/financials") if d["ticker"] == "1111.T"][0]
    assert list(document) == ["ticker", "name", "edinet_code", "currency", "periods"]
    assert document["periods"][0] == {
        "fiscal_year": 2022, "fiscal_year_end": None, "accounting_standard": "JGAAP", "consolidated": True,
        "metrics": {
            "revenue": 48210 * MILLION, "operating_income": 9930 * MILLION, "net_income": 30000 * MILLION,
            "total_assets": 150000 * MILLION, "equity": 70000 * MILLION, "operating_cash_flow": 12045 * MILLION,
            "investing_cash_flow": -3311 * MILLION, "roe_pct": 12.1,
        },
        "calculated_metrics": {
            "revenue_yoy_pct": None, "operating_margin_pct": 20.5974, "free_cash_flow": 8734 * MILLION, "revenue_cagr_3y_pct": None,
        },
        "source_document": {
            "document_id": "filing-22/A", "document_type": "annual_securities_report", "filed_at": "2022-06-30", "url": "https://filings.invalid/annual?y=2022",
        },
        "fetched_at": "2026-07-22T00:00:00Z",
    }
    assert len(read_lines(spark, f"{stage}/comparison_series")) == 15
    charts = read_lines(spark, f"{stage}/stats_charts")
    assert len(charts) == 9 * 5 and "/charts/stats/fy2024/rankings/revenue.svg" in {c["chart"] for c in charts}
    assert read_lines(spark, f"{stage}/charts_header") == [{"schema_version": "1.0", "generated_at": "2026-07-22T00:00:00Z"}]
    listing = {c["ticker"]: (c["has_financials"], c["has_raw"]) for c in read_lines(spark, f"{stage}/company_listing")}
    assert listing == {"2222.T": (True, True), "1111.T": (True, True), "9999.T": (False, False)}
    assert read_lines(spark, f"{stage}/company_totals") == [{"target_count": 4, "direct_count": 2, "indirect_count": 1}]
    axes = {(a["ticker"], a["chart"]): a["has_data"] for a in read_lines(spark, f"{stage}/company_chart_axes")}
    assert {t for t, _ in axes} == {"1111.T", "2222.T"} and all(axes[k] for k in axes if k[0] == "1111.T")
    assert spark.read.json(f"{stage}/stats_ranking").filter("fiscal_year = 2026").count() == 12
    assert spark.read.json(f"{stage}/stats_header").first().years == [2022, 2023, 2024, 2025, 2026]
    assert spark.read.json(f"{stage}/missing_tickers").count() == 0

    W.register_views(spark, stage)
    names = run_sql(spark, "SELECT ticker, max(revenue) AS r FROM company_year_metrics GROUP BY ticker ORDER BY ticker;")
    assert [r.ticker for r in names.collect()] == ["1111.T", "2222.T"]
    assert run_sql(spark, "DESCRIBE financial_history").filter("col_name = 'value'").first().data_type == "decimal(38,4)"
    refused = (
        "DROP VIEW companies", "CREATE TABLE x AS SELECT 1", "SELECT 1; SELECT 2", "SHOW TABLES", "SET a=b",
        f"SELECT 1 AS a) INSERT OVERWRITE DIRECTORY '{place / 'leak'}' USING json OPTIONS (x 'y'", "SELECT 1 AS a) INSERT INTO t (a",
        f"INSERT OVERWRITE DIRECTORY '{place / 'leak'}' USING json SELECT 1", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x",
        "FROM companies INSERT INTO t SELECT ticker INSERT INTO u SELECT name", "EXECUTE IMMEDIATE 'SELECT 1'", "BEGIN SELECT 1; END",
        "SELECT TRANSFORM(ticker) USING 'cat' AS (t) FROM companies", "SELECT reflect('java.lang.System', 'lineSeparator')",
    )
    for text in refused:
        with pytest.raises(YearbookError):
            run_sql(spark, text)
    assert not (place / "leak").exists()
    nested = "WITH x AS (SELECT ticker FROM companies) SELECT * FROM x WHERE ticker IN (SELECT ticker FROM company_year_metrics) ORDER BY 1 LIMIT 9"
    assert run_sql(spark, nested).count() == 2
    sinks.export_tsv(names.coalesce(1), str(place / "tsv"))
    assert spark.read.text(str(place / "tsv")).first().value == "ticker\tr"


def test_rebuild_is_the_same_and_failure_publishes_nothing(spark, place):
    first = build(spark, config(place))
    second = build(spark, config(place, "b2"))
    for name in ("financials", "stats_ranking", "stats_descriptive"):
        assert sorted(map(str, read_lines(spark, f"{first}/{name}"))) == sorted(map(str, read_lines(spark, f"{second}/{name}")))
    write_json(place / "pairs.json", {"schema_version": "1.0", "pairs": [{"id": "x", "left": "1111.T", "right": "1111.T"}]})
    with pytest.raises(YearbookError, match="same_entity"):
        build(spark, config(place, "b3"))
    assert W.published_path(spark, str(place / "out")) == second


def test_missing_company(spark, place):
    companies_file(place / "companies.json", **{"3333.T": {"name": "Third", "edinet_code": "E00003"}})
    with pytest.raises(YearbookError, match="3333.T"):
        build(spark, config(place))
    stage = build(spark, config(place, "b2", allow_missing=True))
    assert [d["ticker"] for d in read_lines(spark, f"{stage}/missing_tickers")] == ["3333.T"]


BROKEN = {
    "code_match": payload("E00009"),
    "period_kind": payload(kind="quarterly"),
    "row_count": payload(years=(2022, 2023, 2024, 2025)),
    "year_unique": payload(years=(2022, 2023, 2024, 2025, 2025)),
    "money": payload(revenue=1.5),
    "ratio": payload(roe_official="0.1"),
    "optional_string": payload(doc_id=5),
    "year_type": {**payload(), "data": [period(y, fiscal_year=float(y)) for y in SERIES]},
    "row_object": {**payload(), "data": [1, 2, 3, 4, 5]},
    "root": {"data": {}, "meta": {}},
    "decode": "[1]",
}


def checked(spark, folder, tmp_path):
    companies = load_companies(spark, str(companies_file(tmp_path / "c.json")))
    return quality.check_snapshots(S.decode_snapshot(S.scan_snapshots(spark, str(folder), companies)))


def test_each_rule(spark, tmp_path):
    raw = tmp_path / "raw"
    for hour, body in enumerate(BROKEN.values()):
        write_snapshot(raw, "1111_t", f"20260101T{hour:02d}0000Z", body)
    write_snapshot(raw, "1111_t", "20260230T000000Z", payload())
    write_snapshot(raw, "1111_t", "20260301T000000Z", b"\xff\xfe")
    write_snapshot(raw, "1111_t", "20260302T000000Z", payload(revenue=None, net_income="ABSENT"))
    result = checked(spark, raw, tmp_path)
    found = quality.list_violations(result).select(F.regexp_extract("raw_file", r"(\d{8}T\d{2})", 1).alias("f"), "rule").distinct()
    rules = {}
    for row in found.collect():
        rules.setdefault(row.f, set()).add(row.rule)
    for hour, rule in enumerate(BROKEN):
        assert rules[f"20260101T{hour:02d}"] == {rule}
    assert rules["20260230T00"] == {"snapshot_time"}
    assert rules["20260301T00"] == {"decode"}
    assert "20260302T00" not in rules
    assert quality.accepted(result).count() == 1


def test_quarantine_when_not_strict(spark, place):
    write_snapshot(place / "raw", "2222_t", "20260725T000000Z", payload("E00002", revenue=True))
    with pytest.raises(YearbookError, match="money"):
        build(spark, config(place))
    stage = build(spark, config(place, "b2", strict=False))
    assert {d["rule"] for d in read_lines(spark, f"{stage}/quarantine")} == {"money"}
    assert W.scan_table(spark, stage, "financial_history").count() == 120


def test_conflicting_snapshots(spark, place):
    write_snapshot(place / "more", "2222_t", "20260721T000000Z", payload("E00002"))
    companies = load_companies(spark, str(place / "companies.json"))
    both = S.scan_snapshots(spark, [str(place / "raw"), str(place / "more")], companies)
    conflicts = quality.check_snapshot_conflict(both).collect()
    assert [(r.ticker, r.rule) for r in conflicts] == [("2222.T", "snapshot_conflict")]

    write_snapshot(place / "raw", "2222_t", "20260719T000000Z", payload("E00002"))
    lenient = config(place, strict=False, snapshots=str(place / "[rm]*"))
    history = W.scan_table(spark, build(spark, lenient), "financial_history")
    kept = history.filter("ticker = '2222.T'").select(F.to_date("raw_fetched_at").alias("d")).distinct()
    assert [str(r.d) for r in kept.collect()] == ["2026-07-19"]


def test_latest_and_explicit_inputs(spark, place):
    companies = load_companies(spark, str(place / "companies.json"))
    write_snapshot(place / "raw", "1111_t", "20260230T000000Z", payload())
    latest = S.scan_latest_snapshots(spark, str(place / "raw"), companies)
    assert {r.file_name for r in latest.select("file_name").collect()} == {
        "1111_t__financials__20260722T000000Z.json", "2222_t__financials__20260721T000000Z.json",
    }
    paths = [str(place / "raw" / f"1111_t__financials__2026072{d}T000000Z.json") for d in (0, 2)]
    assert S.scan_explicit_inputs(spark, paths[:1], companies).count() == 1
    with pytest.raises(YearbookError, match="several"):
        S.scan_explicit_inputs(spark, paths, companies)
    with pytest.raises(YearbookError, match="no company"):
        S.scan_explicit_inputs(spark, [str(place / "raw" / "unknown__financials__20260721T000000Z.json")], companies)


def test_inspection(spark, tmp_path):
    rows = [period(y) for y in sorted(SERIES, reverse=True)]
    rows[1].pop("cf_investing")
    rows[2]["cf_investing"] = 0
    rows[3].pop("doc_id")
    rows[0]["accounting_standard"] = "IFRS"
    body = {"data": rows, "meta": {}}
    shuffled = {"data": [rows[i] for i in (1, 0, 2, 3, 4)], "meta": {}}
    source = spark.createDataFrame([("a", json.dumps(body)), ("b", json.dumps(shuffled))], "raw_file string, content string")
    decoded = S.decode_snapshot(source)
    report = inspection.inspect_snapshots(decoded, ["raw_file"]).filter("raw_file = 'a'").first()
    assert report.fiscal_years == [2026, 2025, 2024, 2023, 2022] and report.year_order == "descending"
    assert report.accounting_standards == ["IFRS", "JP"]
    assert {k: v for k, v in report.missing_values.items() if v} == {"cf_investing": [2025]}
    assert {k: v for k, v in report.zero_values.items() if v} == {"cf_investing": [2024]}
    assert {k: v for k, v in report.missing_source_values.items() if v} == {"doc_id": [2023]}
    assert [(r.raw_file, r.rule) for r in inspection.check_inspection(decoded, ["raw_file"]).collect()] == [("b", "year_order")]


def test_companies(spark, tmp_path):
    path = companies_file(tmp_path / "c.json")
    rows = load_companies(spark, str(path)).orderBy("company_order").collect()
    assert [(r.ticker, r.name, r.status, r.tier) for r in rows] == [
        ("2222.T", "Second", "direct", "2"), ("1111.T", "First", "direct", ""), ("9999.T", "Indirect", "indirect", ""),
    ]
    assert [r.targets for r in rows] == [["Second"], ["First"], ["a", "b"]]
    typed = C.build_companies(C.scan_companies(spark, str(path)))
    assert {r.ticker for r in C.filter_direct(typed).collect()} == {"1111.T", "2222.T"}
    assert {r.ticker for r in C.filter_direct(typed, stated=True).collect()} == {"1111.T"}


@pytest.mark.parametrize(
    "entry",
    [{"name": " ", "edinet_code": "E00003"}, {"name": "X", "edinet_code": "00003"}, {"name": "X", "edinet_code": "E00003", "status": "other"},
     {"name": "X", "edinet_code": "E00003", "avg_salary_fiscal_year": 3000000000}, {"name": "X", "edinet_code": "E00003", "avg_salary_man": 1e400},
     {"name": "X", "edinet_code": "E00003", "avg_salary_man": True}, {"name": "X", "edinet_code": "E00003", "avg_salary_fiscal_year": 2024.5}, "text"],
)
def test_bad_company(spark, tmp_path, entry):
    with pytest.raises(YearbookError):
        load_companies(spark, str(companies_file(tmp_path / "c.json", **{"3.T": entry})))


def test_repeated_slug_and_empty(spark, tmp_path):
    with pytest.raises(YearbookError, match="slug"):
        load_companies(spark, str(companies_file(tmp_path / "c.json", **{"1111-T": {"name": "X", "edinet_code": "E00003"}})))
    with pytest.raises(YearbookError, match="empty"):
        load_companies(spark, str(write_json(tmp_path / "e.json", {})))


def test_fallback(spark, tmp_path):
    (tmp_path / "blank.json").write_text("  \n")
    good = companies_file(tmp_path / "good.json")
    found = C.scan_fallback(spark, [str(tmp_path / "no.json"), str(tmp_path / "blank.json"), str(good)])
    assert found.count() == 3
    assert C.scan_fallback(spark, [str(tmp_path / "no.json")]).count() == 0


@pytest.mark.parametrize("body", [{"schema_version": "2.0", "pairs": []}, {"schema_version": "1.0"}, {"schema_version": "1.0", "pairs": [1]}])
def test_bad_pair_file(spark, tmp_path, body):
    with pytest.raises(YearbookError):
        C.scan_comparisons(spark, str(write_json(tmp_path / "p.json", body)))


def test_entity_match(spark):
    schema = "name string, name_ja string, sec_code string, edinet_code string"
    hit = ("Example", "株式会社ＡＢＣ", "30920", "E00001")
    good = spark.createDataFrame([hit, ("O", None, "1", "E2")], schema)
    assert quality.match_entity_exact(good, "30920", "株式会社ABC", "E00001").count() == 1
    for rows, args in (
        ([hit], ("1", "株式会社ABC", "E00001")),
        ([hit, hit], ("30920", "株式会社ABC", "E00001")),
        ([hit], ("30920", "other", "E00001")),
        ([hit], ("30920", "株式会社ABC", "E00002")),
    ):
        with pytest.raises(YearbookError):
            quality.match_entity_exact(spark.createDataFrame(rows, schema), *args)


def test_landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    at = datetime.datetime(2026, 7, 22, tzinfo=datetime.timezone.utc)
    body = json.dumps(payload()).encode()
    new = spark.createDataFrame([("1111_t", "financials", at, bytearray(body))], RAW_LANDING)
    sinks.land_raw(new, path)
    with pytest.raises(YearbookError, match="not overwritten"):
        sinks.land_raw(new, path)
    naive = new.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
    with pytest.raises(YearbookError, match="zone"):
        sinks.land_raw(naive, path)
    with pytest.raises(YearbookError, match="twice"):
        sinks.land_raw(new.unionAll(new).withColumn("slug", F.lit("x")), path)
    companies = load_companies(spark, str(companies_file(tmp_path / "c.json")))
    landed = S.scan_landed(spark, path, companies)
    row = landed.first()
    assert bytes(row.content) == body and row.file_name == "1111_t__financials__20260722T000000Z.json"
    assert quality.accepted(quality.check_snapshots(S.decode_snapshot(landed))).count() == 1


def test_two_writers_of_one_key(spark, tmp_path):
    """Both begin at once; one lands, the other is told, and nothing is there twice."""
    path = str(tmp_path / "landing")
    at = datetime.datetime(2026, 7, 22, tzinfo=datetime.timezone.utc)

    def land(i: int) -> str:
        new = spark.createDataFrame([("1111_t", "financials", at, bytearray(b"%d" % i)), (f"own_{i}", "financials", at, bytearray(b"x"))], RAW_LANDING)
        try:
            sinks.land_raw(new, path)
        except YearbookError as refused:
            return str(refused)
        return "landed"

    with ThreadPoolExecutor(3) as pool:
        told = sorted(pool.map(land, range(3)))
    assert told[2] == "landed" and all("not overwritten" in t for t in told[:2])
    rows = spark.read.schema(RAW_LANDING).parquet(path).collect()
    assert len(rows) == 2 and len({r.slug for r in rows}) == 2 and not (tmp_path / "landing" / "_lock").exists()


def test_a_lock_that_is_held(spark, tmp_path):
    path = str(tmp_path / "held" / "_lock")
    assert session.create_exclusively(spark, path, "someone") and not session.create_exclusively(spark, path, "me")
    assert session.read_small(spark, path) == "someone"
    with pytest.raises(YearbookError, match="held by someone"), session.exclusive(spark, path, wait=0.3):
        raise AssertionError("not reached")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: session.create_exclusively(spark, str(tmp_path / "one"), str(i)), range(24)))
    assert sum(made) == 1 and session.read_small(spark, str(tmp_path / "one")) == str(made.index(True))


def test_builds_published_at_once(spark, tmp_path):
    base = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda i: sinks.publish_staged(spark, base, f"b{i}"), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    assert W.published_path(spark, base) == f"{base}/v=b{numbers.index(6)}"
    with ThreadPoolExecutor(4) as pool:

        def swap(i: int) -> int | None:
            try:
                return sinks.publish_staged(spark, base, f"c{i}", after=6)
            except YearbookError:
                return None

        got = list(pool.map(swap, range(4)))
    assert sorted(n for n in got if n) == [7] and W.published_path(spark, base) == f"{base}/v=c{got.index(7)}"


def test_newest_files_are_chosen_by_name(spark, tmp_path, monkeypatch):
    """Only chosen files are named to Spark, some at a time; odd folder names are no patterns."""
    raw = tmp_path / "raw [1] {a}, b"
    for stamp in ("20260101T000000Z", "20260301T000000Z", "20260201T000000Z"):
        write_snapshot(raw, "1111_t", stamp, payload(revenue=int(stamp[4:8])))
        write_snapshot(raw, "2222_t", stamp, payload("E00002"))
    write_snapshot(raw, "2222_t", "20261301T000000Z", "impossible date")
    write_snapshot(raw, "unknown", "20270101T000000Z", "{}")
    companies = load_companies(spark, str(companies_file(tmp_path / "c.json")))
    named, files = [], S._files
    monkeypatch.setattr(S, "_files", lambda spark, paths: named.append(paths) or files(spark, paths))
    found = S.scan_latest_snapshots(spark, str(tmp_path / "raw*"), companies, paths_per_read=1)
    want = {f"{slug}__financials__20260301T000000Z.json" for slug in ("1111_t", "2222_t")}
    assert {r.file_name for r in found.collect()} == want and found.filter("ticker = '1111.T'").first().content.find(b"301") > 0
    assert len(named) == 2 and all(len(batch) == 1 for batch in named)
    nobody = S.scan_latest_snapshots(spark, str(tmp_path / "raw*"), companies.limit(0))
    assert nobody.count() == 0


def test_non_finite_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"),)], "x double")
    with pytest.raises(Exception, match="not finite"):
        sinks.write_json_lines(sinks.refuse_non_finite(df), str(tmp_path / "o"))


def test_nothing_published(spark, tmp_path):
    with pytest.raises(YearbookError):
        W.published_path(spark, str(tmp_path))
