"""The full build: raw snapshots to published tables and documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook import sinks
from yearbook.errors import YearbookError
from yearbook.operators import quality as Q
from yearbook.operators.compare import compare_entities, long_comparison
from yearbook.operators.ranking import described_positions
from yearbook.operators.registry import COMPARISON_CHARTS
from yearbook.operators.series import axis_domain, axis_ticks, chart_series, company_listing, company_totals
from yearbook.operators.stats import require_common_periods
from yearbook.plans import documents as D
from yearbook.plans import statistics as S
from yearbook.plans import warehouse as W
from yearbook.plans.snapshots import usable_snapshots, violations
from yearbook.session import configure
from yearbook.sources import companies as C
from yearbook.sources import schemas
from yearbook.sources.snapshots import decode_snapshot, scan_snapshots
from yearbook.sources.warehouse import scan_table, scan_warehouse


# What a build writes beside its tables.
DOCUMENTS = (
    "build_manifest", "raw_inputs", "missing_tickers", "company_listing", "company_totals", "financials_header",
    "financials", "charts_header", "company_charts", "company_chart_series", "company_chart_axes", "company_chart_ticks",
    "stats_header", "stats_charts", "stats_metrics", "stats_scatter_definitions", "stats_periods",
    "stats_descriptive", "stats_scatter_counts", "stats_ranking", "stats_scatter", "stats_exclusion",
)
COMPARISON_DOCUMENTS = ("comparison_charts", "comparison_series")


@dataclass(frozen=True)
class BuildConfig:
    """Where a build reads and writes. All paths are folders or files Spark can reach."""

    companies: str
    snapshots: str
    base: str
    build_id: str
    comparisons: str | None = None
    allow_missing: bool = False
    strict: bool = True


def load_companies(spark: SparkSession, path: str) -> DataFrame:
    """Checked companies. Gates on rules, unique tickers, slugs and entity codes, and emptiness."""
    entries = Q.require_nonempty(C.scan_companies(spark, path), "the company file")
    checked = Q.check_companies(entries)
    Q.require_clean(checked.select("ticker", F.inline("violations")), "company file")
    companies = C.build_companies(entries)
    Q.require_clean(Q.check_unique(companies, ["ticker", "slug", "edinet_code"]), "repeated company")
    return companies


def load_snapshots(
    spark: SparkSession, config: BuildConfig, companies: DataFrame, stage: str
) -> DataFrame:
    """Accepted snapshots, one per (company, fetch time).

    Bodies are read, hashed, decoded and checked once; the checked rows are stored
    in the stage folder, so every later step reads them from there and a lost
    executor costs only its own tasks. Broken snapshots end the build when strict,
    else they are written to the quarantine.
    """
    decoded = decode_snapshot(scan_snapshots(spark, config.snapshots, companies))
    path = f"{stage}/_checked_snapshots"
    Q.check_snapshots(decoded).write.mode("errorifexists").parquet(path)
    checked = spark.read.parquet(path)

    if config.strict:
        Q.require_clean(violations(checked), "broken snapshots")
    else:
        sinks.write_json_lines(violations(checked), f"{stage}/quarantine")
    snapshots = usable_snapshots(checked)
    missing = Q.check_missing_entities(companies, snapshots)
    if not config.allow_missing:
        Q.require_clean(missing, "companies without a snapshot")
    Q.require_nonempty(snapshots, "the set of usable snapshots")
    return snapshots


def build(spark: SparkSession, config: BuildConfig) -> str:
    """Run all steps, check the result and publish it; returns the build's folder.

    Nothing is visible to readers until the last line. A failed build leaves its
    stage folder behind and the earlier build published.
    """
    configure(spark)
    stage = f"{config.base}/v={config.build_id}"
    companies = load_companies(spark, config.companies)
    snapshots = load_snapshots(spark, config, companies, stage)

    # Stored, as history and sources both read them.
    W.normalize_fields(snapshots).write.mode("errorifexists").parquet(f"{stage}/_periods")
    periods = spark.read.parquet(f"{stage}/_periods")
    sinks.write_table(C.build_dimension(companies), f"{stage}/dim_companies", schemas.DIM_COMPANIES)
    sinks.write_table(W.build_history(periods), f"{stage}/financial_history", schemas.FINANCIAL_HISTORY)
    sinks.write_table(
        W.build_sources(periods), f"{stage}/source_documents_history", schemas.SOURCE_DOCUMENTS_HISTORY
    )
    history = scan_table(spark, stage, "financial_history")
    sources = scan_table(spark, stage, "source_documents_history")
    # One row per period finds the newest snapshots, instead of eight.
    mart = W.build_mart(history, scan_table(spark, stage, "dim_companies"), sources, snapshots=sources)
    sinks.write_mart(
        mart, f"{stage}/company_year_metrics", schemas.COMPANY_YEAR_METRICS, ["company_order", "fiscal_year"]
    )
    mart = Q.require_nonempty(scan_table(spark, stage, "company_year_metrics"), "the mart")

    tables = scan_warehouse(spark, stage)
    sinks.write_json_lines(D.manifest(tables), f"{stage}/build_manifest")
    sinks.write_json_lines(D.raw_inputs(history), f"{stage}/raw_inputs")
    sinks.write_json_lines(Q.check_missing_entities(companies, history), f"{stage}/missing_tickers")

    listed = company_listing(companies, mart, spark.read.parquet(f"{stage}/_checked_snapshots"))
    sinks.write_json_lines(listed.drop("slug", "direct_stated").orderBy("company_order"), f"{stage}/company_listing")
    sinks.write_json_lines(company_totals(companies), f"{stage}/company_totals")
    _write_documents(spark, config, stage, mart)
    _write_statistics(spark, stage, mart)

    counts = _expected_counts(spark, stage, companies, snapshots)
    documents = [*DOCUMENTS, *(COMPARISON_DOCUMENTS if config.comparisons else ()), *(() if config.strict else ("quarantine",))]
    sinks.check_complete(spark, stage, schemas.WAREHOUSE, counts, documents)
    sinks.publish_staged(spark, config.base, config.build_id)
    return stage


def _expected_counts(spark: SparkSession, stage: str, companies: DataFrame, snapshots: DataFrame) -> dict[str, int]:
    """Row counts that follow from the inputs: eight facts and one source per period, and
    a mart row for each period (their years differ) of each company's newest snapshot."""
    found = spark.read.json(f"{stage}/build_manifest").first()
    periods = snapshots.count() * Q.PERIODS_PER_SNAPSHOT
    if found.source_document_count != periods:
        raise YearbookError(f"{found.source_document_count} source rows for {periods} periods")
    return {
        "dim_companies": companies.count(),
        "financial_history": periods * (len(Q.MONEY_FIELDS) + len(Q.RATIO_FIELDS)),
        "source_documents_history": periods,
        "company_year_metrics": snapshots.select("ticker").distinct().count() * Q.PERIODS_PER_SNAPSHOT,
    }


def _write_documents(spark: SparkSession, config: BuildConfig, stage: str, mart: DataFrame) -> None:
    sinks.write_json_lines(sinks.header(mart, "fetched_at"), f"{stage}/financials_header")
    sinks.write_json_lines(D.company_documents(mart), f"{stage}/financials")
    sinks.write_json_lines(D.company_chart_manifest(mart.select("ticker").distinct()), f"{stage}/company_charts")
    ids = ["ticker", "fiscal_year"]
    series = chart_series(mart, ids)
    axes = axis_domain(series, ["ticker", "chart"])
    sinks.write_json_lines(sinks.header(mart, "fetched_at"), f"{stage}/charts_header")
    sinks.write_json_lines(series, f"{stage}/company_chart_series")
    sinks.write_json_lines(axes, f"{stage}/company_chart_axes")
    sinks.write_json_lines(axis_ticks(axes, ["ticker", "chart"]), f"{stage}/company_chart_ticks")
    if config.comparisons is None:
        return
    pairs = C.scan_comparisons(spark, config.comparisons)
    Q.require_clean(Q.check_comparisons(pairs, mart), "comparison pairs")
    compared = compare_entities(pairs, mart, "ticker", "fiscal_year", list(COMPARISON_CHARTS))
    series = long_comparison(compared, "fiscal_year", COMPARISON_CHARTS)
    sinks.write_json_lines(D.comparison_chart_manifest(pairs), f"{stage}/comparison_charts")
    sinks.write_json_lines(series, f"{stage}/comparison_series")


def _write_statistics(spark: SparkSession, stage: str, mart: DataFrame) -> None:
    """Long statistics tables, split by year so that a page reads one year only."""
    require_common_periods(S.common_rows(mart))
    path = f"{stage}/_value_positions"
    described_positions(S.common_long(mart), S.GROUP, "value").write.mode("errorifexists").parquet(path)
    stats = S.statistics(mart, positions=spark.read.parquet(path))
    sinks.write_json_lines(S.stats_header(mart), f"{stage}/stats_header")
    sinks.write_json_lines(S.metric_registry(spark).coalesce(1), f"{stage}/stats_metrics")
    sinks.write_json_lines(S.scatter_registry(spark).coalesce(1), f"{stage}/stats_scatter_definitions")
    for name, table in (
        ("stats_periods", stats.periods),
        ("stats_charts", S.stats_charts(stats.periods)),
        ("stats_descriptive", stats.descriptive),
        ("stats_scatter_counts", stats.scatter_counts),
    ):
        sinks.write_json_lines(table, f"{stage}/{name}", ["fiscal_year"])
    ranking_order = ["metric", F.col("rank").isNull(), "rank", "company_order"]
    for name, table, order in (
        ("stats_ranking", stats.rankings, ranking_order),
        ("stats_scatter", stats.scatters, ["scatter", "company_order"]),
        ("stats_exclusion", stats.exclusions, ["scatter", "company_order"]),
    ):
        # A range shuffle on the full order: a task writes few years, and one year
        # is spread over many tasks.
        keys = ["fiscal_year", *order]
        ordered = table.repartitionByRange(*keys).sortWithinPartitions(*keys)
        sinks.write_json_lines(ordered, f"{stage}/{name}", ["fiscal_year"])
