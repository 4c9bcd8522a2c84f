"""Nested documents, one per company or pair, and the build manifest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearbook.functions.text import iso_date, iso_utc, ticker_slug
from yearbook.operators.quality import MONEY_FIELDS, RATIO_FIELDS
from yearbook.operators.registry import COMPANY_CHARTS, COMPARISON_CHARTS
from yearbook.sinks import PIPELINE_VERSION, SCHEMA_VERSION

CALCULATED = ("revenue_yoy_pct", "operating_margin_pct", "free_cash_flow", "revenue_cagr_3y_pct")


def nest_periods(mart: DataFrame) -> DataFrame:
    """One row per company with its periods as an array, oldest first.

    The array of a company holds its periods only, a handful of calendar years.
    """
    period = F.struct(
        F.col("fiscal_year"),
        iso_date(F.col("fiscal_year_end")).alias("fiscal_year_end"),
        F.col("accounting_standard"),
        F.col("consolidated"),
        F.struct(*MONEY_FIELDS, *RATIO_FIELDS).alias("metrics"),
        F.struct(*CALCULATED).alias("calculated_metrics"),
        F.struct(
            F.col("source_document_id").alias("document_id"),
            F.col("source_document_type").alias("document_type"),
            iso_date(F.col("source_filed_at")).alias("filed_at"),
            F.col("source_url").alias("url"),
        ).alias("source_document"),
        iso_utc(F.col("fetched_at")).alias("fetched_at"),
    )
    return mart.groupBy("ticker", "name", "edinet_code", "currency").agg(
        F.min("company_order").alias("company_order"),
        F.array_sort(F.collect_list(period)).alias("periods"),
    )


def company_documents(mart: DataFrame) -> DataFrame:
    """Company documents in dimension order."""
    nested = nest_periods(mart)
    return nested.orderBy("company_order").select("ticker", "name", "edinet_code", "currency", "periods")


def manifest_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: snapshots, facts, source documents and mart rows. The history is read once:
    its facts are counted by snapshot."""
    snapshots = tables["financial_history"].groupBy("ticker", "raw_fetched_at", "raw_sha256").agg(F.count("*").alias("facts"))

    def rows(df: DataFrame):
        return df.agg(F.count("*")).scalar()

    return snapshots.agg(F.count("*").alias("snapshot_count"), F.coalesce(F.sum("facts"), F.lit(0)).alias("fact_count")).select(
        "snapshot_count",
        F.col("fact_count").alias("financial_fact_count"),
        rows(tables["source_documents_history"]).alias("source_document_count"),
        rows(tables["company_year_metrics"]).alias("latest_company_year_count"),
    )


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The one-row build manifest. Inputs and missing tickers are lists of their own."""
    generated = tables["company_year_metrics"].agg(iso_utc(F.max("fetched_at"))).scalar()
    counts = manifest_counts(tables)
    return counts.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        generated.alias("generated_at"),
        *counts.columns,
    )


def raw_inputs(history: DataFrame) -> DataFrame:
    """Lineage: every snapshot behind the build, in company and time order."""
    inputs = history.groupBy("company_order", "ticker", "raw_fetched_at", "raw_sha256").agg(
        F.min("raw_file").alias("raw_file")
    )
    return inputs.orderBy("company_order", "raw_fetched_at").select(
        "ticker",
        "raw_file",
        iso_utc(F.col("raw_fetched_at")).alias("fetched_at"),
        F.col("raw_sha256").alias("sha256"),
    )


def company_chart_manifest(companies: DataFrame) -> DataFrame:
    """``(ticker, charts)``: the asset key of every company chart."""
    slug = ticker_slug(F.col("ticker"))
    charts = F.struct(
        *[
            F.concat(F.lit("/charts/companies/"), slug, F.lit(f"/{chart}.svg")).alias(chart)
            for chart in COMPANY_CHARTS
        ]
    )
    return companies.select("ticker", charts.alias("charts"))


def comparison_chart_manifest(pairs: DataFrame) -> DataFrame:
    """``(id, left, right, charts)``: the asset key of every pair chart."""
    charts = F.struct(
        *[
            F.concat(F.lit("/charts/comparisons/"), F.col("id"), F.lit(f"/{metric}.svg")).alias(metric)
            for metric in COMPARISON_CHARTS
        ]
    )
    return pairs.select("id", "left", "right", charts.alias("charts"))
