"""From accepted snapshots to the stored tables and the company-year mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearbook.functions import variants as V
from yearbook.functions.text import normalize_filed_at, normalize_standard
from yearbook.operators.quality import MONEY_FIELDS, RATIO_FIELDS, members
from yearbook.operators.reshape import pivot_metrics, unpivot_facts, with_unit
from yearbook.operators.snapshots import join_latest, latest_snapshot
from yearbook.operators.timeseries import add_derived_metrics

# Fixed value: the only document type there is.
DOCUMENT_TYPE = "annual_securities_report"

SNAPSHOT_KEYS = ("ticker", "raw_fetched_at", "raw_sha256")


def normalize_fields(snapshots: DataFrame) -> DataFrame:
    """One typed row per period of the accepted, decoded snapshots."""
    keys = ["company_order", "ticker", "fetched_at", "sha256", "raw_file"]
    wanted = [
        "fiscal_year",
        "accounting_standard",
        *MONEY_FIELDS.values(),
        *RATIO_FIELDS.values(),
        "doc_id",
        "submit_date",
        "edinet_filing_url",
    ]
    # The outer form, because Spark copies the input of the plain one into a filter.
    rows = F.posexplode_outer(members(F.col("payload"), "$.data", wanted)).alias("position", "row")
    fields = snapshots.select(*keys, rows).filter(F.col("position").isNotNull())

    def value(name: str):
        return F.col("row")[name]

    return fields.select(
        "company_order",
        "ticker",
        F.variant_get(value("fiscal_year"), "$", "int").alias("fiscal_year"),
        normalize_standard(V.as_text(value("accounting_standard"))).alias("accounting_standard"),
        F.lit(True).alias("consolidated"),
        *[V.normalize_money(value(raw)).alias(name) for name, raw in MONEY_FIELDS.items()],
        *[V.normalize_ratio(value(raw)).alias(name) for name, raw in RATIO_FIELDS.items()],
        V.as_text(value("doc_id")).alias("document_id"),
        normalize_filed_at(V.as_text(value("submit_date"))).alias("filed_at"),
        V.as_text(value("edinet_filing_url")).alias("url"),
        F.col("fetched_at").alias("raw_fetched_at"),
        F.col("sha256").alias("raw_sha256"),
        "raw_file",
    )


def build_history(periods: DataFrame) -> DataFrame:
    """The long fact table: eight rows per period, nulls kept."""
    ids = [
        "company_order",
        "ticker",
        "fiscal_year",
        "accounting_standard",
        "consolidated",
        "document_id",
        "raw_fetched_at",
        "raw_sha256",
        "raw_file",
    ]
    return with_unit(unpivot_facts(periods, ids))


def build_sources(periods: DataFrame) -> DataFrame:
    """One row per period: where its numbers come from."""
    return periods.withColumn("document_type", F.lit(DOCUMENT_TYPE)).select(
        "company_order",
        "ticker",
        "fiscal_year",
        "document_id",
        "document_type",
        "filed_at",
        "url",
        "raw_fetched_at",
        "raw_sha256",
        "raw_file",
    )


def latest_facts(history: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Facts of the newest snapshot of each company. ``snapshots``: a smaller table with
    the same snapshot keys, read instead of the history to find the newest ones."""
    keys = latest_snapshot(history if snapshots is None else snapshots, *SNAPSHOT_KEYS)
    return join_latest(history, keys, *SNAPSHOT_KEYS)


def join_dimension(rows: DataFrame, dimension: DataFrame, columns: Sequence[str], key: str = "ticker") -> DataFrame:
    """Rows with dimension columns; rows of an unknown entity are dropped."""
    return rows.join(dimension.select(key, *columns), key)


def join_sources(mart: DataFrame, sources: DataFrame) -> DataFrame:
    """Add the source document of each period, null where there is none."""
    found = sources.select(
        "ticker",
        "fiscal_year",
        F.col("raw_fetched_at").alias("fetched_at"),
        F.col("raw_sha256").alias("snapshot_sha256"),
        F.col("document_id").alias("source_document_id"),
        F.col("document_type").alias("source_document_type"),
        F.col("filed_at").alias("source_filed_at"),
        F.col("url").alias("source_url"),
    )
    return mart.join(found, ["ticker", "fiscal_year", "fetched_at", "snapshot_sha256"], "left")


def build_mart(
    history: DataFrame, dimension: DataFrame, sources: DataFrame, snapshots: DataFrame | None = None
) -> DataFrame:
    """One row per company and period of its newest snapshot, with derived metrics.

    Facts are reduced to one row per period before anything else is joined. The
    sources need no snapshot filter of their own: the left join is on the snapshot
    keys of the mart rows.

    The pivot groups by the accounting standard as well, then the largest standard
    of each period is taken. A maximum over text is a sorting aggregate; this way it
    sorts one row per period instead of one per fact. ``snapshots`` as in ``latest_facts``.
    """
    keys = [*SNAPSHOT_KEYS, "fiscal_year"]
    metrics = [*MONEY_FIELDS, *RATIO_FIELDS]
    by_standard = pivot_metrics(
        latest_facts(history, snapshots),
        [*keys, "accounting_standard"],
        extra={"consolidated": F.bool_and("consolidated")},
    )
    periods = by_standard.groupBy(*keys).agg(
        *[F.max(metric).alias(metric) for metric in metrics],
        F.max("accounting_standard").alias("accounting_standard"),
        F.bool_and("consolidated").alias("consolidated"),
    )
    named = join_dimension(periods, dimension, ["company_order", "name", "edinet_code", "currency"])
    derived = add_derived_metrics(named, "ticker", "fiscal_year")
    renamed = derived.withColumnsRenamed(
        {"raw_fetched_at": "fetched_at", "raw_sha256": "snapshot_sha256"}
    ).withColumn("fiscal_year_end", F.lit(None).cast("date"))
    return join_sources(renamed, sources).select(
        "company_order",
        "ticker",
        "name",
        "edinet_code",
        "currency",
        "fiscal_year",
        "fiscal_year_end",
        "accounting_standard",
        "consolidated",
        *MONEY_FIELDS,
        *RATIO_FIELDS,
        "revenue_yoy_pct",
        "operating_margin_pct",
        "free_cash_flow",
        "revenue_cagr_3y_pct",
        "source_document_id",
        "source_document_type",
        "source_filed_at",
        "source_url",
        "fetched_at",
        "snapshot_sha256",
    )


def order_mart(mart: DataFrame) -> DataFrame:
    return mart.orderBy("company_order", "fiscal_year")
