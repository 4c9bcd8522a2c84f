"""All statistics of all common periods, as long tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook.functions.numeric import round4
from yearbook.functions.text import iso_utc
from yearbook.operators.ranking import described_positions, rank_metric
from yearbook.operators.registry import DEFAULT_RANKING, DEFAULT_SCATTER, SCATTERS, STATS_METRICS
from yearbook.operators.reshape import long_metrics
from yearbook.operators.stats import (
    common_periods,
    describe_metrics,
    scatter_counts,
    scatter_exclusions,
    scatter_pairs,
    scatter_points,
)
from yearbook.sinks import SCHEMA_VERSION

GROUP = ["fiscal_year", "metric"]


@dataclass(frozen=True)
class Statistics:
    """The statistics of a mart. ``rankings`` and the scatters have a row per entity."""

    periods: DataFrame
    descriptive: DataFrame
    rankings: DataFrame
    scatters: DataFrame
    scatter_counts: DataFrame
    exclusions: DataFrame


def common_rows(mart: DataFrame) -> DataFrame:
    """Mart rows of the periods that all entities share."""
    shared = common_periods(mart, "ticker", "fiscal_year").select("fiscal_year")
    return mart.join(shared, "fiscal_year", "left_semi")


def common_long(mart: DataFrame) -> DataFrame:
    return long_metrics(common_rows(mart), ["fiscal_year", "company_order", "ticker", "name"])


def statistics(mart: DataFrame, positions: DataFrame | None = None) -> Statistics:
    """Everything the statistics page shows, for every metric and plot at once.

    Pass a stored ``described_positions(common_long(mart), GROUP, "value")`` to share
    the sorted values between the quantiles and the ranks.
    """
    rows = common_rows(mart)
    long = common_long(mart)
    if positions is None:
        positions = described_positions(long, GROUP, "value")
    ranked = rank_metric(long, GROUP, "value", positions=positions)
    points = scatter_points(rows, ["fiscal_year", "company_order", "ticker", "name"])
    return Statistics(
        periods=common_periods(mart, "ticker", "fiscal_year"),
        descriptive=describe_metrics(long, GROUP, positions=positions),
        rankings=ranked.withColumn("value", round4(F.col("value"))),
        scatters=scatter_pairs(points),
        scatter_counts=scatter_counts(points, ["fiscal_year"]),
        exclusions=scatter_exclusions(points),
    )


def stats_header(mart: DataFrame) -> DataFrame:
    """One row: versions, common years, and what the page shows by default.

    The list of years is bounded by the calendar.
    """
    generated = mart.agg(iso_utc(F.max("fetched_at"))).scalar()
    years = common_periods(mart, "ticker", "fiscal_year").agg(
        F.array_sort(F.collect_list("fiscal_year")).alias("years")
    )
    return years.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        generated.alias("generated_at"),
        F.array_max("years").alias("default_year"),
        F.lit(DEFAULT_RANKING).alias("default_ranking"),
        F.lit(DEFAULT_SCATTER).alias("default_scatter"),
        "years",
    )


def stats_charts(periods: DataFrame) -> DataFrame:
    """``(fiscal_year, kind, id, chart)``: the asset key of every statistics chart of the
    common years. A year has a fixed number of charts."""
    kinds = [*(("ranking", "rankings", m.id) for m in STATS_METRICS), *(("scatter", "scatters", s.id) for s in SCATTERS)]
    year = F.col("fiscal_year").cast("string")
    cells = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(name).alias("id"),
            F.concat(F.lit("/charts/stats/fy"), year, F.lit(f"/{folder}/{name}.svg")).alias("chart"),
        )
        for kind, folder, name in kinds
    ]
    return periods.select("fiscal_year", F.inline(F.array(*cells)))


def metric_registry(spark: SparkSession) -> DataFrame:
    """The metric registry as a table, for ``metric_metadata_join``."""
    rows = [(i, m.id, m.label, m.english_label, m.unit, m.kind) for i, m in enumerate(STATS_METRICS)]
    return spark.createDataFrame(
        rows,
        "metric_order int, metric string, label string, english_label string, unit string, kind string",
    )


def scatter_registry(spark: SparkSession) -> DataFrame:
    rows = [(s.id, s.label, s.description, s.x, s.y, s.x_scale) for s in SCATTERS]
    return spark.createDataFrame(
        rows,
        "scatter string, label string, description string, x_metric string, y_metric string, x_scale string",
    )


def metric_metadata_join(rows: DataFrame, registry: DataFrame, key: str = "metric") -> DataFrame:
    """Add labels and units. The registry is a fixed table of a few rows."""
    return rows.join(F.broadcast(registry), key)
