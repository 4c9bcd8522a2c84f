"""The data behind the charts: series, axis ranges, ticks, cards and listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearbook.functions.numeric import scale_metric
from yearbook.operators.registry import COMPANY_CHARTS
from yearbook.operators.snapshots import flag_available
from yearbook.operators.timeseries import latest_period

# Axis padding and number of ticks.
AXIS_PADDING = 0.08
AXIS_TICKS = 5


def chart_series(
    mart: DataFrame,
    ids: Sequence[str],
    charts: Mapping[str, tuple[str, tuple[tuple[str, str], ...]]] = COMPANY_CHARTS,
) -> DataFrame:
    """``(*ids, chart, kind, series, label, value)`` for all charts in one pass."""
    cells = [
        F.struct(
            F.lit(chart).alias("chart"),
            F.lit(kind).alias("kind"),
            F.lit(column).alias("series"),
            F.lit(label).alias("label"),
            scale_metric(F.col(column), kind).alias("value"),
        )
        for chart, (kind, lines) in charts.items()
        for column, label in lines
    ]
    return mart.select(*ids, F.inline(F.array(*cells)))


def axis_domain(series: DataFrame, chart_keys: Sequence[str], value: str = "value") -> DataFrame:
    """Value range of each chart, with zero inside and some room at the ends.

    An all-zero chart spans -1 to 1. Room is added below only if a value is
    negative. A chart without any value has null bounds and ``has_data`` false.
    """
    raw = series.groupBy(*chart_keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    flat = (F.col("low") == 0) & (F.col("high") == 0)
    bottom = F.when(flat, -1.0).otherwise(F.least(F.lit(0.0), F.col("low")))
    top = F.when(flat, 1.0).otherwise(F.greatest(F.lit(0.0), F.col("high")))
    known = F.col("low").isNotNull()
    room = (F.col("top") - F.col("bottom")) * AXIS_PADDING
    return (
        raw.withColumns({"bottom": F.when(known, bottom), "top": F.when(known, top)})
        .withColumns(
            {
                "axis_min": F.when(F.col("low") < 0, F.col("bottom") - room).otherwise(F.col("bottom")),
                "axis_max": F.col("top") + room,
                "has_data": known,
            }
        )
        .select(*chart_keys, "axis_min", "axis_max", "has_data")
    )


def axis_ticks(domain: DataFrame, chart_keys: Sequence[str], ticks: int = AXIS_TICKS) -> DataFrame:
    """Evenly spaced ticks from the bottom to the top of each axis."""
    last = ticks - 1
    span = F.col("axis_max") - F.col("axis_min")
    return (
        domain.filter(F.col("has_data"))
        .select(*chart_keys, "axis_min", "axis_max", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("tick"))
        .select(
            *chart_keys,
            F.col("tick").cast("bigint").alias("tick"),
            (F.col("axis_min") + span * F.col("tick") / last).alias("tick_value"),
        )
    )


def latest_cards(
    mart: DataFrame, entity: str, period: str, kinds: Mapping[str, str]
) -> DataFrame:
    """``(entity, period, card_order, metric, value)`` of each entity's newest period."""
    cells = [
        F.struct(
            F.lit(place).alias("card_order"),
            F.lit(metric).alias("metric"),
            scale_metric(F.col(metric), kind).alias("value"),
        )
        for place, (metric, kind) in enumerate(kinds.items())
    ]
    newest = latest_period(mart.select(entity, period, *kinds), entity, period)
    return newest.select(entity, period, F.inline(F.array(*cells)))


def company_listing(companies: DataFrame, financials: DataFrame, raw: DataFrame, key: str = "ticker") -> DataFrame:
    """The companies with ``has_financials`` and ``has_raw``: does either table, of which
    only ``key`` is read, have a row for them?"""
    listed = flag_available(companies, financials, key, "has_financials")
    return flag_available(listed, raw, key, "has_raw")


def company_totals(companies: DataFrame, targets: str = "targets", status: str = "status") -> DataFrame:
    """One row: all targets, direct companies, indirect companies."""
    direct = F.col(status) == "direct"
    return companies.agg(
        F.coalesce(F.sum(F.size(targets)), F.lit(0)).alias("target_count"),
        F.count_if(direct).alias("direct_count"),
        F.count_if(~direct).alias("indirect_count"),
    )
