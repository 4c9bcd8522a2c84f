"""Wide to long and back, on any set of metric columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearbook.functions.numeric import MONEY_TYPE, decimal4, scale_metric, whole
from yearbook.operators.registry import (
    FACT_METRICS,
    MONEY_METRICS,
    MONEY_UNIT,
    PERCENT_METRICS,
    PERCENT_UNIT,
    STATS_METRICS,
    Metric,
)


def unpivot_facts(
    wide: DataFrame, ids: Sequence[str], metrics: Sequence[str] = FACT_METRICS
) -> DataFrame:
    """One row per metric: ``(*ids, metric_name, value decimal(38,4))``.

    Null values stay as rows, so a period whose metrics are all missing survives.
    """
    typed = wide.select(*ids, *[decimal4(F.col(m)).alias(m) for m in metrics])
    return typed.unpivot(list(ids), list(metrics), "metric_name", "value")


def with_unit(facts: DataFrame, money: Sequence[str] = MONEY_METRICS) -> DataFrame:
    return facts.withColumn(
        "unit",
        F.when(F.col("metric_name").isin(*money), MONEY_UNIT).otherwise(PERCENT_UNIT),
    )


def pivot_metrics(
    facts: DataFrame,
    keys: Sequence[str],
    money: Sequence[str] = MONEY_METRICS,
    percent: Sequence[str] = PERCENT_METRICS,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with a column per metric.

    Conditional maxima instead of ``pivot``: one aggregation, partly done before
    the shuffle, so a key with many rows sends one row per task. ``extra`` adds
    further aggregates to the same pass.
    """

    def picked(metric: str) -> Column:
        return F.max(F.when(F.col("metric_name") == metric, F.col("value")))

    return facts.groupBy(*keys).agg(
        *[whole(picked(m)).alias(m) for m in money],
        *[picked(m).cast("double").alias(m) for m in percent],
        *[column.alias(name) for name, column in (extra or {}).items()],
    )


def long_metrics(
    mart: DataFrame, ids: Sequence[str], metrics: Sequence[Metric] = STATS_METRICS
) -> DataFrame:
    """``(*ids, metric, value)`` with money in millions, for every registered metric."""
    scaled = mart.select(*ids, *[scale_metric(F.col(m.column), m.kind).alias(m.id) for m in metrics])
    return scaled.unpivot(list(ids), [m.id for m in metrics], "metric", "value")


__all__ = ["MONEY_TYPE", "unpivot_facts", "with_unit", "pivot_metrics", "long_metrics"]
