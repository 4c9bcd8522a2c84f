"""Statistics over all entities of a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearbook.errors import YearbookError
from yearbook.functions.numeric import exact_mean, round4, scale_metric
from yearbook.operators.ranking import described_positions, known, quantile_columns
from yearbook.operators.registry import SCATTERS, STATS_METRICS, Metric, Scatter

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def count_distinct_entities(df: DataFrame, entity: str, period: str | None = None) -> DataFrame:
    """Exact distinct entities, overall or per period."""
    keys = [] if period is None else [period]
    return df.groupBy(*keys).agg(F.count_distinct(entity).alias("entities"))


def common_periods(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Periods in which every entity of the frame appears: ``(period, entities)``.

    The global count is a scalar subquery, so no row is joined with it.
    """
    everyone = count_distinct_entities(df, entity).scalar()
    return count_distinct_entities(df, entity, period).filter(F.col("entities") == everyone)


def require_common_periods(periods: DataFrame) -> DataFrame:
    """Gate: fail when there is no common period. Runs a one-row read."""
    if periods.isEmpty():
        raise YearbookError("no period is shared by all entities")
    return periods


def default_selection(
    periods: DataFrame, period: str, requested: int | None = None
) -> DataFrame:
    """The requested period if it is a common one, else the newest common one."""
    wanted = F.max(F.when(F.col(period) == F.lit(requested), F.col(period)))
    return periods.agg(F.coalesce(wanted, F.max(period)).alias(period))


def describe_metrics(
    long: DataFrame,
    group: Sequence[str],
    value: str = "value",
    *,
    approx: bool = False,
    positions: DataFrame | None = None,
) -> DataFrame:
    """Count, missing, mean, median, sample deviation, min, quartiles and max.

    All of them come from the counted distinct values, so ``long`` is read once; pass
    ``positions`` (``ranking.described_positions``) to reuse a stored table.

    Nulls and NaN count as missing and are left out of the rest; results have four
    decimals; a single value has no deviation; infinity fails the job. Quantiles are exact unless
    ``approx`` asks for one-pass sketches.
    """
    names = ["count", "missing", "mean", "median", "stddev", "min", "q1", "q3", "max"]
    v = F.col(value)
    if approx:
        if dict(long.dtypes)[value] in ("double", "float"):
            long = long.withColumn(value, known(v))
        basic = [
            F.count(v).alias("count"),
            (F.count("*") - F.count(v)).alias("missing"),
            round4(F.when(F.count(v) > 0, exact_mean(v))).alias("mean"),
            round4(F.stddev_samp(v)).alias("stddev"),
            round4(F.min(v)).alias("min"),
            round4(F.max(v)).alias("max"),
        ]
        sketch = F.percentile_approx(v, list(QUARTILES.values()), 10000)
        out = long.groupBy(*group).agg(*basic, sketch.alias("sketch"))
        for place, name in enumerate(QUARTILES):
            out = out.withColumn(name, round4(F.col("sketch")[place].cast("double")))
        return out.select(*group, *names)

    if positions is None:
        positions = described_positions(long, group, value)
    there = v.isNotNull()
    off = v - F.col("mean")
    picks, quarters = quantile_columns(value, QUARTILES)
    described = positions.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(there, F.col("ties"))), F.lit(0)).alias("count"),
        F.coalesce(F.sum(F.when(~there, F.col("ties"))), F.lit(0)).alias("missing"),
        F.max("mean").alias("group_mean"),
        F.sum(off * off * F.col("ties")).alias("squares"),
        F.min(v).alias("lowest"),
        F.max(v).alias("highest"),
        *picks,
    )
    mean = F.col("group_mean")
    infinite = F.raise_error(F.lit("an infinite value has no mean")).cast("double")
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1)))
    return described.select(
        *group,
        "count",
        "missing",
        round4(F.when(F.abs(mean) < float("inf"), mean).when(mean.isNotNull(), infinite)).alias("mean"),
        round4(deviation).alias("stddev"),
        round4(F.col("lowest")).alias("min"),
        round4(F.col("highest")).alias("max"),
        *quarters,
    ).select(*group, "count", "missing", "mean", *[round4(F.col(q)).alias(q) if q in QUARTILES else F.col(q) for q in names[3:]])


def scatter_reason(x: Column, y: Column, x_scale: Column) -> Column:
    """Why a point cannot be drawn, null if it can. Test the *rounded* values."""
    return (
        F.when(x.isNull() & y.isNull(), "missing_x_and_y")
        .when(x.isNull(), "missing_x")
        .when(y.isNull(), "missing_y")
        .when((x_scale == "log") & (x <= 0), "non_positive_x_for_log")
    )


def scatter_points(
    mart: DataFrame,
    ids: Sequence[str],
    scatters: Sequence[Scatter] = SCATTERS,
    metrics: Sequence[Metric] = STATS_METRICS,
) -> DataFrame:
    """``(*ids, scatter, x, y, reason)`` for every scatter in one pass over the mart.

    The registry is written into the plan as literals, so nothing is joined.
    """
    by_id = {m.id: m for m in metrics}

    def shown(metric_id: str) -> Column:
        metric = by_id[metric_id]
        return round4(scale_metric(F.col(metric.column), metric.kind))

    points = F.array(
        *[
            F.struct(
                F.lit(s.id).alias("scatter"),
                shown(s.x).alias("x"),
                shown(s.y).alias("y"),
                F.lit(s.x_scale).alias("x_scale"),
            )
            for s in scatters
        ]
    )
    return (
        mart.select(*ids, F.inline(points))
        .withColumn("reason", scatter_reason(F.col("x"), F.col("y"), F.col("x_scale")))
        .drop("x_scale")
    )


def scatter_pairs(points: DataFrame) -> DataFrame:
    return points.filter(F.col("reason").isNull()).drop("reason")


def scatter_exclusions(points: DataFrame) -> DataFrame:
    """Excluded rows. They stay rows: their number per plot is not bounded."""
    return points.filter(F.col("reason").isNotNull()).drop("x", "y")


def scatter_counts(points: DataFrame, group: Sequence[str]) -> DataFrame:
    """Included and excluded rows per plot, with zero counts kept."""
    return points.groupBy(*group, "scatter").agg(
        F.count_if(F.col("reason").isNull()).alias("included_count"),
        F.count_if(F.col("reason").isNotNull()).alias("excluded_count"),
    )
