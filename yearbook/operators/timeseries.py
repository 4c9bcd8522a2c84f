"""Operators over one short series per entity.

The input has one row per (entity, period). Periods are calendar steps, so the
length of a series is bounded by the calendar, whatever the number of raw rows
behind it: pre-aggregate raw rows to that grain first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, TimestampNTZType, TimestampType

from yearbook.functions.ratios import free_cash_flow, operating_margin, revenue_cagr, revenue_yoy


def lag_metric(
    df: DataFrame, entity: str, period: str, metric: str, steps: dict[int, str]
) -> DataFrame:
    """Earlier values by position: ``steps`` maps the distance to the new column.

    A missing period is not noticed; the row before is used, however far back.
    """
    series = Window.partitionBy(entity).orderBy(period)
    return df.withColumns({name: F.lag(metric, n).over(series) for n, name in steps.items()})


def lag_by_value(
    df: DataFrame, entity: str, period: str, metric: str, steps: dict[int, str]
) -> DataFrame:
    """Earlier values by distance: period - n, or null where that period is absent.

    Looks in a window over the period's value instead of joining the frame with itself.
    """
    out = df
    for n, name in steps.items():
        exact = Window.partitionBy(entity).orderBy(period).rangeBetween(-n, -n)
        out = out.withColumn(name, F.max(metric).over(exact))
    return out


def add_derived_metrics(
    df: DataFrame, entity: str, period: str, *, by_value: bool = False
) -> DataFrame:
    """Growth, margin, free cash flow and three-step compound growth.

    Both earlier revenues come from one window, so the frame is sorted once.
    """
    steps = {1: "previous_revenue", 3: "starting_revenue"}
    lagged = (lag_by_value if by_value else lag_metric)(df, entity, period, "revenue", steps)
    return lagged.withColumns(
        {
            "revenue_yoy_pct": revenue_yoy(F.col("revenue"), F.col("previous_revenue")),
            "operating_margin_pct": operating_margin(F.col("operating_income"), F.col("revenue")),
            "free_cash_flow": free_cash_flow(
                F.col("operating_cash_flow"), F.col("investing_cash_flow")
            ),
            "revenue_cagr_3y_pct": revenue_cagr(F.col("revenue"), F.col("starting_revenue")),
        }
    ).drop("previous_revenue", "starting_revenue")


def latest_period(df: DataFrame, entity: str, period: str) -> DataFrame:
    """The row of the newest period of each entity; one row each, no sort.

    Columns of fixed width are picked by a hash aggregate, all from one row. If there
    are others, such as text, the newest periods are found by a hash aggregate and joined back;
    a period that occurs twice against the grain of a series keeps both rows then.
    """
    others = [c for c in df.columns if c not in (entity, period)]
    if all(_fixed_width(df.schema[c].dataType) for c in (*others, period)):
        picked = [F.max_by(F.col(c), F.col(period)).alias(c) for c in others]
        return df.groupBy(entity).agg(F.max(period).alias(period), *picked).select(*df.columns)
    newest = df.groupBy(entity).agg(F.max(period).alias("newest")).withColumnRenamed(entity, "of_entity")
    same = F.col(entity).eqNullSafe(F.col("of_entity")) & F.col(period).eqNullSafe(F.col("newest"))
    return df.join(newest, same, "left_semi")


def _fixed_width(kind: DataType) -> bool:
    """Whether a hash aggregate can hold a value of that type."""
    return isinstance(kind, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))


def segment_series(
    df: DataFrame, keys: list[str], period: str, value: str, min_points: int = 2
) -> DataFrame:
    """Runs of present values, cut at nulls; runs shorter than ``min_points`` go.

    Returns ``(*keys, segment, first_period, last_period, points)``; segments are
    numbered from 1 in period order.
    """
    series = Window.partitionBy(*keys).orderBy(period)
    island = F.count(F.when(F.col(value).isNull(), 1)).over(series)
    runs = (
        df.withColumn("island", island)
        .filter(F.col(value).isNotNull())
        .groupBy(*keys, "island")
        .agg(
            F.min(period).alias("first_period"),
            F.max(period).alias("last_period"),
            F.count("*").alias("points"),
        )
        .filter(F.col("points") >= min_points)
    )
    order = Window.partitionBy(*keys).orderBy("first_period")
    return runs.withColumn("segment", F.row_number().over(order).cast("bigint")).drop("island")


def series_position(df: DataFrame, keys: list[str], period: str) -> DataFrame:
    """Place of each period on a chart: index from 0, and share of the width.

    A single point sits in the middle.
    """
    whole = Window.partitionBy(*keys)
    index = F.row_number().over(whole.orderBy(period)).cast("bigint") - 1
    size = F.count("*").over(whole)
    placed = df.withColumns({"position": index, "points": size})
    share = F.when(F.col("points") == 1, F.lit(0.5)).otherwise(
        F.try_divide(F.col("position").cast("double"), F.col("points") - 1)
    )
    return placed.withColumn("x_share", share)
