"""Exact ranks and quantiles inside very large groups.

There are few groups (a period and a metric) and one of them may hold a large
share of all rows, so a window per group would sort it in one task. Instead:

1. equal values are counted first, partly before the shuffle, so a value that
   fills a third of the rows becomes one row;
2. the distinct values are dealt out by ranges of (group, value). Where the ranges are
   cut is taken from a sample of the data, so each holds about as many values, however
   these are spread: close together, far out, or in one group. The dealt values are stored,
   as a second pass must find the same ranges;
3. inside a range the values of a group are summed in order, and the totals of a group's
   ranges, of which there are few, are summed in order too.

The place of a value is the total of the ranges before it plus the count inside
its range. Ranges only spread the work: the result is exact for any data. NaN counts as
missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearbook.functions.numeric import counted_mean
from yearbook.session import stored

# Ranges for each task of a shuffle, so that ranges dealt to tasks by hash come out even.
RANGES_PER_TASK = 4


def known(value: Column) -> Column:
    """The value as double; NaN is missing."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def spread_values(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``(*group, value, ties, part)``: distinct values and the range that each is in.

    A stored table. Missing values are one row of a group, with a null value.
    """
    counted = df.withColumn(value, known(F.col(value))).groupBy(*group, value).agg(F.count("*").alias("ties"))
    ranges = RANGES_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(counted.repartitionByRange(ranges, *group, value).withColumn("part", F.spark_partition_id()))


def described_positions(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """``value_positions`` with the rows of missing values (null ``less``), and beside each
    value the ``mean`` of its group: all that a description of the groups needs."""
    placed = spread_values(df, group, value)
    in_group = Window.partitionBy(*group)
    before = in_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ties = F.when(F.col(value).isNotNull(), F.col("ties"))
    sums = counted_mean(F.col(value), ties)
    ranges = (
        placed.groupBy(*group, "part")
        .agg(F.coalesce(F.sum(ties), F.lit(0)).alias("range_ties"), *(made.alias(name) for name, (made, _) in sums.parts.items()))
        .withColumns(
            {
                "below_range": F.coalesce(F.sum("range_ties").over(before), F.lit(0)),
                "total": F.sum("range_ties").over(in_group),
                **{name: merge(F.col(name)).over(in_group) for name, (_, merge) in sums.parts.items()},
            }
        )
        .withColumn("mean", sums.mean(F.col("total")))
        .select(*[F.col(c).alias(f"of_{c}") for c in (*group, "part")], "below_range", "total", "mean")
    )
    in_range = Window.partitionBy(*group, "part").orderBy(F.asc_nulls_first(value)).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("below_in_range", F.coalesce(F.sum(ties).over(in_range), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in group]
    less = F.when(F.col(value).isNotNull(), F.col("below_range") + F.col("below_in_range"))
    return summed.join(ranges, [*same, F.col("part") == F.col("of_part")]).select(*group, value, "ties", less.alias("less"), "total", "mean")


def value_positions(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """One row per distinct non-null value of a group.

    Returns ``(*group, value, ties, less, total)``: how many rows hold the value,
    how many hold a smaller one, and how many non-null rows the group has.
    """
    return described_positions(df, group, value).filter(F.col(value).isNotNull()).drop("mean")


def rank_metric(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    rank: str = "rank",
    positions: DataFrame | None = None,
) -> DataFrame:
    """Competition rank, largest value first; equal values share the smaller rank.

    Rows without a value (null or NaN) are kept with a null rank. They can be many, so
    they are spread over salts that match nothing instead of meeting in one task. A value
    shared by very many rows makes a skewed key on the row side only, which the
    adaptive join splits. Pass ``positions`` to reuse a stored
    ``value_positions`` table.
    """
    if positions is None:
        positions = value_positions(df, group, value)
    ranks = positions.filter(F.col(value).isNotNull()).select(
        *group,
        F.col(value).alias("ranked_value"),
        (F.col("total") - F.col("less") - F.col("ties") + 1).alias(rank),
        F.lit(0).alias("null_salt"),
    )
    # As many salts as the join has tasks; which one a row gets has no part in the result.
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int") + 1
    ranked_value = known(F.col(value))
    rows = df.withColumns({"null_salt": F.when(ranked_value.isNull(), salt).otherwise(F.lit(0)), "ranked_value": ranked_value})
    return rows.join(ranks, [*group, "null_salt", "ranked_value"], "left").drop(
        "null_salt", "ranked_value"
    )


def order_ranking(ranked: DataFrame, lead: Sequence[str], entity_order: str, rank: str = "rank") -> DataFrame:
    """Ranked rows first, then the missing ones; ties in entity order.

    The three keys make the order total. The sort is a range shuffle, spread over
    all tasks.
    """
    return ranked.orderBy(*lead, F.col(rank).isNull(), F.col(rank), F.col(entity_order))


def quantiles(
    positions: DataFrame, group: Sequence[str], value: str, shares: dict[str, float]
) -> DataFrame:
    """Exact quantiles from ``value_positions``, linear between the two neighbours and
    counted from the nearer one. One aggregation."""
    picks, results = quantile_columns(value, shares)
    return positions.groupBy(*group).agg(*picks).select(*group, *results)


def quantile_columns(value: str, shares: dict[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates over positions, and the quantiles made from them.

    The value at place p is the one with less <= p < less + ties.
    """

    def at(place: Column) -> Column:
        here = (F.col("less") <= place) & (place < F.col("less") + F.col("ties"))
        return F.max(F.when(here, F.col(value)))

    picks, results = [], []
    for name, share in shares.items():
        point = F.lit(share) * (F.col("total") - 1)
        low = F.floor(point)
        picks += [
            at(low).alias(f"{name}_low"),
            at(F.ceil(point)).alias(f"{name}_high"),
            F.max(point - low).alias(f"{name}_part"),
        ]
        low_value, high_value, part = (F.col(f"{name}_{end}") for end in ("low", "high", "part"))
        step = high_value - low_value
        nearer = F.when(part < 0.5, low_value + step * part).otherwise(high_value - step * (1 - part))
        results.append(nearer.alias(name))
    return picks, results
