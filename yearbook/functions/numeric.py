"""Rounding, scaling and exact sums.

Doubles are rounded in scaled form, ``round(x * 10000, 0) / 10000``, because
``round(x, 4)`` goes through a decimal and breaks ties differently from engines
that scale first.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(38,4)"
_MEAN_TYPE = "decimal(28,6)"
_MEAN_LIMIT = 1e21


def round4(value: Column) -> Column:
    """Round a double to four decimals; negative zero becomes zero."""
    rounded = F.round(value * F.lit(10000.0), 0) / F.lit(10000.0)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def decimal4(value: Column) -> Column:
    """Fixed four-decimal form used by the long fact table."""
    return value.cast(MONEY_TYPE)


def whole(value: Column) -> Column:
    """Decimal to BIGINT, half away from zero (a plain cast would truncate)."""
    return F.round(value, 0).cast("bigint")


def hundredths(value: Column) -> Column:
    """A double with two decimals as a whole number of hundredths.

    Cheap: a cast of a double to decimal would go through its text form.
    """
    return F.floor(value * 100 + F.lit(0.5))


def exact_sum(value: Column) -> Column:
    """Sum of BIGINT values as decimal, too wide to overflow.

    The high and low bits are summed apart as BIGINT, which is many times faster
    than adding decimals row by row: the low part holds for 8 * 10**12 rows.
    """
    high = F.sum(F.shiftright(value, 20)).cast("decimal(20,0)")
    low = F.sum(value.bitwiseAND(F.lit(0xFFFFF))).cast("decimal(20,0)")
    return high * F.lit(Decimal(1 << 20)) + low


def shifted(value: Column, places: int) -> Column:
    """A decimal with its point moved left, rounded to a whole BIGINT."""
    return whole(value * F.lit(Decimal(1).scaleb(-places)))


def exact_mean(value: Column) -> Column:
    """Mean over an exact decimal sum, so the result ignores row order.

    Exact for values with at most six decimals: whole units divided by one million, and
    percentages already rounded to four decimals. Where a value of the group passes what
    the decimal holds, the mean is that of the doubles. Infinity fails the job: it has no
    mean.
    """
    number = value.cast("double")
    largest = F.max(F.abs(number))
    held = F.when(F.abs(number) < _MEAN_LIMIT, value).cast(_MEAN_TYPE)
    infinite = F.raise_error(F.lit("an infinite value has no mean")).cast("double")
    exact = F.sum(held).cast("double") / F.count(value)
    return F.when(largest == float("inf"), infinite).when(largest < _MEAN_LIMIT, exact).otherwise(F.avg(number))


class CountedMean(NamedTuple):
    """A mean in steps: aggregates over (value, ties) rows, each with the aggregate that
    merges it, and the mean from the merged ones and the number of values."""

    parts: dict[str, tuple[Column, Callable[[Column], Column]]]
    mean: Callable[[Column], Column]


def counted_mean(value: Column, ties: Column) -> CountedMean:
    """``exact_mean`` over distinct values that occur ``ties`` times, null for no value. An
    infinite value gives an infinite mean, for the caller to refuse."""
    number = value.cast("double")
    held = F.when(F.abs(number) < _MEAN_LIMIT, value).cast(_MEAN_TYPE)
    parts = {
        "sum_largest": (F.max(F.abs(number)), F.max),
        "sum_held": (F.sum((held * ties.cast("decimal(19,0)")).cast("decimal(38,6)")), F.sum),
        "sum_double": (F.sum(number * ties), F.sum),
    }

    def mean(count: Column) -> Column:
        largest = F.col("sum_largest")
        exact = F.col("sum_held").cast("double") / count
        far = F.when(largest == float("inf"), largest).otherwise(F.col("sum_double") / count)
        return F.when(count > 0, F.when(largest < _MEAN_LIMIT, exact).otherwise(far))

    return CountedMean(parts, mean)


def in_millions(value: Column) -> Column:
    """Whole money units to millions, as double."""
    return value.cast("double") / F.lit(1000000.0)


def scale_metric(value: Column, kind: Column | str) -> Column:
    """Money is shown in millions; percentages stay as they are."""
    if isinstance(kind, str):
        return in_millions(value) if kind == "money" else value.cast("double")
    return F.when(kind == "money", in_millions(value)).otherwise(value.cast("double"))
