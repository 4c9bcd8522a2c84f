"""Derived metrics. Each is null when an input is missing or has no meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from yearbook.functions.numeric import round4


def revenue_yoy(current: Column, previous: Column) -> Column:
    """Growth over the previous value in percent; a negative base is used as is."""
    growth = (current.cast("double") / previous.cast("double") - 1) * 100
    return F.when(previous != 0, round4(growth))


def operating_margin(income: Column, revenue: Column) -> Column:
    """Income as a share of revenue in percent."""
    return F.when(revenue != 0, round4(income.cast("double") / revenue.cast("double") * 100))


def free_cash_flow(operating: Column, investing: Column) -> Column:
    """Operating plus investing cash flow; the sign of investing is kept."""
    return operating + investing


def revenue_cagr(current: Column, start: Column, periods: int = 3) -> Column:
    """Compound growth per period in percent; falls to -100 when current is zero."""
    factor = F.pow(current.cast("double") / start.cast("double"), F.lit(1.0 / periods))
    return F.when((start > 0) & (current >= 0), round4((factor - 1) * 100))
