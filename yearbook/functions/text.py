"""Names, codes, dates and display strings."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Spellings of accounting standards and their normal form.
STANDARD_CODES = {
    "JP": "JGAAP",
    "JP_GAAP": "JGAAP",
    "IFRS": "IFRS",
    "US": "USGAAP",
    "US_GAAP": "USGAAP",
}
UNKNOWN_STANDARD = "UNKNOWN"

# Fixed value: what a missing number or date looks like on a page.
MISSING_MARK = "—"


def ticker_slug(ticker: Column) -> Column:
    """Lower case, other characters folded to single underscores; null if nothing is left."""
    folded = F.regexp_replace(F.lower(ticker), "[^a-z0-9]+", "_")
    return F.nullif(F.btrim(folded, F.lit("_")), F.lit(""))


def normalize_standard(
    value: Column, codes: dict[str, str] | None = None, unknown: str = UNKNOWN_STANDARD
) -> Column:
    """Look a spelling up in a fixed table; everything else is unknown."""
    pairs = STANDARD_CODES if codes is None else codes
    table = F.create_map(*[F.lit(part) for pair in pairs.items() for part in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(unknown))


def normalize_filed_at(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` text to a date; any other text gives null."""
    return F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm")).cast("date")


@F.pandas_udf(StringType())
def _nfkc_trim(names: pd.Series) -> pd.Series:
    return names.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s).strip())


def normalize_name(value: Column) -> Column:
    """Compatibility-normalised (full-width to plain), trimmed text.

    Spark has no built-in for this normal form, so it is the one Arrow-batched
    Python function of the package.
    """
    return _nfkc_trim(value)


def stripped(value: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(value, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def _utc_parts(value: Column) -> tuple[Column, list[Column]]:
    """The UTC day, and hours, minutes and seconds as two digits each. By arithmetic, so
    the session's zone has no part in it."""
    seconds = F.unix_seconds(value.cast("timestamp"))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))
    left = F.pmod(seconds, F.lit(86400))
    return day, [F.lpad(F.floor(part).cast("string"), 2, "0") for part in (left / 3600, left % 3600 / 60, left % 60)]


def utc_stamp(value: Column) -> Column:
    """``20260722T000000Z`` in UTC."""
    day, time = _utc_parts(value)
    return F.concat(F.replace(day.cast("string"), F.lit("-"), F.lit("")), F.lit("T"), *time, F.lit("Z"))


def iso_utc(value: Column) -> Column:
    """``2026-07-22T00:00:00Z`` in UTC."""
    day, (hours, minutes, seconds) = _utc_parts(value)
    return F.concat(day.cast("string"), F.lit("T"), hours, F.lit(":"), minutes, F.lit(":"), seconds, F.lit("Z"))


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def format_date_slash(value: Column) -> Column:
    """Date as ``yyyy/MM/dd``, a dash for null."""
    return F.coalesce(F.date_format(value, "yyyy/MM/dd"), F.lit(MISSING_MARK))


def to_japan_time(value: Column) -> Column:
    """UTC timestamp as Tokyo wall time, ``yyyy/MM/dd H:mm``."""
    return F.date_format(F.from_utc_timestamp(value, "Asia/Tokyo"), "yyyy/MM/dd H:mm")


def grouped_number(value: Column, max_decimals: int) -> Column:
    """Digits in groups of three, at most ``max_decimals`` decimals, no trailing zeros."""
    text = F.format_number(value, max_decimals)
    if max_decimals:
        text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return text


def format_millions(value: Column) -> Column:
    """Whole money units shown in millions without decimals."""
    text = grouped_number(F.round(value.cast("double") / F.lit(1000000.0), 0), 0)
    return F.coalesce(text, F.lit(MISSING_MARK))


def format_percent(value: Column) -> Column:
    text = F.concat(grouped_number(F.round(value * 100, 0) / 100, 2), F.lit("%"))
    return F.coalesce(text, F.lit(MISSING_MARK))


def format_stat(value: Column, kind: Column) -> Column:
    """A statistic with at most two decimals, with a percent sign where it is one."""
    text = grouped_number(F.round(value * 100, 0) / 100, 2)
    return F.coalesce(
        F.when(kind == "percent", F.concat(text, F.lit("%"))).otherwise(text),
        F.lit(MISSING_MARK),
    )


def _one_decimal(value: Column) -> Column:
    return F.replace(F.format_number(value, 1), F.lit(","), F.lit(""))


def format_compact(value: Column) -> Column:
    """A value in millions with a B (thousand) or T (million) suffix when large."""
    size = F.abs(value)
    return (
        F.when(size >= 1000000, F.concat(_one_decimal(value / 1000000.0), F.lit("T")))
        .when(size >= 1000, F.concat(_one_decimal(value / 1000.0), F.lit("B")))
        .otherwise(F.format_number(value, 0))
    )


def fiscal_label(period: Column) -> Column:
    """``FY`` and the last two digits of the year."""
    return F.concat(F.lit("FY"), F.right(period.cast("string"), F.lit(2)))
