"""Strict reading of schemaless JSON.

A VARIANT keeps the kind of each JSON token, so ``2021``, ``2021.0``, ``"2021"``
and ``true`` can be told apart. A declared schema would coerce them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegralType

from yearbook.functions.numeric import round4


def decode_json(content: Column) -> Column:
    """Bytes to VARIANT; null for bad UTF-8 and for malformed JSON."""
    return F.try_parse_json(F.try_validate_utf8(content.cast("string")))


def field(value: Column, path: str) -> Column:
    """A member by path as VARIANT; null where it is absent."""
    return F.try_variant_get(value, path, "variant")


def token(value: Column) -> Column:
    """Kind of a JSON value: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID,
    ``ARRAY<...>`` or ``OBJECT<...>``; null where the value is absent."""
    return F.schema_of_variant(value)


def is_missing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def is_object(value: Column) -> Column:
    return F.coalesce(token(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(token(value).startswith("ARRAY"), F.lit(False))


def as_double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


# The rules below look at a value through its token and its double, so that a
# caller with many fields computes these two once per field (see ``scalar``).


def scalar(value: Column) -> Column:
    """``(value, token, number)`` of a JSON scalar, as one struct."""
    return F.struct(value.alias("value"), token(value).alias("token"), as_double(value).alias("number"))


def scalar_is_missing(s: Column) -> Column:
    return s["token"].isNull() | (s["token"] == "VOID")


def _number(s: Column) -> Column:
    kind = s["token"]
    known = (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")
    return F.coalesce(known, F.lit(False))


def scalar_is_zero(s: Column) -> Column:
    """A real zero; null and absent are not."""
    return _number(s) & (s["number"] == 0)


def _finite(s: Column) -> Column:
    return F.coalesce(F.abs(s["number"]) < F.lit(float("inf")), F.lit(False))


def scalar_is_text(s: Column) -> Column:
    return F.coalesce(s["token"] == "STRING", F.lit(False))


def scalar_is_integer(s: Column) -> Column:
    """A JSON integer token; ``2021.0`` and ``true`` are not."""
    return F.coalesce(s["token"] == "BIGINT", F.lit(False))


def scalar_is_ratio(s: Column) -> Column:
    """Null, or a finite number."""
    return scalar_is_missing(s) | (_number(s) & _finite(s))


def scalar_is_money(s: Column) -> Column:
    """Null, or a number without a fraction (``100.0`` is fine) that the mart's BIGINT holds."""
    number = s["number"]
    fits = F.abs(number) < 9.2233720368547e18
    # Every double beyond 2**53 is integral, and floor() to BIGINT would overflow.
    integral = (F.abs(number) >= 9007199254740992.0) | (number == F.floor(number).cast("double"))
    return scalar_is_ratio(s) & (scalar_is_missing(s) | F.coalesce(integral & fits, F.lit(False)))


# Kinds of whole numbers that fit, whatever the digits; trailing zeros are no digits here.
_WHOLE_KINDS = tuple(f"DECIMAL({digits},0)" for digits in range(1, 19))


def is_plain_money(value: Column) -> Column:
    """The usual forms of what ``scalar_is_money`` lets through, told by their kind and at
    most one number. False says nothing."""
    kind = F.coalesce(token(value), F.lit("VOID"))
    return kind.isin("VOID", *_WHOLE_KINDS) | ((kind == "BIGINT") & (F.abs(as_double(value)) < 9.2233720368547e18))


def scalar_is_optional_text(s: Column) -> Column:
    return scalar_is_missing(s) | scalar_is_text(s)


def is_text(value: Column) -> Column:
    return scalar_is_text(scalar(value))


def is_integer(value: Column) -> Column:
    return scalar_is_integer(scalar(value))


def is_number(value: Column) -> Column:
    return _number(scalar(value))


def is_money(value: Column) -> Column:
    return scalar_is_money(scalar(value))


def is_ratio(value: Column) -> Column:
    return scalar_is_ratio(scalar(value))


def is_optional_text(value: Column) -> Column:
    return scalar_is_optional_text(scalar(value))


def fits(value: Column, kind: DataType) -> Column:
    """Whether a column of that type holds the JSON number: an integer token in range, or a
    finite number."""
    if isinstance(kind, IntegralType):
        return is_integer(value) & F.try_variant_get(value, "$", kind.simpleString()).isNotNull()
    if isinstance(kind, DoubleType):
        return is_number(value) & _finite(scalar(value))
    raise TypeError(f"no rule for {kind.simpleString()}")


def as_text(value: Column) -> Column:
    return F.when(token(value) == "STRING", F.try_variant_get(value, "$", "string"))


def normalize_money(value: Column) -> Column:
    """A checked money value as exact decimal; integer tokens never pass through double.
    A number that does not fit fails the job, as the rules do not let one through."""
    exact = F.variant_get(value, "$", "decimal(38,4)")
    return F.when(is_number(value), exact)


def normalize_ratio(value: Column) -> Column:
    """A checked ratio (0.466) as rounded percentage points (46.6)."""
    return F.when(is_number(value), round4(as_double(value) * 100))
