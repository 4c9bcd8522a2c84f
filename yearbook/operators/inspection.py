"""Which values are missing, and which are a real zero."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearbook.functions import variants as V
from yearbook.operators.quality import MONEY_FIELDS, RATIO_FIELDS, SOURCE_FIELDS, data_rows, members

INSPECTED_FIELDS = (*MONEY_FIELDS.values(), *RATIO_FIELDS.values())


def year_order(years: Column) -> Column:
    """``ascending``, ``descending`` or null for neither."""
    return F.when(years == F.array_sort(years), "ascending").when(
        years == F.sort_array(years, asc=False), "descending"
    )


def _inspected(row: Column) -> Column:
    return F.struct(
        F.try_variant_get(row["fiscal_year"], "$", "int").alias("year"),
        V.as_text(row["accounting_standard"]).alias("standard"),
        *[V.scalar_is_missing(V.scalar(row[name])).alias(f"{name}_missing") for name in (*INSPECTED_FIELDS, *SOURCE_FIELDS)],
        *[V.scalar_is_zero(V.scalar(row[name])).alias(f"{name}_zero") for name in INSPECTED_FIELDS],
    )


def inspect_snapshots(decoded: DataFrame, keys: Sequence[str] = ("raw_file", "ticker")) -> DataFrame:
    """One report row per decoded snapshot, without a shuffle.

    Years stay in file order; standards are distinct in first-seen order; the
    three maps go from field to the years concerned.
    """
    names = (*INSPECTED_FIELDS, *SOURCE_FIELDS, "accounting_standard", "fiscal_year")
    rows = members(F.col("payload"), "$.data", names)
    parts = decoded.select(*keys, F.transform(rows, _inspected).alias("_rows"))

    def report(fields: Sequence[str], kind: str) -> Column:
        def years(name: str) -> Column:
            return F.transform(F.filter("_rows", lambda r: r[f"{name}_{kind}"]), lambda r: r["year"])

        return F.map_from_arrays(
            F.array(*[F.lit(f) for f in fields]), F.array(*[years(f) for f in fields])
        )

    years = F.transform("_rows", lambda r: r["year"])
    standards = F.transform("_rows", lambda r: r["standard"])
    return parts.select(
        *keys,
        years.alias("fiscal_years"),
        year_order(years).alias("year_order"),
        F.array_distinct(F.array_compact(standards)).alias("accounting_standards"),
        report(INSPECTED_FIELDS, "missing").alias("missing_values"),
        report(INSPECTED_FIELDS, "zero").alias("zero_values"),
        report(SOURCE_FIELDS, "missing").alias("missing_source_values"),
    )


def check_inspection(decoded: DataFrame, keys: Sequence[str] = ("raw_file", "ticker")) -> DataFrame:
    """The rules that hold before landing and not later: years in order, text standards."""
    rows = data_rows(F.col("payload"))
    years = F.transform(rows, lambda r: F.try_variant_get(r, "$.fiscal_year", "int"))
    odd = F.exists(
        rows, lambda r: ~V.is_optional_text(V.field(r, "$.accounting_standard"))
    )
    found = F.array_compact(
        F.array(
            F.when(year_order(years).isNull(), F.lit("year_order")),
            F.when(odd, F.lit("standard_type")),
        )
    )
    return decoded.select(*keys, F.explode(found).alias("rule"))


def inspect_missing_zero(
    df: DataFrame, entity: str, period: str, fields: Sequence[str]
) -> DataFrame:
    """The same report for a wide table: ``(entity, field, missing, zero)``.

    The two arrays hold periods in order; an entity has at most one entry per
    calendar period, so they stay short. Fields without a finding give no row.
    """
    typed = df.select(entity, period, *[F.col(f).cast("double").alias(f) for f in fields])
    long = typed.unpivot([entity, period], list(fields), "field", "value")
    hits = long.filter(F.col("value").isNull() | (F.col("value") == 0))
    missing = F.when(F.col("value").isNull(), F.col(period))
    zero = F.when(F.col("value") == 0, F.col(period))
    return hits.groupBy(entity, "field").agg(
        F.array_sort(F.collect_list(missing)).alias("missing"),
        F.array_sort(F.collect_list(zero)).alias("zero"),
    )


def inspect_standards(df: DataFrame, entity: str, position: str, standard: str) -> DataFrame:
    """Distinct values of an entity, numbered in first-seen order."""
    first = (
        df.filter(F.col(standard).isNotNull())
        .groupBy(entity, standard)
        .agg(F.min(position).alias("first_seen"))
    )
    order = Window.partitionBy(entity).orderBy("first_seen", standard)
    return first.withColumn("seen_order", F.row_number().over(order).cast("bigint"))
