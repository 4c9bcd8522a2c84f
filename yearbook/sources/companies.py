"""The company dimension and the pair configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from yearbook.errors import YearbookError
from yearbook.functions import variants as V
from yearbook.functions.text import stripped, ticker_slug
from yearbook.sources.schemas import DIM_COMPANIES

# Defaults of the dimension.
CURRENCY = "JPY"
DEFAULT_STATUS = "direct"
DEFAULT_LISTING = "listed"
COMPARISON_VERSION = "1.0"


def company_entries(documents: DataFrame, text: str = "value") -> DataFrame:
    """``(company_order, ticker, meta VARIANT)`` from one JSON object per row.

    The order of the keys is data, and a VARIANT sorts its keys, so the object is
    first read as a map.
    """
    members = F.from_json(F.col(text), "map<string,string>")
    return documents.select(F.posexplode(members).alias("company_order", "ticker", "member")).select(
        "company_order", "ticker", F.try_parse_json("member").alias("meta")
    )


def scan_companies(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a dimension file: ticker to attributes, in file order."""
    return company_entries(spark.read.option("wholetext", True).text(path))


def build_companies(entries: DataFrame) -> DataFrame:
    """Typed company rows with defaults; one row per (checked) entry. A number that the
    dimension can't hold fails the job, as the rules let none through."""
    meta = F.col("meta")
    stored = StructType.fromDDL(DIM_COMPANIES)

    def number(name: str):
        return F.variant_get(meta, f"$.{name}", stored[name].dataType.simpleString()).alias(name)

    def text(name: str):
        return F.try_variant_get(meta, f"$.{name}", "string")

    name = stripped(text("name"))
    targets = F.try_variant_get(meta, "$.targets", "array<string>")
    return entries.select(
        "company_order",
        "ticker",
        name.alias("name"),
        text("edinet_code").alias("edinet_code"),
        F.lit(CURRENCY).alias("currency"),
        F.coalesce(text("status"), F.lit(DEFAULT_STATUS)).alias("status"),
        F.coalesce(text("tier"), F.lit("")).alias("tier"),
        F.coalesce(text("listing_status"), F.lit(DEFAULT_LISTING)).alias("listing_status"),
        number("avg_salary_man"),
        number("avg_salary_fiscal_year"),
        ticker_slug(F.col("ticker")).alias("slug"),
        split_targets(targets, name).alias("targets"),
        F.coalesce(text("note"), F.lit("")).alias("note"),
        (V.as_text(V.field(meta, "$.status")) == "direct").alias("direct_stated"),
    )


def split_targets(targets, name):
    """The listed targets, or the company itself when none is listed."""
    return F.when(F.coalesce(F.size(targets), F.lit(0)) > 0, targets).otherwise(F.array(name))


def build_dimension(companies: DataFrame) -> DataFrame:
    """The stored dimension table."""
    return companies.select(
        "company_order",
        "ticker",
        "name",
        "edinet_code",
        "currency",
        "status",
        "tier",
        "listing_status",
        "avg_salary_man",
        "avg_salary_fiscal_year",
    )


def filter_direct(companies: DataFrame, *, stated: bool = False) -> DataFrame:
    """Direct companies; ``stated`` leaves out those that are direct by default only."""
    if stated:
        return companies.filter(F.coalesce(F.col("direct_stated"), F.lit(False)))
    return companies.filter(F.col("status") == "direct")


def scan_fallback(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """Entries of the first candidate file that is readable, not blank and JSON."""
    for path in candidates:
        try:
            documents = spark.read.option("wholetext", True).text(path)
            usable = documents.filter(F.try_parse_json("value").isNotNull())
            if not usable.isEmpty():
                return company_entries(usable)
        except AnalysisException:
            continue
    empty = spark.createDataFrame([], "value string")
    return company_entries(empty)


def scan_comparisons(spark: SparkSession, path: str) -> DataFrame:
    """Configured pairs ``(pair_order, id, left, right)``.

    Gate: the file is an object with the known version and a list of objects.
    Members that are not strings become null for ``check_comparisons`` to report.
    """
    documents = spark.read.option("wholetext", True).text(path)
    payload = documents.select(F.try_parse_json("value").alias("payload"))
    version, pairs = V.field(F.col("payload"), "$.schema_version"), V.field(F.col("payload"), "$.pairs")
    listed = F.try_variant_get(F.col("payload"), "$.pairs", "array<variant>")
    good = (
        (V.as_text(version) == COMPARISON_VERSION)
        & V.is_array(pairs)
        & F.forall(listed, V.is_object)
    )
    if payload.filter(F.coalesce(good, F.lit(False))).isEmpty():
        raise YearbookError(f"{path} needs schema_version {COMPARISON_VERSION} and a list of pairs")
    return payload.select(F.posexplode(listed).alias("pair_order", "pair")).select(
        "pair_order",
        *[V.as_text(V.field(F.col("pair"), f"$.{name}")).alias(name) for name in ("id", "left", "right")],
    )
