"""Stored tables of a published build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yearbook.errors import YearbookError
from yearbook.session import folder_names, path_exists, read_small
from yearbook.sources.schemas import VIEWS, WAREHOUSE


def published_path(spark: SparkSession, base: str) -> str:
    """Folder of the newest published build. One listing and one small file are read."""
    log = f"{base}/_published"
    names = folder_names(spark, log) if path_exists(spark, log) else set()
    for name in sorted((n for n in names if n.isdigit()), key=int, reverse=True):
        if build_id := read_small(spark, f"{log}/{name}"):  # empty: its writer hasn't closed it
            return f"{base}/v={build_id}"
    raise YearbookError(f"nothing is published under {base}")


def scan_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(WAREHOUSE[table]).parquet(f"{folder}/{table}")


def scan_warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: scan_table(spark, folder, table) for table in WAREHOUSE}


def scan_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart in (company, period) order."""
    return scan_table(spark, folder, "company_year_metrics").orderBy("company_order", "fiscal_year")


def register_views(spark: SparkSession, folder: str) -> None:
    """Temporary views over the stored tables, for SQL."""
    for view, table in VIEWS.items():
        scan_table(spark, folder, table).createOrReplaceTempView(view)
