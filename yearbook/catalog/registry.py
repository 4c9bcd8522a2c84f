"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from yearbook.catalog import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name, with plain result types."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return T.plain(function(spark, sf))

    QUERIES[function.__name__] = run
    return function
