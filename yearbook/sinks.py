"""Writers. Each writes distributed output; nothing passes through the driver.

Documents that would grow with the data (one array of all companies, one ranking
of all entities) are written as JSON lines, one object per company or row, with a
one-row header beside them.
"""

from __future__ import annotations

import functools
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StructType, TimestampType

from yearbook.errors import YearbookError
from yearbook.functions.text import iso_utc
from yearbook.session import create_exclusively, exclusive, folder_names, path_exists, stored
from yearbook.sources.schemas import RAW_LANDING

# Versions written into documents.
SCHEMA_VERSION = "1.0"
PIPELINE_VERSION = "1.0"


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Columns, order and types of a declared schema; a lossy cast fails."""
    return df.to(StructType.fromDDL(schema))


def write_table(df: DataFrame, path: str, schema: str) -> None:
    """A stored table: declared schema, Parquet, zstd. Never overwrites."""
    conform(df, schema).write.mode("errorifexists").option("compression", "zstd").parquet(path)


def write_mart(df: DataFrame, path: str, schema: str, order: Sequence[str]) -> None:
    """A table in global order: a range shuffle, then a sort inside each file."""
    ordered = conform(df, schema).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def write_json_lines(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One JSON object per row, with nulls written out. NaN and infinity are refused,
    at any depth."""
    writer = refuse_non_finite(df).write.mode("errorifexists").option("ignoreNullFields", "false")
    writer.partitionBy(*partition_by).json(path)


def refuse_non_finite(df: DataFrame) -> DataFrame:
    """Fail the job on a NaN or infinite number, which JSON cannot hold, also inside
    structs, arrays and maps."""

    def bad(value: Column, kind: DataType) -> Column | None:
        if isinstance(kind, (DoubleType, FloatType)):
            return F.coalesce(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(False))
        if isinstance(kind, StructType):
            parts = [p for f in kind.fields if (p := bad(value[f.name], f.dataType)) is not None]
            return functools.reduce(Column.__or__, parts) if parts else None
        if isinstance(kind, ArrayType):
            if bad(F.lit(None), kind.elementType) is None:
                return None
            return F.coalesce(F.exists(value, lambda x: bad(x, kind.elementType)), F.lit(False))
        if isinstance(kind, MapType):
            return bad(F.map_values(value), ArrayType(kind.valueType))
        return None

    found = {f.name: bad(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields}
    checked = {
        name: F.when(wrong, F.raise_error(F.lit(f"{name} is not finite")).cast(df.schema[name].dataType)).otherwise(F.col(f"`{name}`"))
        for name, wrong in found.items()
        if wrong is not None
    }
    return df.withColumns(checked)


def header(df: DataFrame, fetched_at: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: schema version, newest fetch time, and further aggregates."""
    return df.agg(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        iso_utc(F.max(fetched_at)).alias("generated_at"),
        *[column.alias(name) for name, column in (extra or {}).items()],
    )


def export_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header; null becomes an empty field."""
    df.write.mode("errorifexists").csv(path, sep="\t", header=True, nullValue="", emptyValue="")


def land_raw(new: DataFrame, path: str, wait: float = 60.0) -> None:
    """Append raw bodies ``(slug, kind, fetched_at, body)``, never over an existing key.

    Gates: fetch times carry a zone; no key is repeated or already landed. The rows are
    stored first, so those that are checked are those that are written. Check and append
    are done under the lock ``_lock`` of the table, so of two writers of one key the second
    finds it landed. One lock for all keys, as two of Spark's appends to a folder at once
    can remove each other's files; a writer waits for it at most ``wait`` seconds.
    """
    if not isinstance(new.schema["fetched_at"].dataType, TimestampType):
        raise YearbookError("fetched_at needs a time zone")
    spark = new.sparkSession
    keys = ["slug", "kind", "fetched_at"]
    named = stored(new.withColumn("fetched_at", F.date_trunc("second", "fetched_at")))
    twice = named.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise YearbookError("a key occurs twice in one landing")
    with exclusive(spark, f"{path}/_lock", wait):
        landed = spark.read.schema(RAW_LANDING).parquet(path)
        clash = named.join(landed.select(*keys), keys, "left_semi").select("slug", "kind", "fetched_at")
        if found := clash.limit(1).collect():
            raise YearbookError(f"already landed, not overwritten: {found[0].asDict()}")
        conform(named, RAW_LANDING).write.mode("append").option("compression", "zstd").parquet(path)


def check_complete(
    spark: SparkSession,
    folder: str,
    expected: Mapping[str, str],
    counts: Mapping[str, int],
    documents: Collection[str] = (),
) -> None:
    """Gate: the folder holds the expected tables and documents and nothing else, and
    every table is readable with its schema and row count."""
    names = folder_names(spark, folder)
    if names != {*expected, *documents}:
        raise YearbookError(f"missing {sorted({*expected, *documents} - names)}, unexpected {sorted(names - {*expected, *documents})}")
    for table, schema in expected.items():
        stored = spark.read.parquet(f"{folder}/{table}")
        wanted = StructType.fromDDL(schema)
        if [(f.name, f.dataType) for f in stored.schema] != [(f.name, f.dataType) for f in wanted]:
            raise YearbookError(f"{table} has a different schema")
        rows = stored.count()
        if rows != counts[table]:
            raise YearbookError(f"{table} has {rows} rows, expected {counts[table]}")


def publish_staged(spark: SparkSession, base: str, build_id: str, after: int | None = None) -> int:
    """Make a finished build the one readers see; returns its number.

    A build is staged under ``v=<build id>``. Publishing creates one file, named by the
    next number and holding the build's id, that must not be there yet. So readers see all of a
    build or none of it, and of two builds at once each gets a number of its own; the higher
    one is read. With ``after`` only the number that follows it will do: the build fails if
    another one was published since that was the newest.
    """
    while True:
        number = (published_number(spark, base) if after is None else after) + 1
        if create_exclusively(spark, f"{base}/_published/{number:012d}", build_id):
            return number
        if after is not None:
            raise YearbookError(f"another build was published after number {after}")


def published_number(spark: SparkSession, base: str) -> int:
    """The number of the newest published build, 0 if there is none."""
    log = f"{base}/_published"
    return max((int(n) for n in folder_names(spark, log) if n.isdigit()), default=0) if path_exists(spark, log) else 0
