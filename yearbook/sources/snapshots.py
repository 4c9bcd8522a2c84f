"""Raw snapshots: files named ``{slug}__financials__{yyyyMMdd'T'HHmmss'Z'}.json``."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook.errors import YearbookError
from yearbook.functions import variants as V
from yearbook.functions.text import ticker_slug, utc_stamp
from yearbook.operators.quality import data_rows
from yearbook.session import checkpoint_dir, temporary
from yearbook.sources.schemas import RAW_LANDING

# Files named to one read of Spark; the driver holds the names of one read at a time.
PATHS_PER_READ = 5000

# The file naming rule.
NAME_GLOB = "*__financials__*.json"
NAME_PATTERN = r"^([a-z0-9_]+)__financials__(\d{8}T\d{6}Z)\.json$"
TIME_FORMAT = "yyyyMMdd'T'HHmmssX"


def parse_slug(file_name: Column) -> Column:
    """The slug in a file name; null if the name does not fit the rule."""
    return F.nullif(F.regexp_extract(file_name, NAME_PATTERN, 1), F.lit(""))


def parse_fetched_at(file_name: Column) -> Column:
    """The UTC fetch time in a file name, read with its zone; null for a wrong name or
    impossible date."""
    stamp = F.nullif(F.regexp_extract(file_name, NAME_PATTERN, 2), F.lit(""))
    return F.try_to_timestamp(stamp, F.lit(TIME_FORMAT))


def snapshot_fingerprint(content: Column) -> Column:
    return F.sha2(content, 256)


def _files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", NAME_GLOB)
        .load([paths] if isinstance(paths, str) else list(paths))
    )
    return found.select(
        F.col("_metadata.file_path").alias("raw_file"),
        F.col("_metadata.file_name").alias("file_name"),
        "content",
    )


def _named(files: DataFrame) -> DataFrame:
    name = F.col("file_name")
    return files.withColumns({"slug": parse_slug(name), "fetched_at": parse_fetched_at(name)})


def _identities(companies: DataFrame) -> DataFrame:
    """Slug to identity of the companies that have their own filings."""
    direct = companies.filter(F.col("status") == "direct")
    return direct.select("company_order", "ticker", "edinet_code", ticker_slug(F.col("ticker")).alias("slug"))


def identify(files: DataFrame, companies: DataFrame) -> DataFrame:
    """Files of known direct companies, with identity, fetch time and hash.

    Names that miss the rule and unknown slugs are ignored. An impossible date
    stays in, with a null ``fetched_at``, for the quality rules to report.
    """
    return (
        _named(files)
        .filter(F.col("slug").isNotNull())
        .join(_identities(companies), "slug")
        .withColumn("sha256", snapshot_fingerprint(F.col("content")))
    )


def unknown_files(files: DataFrame, companies: DataFrame) -> DataFrame:
    """Files that fit the naming rule but belong to no known direct company (yet)."""
    named = _named(files).filter(F.col("slug").isNotNull())
    return named.join(_identities(companies), "slug", "left_anti").select(*files.columns)


def scan_snapshots(spark: SparkSession, paths: str | Sequence[str], companies: DataFrame) -> DataFrame:
    """All snapshots of known direct companies."""
    return identify(_files(spark, paths), companies)


def newest_files(spark: SparkSession, paths: str | Sequence[str], companies: DataFrame) -> DataFrame:
    """``(slug, path)``: the newest snapshot file of each known direct company, by name.

    Wrong names and dates are skipped. Only the listing is read; files without their content
    are not opened. The maxima are over times, so they hash; of files with one slug and
    time the last path is taken.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", NAME_GLOB).load([paths] if isinstance(paths, str) else list(paths))
    names = _named(listed.select("path", F.col("_metadata.file_name").alias("file_name"))).filter(F.col("fetched_at").isNotNull())
    known = names.join(_identities(companies).select("slug"), "slug", "left_semi").select("slug", "fetched_at", "path")
    newest = known.groupBy("slug").agg(F.max("fetched_at").alias("fetched_at"))
    return known.join(newest, ["slug", "fetched_at"], "left_semi").groupBy("slug").agg(F.max("path").alias("path"))


def _batches(paths: Iterator[str], size: int) -> Iterator[list[str]]:
    while batch := list(itertools.islice(paths, size)):
        yield batch


def scan_latest_snapshots(spark: SparkSession, paths: str | Sequence[str], companies: DataFrame, paths_per_read: int = PATHS_PER_READ) -> DataFrame:
    """The newest snapshot file of each known direct company, chosen by name before any body
    is read.

    The chosen files are read ``paths_per_read`` at a time into a stored table, so the bytes read
    follow the number of companies, not of snapshots, and the driver holds one read's names.
    """
    folder = f"{checkpoint_dir(spark)}/yearbook-newest-{uuid.uuid4().hex}"
    chosen = (row.path for row in newest_files(spark, paths, companies).select("path").toLocalIterator())
    schema = "raw_file string, file_name string, content binary"
    spark.createDataFrame([], schema).write.parquet(temporary(spark, folder))
    for batch in _batches(chosen, paths_per_read):
        plain = [re.sub(r"([\\\[\]{}*?,])", r"\\\1", path) for path in batch]  # a path, not a pattern
        _files(spark, plain).write.mode("append").parquet(folder)
    return identify(spark.read.schema(schema).parquet(folder), companies)


def scan_explicit_inputs(spark: SparkSession, paths: Sequence[str], companies: DataFrame) -> DataFrame:
    """Snapshots from a list of files; gate: every name known, no company twice."""
    named = _named(_files(spark, paths))
    listed = named.select("file_name", "slug")
    slugs = companies.select(ticker_slug(F.col("ticker")).alias("slug"))
    unknown = listed.join(slugs, "slug", "left_anti").limit(1).collect()
    if unknown or named.isEmpty():
        raise YearbookError(f"no company for input {unknown[0].file_name if unknown else list(paths)}")
    twice = listed.groupBy("slug").agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise YearbookError(f"several inputs for {twice[0].slug}")
    return scan_snapshots(spark, paths, companies)


def scan_landed(spark: SparkSession, path: str, companies: DataFrame) -> DataFrame:
    """Snapshots from the landing table: the same columns as ``scan_snapshots``.

    A landing table holds many small bodies in few large files, which is how raw
    data should be kept at scale.
    """
    landed = spark.read.schema(RAW_LANDING).parquet(path).filter(F.col("kind") == "financials")
    name = F.concat(
        "slug", F.lit("__financials__"), utc_stamp(F.col("fetched_at")), F.lit(".json")
    )
    return landed.select(
        "slug",
        F.concat(F.lit(path.rstrip("/") + "/"), name).alias("raw_file"),
        name.alias("file_name"),
        F.col("body").alias("content"),
        "fetched_at",
    ).join(_identities(companies), "slug").withColumn("sha256", snapshot_fingerprint(F.col("content")))


def decode_snapshot(snapshots: DataFrame, content: str = "content") -> DataFrame:
    """Replace the bytes by a VARIANT ``payload``; null if they are not UTF-8 JSON."""
    return snapshots.withColumn("payload", V.decode_json(F.col(content))).drop(content)


def explode_periods(decoded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per period: ``(*keys, position, row VARIANT)``, in file order."""
    # The outer form, because Spark copies the input of the plain one into a filter,
    # which would parse the JSON again.
    rows = F.posexplode_outer(data_rows(F.col("payload"))).alias("position", "row")
    return decoded.select(*keys, rows).filter(F.col("position").isNotNull())
