"""Raw snapshot files to the history tables, as they arrive.

Each micro-batch goes through the same decoding, rules, conflict check and reshaping as
the full build. Broken snapshots go to the quarantine. Files of companies that the
dimension does not hold wait in ``pending`` and are looked at again with every later batch,
and whenever the stream is started with a dimension that holds them. The mart is then built
from the history by ``plans.warehouse.build_mart`` whenever it is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from yearbook import sinks
from yearbook.operators import quality as Q
from yearbook.plans import warehouse as W
from yearbook.plans.snapshots import usable_snapshots, violations
from yearbook.session import configure, folder_names, path_exists
from yearbook.sources import schemas
from yearbook.sources.snapshots import NAME_GLOB, decode_snapshot, identify, unknown_files

# Batches that take in waiting files alone are numbered from here: a thousand after each
# batch of the stream.
RETRY, RETRIES = 10**9, 1000

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


# What waits: a file of the stream.
WAITING = "raw_file string, file_name string, content binary"


def read_raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New snapshot files under ``folder``: ``(raw_file, file_name, content)``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", NAME_GLOB)
        .load(folder)
    )
    return files.select(
        F.col("path").alias("raw_file"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "content",
    )


def write_batch(files: DataFrame, batch_id: int, companies: DataFrame, base: str) -> None:
    """One micro-batch into its own folders; a repeated batch overwrites only itself.

    Conflicts are looked for inside a batch; between batches the newest snapshot wins.
    """
    waiting = _waiting(files.sparkSession, batch_id - 1, base)
    _write(files if waiting is None else files.unionByName(waiting), batch_id, companies, base)


def _retries(spark: SparkSession, last: int, base: str) -> list[int]:
    """The numbers of batches of waiting files after batch ``last`` of the stream."""
    first = RETRY + (last + 1) * RETRIES
    return sorted(n for n in _batches(spark, base) if first <= n < first + RETRIES)


def _batches(spark: SparkSession, base: str) -> list[int]:
    folder = f"{base}/pending"
    return [int(n.removeprefix("batch=")) for n in folder_names(spark, folder)] if path_exists(spark, folder) else []


def _waiting(spark: SparkSession, last: int, base: str) -> DataFrame | None:
    """The files that wait after batch ``last`` of the stream."""
    number = (_retries(spark, last, base) or [last])[-1]
    path = f"{base}/pending/batch={number}"
    return spark.read.schema(WAITING).parquet(path) if path_exists(spark, path) else None


def retry_waiting(spark: SparkSession, companies: DataFrame, base: str) -> None:
    """Take in waiting files whose company the dimension holds by now.

    They are a batch of their own, named after the last one of the stream. What still waits
    is written last, so a batch that was broken off is done again under its name.
    """
    last = max((n for n in _batches(spark, base) if n < RETRY), default=None)
    files = None if last is None else _waiting(spark, last, base)
    if files is not None and not identify(files, companies).isEmpty():
        _write(files, RETRY + (last + 1) * RETRIES + len(_retries(spark, last, base)), companies, base)


def _write(files: DataFrame, batch_id: int, companies: DataFrame, base: str) -> None:
    spark = files.sparkSession
    checked_path = f"{base}/checked/batch={batch_id}"
    checked = Q.check_snapshots(decode_snapshot(identify(files, companies)))
    checked.write.mode("overwrite").parquet(checked_path)
    stored = spark.read.parquet(checked_path)
    periods = W.normalize_fields(usable_snapshots(stored))
    for name, rows, schema in (
        ("financial_history", W.build_history(periods), schemas.FINANCIAL_HISTORY),
        ("source_documents_history", W.build_sources(periods), schemas.SOURCE_DOCUMENTS_HISTORY),
    ):
        sinks.conform(rows, schema).write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")
    violations(stored).write.mode("overwrite").parquet(f"{base}/quarantine/batch={batch_id}")
    unknown_files(files, companies).write.mode("overwrite").parquet(f"{base}/pending/batch={batch_id}")


def ingest(spark: SparkSession, folder: str, companies: DataFrame, base: str) -> StreamingQuery:
    """Start a query that takes in all files present and stops.

    Files already taken in are remembered by the stream's checkpoint, so a later
    run reads only new ones. ``companies`` is a stored, checked dimension.
    """
    configure(spark)
    retry_waiting(spark, companies, base)
    return (
        read_raw_stream(spark, folder)
        .writeStream.option("checkpointLocation", f"{base}/_stream")
        .trigger(availableNow=True)
        .foreachBatch(lambda files, batch_id: write_batch(files, batch_id, companies, base))
        .start()
    )
