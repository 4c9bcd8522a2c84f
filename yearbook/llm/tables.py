"""Intermediate tables and bounded filters in the folder that the cluster shares."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearbook.session import checkpoint_dir, temporary


#: Parts that a key of a join is dealt to.
SALTS = 64
#: Bytes of one batch between Spark and Python workers.
BATCH_BYTES = "8m"


def bounded(spark: SparkSession) -> SparkSession:
    """The session with small Arrow batches: texts may be long, and a batch is held on
    both sides. For queries and pipelines; operators take the session as it is."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """``df`` written to a new shared folder and read back, and that folder, which goes
    with the application."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(temporary(df.sparkSession, path)), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written`` made and nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables that are stored for a while and dropped together."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        df, path = written(df, name, codec)
        self.paths.append(path)
        return df

    def drop(self) -> None:
        for path in self.paths:
            drop(self.spark, path)
        self.paths = []
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed. Spark's cleaner does that when the
    driver collects garbage, which it asks for by itself every half hour only."""
    gc.collect()
    spark._jvm.System.gc()


def kept(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` stored until the application ends."""
    return written(df, name, codec)[0]


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], salt: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each key.

    The keys that occur are first joined with the table, once for each of ``SALTS`` parts of
    a key's rows; rows then meet their part. So no key's rows are all in one task.
    """
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)))
    parts = dealt.select(*keys, "salt").distinct().join(table, list(keys))
    return dealt.join(parts, [*keys, "salt"]).drop("salt")


def bit_filter(keys: DataFrame, column: str, bits: int = 1 << 25) -> np.ndarray:
    """Which places of a table of ``bits`` the hashes in ``column`` (bigint) take.

    The table is put together by an aggregation and has at most ``bits / 64`` rows, so
    what reaches the driver is bounded however many keys there are; with more keys it
    lets more through, never less.
    """
    place = F.pmod(F.col(column), F.lit(bits))
    words = keys.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64L) as int))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(bits // 64, np.uint64)
    table[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def passes_filter(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit hashes may be among the keys."""
    place = hashes.view(np.int64) % (len(table) * 64)
    return (table[place >> 6] >> (hashes.view(np.int64) % 64).astype(np.uint64)) & np.uint64(1) == 1
