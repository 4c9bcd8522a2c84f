"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import contextlib
import functools
import os
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from yearbook.errors import YearbookError

# Settings that change results or plans. All are runtime settings, so they can be
# applied to a session that somebody else started.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # The last of two equal JSON keys wins, as in most JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # A join key that holds a large share of the rows is split over several tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "yearbook") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("YEARBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a session that runs on
    one machine may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _scratch()


@functools.cache
def _scratch() -> str:
    """One folder per process, gone with it."""
    folder = tempfile.mkdtemp(prefix="yearbook-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with that text, unless it is there. Of several callers at once
    exactly one is told that it did.

    Stores create a file that must not exist in one step. A local file system looks first
    and creates then, so there the file is written under another name and linked.
    """
    files, target = _file_system(spark, path)
    body = bytearray(text, "utf-8")
    try:
        if files.makeQualified(target).toUri().getScheme() != "file":
            out = files.create(target, False)
            out.write(body)
            out.close()
            return True
        nio = spark._jvm.java.nio.file
        place = nio.Paths.get(files.makeQualified(target).toUri())
        nio.Files.createDirectories(place.getParent(), spark._sc._gateway.new_array(nio.attribute.FileAttribute, 0))
        draft = place.resolveSibling(f".{uuid.uuid4().hex}")
        nio.Files.write(draft, body, spark._sc._gateway.new_array(nio.OpenOption, 0))
        try:
            nio.Files.createLink(place, draft)
        finally:
            nio.Files.deleteIfExists(draft)
    except Py4JJavaError as failed:
        if "AlreadyExists" in failed.java_exception.getClass().getSimpleName():
            return False
        raise
    return True


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    files, target = _file_system(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextlib.contextmanager
def exclusive(spark: SparkSession, path: str, wait: float = 60.0) -> Iterator[None]:
    """Hold the file ``path`` as a lock; wait for another holder at most ``wait`` seconds.

    A writer that dies leaves its lock. The error says whose it is, and to delete the file if that
    one is gone: nothing here guesses.
    """
    owner = f"{spark.sparkContext.applicationId} {uuid.uuid4().hex}"
    until = time.monotonic() + wait
    while not create_exclusively(spark, path, owner):
        if time.monotonic() > until:
            raise YearbookError(f"{path} is held by {read_small(spark, path)}; delete it if that writer is gone")
        time.sleep(0.1)
    try:
        yield
    finally:
        files, target = _file_system(spark, path)
        files.delete(target, False)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_names(spark: SparkSession, path: str) -> set[str]:
    """Names in a folder; those with a leading underscore or dot are Spark's or private."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return {name for name in (s.getPath().getName() for s in listed) if name[0] not in "_."}


def temporary(spark: SparkSession, path: str) -> str:
    """Have a folder deleted when the application ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For an intermediate result that several later steps use: they read the table
    instead of computing it again, also after an executor is lost. The table goes with
    the application.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/yearbook-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(temporary(spark, path))
