"""Session helpers: where a job may put scratch data, and Hadoop file-system calls."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession

# The largest side this library will ask Spark to broadcast by itself, in rows of
# (file name, block, offset) or (file name, run id) metadata: about 100 bytes each.
BROADCAST_ROWS = 100_000


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Runs wide projections in a form the JVM can optimise.

    The JVM does not compile methods beyond 8000 bytes of code, and a record with many checked
    fields becomes one such method. With this limit Spark splits the projection instead.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def steady_splits(spark: SparkSession) -> Iterator[None]:
    """Cuts the same files into the same splits in every scan, however many executors there are by then."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    if before is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a fresh local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="siftgate-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/siftgate/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as listings give it."""
    jpath, fs = _hadoop(spark, path)
    return str(fs.makeQualified(jpath))


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return fs.exists(jpath)


def is_directory(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    jpath, fs = _hadoop(spark, pattern)
    return [str(s.getPath()) for s in (fs.globStatus(jpath) or [])]


def glob_files(spark: SparkSession, pattern: str) -> list[tuple[str, int, datetime]]:
    """Path, size and time of the files a pattern names."""
    jpath, fs = _hadoop(spark, pattern)
    return [
        (str(s.getPath()), s.getLen(), datetime.fromtimestamp(s.getModificationTime() / 1000, timezone.utc))
        for s in (fs.globStatus(jpath) or [])
        if s.isFile()
    ]


def escaped(path: str) -> str:
    """A path as a pattern that names just it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def make_directory(spark: SparkSession, path: str) -> None:
    jpath, fs = _hadoop(spark, path)
    fs.mkdirs(jpath)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    jpath, fs = _hadoop(spark, path)
    if not fs.rename(jpath, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"Could not move {path} to {to}")


def remove_path(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return fs.delete(jpath, True)
