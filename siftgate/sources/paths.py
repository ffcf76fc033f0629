"""File paths as Spark takes and gives them."""

from __future__ import annotations

import codecs
import re
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import Column
from pyspark.sql import functions as F

# File systems that Python can open itself, by URI scheme.
OPENABLE = {"file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss"}


# Charset names Spark takes, by the names Python gives the same encodings.
CHARSETS = {"iso8859-1": "iso-8859-1", "ascii": "us-ascii", "utf-8-sig": "utf-8"}


def charset(encoding: str) -> str:
    """Spark's name of a Python encoding."""
    name = codecs.lookup(encoding).name
    return CHARSETS.get(name, name)


def can_open(paths: Sequence[str]) -> bool:
    return all(p.split(":", 1)[0] in OPENABLE for p in paths)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a full path, and the path as that file system names it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def literal_paths(paths: Sequence[str]) -> list[str]:
    """Paths for a reader, with the characters escaped that would be read as a glob."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def _decoded(encoded: Column) -> Column:
    """Metadata columns are URL-encoded; few names have a character that shows it."""
    plain = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(encoded, F.lit("%")), plain).otherwise(encoded)


def scanned_path() -> Column:
    return _decoded(F.col("_metadata.file_path"))


def scanned_name() -> Column:
    return _decoded(F.col("_metadata.file_name"))


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)
