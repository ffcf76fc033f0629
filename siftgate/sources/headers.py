"""Header rows: reading the first record of many files, and checking it."""

from __future__ import annotations

import csv
import io
import itertools
import logging
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.functions import messages
from siftgate.sources.paths import can_open, file_name, file_system
from siftgate.sources.records import HEADERS, first_records, newline_of
from siftgate.spec import SourceSpec

log = logging.getLogger(__name__)

SCHEMA = "path string, header array<string>"


def open_text(path: str, encoding: str) -> io.TextIOWrapper:
    """A file of any openable scheme as text, read in small pieces; gzip by its ending."""
    filesystem, name = file_system(path)
    compression = "gzip" if name.lower().endswith(".gz") else None
    stream = filesystem.open_input_stream(name, compression=compression, buffer_size=1 << 16)
    return io.TextIOWrapper(stream, encoding=encoding, newline="")


def read_heads(spark: SparkSession, paths: Sequence[str], read: Callable[[str], tuple], schema: str) -> DataFrame:
    """``read(path)`` for every file, by the executors."""
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def read_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(p, *read(p)) for p in batch["path"]], columns=names)

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    parts = max(1, min(len(paths), spark.sparkContext.defaultParallelism * 8))
    return listed.repartition(parts, "path").mapInPandas(read_all, schema)


def csv_headers(spark: SparkSession, paths: Sequence[str], source: SourceSpec) -> DataFrame:
    """``path, header, newline`` per file, from its first record, however many lines that has.

    Executors open each file and read that record only. Where Python cannot open the files (another
    scheme, or credentials that only Spark has), a scan of their lines gives the same.
    """
    delimiter, encoding = source.delimiter, source.encoding

    def first_record(path: str) -> tuple[list[str], str]:
        with open_text(path, encoding) as text:
            first = next(text, "")  # up to any line break
            kind = newline_of(first if first.endswith("\n") else first + " " * first.endswith("\r"))
            return next(csv.reader(itertools.chain([first], text), delimiter=delimiter), []), kind

    if can_open(paths):
        try:
            found = read_heads(spark, paths, first_record, HEADERS).collect()  # one row per file
            return spark.createDataFrame(found, HEADERS)
        except Exception:
            log.warning("Headers of %d files are read by a scan", len(paths), exc_info=True)
    return first_records(spark, paths, delimiter, encoding)


def blank_header(header: Column) -> Column:
    """No header cell holds anything but white space."""
    return ~F.exists(header, lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")


def generated_header(header: Column) -> Column:
    """Spreadsheet headers that are empty or only running numbers."""
    return F.forall(header, lambda c: F.trim(F.coalesce(c, F.lit(""))).rlike("^(-*[0-9]+)?$"))


def missing_columns(header: Column, source: SourceSpec) -> Column:
    """Declared columns, lower-case and sorted, that the header lacks."""
    expected = F.array(*[F.lit(c.lower()) for c in source.file_columns])
    return F.array_sort(F.array_except(expected, F.transform(header, lambda c: F.lower(c))))


def check_headers(headers: DataFrame, source: SourceSpec, spreadsheet: bool = False) -> DataFrame:
    """Adds ``error_type`` and ``error_message``; both null for a usable header."""
    name = file_name("path")
    suffix = F.upper(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    empty = F.coalesce(F.size("header"), F.lit(0)) <= 0
    blank = generated_header(F.col("header")) if spreadsheet else blank_header(F.col("header"))
    missing = missing_columns(F.col("header"), source)
    required = ", ".join(sorted({c.lower() for c in source.file_columns}))
    lacking = F.format_string(
        messages.LACKING_COLUMNS, suffix, name, F.lit(required), F.array_join(missing, ", ")
    )
    kind = F.lit("Excel" if spreadsheet else "CSV")
    blank_text = messages.BLANK_SHEET_HEADER if spreadsheet else messages.BLANK_HEADER
    return headers.withColumns(
        {
            "error_type": F.when(empty | blank, messages.MISSING_HEADER).when(
                F.size(missing) > 0, messages.MISSING_COLUMNS
            ),
            "error_message": F.when(empty, F.format_string(messages.NO_HEADER, kind, "path"))
            .when(blank, F.format_string(blank_text, kind, "path"))
            .when(F.size(missing) > 0, lacking),
        }
    )


def field_positions(header: Sequence[str], source: SourceSpec) -> list[int]:
    """Position of every field in a header; of headers equal but for case the last counts."""
    last = {name.lower(): i for i, name in enumerate(header) if name is not None}
    return [last[c.lower()] for c in source.file_columns]
