"""CSV scan: every record of many files, with its place in the file."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.operators.rows import BLOCK, SEQUENCE
from siftgate.sources.headers import field_positions
from siftgate.sources.paths import charset, literal_paths, scanned_name
from siftgate.sources.records import LF, can_split, drop_headers, split_records
from siftgate.spec import SourceSpec

# Bytes of a file that one task reads, where quoted cells may hold line breaks.
WHOLE_BYTES = 16 * 1024 * 1024

CORRUPT = "corrupt_record"
SHAPE = "shape_error"


def _cell_count(record: Column, delimiter: str) -> Column:
    """Cells of a record, from its text: quoted cells are emptied, then delimiters counted.

    Doubled quotes go first. They stand inside quoted cells, or are empty ones, and without them a quoted
    cell reaches to the next quote; a pattern that repeats a group would recurse once per character.
    """
    mark = re.escape(delimiter)
    single = F.replace(record, F.lit('""'), F.lit(""))
    bare = F.regexp_replace(single, f'(^|{mark})"[^"]*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def _column_names(header: Sequence[str]) -> list[str]:
    """The header's own names, so that Spark finds them confirmed; numbers where they would not do."""
    taken = {CORRUPT, SHAPE, BLOCK, SEQUENCE, "source_filename", "cell_count", "_metadata"}
    lower = [h.lower() for h in header]
    usable = len(set(lower)) == len(lower) and not taken & set(lower) and all(h.strip() and "`" not in h for h in header)
    return list(header) if usable else [f"c{i}" for i in range(len(header))]


def read_csv(
    spark: SparkSession,
    paths: Sequence[str],
    source: SourceSpec,
    header: Sequence[str],
    newline: str = LF,
    sizes: Mapping[str, int] | None = None,
    whole_bytes: int | None = None,
) -> DataFrame:
    """Files that share one header, as text fields plus file, split, sequence, shape.

    Empty cells are empty text; cells a short record does not have are null; a record with
    too many cells is marked. Columns that no field uses are dropped here. Where quoted cells may hold line
    breaks, files of more than ``whole_bytes`` are read by several tasks; others, and those that cannot be split,
    by one task each. Both ways give the same rows in the same order.
    """
    paths = list(paths)
    large: list[str] = []
    if source.multiline:
        fit = [p for p in paths if can_split(p, source.encoding, newline)]
        least = WHOLE_BYTES if whole_bytes is None else whole_bytes
        known = sizes if sizes is not None else _sizes(spark, fit)
        large = [p for p in fit if known.get(p, 0) > least]
    small = sorted(set(paths) - set(large))
    frames = []
    if large:
        frames.append(_split_cells(spark, large, source, header, newline))
    if small:
        frames.append(_scanned_cells(spark, small, source, header))
    return _fields(reduce(DataFrame.unionByName, frames), source, header)


def _sizes(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """Bytes of the files, by path; contents are not read."""
    if not paths:
        return {}
    listed = spark.read.format("binaryFile").load(literal_paths(paths)).select("path", "length")
    return {r.path: r.length for r in listed.collect()}  # one row per file


def _options(source: SourceSpec) -> dict[str, str]:
    return {"sep": source.delimiter, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": CORRUPT}


def _cell_schema(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*_column_names(header), CORRUPT]])


def _scanned_cells(spark: SparkSession, paths: Sequence[str], source: SourceSpec, header: Sequence[str]) -> DataFrame:
    reader = spark.read.schema(_cell_schema(header)).options(**_options(source))
    return (
        reader.option("header", True)
        .option("encoding", charset(source.encoding))
        .option("multiLine", source.multiline)
        # with pruning on, a record of the wrong width would pass unseen
        .option("columnPruning", False)
        .csv(literal_paths(paths))
        .select(
            "*",
            scanned_name().alias("source_filename"),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(SEQUENCE),
        )
    )


def _split_cells(spark: SparkSession, paths: Sequence[str], source: SourceSpec, header: Sequence[str], newline: str) -> DataFrame:
    records = drop_headers(split_records(spark, paths, source.delimiter, source.encoding, newline))
    cells = F.from_csv("record", _cell_schema(header).toDDL(), _options(source))
    return records.select(cells.alias("cells"), "source_filename", BLOCK, SEQUENCE).select("cells.*", "source_filename", BLOCK, SEQUENCE)


def _fields(records: DataFrame, source: SourceSpec, header: Sequence[str]) -> DataFrame:
    names = _column_names(header)
    count = F.when(F.col(CORRUPT).isNotNull(), _cell_count(F.col(CORRUPT), source.delimiter))
    counted = records.withColumn("cell_count", count)
    cells = [
        f"CASE WHEN cell_count IS NULL OR cell_count > {position} THEN coalesce(`{names[position]}`, '') END AS `{spec.name}`"
        for spec, position in zip(source.fields, field_positions(header, source))
    ]
    too_many = f"CASE WHEN cell_count > {len(header)} THEN 'too_many_columns' END AS {SHAPE}"
    return counted.selectExpr("source_filename", BLOCK, SEQUENCE, too_many, *cells)
