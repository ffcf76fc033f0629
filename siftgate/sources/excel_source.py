"""Workbook scan: many .xlsx files, one task per group of workbooks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.functions.text import excel_serial_to_date
from siftgate.operators.rows import BLOCK, SEQUENCE
from siftgate.session import scratch_path
from siftgate.sources.csv_source import SHAPE
from siftgate.sources.headers import field_positions
from siftgate.sources.paths import file_name, literal_paths
from siftgate.spec import FieldSpec, SourceSpec

CELLS = "path string, sheet_row int, cells array<struct<text: string, kind: string>>"
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
ROWS_PER_BATCH = 5000


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _text_of(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _cell(node: ElementTree.Element, shared: list[str]) -> tuple[str, str]:
    kind, value = node.get("t", "n"), node.find(f"{MAIN}v")
    text = "" if value is None else value.text or ""
    if kind == "inlineStr":
        return _text_of(node), "string"
    if kind == "s":
        return shared[int(text)], "string"
    if kind == "b":
        return ("true" if text == "1" else "false"), "boolean"
    if kind == "n" and text:
        return text, "integer" if re.fullmatch(r"-?\d+", text) else "number"
    return text, "string"


def sheet_rows(content: bytes, sheet: str | None) -> Iterator[tuple[int, list[tuple[str, str]]]]:
    """Rows of the named sheet, or of the first one: row number and (text, kind) cells."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        links = {
            r.get("Id"): r.get("Target").lstrip("/")
            for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        }
        sheets = {
            s.get("name"): links[s.get(LINK)]
            for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        }
        if sheet is not None and sheet not in sheets:
            return
        member = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
        member = member if member.startswith("xl/") else f"xl/{member}"
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            table = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = [_text_of(item) for item in table.iter(f"{MAIN}si")]
        with book.open(member) as xml:
            number = 0
            for _, row in ElementTree.iterparse(xml):
                if row.tag != f"{MAIN}row":
                    continue
                number = int(row.get("r", number + 1))
                cells: list[tuple[str, str]] = []
                for i, node in enumerate(row.iter(f"{MAIN}c")):
                    place = _column_index(node.get("r")) if node.get("r") else i
                    cells += [("", "string")] * (place - len(cells))
                    cells.append(_cell(node, shared))
                yield number, cells
                row.clear()


def read_cells(spark: SparkSession, paths: Sequence[str], sheet: str | None) -> DataFrame:
    """All cells of one sheet per workbook, header row included."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for number, cells in sheet_rows(content, sheet):
                    rows.append((path, number, [{"text": t, "kind": k} for t, k in cells]))
                    if len(rows) == ROWS_PER_BATCH:
                        yield pd.DataFrame(rows, columns=["path", "sheet_row", "cells"])
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["path", "sheet_row", "cells"])

    books = spark.read.format("binaryFile").load(literal_paths(paths)).select("path", "content")
    return books.mapInPandas(parse, CELLS)


def stage_cells(spark: SparkSession, paths: Sequence[str], source: SourceSpec, work: str | None = None) -> DataFrame:
    """Parsed cells, written once: the header check and the scan both read them."""
    written = f"{work}/sheets" if work else scratch_path(spark, "sheets")
    read_cells(spark, paths, source.sheet).write.parquet(written)
    return spark.read.parquet(written)


def excel_headers(cells: DataFrame) -> DataFrame:
    """``path, header`` from the first row of each workbook."""
    first = cells.groupBy("path").agg(F.min_by("cells", "sheet_row").alias("cells"))
    return first.select("path", F.transform("cells", lambda c: c["text"]).alias("header"))


def _serial_as_text(cell: Column, spec: FieldSpec) -> Column:
    """Numbers in date fields are days since 1899-12-30; give them the ISO text of that day."""
    serial = cell["text"].try_cast("double")
    day = excel_serial_to_date(serial).cast("string")
    fraction = serial - F.when(serial < 0, F.ceil(serial)).otherwise(F.floor(serial))
    seconds = F.when(fraction > 0, F.floor(fraction * 86400)).otherwise(0).cast("int")
    clock = F.format_string(
        "T%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60
    )
    text = day if spec.type == "date" else F.concat(day, clock)
    return F.when(
        cell["kind"].isin("integer", "number"), F.struct(text.alias("text"), F.lit("string").alias("kind"))
    ).otherwise(cell)


def read_excel(cells: DataFrame, source: SourceSpec, header: Sequence[str]) -> DataFrame:
    """Workbooks that share one header, as typed cells; short rows are padded with empty text."""
    first = cells.groupBy("path").agg(F.min("sheet_row").alias("header_row"))
    empty = F.struct(F.lit("").alias("text"), F.lit("string").alias("kind"))
    fields = []
    for spec, position in zip(source.fields, field_positions(header, source)):
        cell = F.coalesce(F.get("cells", F.lit(position)), empty)
        if spec.type in ("date", "timestamp"):
            cell = _serial_as_text(cell, spec)
        fields.append(cell.alias(spec.name))
    rows = cells.join(first, "path").filter(F.col("sheet_row") > F.col("header_row"))
    return rows.select(
        file_name("path").alias("source_filename"),
        F.lit(0).cast("bigint").alias(BLOCK),
        (F.col("sheet_row") - F.col("header_row") - 1).cast("bigint").alias(SEQUENCE),
        F.lit(None).cast("string").alias(SHAPE),
        *fields,
    )
