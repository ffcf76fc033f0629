"""Workbooks as a format of their own: ``spark.read.format("workbook")`` and ``spark.readStream``."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from siftgate.sources.excel_source import CELLS, sheet_rows
from siftgate.sources.paths import file_system


# Tasks that the sheets are shared out to before one has several, and the most sheets that one has.
TASKS, SHEETS = 256, 64


class Sheets(InputPartition):
    """Sheets of workbooks, by path and name: what a task reads."""

    def __init__(self, sheets: Sequence[tuple[str, str | None]]):
        self.sheets = sheets


def list_workbooks(folder: str) -> list[tuple[int, str]]:
    """Time of the last change and path of the workbooks directly in a folder, or of the one file named; oldest first."""
    filesystem, name = file_system(folder)
    scheme = folder[: len(folder) - len(name)] if folder.endswith(name) else folder.split("/", 1)[0]
    info = filesystem.get_file_info(name)
    found = [info] if info.is_file else filesystem.get_file_info(fs.FileSelector(name))
    books = [f for f in found if f.is_file and f.base_name.lower().endswith(".xlsx") and f.base_name[0] not in "._"]
    return sorted((f.mtime_ns, scheme + f.path) for f in books)


def read_sheets(partition: Sheets) -> Iterator[tuple]:
    for path, sheet in partition.sheets:
        filesystem, name = file_system(path)
        with filesystem.open_input_file(name) as file:
            content = file.read()
        for number, cells in sheet_rows(content, sheet):
            yield path, number, cells


class _Options:
    def __init__(self, options):
        self.folder = options["path"]
        # several sheets are parted by line feeds, which no sheet's name has
        self.sheets: Sequence[str | None] = options["sheet"].split("\n") if "sheet" in options else [None]

    def partitions_of(self, books: Sequence[tuple[int, str]]) -> list[Sheets]:
        every = [(path, sheet) for _, path in books for sheet in self.sheets]
        size = min(SHEETS, max(1, len(every) // TASKS))
        return [Sheets(every[i : i + size]) for i in range(0, len(every), size)]


class WorkbookReader(_Options, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return self.partitions_of(list_workbooks(self.folder))

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return read_sheets(partition)


class WorkbookStreamReader(_Options, DataSourceStreamReader):
    """A micro-batch has the workbooks that the offsets before it did not name. An offset names all books there were.

    A book that is changed comes again: its time is part of its name in the offset.
    """

    def initialOffset(self) -> dict:
        return {"books": "[]"}

    def latestOffset(self) -> dict:
        return {"books": json.dumps(list_workbooks(self.folder))}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        seen = {tuple(b) for b in json.loads(start["books"])}
        return self.partitions_of([tuple(b) for b in json.loads(end["books"]) if tuple(b) not in seen])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return read_sheets(partition)


class WorkbookSource(DataSource):
    """Rows ``path, sheet_row, cells`` of a sheet of each workbook in a folder; ``sheet`` names it, else it is the first.

    Files are opened by the executors, so the folder's scheme must be one that Python opens.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return WorkbookStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.dataSource.register(WorkbookSource)
