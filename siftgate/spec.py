"""Declarations: what a feed looks like, how its fields are checked, where it lands."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T

FIELD_TYPES = ("str", "int", "float", "bool", "decimal", "date", "timestamp", "email")
FORMATS = ("csv", "json", "excel")

# Columns every target carries beside its own fields.
STAGE_COLUMNS = ("etl_row_hash", "source_filename", "file_load_log_id")
TIMESTAMP_COLUMNS = ("etl_created_at", "etl_updated_at")


@dataclass(frozen=True)
class Rule:
    """A user check: ``is_bad(value)`` is a boolean Column, true for rejected values."""

    error_type: str
    message: str
    is_bad: Callable[[Column], Column]


@dataclass(frozen=True)
class Audit:
    """A dataset check written as a boolean aggregate, e.g. ``count_if(x > 0) = count(*)``."""

    name: str
    expression: str


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "str"
    column: str | None = None
    nullable: bool = False
    max_length: int | None = None
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    lt: float | None = None
    allowed: tuple[str, ...] = ()
    clean: tuple[Callable[[Column], Column], ...] = ()
    rules: tuple[Rule, ...] = ()
    formats: tuple[str, ...] = ()
    precision: int = 18
    scale: int = 4

    def __post_init__(self) -> None:
        if self.type not in FIELD_TYPES:
            raise ValueError(f"Unsupported field type {self.type!r} for {self.name}")

    @property
    def file_column(self) -> str:
        return self.column or self.name

    @property
    def spark_type(self) -> T.DataType:
        if self.type == "decimal":
            return T.DecimalType(self.precision, self.scale)
        return {
            "str": T.StringType(),
            "email": T.StringType(),
            "int": T.LongType(),
            "float": T.DoubleType(),
            "bool": T.BooleanType(),
            "date": T.DateType(),
            "timestamp": T.TimestampType(),
        }[self.type]


@dataclass(frozen=True)
class SourceSpec:
    """One feed. ``reader`` may replace the built-in reader of ``format``."""

    table: str
    patterns: tuple[str, ...]
    fields: tuple[FieldSpec, ...]
    grain: tuple[str, ...]
    format: str = "csv"
    audit_sql: str | None = None
    audits: tuple[Audit, ...] = ()
    error_threshold: float = 0.0
    owners: tuple[str, ...] = ()
    skip_rows: int = 0
    delimiter: str = ","
    encoding: str = "utf-8"
    multiline: bool = True
    array_path: str = "item"
    json_lines: bool = False
    sheet: str | None = None
    reader: Callable | None = None

    def __post_init__(self) -> None:
        if isinstance(self.patterns, str):
            object.__setattr__(self, "patterns", (self.patterns,))
        if self.reader is None and self.format not in FORMATS:
            raise ValueError(f"Unsupported format {self.format!r} for {self.table}")
        unknown = [g for g in self.grain if g not in self.field_names]
        if unknown or not self.grain:
            raise ValueError(f"Grain of {self.table} names unknown fields: {unknown}")
        if len(self.grain) > 3:
            warnings.warn(f"Grain of {self.table} has {len(self.grain)} columns", stacklevel=2)

    @property
    def field_names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def file_columns(self) -> tuple[str, ...]:
        return tuple(f.file_column for f in self.fields)

    @property
    def grain_columns(self) -> tuple[str, ...]:
        """File column names of the grain, used in messages and rejected records."""
        by_name = {f.name: f.file_column for f in self.fields}
        return tuple(by_name[g] for g in self.grain)

    @property
    def name_regex(self) -> str:
        return "|".join(glob_regex(p) for p in self.patterns)

    def to_struct(self) -> T.StructType:
        """Schema of the target table."""
        columns = [T.StructField(f.name, f.spark_type, True) for f in self.fields]
        return T.StructType(
            columns
            + [
                T.StructField("etl_row_hash", T.BinaryType(), True),
                T.StructField("source_filename", T.StringType(), True),
                T.StructField("file_load_log_id", T.LongType(), True),
                T.StructField("etl_created_at", T.TimestampType(), True),
                T.StructField("etl_updated_at", T.TimestampType(), True),
            ]
        )


@dataclass
class Registry:
    sources: list[SourceSpec] = field(default_factory=list)

    def add(self, *sources: SourceSpec) -> Registry:
        self.sources.extend(sources)
        return self

    def __iter__(self) -> Iterable[SourceSpec]:
        return iter(self.sources)

    def by_table(self, table: str) -> SourceSpec:
        return next(s for s in self.sources if s.table == table)


def glob_regex(pattern: str) -> str:
    """A file-name glob (``*``, ``?``, ``[..]``) as an anchored, case-insensitive Java regex."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return "(?is)^" + "".join(out) + "$"
