"""JSON scan: records at an array path, flattened on demand."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.operators.rows import BLOCK, SEQUENCE
from siftgate.session import scratch_path
from siftgate.sources.csv_source import SHAPE
from siftgate.sources.paths import charset, literal_paths, scanned_name, scanned_path
from siftgate.spec import SourceSpec


def records_at(document: Column, array_path: str) -> Column:
    """Array of the records a dotted path selects; ``item`` steps into the elements of a list.

    ``item`` also follows a key of that name, and a selected list gives all its elements.
    """

    def elements(value: Column) -> Column:
        return F.try_variant_get(value, "$", "array<variant>")

    def child(value: Column, key: str) -> Column:
        return F.try_variant_get(value, f"$['{key}']", "variant")

    def child_of(key: str) -> Callable[[Column], Column]:
        return lambda value: child(value, key)

    found = F.array(document)
    for step in [s for s in array_path.split(".") if s]:
        if step == "item":
            found = F.flatten(F.transform(found, lambda v: F.coalesce(elements(v), F.array(child(v, "item")))))
        else:
            found = F.transform(found, child_of(step))
        found = F.filter(found, lambda v: v.isNotNull())
    return F.flatten(F.transform(found, lambda v: F.coalesce(elements(v), F.array(v))))


def read_elements(spark: SparkSession, paths: Sequence[str], source: SourceSpec) -> DataFrame:
    """One row per record: file, place, and the record as a variant.

    A whole document is one row until its records are exploded, so it is bounded by the
    variant size limit; large feeds are JSON lines, which Spark splits.
    """
    scan = (
        spark.read.option("singleVariantColumn", "document")
        .option("multiLine", not source.json_lines)
        .option("encoding", charset(source.encoding))
        .json(literal_paths(paths))
    )
    place = [
        scanned_path().alias("path"),
        scanned_name().alias("source_filename"),
        F.col("_metadata.file_block_start").alias(BLOCK),
    ]
    if source.json_lines:
        return scan.select(*place, F.monotonically_increasing_id().alias(SEQUENCE), F.col("document").alias("record"))
    exploded = scan.select(*place, F.posexplode(records_at(F.col("document"), source.array_path)))
    return exploded.select("path", "source_filename", BLOCK, F.col("pos").cast("bigint").alias(SEQUENCE), F.col("col").alias("record"))


def flat_paths(value: dict, name: str = "", path: str = "$") -> dict[str, str]:
    """Lower-case flattened key of every leaf of a record, with the path that leads there."""
    found: dict[str, str] = {}
    for key, child in value.items():
        flat = (f"{name}_{key}" if name else key).lower()
        here = _key(path, key)
        listed = isinstance(child, list) and bool(child) and isinstance(child[0], dict)
        if isinstance(child, dict):
            found |= flat_paths(child, flat, here)
        elif listed:
            for i, part in enumerate(child):
                inner = f"{here}[{i}]"
                found |= flat_paths(part, f"{flat}_{i}", inner) if isinstance(part, dict) else {f"{flat}_{i}": inner}
        else:
            found[flat] = here
    return found


def stage_records(spark: SparkSession, paths: Sequence[str], source: SourceSpec, work: str | None = None) -> DataFrame:
    """Parsed records, written once: keys, headers and cells are read from there."""
    elements = read_elements(spark, paths, source)
    written = f"{work}/records" if work else scratch_path(spark, "records")
    elements.write.parquet(written)
    return spark.read.schema(elements.schema).parquet(written)


JSON_HEADER = "path string, header array<string>"


def json_headers(records: DataFrame, json_lines: bool = True) -> DataFrame:
    """``path, header``: flattened keys of the first record of each file; one of a document is numbered 0."""

    def flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [list(flat_paths(found)) if isinstance(found := json.loads(r), dict) else [] for r in batch["record"]]
            yield pd.DataFrame({"path": batch["path"], "header": keys})

    if not json_lines:
        heads = records.filter(F.col(SEQUENCE) == 0)
    else:
        first = records.groupBy("path").agg(F.min(F.struct(BLOCK, SEQUENCE)).alias("first"))
        named = first.select("path", f"first.{BLOCK}", f"first.{SEQUENCE}")
        heads = records.join(named, ["path", BLOCK, SEQUENCE])
    return heads.select("path", F.to_json("record").alias("record")).mapInPandas(flatten, JSON_HEADER)


def _key(path: str, key: str) -> str:
    """A step into an object; paths know no escapes, only two kinds of quotes."""
    return f"{path}[\"{key}\"]" if "'" in key else f"{path}['{key}']"


# A type as text: names (quoted where they are no identifiers), kinds with their sizes, and signs.
TOKEN = re.compile(r"`(?:[^`]|``)*`|\w+(?:\(\d+, *\d+\))?|[<>:,]")


def shape_paths(shape: str, wanted: Sequence[str]) -> set[tuple[str, str]]:
    """Wanted columns that a record of this type has, with the paths that flatten to their names.

    The type is the text that ``schema_of_variant`` gives. Of a list of objects any place may be wanted: a declared
    name says which.
    """
    tokens = iter(TOKEN.findall(shape))
    found: set[tuple[str, str]] = set()

    def leaf(flat: str, path: str) -> None:
        pattern = re.escape(flat).replace(re.escape("#"), "([0-9]+)")
        for column in wanted:
            if match := re.fullmatch(pattern, column):
                here = path
                for number in match.groups():
                    here = here.replace("[#]", f"[{number}]", 1)
                found.add((column, here))

    def kind(flat: str, path: str) -> str:
        """Reads one type; its first word."""
        word = next(tokens)
        if word == "OBJECT":
            next(tokens)
            sign = name = next(tokens)
            while sign != ">":
                key = name[1:-1].replace("``", "`") if name.startswith("`") else name
                next(tokens)
                below = (f"{flat}_{key}" if flat else key).lower()
                if kind(below, _key(path, key)) != "OBJECT":
                    leaf(below, _key(path, key))
                sign = next(tokens)
                if sign == ",":
                    name = next(tokens)
        elif word == "ARRAY":
            next(tokens)
            if kind(f"{flat}_#", f"{path}[#]") == "VARIANT":  # elements of several kinds
                leaf(f"{flat}_#", f"{path}[#]")
            next(tokens)
        return word

    kind("", "$")
    return found


def field_paths(records: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """For each column every path that flattens to its name, whatever the spelling and nesting.

    One pass over the records: each has a type, equal types are one, and each of them is walked once, by the executors.
    """
    wanted = sorted({c.lower() for c in columns})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set().union(*[shape_paths(s, wanted) for s in batch["shape"]])
            yield pd.DataFrame(sorted(found), columns=["name", "path"])

    shapes = records.select(F.schema_of_variant("record").alias("shape")).filter(F.col("shape").startswith("OBJECT")).distinct()
    paths: dict[str, list[str]] = {c: [] for c in wanted}
    for row in shapes.mapInPandas(walk, "name string, path string").distinct().collect():  # spellings of declared names
        paths[row["name"]].append(row["path"])
    return {c: sorted(found) for c, found in paths.items()}


def variant_cell(record: Column, path: str) -> Column:
    """``struct<text, kind>`` at a path; null when the path leads to no scalar.

    Objects and lists of objects have been flattened away, so their own key is absent; a
    list of scalars counts as its JSON text.
    """
    value = F.try_variant_get(record, path, "variant")
    shape = F.schema_of_variant(value)
    listed = shape.startswith("ARRAY")
    kind = (
        F.when(shape == "STRING", "string")
        .when(shape == "BIGINT", "integer")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "number")
        .when(shape == "BOOLEAN", "boolean")
        .when(listed, "string")
        .when(shape == "VOID", "null")
    )
    head = F.coalesce(F.schema_of_variant(F.try_variant_get(record, path + "[0]", "variant")), F.lit(""))
    absent = value.isNull() | shape.startswith("OBJECT") | (listed & head.startswith("OBJECT"))
    text = F.when(listed, F.to_json(value)).otherwise(F.try_variant_get(record, path, "string"))
    return F.when(~absent, F.struct(text.alias("text"), kind.alias("kind")))


def read_json(records: DataFrame, source: SourceSpec) -> DataFrame:
    """Parsed records as cells; each field is read from the first of its paths that leads to a scalar."""
    paths = field_paths(records, source.file_columns)
    nothing = F.lit(None).cast("struct<text: string, kind: string>")
    cells = [
        F.coalesce(*[variant_cell(F.col("record"), p) for p in paths[s.file_column.lower()]], nothing).alias(s.name)
        for s in source.fields
    ]
    return records.select("source_filename", BLOCK, SEQUENCE, F.lit(None).cast("string").alias(SHAPE), *cells)
