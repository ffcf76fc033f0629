"""Record validation: one pass that yields typed rows and, for bad rows, every reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.functions.coerce import (
    NO_TEXT,
    Cell,
    error_entry,
    field_error,
    is_fine,
    message_of,
    quoted,
    typed_value,
)
from siftgate.functions.messages import THRESHOLD_EXCEEDED, TOO_MANY_ERRORS
from siftgate.functions.text import row_hash
from siftgate.spec import FieldSpec, SourceSpec

ERROR_FIELDS = ("column_name", "column_value", "error_type", "error_msg")
ERRORS_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ERROR_FIELDS]))


def _texts(raw: DataFrame, fields: Sequence[FieldSpec], keep: Sequence[Column], shape_error: Column | None) -> DataFrame:
    """Per field its text ``t_``, cleaned if asked for, and, if the format is typed, its kind ``k_``.

    Where cleaning may change the text, ``r_`` keeps what the file says.
    """
    schema = raw.schema
    cells = []
    for spec in fields:
        typed = isinstance(schema[spec.name].dataType, T.StructType)
        text, kind = (f"`{spec.name}`.text", f"`{spec.name}`.kind") if typed else (f"`{spec.name}`", None)
        if spec.clean:
            cleaned = F.col(text)
            for cleaner in spec.clean:
                cleaned = F.when(F.col(kind) == "string", cleaner(cleaned)).otherwise(cleaned) if typed else cleaner(cleaned)
            cells += [cleaned.alias(f"t_{spec.name}"), F.expr(f"{text} AS `r_{spec.name}`")]
        else:
            cells.append(F.expr(f"{text} AS `t_{spec.name}`"))
        if typed:
            cells.append(F.expr(f"coalesce({kind}, 'missing') AS `k_{spec.name}`"))
    shape = (shape_error if shape_error is not None else F.lit(None).cast("string")).alias("shape")
    return raw.select(*keep, shape, *cells)


def _cell_of(spec: FieldSpec, columns: Sequence[str]) -> Cell:
    return Cell(f"`t_{spec.name}`", f"`k_{spec.name}`" if f"k_{spec.name}" in columns else None)


def validate(
    raw: DataFrame,
    fields: Sequence[FieldSpec],
    carry: Sequence[str] = (),
    shape_error: Column | None = None,
) -> DataFrame:
    """Adds ``errors`` and ``raw_cells`` to the typed fields; keeps the ``carry`` columns.

    A raw field column is text, or ``struct<text, kind>`` when the format has types of its
    own; there a null struct is an absent key. ``shape_error`` names a fault of the whole
    record, which is then its only error. The selects stay apart so that each typed
    value is computed once and used by its own check.
    """
    keep = [F.col(f"`{c}`") for c in carry]
    texts = _texts(raw, fields, keep, shape_error)
    cells = {s.name: _cell_of(s, texts.columns) for s in fields}
    typed = texts.selectExpr("*", *[f"{typed_value(cells[s.name], s)} AS `v_{s.name}`" for s in fields])

    fine = F.col("shape").isNull()
    for spec in fields:
        fine = fine & is_fine(cells[spec.name], f"`v_{spec.name}`", spec)
    entries = [field_error(cells[s.name], f"`v_{s.name}`", s) for s in fields]
    of_record = F.expr(f"array({error_entry(NO_TEXT, NO_TEXT, 'shape')})")
    found = F.when(F.col("shape").isNotNull(), of_record).otherwise(F.array_compact(F.array(*entries)))
    explained = F.transform(
        found, lambda e: e.withField("error_msg", F.coalesce(e["error_msg"], message_of(e["error_type"])))
    )
    # good records never evaluate the error texts
    errors = F.when(F.coalesce(fine, F.lit(False)), F.array().cast(ERRORS_TYPE)).otherwise(explained.cast(ERRORS_TYPE))
    originals = ", ".join(
        f"struct({quoted(s.file_column)} AS key, `{'r' if s.clean else 't'}_{s.name}` AS value)" for s in fields
    )
    return typed.select(
        *keep,
        *[F.expr(f"`v_{s.name}` AS `{s.name}`") for s in fields],
        errors.alias("errors"),
        F.expr(f"array({originals}) AS raw_cells"),
    )


def with_verdict(validated: DataFrame, source: SourceSpec) -> DataFrame:
    """Turns ``errors`` into the stage columns: flag, row hash, and the rejected record.

    The rejected record holds the failed fields and the grain, keyed by file column name, so
    that a good row stores nothing twice.
    """
    failed = F.transform("errors", lambda e: e["column_name"])
    wanted = F.array_union(F.array(*[F.lit(c) for c in source.grain_columns]), failed)
    record = F.map_from_entries(F.filter("raw_cells", lambda c: F.array_contains(wanted, c["key"])))
    names = set(source.field_names) | {"errors", "raw_cells"}
    carry = [F.col(f"`{c}`") for c in validated.columns if c not in names]
    is_valid = F.size("errors") == 0
    return validated.select(
        *carry,
        *[F.col(f"`{n}`") for n in source.field_names],
        row_hash([(f.name, f.spark_type) for f in source.fields]).alias("etl_row_hash"),
        is_valid.alias("is_valid"),
        F.when(~is_valid, F.col("errors")).alias("validation_errors"),
        F.when(~is_valid, record).alias("file_record_data"),
    )


def errors_text(errors: Column) -> Column:
    """Errors in the report's one-line form: ``[{column_name: .., error_type: ..}, ..]``."""

    def one(entry: Column) -> Column:
        parts = [F.concat(F.lit(f"{n}: "), entry[n]) for n in ERROR_FIELDS]
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    return F.concat(F.lit("["), F.array_join(F.transform(errors, one), ", "), F.lit("]"))


def record_text(record: Column) -> Column:
    """The rejected cells in one line, by column name: ``{column: value, ..}``."""
    entries = F.array_sort(F.map_entries(record))
    parts = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("null"))))
    return F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}"))


def file_counts(stage: DataFrame, by: str = "source_filename") -> DataFrame:
    """Processed, rejected and good rows per file: one aggregate with map-side combine."""
    return stage.groupBy(by).agg(
        F.count("*").alias("records_processed"),
        F.count_if(~F.col("is_valid")).alias("validation_errors"),
        F.count_if("is_valid").alias("records_stage_loaded"),
    )


def threshold_gate(counts: DataFrame, threshold: Column | float, by: str = "source_filename") -> DataFrame:
    """Fails a file whose error rate is strictly above the allowed one."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    rate = F.when(
        F.col("records_processed") > 0, F.col("validation_errors") / F.col("records_processed")
    ).otherwise(0.0)
    failed = rate > limit
    message = F.format_string(
        TOO_MANY_ERRORS,
        rate * 100,
        limit * 100,
        F.col(by),
        F.col("records_processed"),
        F.col("validation_errors"),
    )
    return counts.withColumns(
        {
            "error_rate": rate,
            "error_type": F.when(failed, F.lit(THRESHOLD_EXCEEDED)),
            "error_message": F.when(failed, message),
        }
    )


def sample_errors(
    rejected: DataFrame, count: int = 6, by: str = "source_filename", order: str = "file_row_number"
) -> DataFrame:
    """The first ``count`` rejected rows of each file, by row number.

    A ``row_number() <= k`` filter lets Spark keep only k rows per file and task before the
    shuffle, so a file that holds most of the rows does not land in one task.
    """
    window = Window.partitionBy(by).orderBy(order)
    return rejected.withColumn("sample", F.row_number().over(window)).filter(F.col("sample") <= count)


def sample_texts(samples: DataFrame, by: str = "source_filename") -> DataFrame:
    """The samples of a file as one text, for failure messages: row number, errors, record."""
    line = F.concat(
        F.lit("row "),
        F.col("file_row_number"),
        F.lit(": "),
        errors_text(F.col("validation_errors")),
        F.lit(" record: "),
        record_text(F.col("file_record_data")),
    )
    ordered = F.array_sort(F.collect_list(F.struct("sample", line.alias("line"))))
    return samples.groupBy(by).agg(
        F.array_join(F.transform(ordered, lambda s: s["line"]), "; ").alias("sample_errors")
    )
