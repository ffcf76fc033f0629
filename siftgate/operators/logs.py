"""Run log and rejected records: folding, cleanup, reports, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.functions.messages import DUPLICATE_FILE, FILE_ERRORS, RUN_FAILURES
from siftgate.functions.text import truncate

PHASES = ("archive_copy", "processing", "stage_load", "audit", "merge")
COUNTERS = ("records_processed", "validation_errors", "records_stage_loaded", "target_inserts", "target_updates")

RUN_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source_filename", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("duplicate_skipped", T.BooleanType()),
    ]
    + [
        T.StructField(f"{phase}_{part}", kind)
        for phase in PHASES
        for part, kind in (("started_at", T.TimestampType()), ("ended_at", T.TimestampType()), ("success", T.BooleanType()))
    ]
    + [T.StructField("ended_at", T.TimestampType())]
    + [T.StructField(name, T.LongType()) for name in COUNTERS]
    + [T.StructField(n, k) for n, k in (("success", T.BooleanType()), ("error_type", T.StringType()), ("table_name", T.StringType()))]
)

# The log is kept as events; a later number says what is known now.
EVENT_NUMBER = "event_number"
RUN_EVENTS = T.StructType([*RUN_LOG.fields, T.StructField(EVENT_NUMBER, T.LongType())])

DEAD_LETTERS = T.StructType(
    [
        T.StructField("source_filename", T.StringType()),
        T.StructField("file_row_number", T.LongType()),
        T.StructField("file_record_data", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "validation_errors",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(n, T.StringType())
                        for n in ("column_name", "column_value", "error_type", "error_msg")
                    ]
                )
            ),
        ),
        T.StructField("file_load_log_id", T.LongType()),
        T.StructField("target_table_name", T.StringType()),
        T.StructField("failed_at", T.TimestampType()),
    ]
)


def fold_events(events: DataFrame, key: str, sequence: str, columns: Sequence[str]) -> DataFrame:
    """Latest known value of every column per run; an event leaves unknown columns null."""
    latest = [f"max_by(`{c}`, CASE WHEN `{c}` IS NOT NULL THEN `{sequence}` END) AS `{c}`" for c in columns]
    return events.groupBy(key).agg(*[F.expr(e) for e in latest])


def dead_letters(rejected: DataFrame, table: str, failed_at: Column) -> DataFrame:
    """Rejected stage rows, numbered, as dead-letter rows."""
    return rejected.select(
        "source_filename",
        "file_row_number",
        "file_record_data",
        "validation_errors",
        "file_load_log_id",
        F.lit(table).alias("target_table_name"),
        failed_at.alias("failed_at"),
    )


def cleanup(dlq: DataFrame, reloaded: DataFrame, mode: str = "older") -> DataFrame:
    """Dead letters left after files loaded again successfully.

    ``reloaded`` has ``source_filename`` and ``file_load_log_id`` of the new runs. Files with
    no older dead letters are left alone. ``older`` removes the rows of earlier runs; ``all``
    also removes what the new run rejected.
    """
    runs = reloaded.select(
        F.col("source_filename").alias("reloaded_file"), F.col("file_load_log_id").alias("current_id")
    )
    stale = (F.col("source_filename") == F.col("reloaded_file")) & (F.col("file_load_log_id") < F.col("current_id"))
    if mode == "older":
        return dlq.join(runs, stale, "left_anti")
    oldest = dlq.groupBy("source_filename").agg(F.min("file_load_log_id").alias("file_load_log_id"))
    affected = oldest.join(runs, stale, "left_semi").select("source_filename")
    return dlq.join(affected, "source_filename", "left_anti")


def orphans(dlq: DataFrame, log: DataFrame) -> DataFrame:
    """Dead letters whose run is not in the log."""
    return dlq.join(log.select(F.col("id").alias("file_load_log_id")), "file_load_log_id", "left_anti")


def dead_letter_report(dlq: DataFrame, source_filename: str) -> DataFrame:
    return (
        dlq.filter(F.col("source_filename") == source_filename)
        .select("file_row_number", "file_record_data", "validation_errors", "failed_at")
        .orderBy("file_row_number")
    )


def run_report(log: DataFrame, name_like: str = "%") -> DataFrame:
    """Runs with their duration and the first phase that did not succeed."""

    def not_done(column: str) -> Column:
        return ~F.col(column).eqNullSafe(F.lit(True))

    stage = (
        F.when(F.col("duplicate_skipped"), "Duplicate File")
        .when(F.col("success"), F.lit(None))
        .when(not_done("archive_copy_success"), "Archive Copy")
        .when(not_done("processing_success"), "Processing")
        .when(not_done("stage_load_success"), "Stage Load")
        .when(not_done("audit_success"), "Audit")
        .when(not_done("merge_success"), "Publish")
        .otherwise("Unknown")
    )
    return (
        log.filter(F.col("source_filename").like(name_like))
        .select(
            F.col("id").alias("file_load_id"),
            F.to_date("started_at").alias("start_date"),
            "source_filename",
            (F.col("ended_at") - F.col("started_at")).alias("run_time"),
            "success",
            "records_processed",
            "validation_errors",
            F.col("records_stage_loaded").alias("records_loaded_to_stage"),
            "target_inserts",
            "target_updates",
            stage.alias("stage_failed_at"),
            F.col("error_type").alias("failure_reason"),
        )
        .orderBy("file_load_id")
    )


def batch_totals(results: DataFrame) -> DataFrame:
    done = F.coalesce(F.col("success"), F.lit(False))
    return results.agg(
        F.count("*").alias("files"), F.count_if(done).alias("successful"), F.count_if(~done).alias("failed")
    )


def _is_code_failure() -> Column:
    known = F.coalesce(F.col("error_type").isin(*FILE_ERRORS), F.lit(False))
    return ~F.coalesce(F.col("success"), F.lit(True)) & ~known


def code_failures(results: DataFrame) -> DataFrame:
    """Failures that are not the file's fault, one line of text each."""
    line = F.concat(
        F.lit("• "),
        F.coalesce("source_filename", F.lit("Unknown")),
        F.when(F.col("id").isNotNull(), F.concat(F.lit(" (log_id: "), F.col("id"), F.lit(")"))).otherwise(""),
        F.lit(": "),
        F.coalesce("error_type", F.lit("Unknown Error")),
        F.concat(F.lit(" - "), truncate(F.coalesce("error_message", F.lit("No error details")))),
    )
    return results.filter(_is_code_failure()).select("id", line.alias("line"))


def failure_summary(results: DataFrame) -> DataFrame:
    """Head line of the run's failure message; no row when nothing failed.

    The lines stay rows (``code_failures``): their number grows with the files of a run.
    """
    counts = results.agg(
        F.count_if(_is_code_failure()).alias("failure_count"), F.count("*").alias("total_count")
    )
    text = F.format_string(
        RUN_FAILURES, "failure_count", "total_count"
    )
    return counts.filter("failure_count > 0").withColumn("summary", text)


def notifications(results: DataFrame, owners: Column) -> DataFrame:
    """One row per failed or duplicate file whose feed has owners to tell."""
    told = F.col("error_type").isin(*FILE_ERRORS, DUPLICATE_FILE)
    return (
        results.filter(told)
        .withColumn("recipients", owners)
        .filter(F.size("recipients") > 0)
        .select("id", "source_filename", "error_type", "error_message", "recipients")
    )
