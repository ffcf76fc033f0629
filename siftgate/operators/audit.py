"""Checks on staged rows, all files of a source in one job."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.functions import messages
from siftgate.session import scratch_path
from siftgate.spec import Audit

# Files whose audit texts run in one job, where they cannot run as one aggregate.
FILES_PER_JOB = 16


def key_groups(stage: DataFrame, grain: Sequence[str], by: Sequence[str] = ("source_filename",)) -> DataFrame:
    """Rows per key. Equal keys are combined before the shuffle, so a hot key costs one row per task."""
    return stage.groupBy(*by, *grain).agg(F.count("*").alias("duplicate_count"))


def grain_stats(groups: DataFrame, grain: Sequence[str], by: Sequence[str] = ("source_filename",)) -> DataFrame:
    """Uniqueness per file. A null key part counts as a violation of its own."""
    has_null = F.lit(False)
    for name in grain:
        has_null = has_null | F.col(name).isNull()
    stats = groups.groupBy(*by).agg(
        F.sum("duplicate_count").alias("key_rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.when(has_null, F.col("duplicate_count"))), F.lit(0)).alias("null_keys"),
    )
    unique = (F.col("key_rows") == F.col("distinct_keys")) & (F.col("null_keys") == 0)
    return stats.withColumn("grain_unique", unique.cast("int"))


def unique_by_print(stage: DataFrame, grain: Sequence[str], by: Sequence[str] = ("source_filename",)) -> DataFrame:
    """The same verdicts as ``grain_stats`` from the hashes of keys: eight bytes a key are exchanged, however wide it is.

    As many hashes as rows, none of a null key, prove a file's keys unique. Only files of which that is not true, which
    may be two keys with one hash, are looked at key by key.
    """
    null = F.lit(False)
    for name in grain:
        null = null | F.col(name).isNull()
    prints = stage.groupBy(*by, F.xxhash64(*grain).alias("key_print"), null.alias("key_null")).agg(F.count("*").alias("n"))
    found = prints.groupBy(*by).agg(
        F.sum("n").alias("key_rows"), F.count("*").alias("distinct_keys"), F.count_if("key_null").alias("null_prints")
    )
    sure = (F.col("key_rows") == F.col("distinct_keys")) & (F.col("null_prints") == 0)
    unique = found.filter(sure).select(
        *by, "key_rows", "distinct_keys", F.lit(0).cast("long").alias("null_keys"), F.lit(1).alias("grain_unique")
    )
    doubtful = stage.join(found.filter(~sure).select(*by), list(by), "left_semi")
    return unique.unionByName(grain_stats(key_groups(doubtful, grain, by), grain, by))


def duplicate_examples(
    groups: DataFrame, grain: Sequence[str], by: Sequence[str] = ("source_filename",), count: int = 5
) -> DataFrame:
    """Up to ``count`` repeated keys per file, most repeated first."""
    repeated = groups.filter(F.col("duplicate_count") > 1)
    order = [F.desc("duplicate_count"), *[F.asc(g) for g in grain]]
    if not by:
        return repeated.orderBy(*order).limit(count)
    window = Window.partitionBy(*by).orderBy(*order)
    return repeated.withColumn("example", F.row_number().over(window)).filter(F.col("example") <= count)


def grain_messages(stats: DataFrame, examples: DataFrame, grain: Sequence[str], columns: Sequence[str], table: str) -> DataFrame:
    """Error rows for the files whose keys are not unique."""
    pairs = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(g).cast("string"), F.lit("null"))) for g, c in zip(grain, columns)]
    line = F.concat(F.lit("  - "), F.concat_ws(", ", *pairs, F.concat(F.lit("duplicate_count: "), F.col("duplicate_count"))))
    listed = F.array_sort(F.collect_list(F.struct("example", line.alias("line"))))
    lines = examples.groupBy("source_filename").agg(
        F.array_join(F.transform(listed, lambda e: e["line"]), "\n").alias("lines")
    )
    message = F.concat_ws(
        "\n",
        F.format_string(messages.KEYS_NOT_UNIQUE, "source_filename", F.lit(table), F.lit(", ".join(columns))),
        F.when(F.col("null_keys") > 0, F.format_string(messages.EMPTY_KEYS, "null_keys")),
        F.when(F.col("lines").isNotNull(), F.concat(F.lit(messages.KEY_EXAMPLES), F.col("lines"))),
    )
    return (
        stats.filter("grain_unique = 0")
        .join(lines, "source_filename", "left")
        .select("source_filename", F.lit(messages.GRAIN_ERROR).alias("error_type"), message.alias("error_message"))
    )


def audit_by_file(stage: DataFrame, files: DataFrame, audits: Sequence[Audit]) -> DataFrame:
    """Boolean aggregates grouped by file; a file without rows gets the result on no rows."""
    checks = [F.expr(a.expression).cast("int").alias(a.name) for a in audits]
    by_file = stage.groupBy("source_filename").agg(*checks)
    on_nothing = stage.limit(0).agg(*checks).first()
    joined = files.select("source_filename").join(
        by_file.withColumn("has_rows", F.lit(True)), "source_filename", "left"
    )
    values = [
        F.when(F.col("has_rows"), F.col(a.name)).otherwise(F.lit(on_nothing[a.name]).cast("int")).alias(a.name)
        for a in audits
    ]
    return joined.select("source_filename", *values)


def audit_sql_by_file(
    spark: SparkSession, stage: DataFrame, files: DataFrame, template: str, work: str | None = None
) -> DataFrame:
    """A user's one-row audit text, where ``{table}`` stands for the file's staged rows.

    The text becomes a lateral subquery over the file list, which Spark turns into one
    grouped aggregate for all files. For texts that Spark cannot turn that way the rows are laid out by
    file in the ``work`` folder, and the text runs over one file's folder at a time, a few files to a job.
    """
    text = template.strip().rstrip(";")
    rows, names = _view("stage"), _view("files")
    stage.createOrReplaceTempView(rows)
    files.select(F.col("source_filename").alias("audited_file")).createOrReplaceTempView(names)
    mine = f"(SELECT * FROM {rows} WHERE source_filename = audited_file)"
    try:
        return spark.sql(
            f"SELECT audited_file AS source_filename, audit.* FROM {names}, LATERAL ({text.replace('{table}', mine)}) AS audit"
        )
    except AnalysisException:
        return _audit_laid_out(spark, stage, files, text, work or scratch_path(spark, "audit"))
    finally:
        spark.catalog.dropTempView(rows)
        spark.catalog.dropTempView(names)


def _view(label: str) -> str:
    """A view name of its own, so that loads in one session do not meet."""
    return f"siftgate_{label}_{uuid.uuid4().hex}"


def _audit_laid_out(spark: SparkSession, stage: DataFrame, files: DataFrame, text: str, work: str) -> DataFrame:
    by_file = stage.withColumn("audited_file", F.col("source_filename"))
    # rows of one file lie together; a large file is still written by several tasks
    by_file.hint("rebalance", F.col("audited_file")).write.partitionBy("audited_file").parquet(f"{work}/by_file")
    laid = spark.read.schema(by_file.schema).parquet(f"{work}/by_file")
    results: list[Row] = []
    schema = None
    batch: list[DataFrame] = []

    def run() -> None:
        if batch:
            results.extend(reduce(DataFrame.unionByName, batch).collect())  # one row per file
            batch.clear()

    for row in files.select("source_filename").distinct().toLocalIterator():
        view = _view("one_file")
        laid.filter(F.col("audited_file") == row[0]).drop("audited_file").createOrReplaceTempView(view)
        one = spark.sql(text.replace("{table}", view)).select(F.lit(row[0]).alias("source_filename"), "*")
        spark.catalog.dropTempView(view)
        schema = schema or one.schema
        batch.append(one)
        if len(batch) == FILES_PER_JOB:
            run()
    run()
    return spark.createDataFrame(results, T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


def failed_audits(results: DataFrame, table: str) -> DataFrame:
    """Error rows for files with a check that came out 0; a null check passes."""
    names = [c for c in results.columns if c != "source_filename"]
    failed = F.concat_ws(", ", *[F.when(F.col(f"`{n}`").cast("double") == 0, F.lit(n)) for n in names])
    message = F.format_string(messages.AUDITS_FAILED, "source_filename", F.lit(table), failed)
    return results.select(
        "source_filename",
        F.when(failed != "", F.lit(messages.AUDIT_FAILED)).alias("error_type"),
        F.when(failed != "", message).alias("error_message"),
    ).filter(F.col("error_type").isNotNull())
