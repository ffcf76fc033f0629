"""Batch load: route, archive, validate, stage, check, publish, log.

All files of a source go through one set of Spark jobs. What comes back to the driver is
per-file metadata (names, headers, counts, verdicts), never records.
"""

from __future__ import annotations

import logging
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.functions.messages import ALREADY_LOADED, DUPLICATE_FILE, NO_DATA
from siftgate.operators import audit, logs, merge, rows, validate
from siftgate.operators.rows import BLOCK, SEQUENCE
from siftgate.session import BROADCAST_ROWS, remove_path, short_methods, steady_splits
from siftgate.sources import discover, headers
from siftgate.sources.csv_source import SHAPE, read_csv
from siftgate.sources.excel_source import excel_headers, read_excel, stage_cells
from siftgate.sources.json_source import json_headers, read_json, stage_records
from siftgate.sources.paths import charset
from siftgate.sources.records import SPLITTABLE
from siftgate.sources.tables import Warehouse
from siftgate.spec import Registry, SourceSpec

log = logging.getLogger(__name__)

# Size of a split, and about how far gzip shrinks delimited text.
SPLIT_BYTES = 128 * 1024 * 1024
GZIP_RATIO = 5

# How a run ended that nobody saw end, and one whose rows were taken out again.
INTERRUPTED, BACKED_OUT = "Interrupted", "Backed Out"

RESULTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source_filename", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("validation_errors", T.LongType()),
        T.StructField("records_stage_loaded", T.LongType()),
        T.StructField("target_inserts", T.LongType()),
        T.StructField("target_updates", T.LongType()),
    ]
)


def load_directory(
    spark: SparkSession, registry: Registry, directory: str, warehouse: Warehouse, archive: bool = True
) -> DataFrame:
    """Loads every new file of a directory; one result row per file."""
    files = discover.supported(discover.list_files(spark, directory))
    return load_files(spark, registry, files, warehouse, archive)


def load_files(
    spark: SparkSession, registry: Registry, files: DataFrame, warehouse: Warehouse, archive: bool = True
) -> DataFrame:
    listed = discover.route(files, registry.sources).orderBy("source_filename").collect()
    if not listed:
        log.warning("No files found")
    _close_interrupted(spark, registry, warehouse)
    warehouse.fold_run_log()
    run_id = warehouse.next_run_id()
    runs: list[dict] = []
    by_table: dict[str, list[dict]] = defaultdict(list)
    for file in listed:
        if file.match_count == 0:
            log.warning("No source found for file: %s", file.source_filename)
            continue
        run = file.asDict() | {"id": run_id, "started_at": _now()}
        run_id += 1
        runs.append(run)
        if file.error_type:
            run |= {"success": False, "ended_at": _now()}
        else:
            by_table[file.table_name].append(run)
    if runs:
        _write_log(spark, warehouse, runs)
    for table, members in by_table.items():
        _load_table(spark, registry.by_table(table), members, warehouse, archive)
        _write_log(spark, warehouse, members)
    return spark.createDataFrame([_as_row(r, RESULTS) for r in runs], RESULTS)


def _write_log(spark: SparkSession, warehouse: Warehouse, runs: Sequence[dict]) -> None:
    """What is known of the runs now. Written twice or not at all it does no harm, so it is tried again."""
    rows = spark.createDataFrame([_as_row(r, logs.RUN_LOG) for r in runs], logs.RUN_LOG)
    _twice(spark, lambda: warehouse.append_run_log(rows), "The run log could not be written at first")


def _twice(spark: SparkSession, action: Callable[[], object], warning: str) -> None:
    try:
        action()
    except Exception as error:
        if _is_fatal(spark, error):
            raise
        log.warning(warning, exc_info=True)
        action()


def _is_fatal(spark: SparkSession, error: Exception) -> bool:
    """Errors that no file is to blame for, and that would only come again."""
    return spark._jsc.sc().isStopped() or "No space left on device" in str(error)


def _close_interrupted(spark: SparkSession, registry: Registry, warehouse: Warehouse) -> None:
    """Ends the runs that an earlier load left open: published ones by their rows, the others as interrupted.

    What stood at its commit is published first.
    """
    for source in registry.sources:
        if warehouse.is_pending(source):
            warehouse.finish(source, F.lit(_now()))
    left = warehouse.run_log().filter("ended_at IS NULL").collect()
    by_table: dict[str, list[Row]] = defaultdict(list)
    for row in left:
        by_table[row.table_name].append(row)
    known = {s.table: s for s in registry.sources}
    closed = []
    for table, rows in by_table.items():
        published: set[int] = set()
        if table in known:
            ids = F.col("file_load_log_id")
            found = warehouse.target(known[table]).filter(ids.isin([r.id for r in rows])).select(ids).distinct()
            published = {r[0] for r in found.collect()}
        for row in rows:
            done = row.id in published
            closed.append({"id": row.id, "success": done, "ended_at": _now(), "error_type": None if done else INTERRUPTED})
            if not done:
                warehouse.drop_dead_letters([row.id])
    if closed:
        _write_log(spark, warehouse, closed)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _as_row(run: dict, schema: T.StructType) -> tuple:
    return tuple(run.get(name) for name in schema.names)


def _load_table(spark: SparkSession, source: SourceSpec, runs: list[dict], warehouse: Warehouse, archive: bool) -> None:
    """Leaves out files loaded before, then loads the others."""
    files = _files_frame(spark, runs)
    done = warehouse.run_log().filter("success").select("source_filename").distinct()
    known = {r.source_filename for r in files.join(done, "source_filename", "left_semi").select("source_filename").collect()}
    asked = [r for r in runs if r["source_filename"] not in known]
    if asked:
        # rows that came without a log
        found = discover.already_loaded(_files_frame(spark, asked), warehouse.loaded_files(source))
        known |= {r.source_filename for r in found.collect()}
    fresh = []
    for run in runs:
        if run["source_filename"] in known:
            run |= {
                "duplicate_skipped": True,
                "ended_at": _now(),
                "error_type": DUPLICATE_FILE,
                "error_message": ALREADY_LOADED % (run["source_filename"], source.table),
            }
        else:
            fresh.append(run)
    if fresh:
        _load_isolated(spark, source, fresh, warehouse, archive)


def _load_isolated(
    spark: SparkSession, source: SourceSpec, runs: list[dict], warehouse: Warehouse, archive: bool
) -> None:
    """Loads the files together; if a job breaks, halves the list until the bad file stands alone.

    An attempt starts from what the runs were before it, and takes back the dead letters it wrote. Only the
    archive copy is kept. If it breaks as it publishes, the staged rows, which are checked by then, stay for the halves.
    """
    states = {r["id"]: dict(r) for r in runs}
    try:
        for run, error in _attempt(spark, source, runs, warehouse, archive):
            _take_back([run], states, warehouse)
            _break(run, error)
    except Exception as error:
        if _is_fatal(spark, error) or warehouse.is_pending(source):
            raise
        _take_back(runs, states, warehouse)
        if len(runs) > 1:
            log.warning("The files of %s are taken apart", source.table, exc_info=True)
            for part in _halves(runs):
                _load_isolated(spark, source, part, warehouse, archive)
            return
        _break(runs[0], error)
    finally:
        for run in runs:
            run.setdefault("ended_at", _now())


def _halves(runs: list[dict]) -> tuple[list[dict], list[dict]]:
    return runs[: len(runs) // 2], runs[len(runs) // 2 :]


def _take_back(runs: Sequence[dict], states: Mapping[int, dict], warehouse: Warehouse) -> None:
    """Runs as they were before an attempt, but for the archive copy."""
    for run in runs:
        copied = {k: v for k, v in run.items() if k.startswith("archive")}
        state = states[run["id"]]
        run.clear()
        run.update(state | copied)
    warehouse.drop_dead_letters([r["id"] for r in runs])


def _break(run: dict, error: Exception) -> None:
    log.error("Load failed: %s", run["source_filename"], exc_info=error)
    message = str(error).split("\n\nJVM stacktrace")[0]
    run |= {"success": False, "error_type": type(error).__name__, "error_message": message}


def _published(spark: SparkSession, source: SourceSpec, runs: list[dict], warehouse: Warehouse) -> None:
    """What follows a commit; it can be repeated, and no longer undoes it."""
    for run in runs:
        run["success"] = True
    try:
        _twice(spark, lambda: _clear_old_rejects(source, runs, warehouse), "Dead letters of earlier runs are cleared again")
    except Exception as error:
        if _is_fatal(spark, error):
            raise
        log.exception("Dead letters of earlier runs stay")


def _fail(run: dict, row: Row) -> None:
    run |= {"success": False, "error_type": row.error_type, "error_message": row.error_message}


def _files_frame(spark: SparkSession, runs: Sequence[dict]) -> DataFrame:
    """Per-file metadata for joins; broadcast while its row count is below the fixed bound."""
    frame = spark.createDataFrame(
        [(r["source_filename"], r["id"], r["modified_at"]) for r in runs],
        "source_filename string, file_load_log_id long, modified_at timestamp",
    )
    return F.broadcast(frame) if len(runs) <= BROADCAST_ROWS else frame


def first_row(source: SourceSpec) -> int:
    """Number of a file's first record: a header takes row 1, JSON has none."""
    return 1 if source.format == "json" else 2


def scan(
    spark: SparkSession,
    source: SourceSpec,
    paths: Sequence[str],
    work: str | None = None,
    sizes: Mapping[str, int] | None = None,
) -> tuple[DataFrame | None, list[Row]]:
    """Raw records of the files with a usable header, and the header verdict of every file.

    ``work`` is a folder for what workbooks and documents are unpacked to, ``sizes`` the files' bytes, if known. CSV files and sheets are scanned
    together per distinct header, because cells bind by position; JSON files in one scan.
    """
    if source.reader is not None:
        return source.reader(spark, list(paths), source), []
    cells = records = None
    if source.format == "csv":
        found = headers.csv_headers(spark, paths, source)
    elif source.format == "json":
        records = stage_records(spark, paths, source, work)
        found = json_headers(records, source.json_lines)
    else:
        cells = stage_cells(spark, paths, source, work)
        found = excel_headers(cells)
    verdicts = headers.check_headers(found, source, spreadsheet=source.format == "excel").collect()
    bad = [(v.path,) for v in verdicts if v.error_type is not None]
    if source.format == "json":
        if len(bad) == len(verdicts):
            return None, verdicts
        if bad:
            records = records.join(spark.createDataFrame(bad, "path string"), "path", "left_anti")
        return read_json(records, source), verdicts
    alike: dict[tuple, list[str]] = defaultdict(list)
    for v in verdicts:
        if v.error_type is None:
            alike[tuple(v.header), v.newline if source.format == "csv" else None].append(v.path)
    frames = []
    for (header, newline), members in alike.items():
        if source.format == "csv":
            frames.append(read_csv(spark, members, source, header, newline, sizes))
        else:
            mine = cells if len(alike) == 1 else cells.filter(F.col("path").isin(members))
            frames.append(read_excel(mine, source, header))
    return (reduce(DataFrame.unionByName, frames) if frames else None), verdicts


def _has_positions(source: SourceSpec) -> bool:
    """Records of a JSON document or a sheet come with their exact position."""
    return source.format in ("json", "excel") and source.reader is None and not source.json_lines


def number_rows(records: DataFrame, source: SourceSpec, offsets: DataFrame | None = None) -> DataFrame:
    """Adds ``file_row_number``; ``offsets`` are those of all records, if the given ones are not all."""
    if _has_positions(source):
        return records.withColumn("file_row_number", F.col(SEQUENCE) + first_row(source))
    return rows.add_row_number(records, rows.block_offsets(records) if offsets is None else offsets, first_row(source))


def drop_skipped(records: DataFrame, source: SourceSpec, offsets: DataFrame | None = None) -> DataFrame:
    """Leaves out the rows that the feed says to skip, such as units under the header."""
    if source.skip_rows == 0:
        return records
    if _has_positions(source):
        return records.filter(F.col(SEQUENCE) >= source.skip_rows)
    return rows.drop_first(records, rows.block_offsets(records) if offsets is None else offsets, source.skip_rows)


def staged(raw: DataFrame, source: SourceSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Raw records to stage rows: fields typed, errors and hash added."""
    place = ["source_filename", BLOCK, SEQUENCE, *carry]
    checked = validate.validate(raw, source.fields, carry=place, shape_error=F.col(SHAPE))
    return validate.with_verdict(checked, source)


def spread(raw: DataFrame, source: SourceSpec, runs: Sequence[dict]) -> DataFrame:
    """Spreads the records of files that Spark cannot split, where they are larger than a split.

    One task still reads each such file, but checking, hashing and writing is shared.
    """
    if source.format == "csv":
        whole = source.multiline and charset(source.encoding) not in SPLITTABLE
    else:
        whole = not source.json_lines
    size = sum(
        r["file_bytes"] * (GZIP_RATIO if r["path"].lower().endswith(".gz") else 1)
        for r in runs
        if whole or r["path"].lower().endswith(".gz")
    )
    parts = -(-size // SPLIT_BYTES)
    return raw.repartition(parts) if parts > len(runs) else raw


def _attempt(
    spark: SparkSession, source: SourceSpec, fresh: list[dict], warehouse: Warehouse, archive: bool
) -> list[tuple[dict, Exception]]:
    """Loads files together; those that could not be published even alone, and why."""
    now = _now()
    copied = [r for r in fresh if not r.get("archived")]
    if archive and copied:
        started = _now()
        discover.archive_raw(spark, [(r["path"], r["file_bytes"]) for r in copied], f"{warehouse.root}/raw/{source.table}")
        _phase(copied, "archive_copy", started)
        for run in copied:
            run["archived"] = True

    started = _now()
    stage_path = f"{warehouse.root}/stage/{source.table}-{uuid.uuid4().hex}"
    try:
        with steady_splits(spark):
            return _check_and_publish(spark, source, fresh, warehouse, stage_path, now, started)
    finally:
        remove_path(spark, stage_path)


def _check_and_publish(
    spark: SparkSession,
    source: SourceSpec,
    fresh: list[dict],
    warehouse: Warehouse,
    stage_path: str,
    now: datetime,
    started: datetime,
) -> list[tuple[dict, Exception]]:
    sizes = {r["path"]: r["file_bytes"] for r in fresh}
    raw, verdicts = scan(spark, source, list(sizes), stage_path, sizes)
    by_name = {r["source_filename"]: r for r in fresh}
    for verdict in verdicts:
        if verdict.error_type is not None:
            _fail(by_name[verdict.path.rsplit("/", 1)[-1]], verdict)
    if source.reader is None:
        seen = {v.path.rsplit("/", 1)[-1] for v in verdicts}
        for name, run in by_name.items():
            if name not in seen:
                run |= {"success": False, "error_type": "ValueError", "error_message": NO_DATA % name}
    open_runs = [r for r in fresh if r.get("success") is None]
    if raw is None or not open_runs:
        return []
    return _stage_and_publish(spark, source, raw, open_runs, warehouse, stage_path, now, started)


def _phase(runs: Sequence[dict], name: str, started: datetime, success: bool | None = True) -> None:
    ended = _now()
    for run in runs:
        run |= {f"{name}_started_at": started, f"{name}_ended_at": ended}
        if success is not None:
            run[f"{name}_success"] = success


def _stage_and_publish(
    spark: SparkSession,
    source: SourceSpec,
    raw: DataFrame,
    runs: list[dict],
    warehouse: Warehouse,
    stage_path: str,
    now: datetime,
    started: datetime,
) -> list[tuple[dict, Exception]]:
    by_name = {r["source_filename"]: r for r in runs}
    names = _files_frame(spark, runs)
    with short_methods(spark):
        records = spread(raw, source, runs)
        staged(records, source).join(names, "source_filename").write.parquet(f"{stage_path}/rows")
    everything = spark.read.parquet(f"{stage_path}/rows")
    offsets = None
    if source.skip_rows and not _has_positions(source):
        rows.block_offsets(everything).write.parquet(f"{stage_path}/offsets")
        offsets = spark.read.parquet(f"{stage_path}/offsets")
    stage = drop_skipped(everything, source, offsets)
    _phase(runs, "processing", started)
    _phase(runs, "stage_load", started)

    for run in runs:
        run |= {"records_processed": 0, "validation_errors": 0, "records_stage_loaded": 0}
    gate = validate.threshold_gate(validate.file_counts(stage), source.error_threshold)
    for row in gate.collect():
        run = by_name[row.source_filename]
        run |= {c: row[c] for c in ("records_processed", "validation_errors", "records_stage_loaded")}
        if row.error_type is not None:
            _fail(run, row)
            run |= {"processing_success": False, "stage_load_success": None}
    if any(r["validation_errors"] for r in runs):
        if offsets is None and not _has_positions(source):
            offsets = rows.block_offsets(everything)
        rejected = number_rows(stage.filter(~F.col("is_valid")), source, offsets)
        _publish_rejected(spark, source, rejected, runs, warehouse, now)

    started = _now()
    passed = [r for r in runs if r.get("success") is None]
    _audit(spark, source, stage, passed, stage_path)
    _phase([r for r in passed if r.get("success") is None], "audit", started)
    _phase([r for r in passed if r.get("success") is False], "audit", started, False)

    passed = [r for r in passed if r.get("success") is None]
    return _publish_isolated(spark, source, stage, passed, warehouse, now) if passed else []


def _publish_isolated(
    spark: SparkSession, source: SourceSpec, stage: DataFrame, runs: list[dict], warehouse: Warehouse, now: datetime
) -> list[tuple[dict, Exception]]:
    """Publishes the checked rows of files; if that breaks, halves the list until the bad file stands alone.

    Once the rows to publish are complete it goes on: they are published, if not at the first try then at the second, or
    by the next load.
    """
    started = _now()
    try:
        _publish(spark, source, stage, runs, warehouse, now)
    except Exception as error:
        if _is_fatal(spark, error):
            raise
        if warehouse.is_pending(source):
            log.warning("After the commit of %s", source.table, exc_info=True)
            _count(runs, warehouse.finish(source, F.lit(_now())))
        elif len(runs) > 1:
            log.warning("The staged files of %s are taken apart", source.table, exc_info=True)
            return [x for part in _halves(runs) for x in _publish_isolated(spark, source, stage, part, warehouse, now)]
        else:
            return [(runs[0], error)]
    _phase(runs, "merge", started)
    _published(spark, source, runs, warehouse)
    return []


def _publish_rejected(
    spark: SparkSession,
    source: SourceSpec,
    rejected: DataFrame,
    runs: list[dict],
    warehouse: Warehouse,
    now: datetime,
) -> None:
    """Dead letters of all files, failed ones too; samples go into the messages of failed files."""
    letters = logs.dead_letters(rejected, source.table, F.lit(now))
    warehouse.append_dead_letters(letters)
    failed = [r for r in runs if r.get("success") is False]
    if failed:
        mine = warehouse.dead_letters().join(_files_frame(spark, failed).drop("modified_at"), ["source_filename", "file_load_log_id"])
        by_name = {r["source_filename"]: r for r in failed}
        for row in validate.sample_texts(validate.sample_errors(mine)).collect():
            by_name[row.source_filename]["error_message"] += f" Sample validation errors: {row.sample_errors}"


def _audit(spark: SparkSession, source: SourceSpec, stage: DataFrame, runs: list[dict], work: str) -> None:
    """Key uniqueness first, then the declared audits for the files whose keys are unique."""
    if not runs:
        return
    by_name = {r["source_filename"]: r for r in runs}
    good = merge.passed_only(stage, _files_frame(spark, runs))
    stats = audit.unique_by_print(good, source.grain)
    bad = stats.filter("grain_unique = 0").collect()
    if bad:
        broken = spark.createDataFrame(bad, stats.schema)
        groups = audit.key_groups(good.join(broken.select("source_filename"), "source_filename", "left_semi"), source.grain)
        examples = audit.duplicate_examples(groups, source.grain)
        for row in audit.grain_messages(broken, examples, source.grain, source.grain_columns, source.table).collect():
            _fail(by_name[row.source_filename], row)
    left = [r for r in runs if r.get("success") is None]
    if not left:
        return
    names = _files_frame(spark, left)
    results = []
    if source.audit_sql:
        results.append(audit.audit_sql_by_file(spark, merge.passed_only(stage, names), names, source.audit_sql, work))
    if source.audits:
        results.append(audit.audit_by_file(merge.passed_only(stage, names), names, source.audits))
    for frame in results:
        for row in audit.failed_audits(frame, source.table).collect():
            _fail(by_name[row.source_filename], row)


def _publish(
    spark: SparkSession,
    source: SourceSpec,
    stage: DataFrame,
    runs: list[dict],
    warehouse: Warehouse,
    now: datetime,
) -> None:
    good = merge.passed_only(stage, _files_frame(spark, runs))
    latest = [F.desc("modified_at"), F.desc("source_filename"), F.desc(BLOCK), F.desc(SEQUENCE)] if len(runs) > 1 else []
    for run in runs:
        run |= {"publishing": True, "target_inserts": 0, "target_updates": 0}
    _count(runs, warehouse.upsert(source, good, F.lit(now), latest))


def _count(runs: list[dict], counts: DataFrame) -> None:
    by_id = {r["id"]: r for r in runs}
    for row in counts.collect():
        by_id[row.file_load_log_id] |= {c: row[c] for c in ("target_inserts", "target_updates")}


def _clear_old_rejects(source: SourceSpec, runs: list[dict], warehouse: Warehouse) -> None:
    """A file that now loaded keeps no dead letters of earlier runs: their partitions go."""
    names = _files_frame(warehouse.spark, runs).withColumnRenamed("file_load_log_id", "current_id")
    stale = (
        warehouse.dead_letters()
        .filter(F.col("target_table_name") == source.table)
        .select("source_filename", "file_load_log_id")
        .join(names, "source_filename")
        .filter(F.col("file_load_log_id") < F.col("current_id"))
        .select("file_load_log_id")
        .distinct()
    )
    warehouse.drop_dead_letters([r.file_load_log_id for r in stale.collect()])


def notifications(results: DataFrame, registry: Registry) -> DataFrame:
    """What to tell the owners of the feeds about a run's files."""
    owners = F.create_map(
        *[x for s in registry.sources for x in (F.lit(s.table), F.array(*map(F.lit, s.owners)).cast("array<string>"))]
    )
    return logs.notifications(results, owners[F.col("table_name")])


def back_out(warehouse: Warehouse, source: SourceSpec, source_filename: str) -> int:
    """Removes the rows a file last wrote, and notes it, so that the file can be loaded again; buckets written anew."""
    buckets = warehouse.remove_file(source, source_filename)
    runs = warehouse.run_log().filter((F.col("source_filename") == source_filename) & F.col("success")).collect()
    noted = [{"id": r.id, "success": False, "error_type": BACKED_OUT} for r in runs]
    if noted:
        _write_log(warehouse.spark, warehouse, noted)
    return buckets
