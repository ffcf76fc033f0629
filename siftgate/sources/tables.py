"""Where loaded data lives: targets, dead letters, run log; and the JDBC sink."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.operators import merge
from siftgate.operators.logs import DEAD_LETTERS, EVENT_NUMBER, RUN_EVENTS, RUN_LOG, fold_events
from siftgate.session import escaped, glob_paths, make_directory, move_path, path_exists, qualified, remove_path, setting
from siftgate.spec import TIMESTAMP_COLUMNS, SourceSpec

# Buckets of a target for which none are named: enough for a few gigabytes.
BUCKETS = 8
# Files of run events that are folded into one snapshot.
EVENT_FILES = 64
# Partition column of a target: the number of the bucket that a row's key falls into.
BUCKET = "etl_bucket"

PENDING_COUNTS = "file_load_log_id long, target_inserts long, target_updates long"
NAMES = "source_filename string, present boolean, noted_at long"


@dataclass(frozen=True)
class Warehouse:
    """Tables under one shared folder.

    A target is a table of the session's catalog over a folder here: partitioned by the bucket of its key and
    clustered into the same buckets, so that a merge joins it without an exchange and overwrites just the
    partitions that change. A table keeps the number of buckets it began with.

    Rows to publish are written to ``pending`` first. Once they are complete the load rolls forward: merging them
    again changes nothing, so whoever finds them after a break, this load or the next, merges them again.
    """

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def _folder(self, source: SourceSpec) -> tuple[str, int]:
        """Folder of a target, and its number of buckets."""
        for path in glob_paths(self.spark, f"{escaped(self.root)}/targets/{escaped(source.table)}/buckets-*"):
            return path, int(path.rsplit("-", 1)[-1])
        count = self.buckets or BUCKETS
        return f"{self.root}/targets/{source.table}/buckets-{count}", count

    def _table(self, source: SourceSpec) -> str:
        """Name of the target in the catalog. It is declared anew where the session or the fields are new."""
        folder, _ = self._folder(source)
        return self._declared(source, folder, source.to_struct().fields, partitioned=True)

    def _declared(self, source: SourceSpec, folder: str, fields: Sequence[T.StructField], partitioned: bool) -> str:
        """Name of a table over a folder, in the buckets of the target."""
        name = f"siftgate_{hashlib.md5(folder.encode()).hexdigest()}"
        columns = T.StructType([*fields, *([T.StructField(BUCKET, T.IntegerType())] if partitioned else [])])
        spark = self.spark
        if spark.catalog.tableExists(name):
            kept = [(f.name, f.dataType) for f in spark.table(name).schema]
            if kept == [(f.name, f.dataType) for f in columns]:
                spark.catalog.refreshTable(name)
                return name
            spark.sql(f"DROP TABLE {name}")  # the rows stay where they lie
        make_directory(spark, folder)
        keys = ", ".join(f"`{g}`" for g in source.grain)
        place = qualified(spark, folder).replace("\\", "\\\\").replace("'", "\\'")
        parts = f"PARTITIONED BY ({BUCKET})" if partitioned else ""
        with setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):  # partitions are what the folder has
            spark.sql(
                f"CREATE TABLE {name} ({columns.toDDL()}) USING parquet {parts} "
                f"CLUSTERED BY ({keys}) INTO {self._folder(source)[1]} BUCKETS LOCATION '{place}'"
            )
        return name

    def _partitions(self, source: SourceSpec) -> list[int]:
        folder, _ = self._folder(source)
        return sorted(int(p.rsplit("=", 1)[-1]) for p in glob_paths(self.spark, f"{escaped(folder)}/{BUCKET}=*"))

    def bucket(self, source: SourceSpec) -> Column:
        """The bucket that Spark puts a key into."""
        return F.pmod(F.hash(*source.grain), F.lit(self._folder(source)[1]))

    def target(self, source: SourceSpec, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a target, of all buckets or of some."""
        if not self._partitions(source):
            return empty_target(self.spark, source)
        rows = self.spark.table(self._table(source))
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        return rows.select(*source.to_struct().names)

    def touched(self, source: SourceSpec, rows: DataFrame) -> list[int]:
        """Buckets that rows lie in."""
        return sorted(r[0] for r in rows.select(self.bucket(source)).distinct().collect())

    def _overwrite(self, source: SourceSpec, rows: DataFrame) -> None:
        """Rows take the place of the buckets they lie in."""
        columns = [*source.to_struct().names, self.bucket(source).cast("int").alias(BUCKET)]
        with setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.select(*columns).write.mode("overwrite").insertInto(self._table(source))

    def commit(self, source: SourceSpec, rows: DataFrame) -> None:
        """Rows become the whole target."""
        before = self._partitions(source)
        spread = rows.repartition(self._folder(source)[1], *source.grain)
        self._overwrite(source, spread)
        self._drop(source, set(before) - set(self.touched(source, self.target(source))))
        self._note_files(source, self.target(source).select("source_filename").distinct())

    def _drop(self, source: SourceSpec, buckets: Iterable[int]) -> None:
        for number in buckets:
            remove_path(self.spark, f"{self._folder(source)[0]}/{BUCKET}={number}")

    def _put_back(self, source: SourceSpec) -> None:
        """Completes what a driver left that died while Spark was putting new partitions in the place of old ones.

        Spark removes a partition and moves the new one there from a folder beside it. A partition that is missing
        and lies in such a folder is moved; others are merged again, so that it does not matter which state they have.
        """
        folder, _ = self._folder(source)
        there = {f"{BUCKET}={n}" for n in self._partitions(source)}
        for staging in glob_paths(self.spark, f"{escaped(folder)}/.spark-staging-*"):
            for path in glob_paths(self.spark, f"{escaped(staging)}/{BUCKET}=*"):
                name = path.rsplit("/", 1)[-1]
                if name not in there:
                    move_path(self.spark, path, f"{folder}/{name}")
            remove_path(self.spark, staging)

    def _pending(self, source: SourceSpec) -> str:
        return f"{self.root}/pending/{source.table}"

    def is_pending(self, source: SourceSpec) -> bool:
        """Whether a load got as far as its commit, and no further."""
        return path_exists(self.spark, f"{self._pending(source)}/rows/_SUCCESS")

    def _pending_rows(self, source: SourceSpec) -> str:
        fields = [f for f in source.to_struct() if f.name not in TIMESTAMP_COLUMNS]
        return self._declared(source, f"{self._pending(source)}/rows", fields, partitioned=False)

    def upsert(self, source: SourceSpec, stage: DataFrame, now: Column, latest: Sequence[Column] = ()) -> DataFrame:
        """Publishes staged rows; ``file_load_log_id, target_inserts, target_updates`` of the runs.

        Staged rows are exchanged and written once, in the target's buckets and with the last row of a key if ``latest``
        says how they follow one another. That they are complete is the commit.
        """
        remove_path(self.spark, self._pending(source))
        make_directory(self.spark, f"{self._pending(source)}/rows")
        name = self._pending_rows(source)
        rows = stage.repartition(self._folder(source)[1], *source.grain)
        if latest:
            rows = merge.latest_per_key(rows, source.grain, latest)
        rows.select(*self.spark.table(name).columns).write.insertInto(name)
        return self.finish(source, now)

    def finish(self, source: SourceSpec, now: Column) -> DataFrame:
        """Merges the pending rows into the target: keys and hashes tell what changes, those buckets are overwritten.

        Both lie in the same buckets, so nothing is exchanged. If nothing changes nothing is written. Counts are those
        of the first time.
        """
        place = self._pending(source)
        # a task reads a bucket, also where Spark would see no need for it
        with setting(self.spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false"):
            counts = self._merge_pending(source, now)
        remove_path(self.spark, place)
        return self.spark.createDataFrame(counts, PENDING_COUNTS)

    def _merge_pending(self, source: SourceSpec, now: Column) -> list[Row]:
        place = self._pending(source)
        pending = self.spark.table(self._pending_rows(source))
        self._put_back(source)
        if self._partitions(source):
            existing = self.target(source, self.touched(source, pending))
            actions = merge.merge_actions(existing, pending, source.grain).filter(F.col("action") != "unchanged")
        else:
            existing, actions = None, pending.withColumn("action", F.lit("insert"))
        # one row per bucket and one per run
        summary = actions.withColumn(BUCKET, self.bucket(source)).groupingSets([[F.col(BUCKET)], [F.col("file_load_log_id")]], BUCKET, "file_load_log_id").agg(
            F.count_if(F.col("action") == "insert").alias("target_inserts"), F.count_if(F.col("action") == "update").alias("target_updates")
        )
        found = summary.collect()
        changed = sorted(r[BUCKET] for r in found if r[BUCKET] is not None)
        if not path_exists(self.spark, f"{place}/counts/_SUCCESS"):
            counted = [(r.file_load_log_id, r.target_inserts, r.target_updates) for r in found if r[BUCKET] is None]
            self.spark.createDataFrame(counted, PENDING_COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{place}/counts")
        counts = self.spark.read.schema(PENDING_COUNTS).parquet(f"{place}/counts").collect()  # one row per file
        if changed and existing is None:
            self._overwrite(source, pending.withColumns({"etl_created_at": now, "etl_updated_at": F.lit(None).cast("timestamp")}))
        elif changed:
            stage = pending.filter(self.bucket(source).isin(changed))
            self._overwrite(source, merge.merge_frames(self.target(source, changed), stage, source.grain, now))
        wrote = self.spark.createDataFrame([(r.file_load_log_id,) for r in counts], "file_load_log_id long")
        self._note_files(source, pending.select("file_load_log_id", "source_filename").distinct().join(wrote, "file_load_log_id").select("source_filename"))
        return counts

    def remove_file(self, source: SourceSpec, source_filename: str) -> int:
        """Takes out the rows a file last wrote; only their buckets are written anew. The number of those."""
        self._put_back(source)
        target = self.target(source)
        buckets = self.touched(source, target.filter(F.col("source_filename") == source_filename))
        if buckets:
            left = merge.without_file(self.target(source, buckets), source_filename)
            kept = self.touched(source, left)
            self._overwrite(source, left.repartition(self._folder(source)[1], *source.grain))
            self._drop(source, set(buckets) - set(kept))
        self._note_files(source, self.spark.createDataFrame([(source_filename,)], "source_filename string"), present=False)
        return len(buckets)

    def _note_files(self, source: SourceSpec, names: DataFrame, present: bool = True) -> None:
        noted = names.select("source_filename", F.lit(present).alias("present"), F.lit(time.time_ns()).cast("long").alias("noted_at"))
        noted.coalesce(1).write.mode("append").parquet(f"{self.root}/target_files/{source.table}")

    def loaded_files(self, source: SourceSpec) -> DataFrame:
        """``source_filename`` of the files that wrote rows to a target: a small table that every publication adds to."""
        place = f"{self.root}/target_files/{source.table}"
        if not path_exists(self.spark, place):
            if not self._partitions(source):
                return self.spark.createDataFrame([], "source_filename string")
            # a target that came without such a table gets it from one scan
            self._note_files(source, self.target(source).select("source_filename").distinct())
        noted = self.spark.read.schema(NAMES).parquet(place)
        return noted.groupBy("source_filename").agg(F.max_by("present", "noted_at").alias("present")).filter("present").select("source_filename")

    def _append(self, rows: DataFrame, name: str, *partitions: str) -> None:
        rows.write.mode("append").partitionBy(*partitions).parquet(f"{self.root}/{name}")

    def dead_letters(self) -> DataFrame:
        if not glob_paths(self.spark, f"{self.root}/file_load_dlq/file_load_log_id=*"):
            return self.spark.createDataFrame([], DEAD_LETTERS)
        return self.spark.read.schema(DEAD_LETTERS).parquet(f"{self.root}/file_load_dlq")

    def append_dead_letters(self, rows: DataFrame) -> None:
        """One partition per run of a file, so that cleaning up a file drops whole partitions.

        A run's rows lie in few files; a run with very many is still written by several tasks.
        """
        self._append(rows.hint("rebalance", F.col("file_load_log_id")), "file_load_dlq", "file_load_log_id")

    def drop_dead_letters(self, runs: list[int]) -> None:
        for run in runs:
            remove_path(self.spark, f"{self.root}/file_load_dlq/file_load_log_id={run}")

    def run_log(self) -> DataFrame:
        """The runs as their events left them."""
        return self._folded(self._run_events())

    def _folded(self, events: DataFrame) -> DataFrame:
        return fold_events(events, "id", EVENT_NUMBER, [c for c in RUN_LOG.names if c != "id"]).select(*RUN_LOG.names)

    def _log_snapshots(self) -> list[int]:
        """Numbers of the last events that are folded into a written table of runs, oldest first."""
        markers = glob_paths(self.spark, f"{escaped(self.root)}/file_load_log/folded/upto=*/_SUCCESS")
        return sorted(int(m.rsplit("/", 2)[-2].removeprefix("upto=")) for m in markers)

    def _event_files(self, since: int) -> list[str]:
        return glob_paths(self.spark, f"{escaped(self.root)}/file_load_log/since={since}/*.parquet")

    def _run_events(self) -> DataFrame:
        """The last snapshot, each of its runs as one event, and the events after it."""
        since = ([0] + self._log_snapshots())[-1]
        read = self.spark.read.schema(RUN_EVENTS)
        frames = [read.parquet(f"{self.root}/file_load_log/folded/upto={since}")] if since else []
        if self._event_files(since):
            frames.append(read.parquet(f"{self.root}/file_load_log/since={since}"))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], RUN_EVENTS)

    def append_run_log(self, rows: DataFrame) -> None:
        """Events: what has become known of runs. What an event does not know stays as it was."""
        since = ([0] + self._log_snapshots())[-1]
        numbered = rows.withColumn(EVENT_NUMBER, F.lit(time.time_ns()).cast("long"))
        numbered.coalesce(1).write.mode("append").parquet(f"{self.root}/file_load_log/since={since}")

    def fold_run_log(self, event_files: int = EVENT_FILES) -> bool:
        """Folds the log into a snapshot once its events lie in more files than that; new events start after it.

        Reading the log costs a snapshot and that many files, however many loads there were. The snapshot before
        the last one stays for readers that began with it.
        """
        snapshots = self._log_snapshots()
        if len(self._event_files(([0] + snapshots)[-1])) <= event_files:
            return False
        events = self._run_events()
        last = events.agg(F.max(EVENT_NUMBER)).first()[0]
        self._folded(events).withColumn(EVENT_NUMBER, F.lit(last).cast("long")).write.mode("overwrite").parquet(f"{self.root}/file_load_log/folded/upto={last}")
        for old in ([0] + snapshots)[:-1]:
            remove_path(self.spark, f"{self.root}/file_load_log/folded/upto={old}")
            remove_path(self.spark, f"{self.root}/file_load_log/since={old}")
        return True

    def next_run_id(self) -> int:
        """One more than any run in the log; runs are logged before they begin."""
        return (self._run_events().agg(F.max("id")).first()[0] or 0) + 1


def empty_target(spark: SparkSession, source: SourceSpec) -> DataFrame:
    # the limit makes Spark see at planning time that nothing is there, and drop joins with it
    return spark.createDataFrame([], source.to_struct()).limit(0)


def write_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 10_000,
    connections: int = 16,
    properties: dict[str, str] | None = None,
) -> None:
    """Publishes a table to a database in batches; ``connections`` bounds the parallel writers."""
    writer = rows.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", batch_size).option("numPartitions", connections)
    writer.options(**(properties or {})).save()
