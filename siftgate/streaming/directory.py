"""Watch a directory: each new file goes through the batch load once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siftgate.plans.load import load_files
from siftgate.sources.discover import describe_files, supported, unscanned_files
from siftgate.sources.paths import literal_paths
from siftgate.sources.tables import Warehouse
from siftgate.spec import Registry

FILE_ROW = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, directory: str, max_files: int | None = None, move_to: str | None = None) -> DataFrame:
    """Stream of file descriptions; contents are not read.

    With ``move_to`` Spark moves the files of a finished batch below that folder, under their full paths, as the
    next batch begins.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_ROW)
    if move_to is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", move_to)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return supported(describe_files(reader.load(literal_paths([directory])[0])))


def watch(
    spark: SparkSession,
    registry: Registry,
    directory: str,
    warehouse: Warehouse,
    checkpoint: str,
    max_files: int | None = None,
    archive: bool = True,
    available_now: bool = True,
    move_to: str | None = None,
) -> StreamingQuery:
    """Loads new files as they come, or all that are there now and then stops.

    A micro-batch may run again after a crash. That is harmless: a file that was published
    is recognised by name, and merging the same rows twice changes nothing. Files that no stream shows (of
    length zero, or named ``_..``) come with the next batch, once. With ``move_to`` the files of a batch leave the
    directory as the next one begins, so that listing costs what is new, not what ever came.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = unscanned_files(session, directory)
        unseen = describe_files(session.createDataFrame(rows, "path string, length long, modificationTime timestamp"))
        unseen = supported(unseen).join(warehouse.run_log().select("source_filename"), "source_filename", "left_anti")
        files = batch.unionByName(unseen.select(*batch.columns))
        if not files.isEmpty():
            load_files(session, registry, files, warehouse, archive)

    writer = new_files(spark, directory, max_files, move_to).writeStream.foreachBatch(publish)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
