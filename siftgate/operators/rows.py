"""Row numbers inside a file without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A reader hands every record its file, the byte offset of its split, and an id that rises
# inside the split. Split and id alone order the records of a file; the number needs counts.
BLOCK, SEQUENCE = "file_block", "block_sequence"


def block_offsets(rows: DataFrame, by: str = "source_filename") -> DataFrame:
    """Per split: its lowest id and how many records of the file come before it.

    One output row per split (about 128 MB of input), so the running sum sorts metadata only.
    """
    blocks = rows.groupBy(by, BLOCK).agg(F.min(SEQUENCE).alias("first_sequence"), F.count("*").alias("block_rows"))
    before = Window.partitionBy(by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        by, BLOCK, "first_sequence", F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before")
    )


def add_row_number(rows: DataFrame, offsets: DataFrame, first_row: int, by: str = "source_filename") -> DataFrame:
    """Adds ``file_row_number``, where the first record of a file gets ``first_row``.

    Spark broadcasts the offsets while they are small; beyond that the join shuffles by
    (file, split), whose groups are one split at most.
    """
    number = F.col("rows_before") + F.col(SEQUENCE) - F.col("first_sequence") + first_row
    return (
        rows.join(offsets, [by, BLOCK])
        .withColumn("file_row_number", number.cast("bigint"))
        .drop("first_sequence", "rows_before")
    )


def drop_first(rows: DataFrame, offsets: DataFrame, count: int, by: str = "source_filename") -> DataFrame:
    """Drops the first ``count`` records of every file. Only the splits they lie in are joined."""
    first = offsets.filter(F.col("rows_before") < count)
    place = F.col("rows_before") + F.col(SEQUENCE) - F.col("first_sequence")
    kept = rows.join(first, [by, BLOCK], "left").filter(F.col("rows_before").isNull() | (place >= count))
    return kept.drop("first_sequence", "rows_before")
