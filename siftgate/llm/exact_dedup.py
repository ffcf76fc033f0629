"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.llm.common import as_row, stored, table, whole, with_groups

# Marks of one refinement step: a step sends at most so many rows to every task.
MARKS = 1 << 20


def _several(marks: DataFrame) -> DataFrame:
    """Marks that more than one row has. At most MARKS rows."""
    return F.broadcast(marks.groupBy("_mark").count().filter("count > 1").select("_mark"))


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix: int = 256,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept`` and the carried expressions.

    Texts are equal when all characters are; of equal ones the largest id stays. Length and prefix
    hash come from one scan. A second scan hashes whole texts, and only of rows whose length and
    prefix some other row shares. What a step hands to the next is a set of marks from a fixed range,
    so a stray mark costs a hash but never a result.

    Null text counts as empty, null ids sort below all others, a repeated row is kept once, an empty
    table gives no rows, and other columns are not looked at.
    """
    text = whole(text_column)
    length = F.octet_length(text).cast("long")
    start = F.xxhash64(length, F.substring(text, 1, prefix))
    first = stored(docs.select(length.alias("_length"), start.alias("_start")), "op10-first")
    by_length = first.withColumn("_mark", F.pmod("_length", F.lit(MARKS)))
    same_length = by_length.join(_several(by_length), "_mark", "left_semi")
    by_start = same_length.withColumn("_mark", F.pmod("_start", F.lit(MARKS)))
    shared = stored(by_start.groupBy("_mark").count().filter("count > 1").select("_mark"), "op10-marks")

    carried = {f"_carry_{n}": c for n, c in (carry or {}).items()}
    marked = docs.select(
        F.col(id_column).alias("_id"),
        text.alias("_text"),
        F.pmod(start, F.lit(MARKS)).alias("_mark"),
        *[c.alias(n) for n, c in carried.items()],
    )
    marked = marked.join(F.broadcast(shared.withColumn("_open", F.lit(True))), "_mark", "left")
    rows = marked.select(
        "_id",
        F.monotonically_increasing_id().alias("_row"),
        F.when(F.col("_open"), F.sha2(F.col("_text").cast("binary"), 256)).alias("_hash"),
        *carried,
    )
    rows = stored(rows, "op10-rows")
    groups = rows.filter("_hash IS NOT NULL").groupBy("_hash")
    groups = groups.agg(F.max(F.struct("_id", "_row")).alias("_keep"), F.count("*").alias("_size"))
    groups = stored(groups.filter("_size > 1"), "op10-groups")
    found = with_groups(rows, groups, ["_hash"], "_size", F.col("_row"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_keep._row") == F.col("_row"), F.lit(True)).alias("kept"),
        *[F.col(f"_carry_{n}").alias(n) for n in (carry or {})],
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, all columns as they came."""
    digest = F.sha2(whole(text_column).cast("binary"), 256)
    found = stored(exact_dedup(docs, id_column, text_column, carry={"_digest": digest}), "op10-found")
    kept = found.filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("_digest").alias("_kept_digest"))
    marked = docs.select(as_row(docs), F.col(id_column).alias("_id"), digest.alias("_digest"))
    same = marked["_id"].eqNullSafe(kept["_kept_id"]) & (marked["_digest"] == kept["_kept_digest"])
    left = marked.join(kept, same, "left_semi")
    repeated = found.groupBy("doc_id", "_digest").count().filter("count > 1").limit(1).count()
    if repeated:  # the very same row more than once: neither id nor text tells which one stayed
        left = left.dropDuplicates(["_id", "_digest"])
    return left.select("_row.*")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(whole("text").cast("binary"), 256)
    return exact_dedup(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
