"""Helpers the operators share: tables in the scratch folder, sums along a global order, joins with hot groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.session import scratch_path

# A word, as the contracts of several operators spell it.
WORD = r"[^\x20\x09-\x0D]+"

# Stands for a null id among whole numbers: below all others.
NULL_ID = -(1 << 63)

# A group with at least this share of all rows is hot; there can be no more than 1000 of them.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The same rows as a written table in the shared scratch folder: lineage ends there."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole(text: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def as_row(docs: DataFrame) -> Column:
    """All columns as one, so that helper columns cannot clash with them; ``select("_row.*")`` undoes it."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row")


def running(frame: DataFrame, order: Sequence[Column], sums: Mapping[str, str], label: str) -> DataFrame:
    """Adds totals along a global order: ``sums`` maps a new column to the column it adds up, the row included.

    The rows are range-sorted once and written; only one row per partition is summed in one place,
    so no key, however frequent, has to fit into a task.
    """
    cut = stored(frame.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)
    totals = cut.groupBy("_part").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_part", *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_start_{k}") for k in sums]
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[F.sum(v).over(inside).alias(f"_local_{k}") for k, v in sums.items()])
    # one row per partition of the range sort
    return local.join(F.broadcast(starts), "_part").select(
        *frame.columns, *[(F.col(f"_local_{k}") + F.col(f"_start_{k}")).alias(k) for k in sums]
    )


def with_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], count: str, spread: Column) -> DataFrame:
    """Left join of rows with a written table of their groups, whatever the size of a group.

    Groups with a thousandth of all grouped rows or more are at most 1000 and go to every task; their
    rows, and rows without a key, are spread by a salt that matches nothing. ``spread`` is any
    column with many values.
    """
    values = [c for c in groups.columns if c not in keys]
    total = groups.agg(F.sum(count)).first()[0] or 0
    hot = groups.filter(F.col(count) * HOT_SHARE >= F.lit(total))
    hot = hot.select(*keys, F.struct(*values).alias("_hot"))
    cold = groups.filter(F.col(count) * HOT_SHARE < F.lit(total))
    cold = cold.select(*keys, F.struct(*values).alias("_cold"), F.lit(0).cast("long").alias("_salt"))
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    salt = F.when(F.col("_hot").isNotNull() | keyless, F.pmod(F.xxhash64(spread), F.lit(1 << 20)) + 1).otherwise(0)
    joined = rows.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", salt.cast("long"))
    joined = joined.join(cold, [*keys, "_salt"], "left").withColumn("_group", F.coalesce("_hot", "_cold"))
    return joined.select(*rows.columns, *[F.col(f"_group.{v}").alias(v) for v in values])
