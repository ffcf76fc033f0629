"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.llm.common import WORD, as_row, running, stored, table, whole

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 20


def targets(sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources share the sum of all sizes by weight; none gets more than ``most`` times its size, and
    what it cannot take the others share by weight again. Sources fill up in the order of
    ``most * size / weight``, so two running sums tell where the level lies.
    """
    named = sizes.withColumn("_one", F.lit(1))
    ranked = running(named, [F.col("source").asc_nulls_last()], {"_rank": "_one"}, "op5-ranks")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    weighed = ranked.select("source", "source_size", weight.alias("_weight"), F.lit(most) * F.col("source_size"))
    weighed = weighed.toDF("source", "source_size", "_weight", "_cap").withColumn("_fill", F.col("_cap") / F.col("_weight"))
    order = [F.col("_fill").asc(), F.col("source").asc_nulls_last()]
    summed = stored(running(weighed, order, {"_caps": "_cap", "_weights": "_weight"}, "op5-fill"), "op5-caps")
    every = summed.agg(F.sum("source_size").alias("total"), F.sum("_weight").alias("all")).first()
    # the level if just the sources before this one are full; the first that it does not fill sets it
    left = F.lit(every["total"]) - (F.col("_caps") - F.col("_cap"))
    level = left / (F.lit(every["all"]) - (F.col("_weights") - F.col("_weight")))
    levels = summed.select("_fill", level.alias("_level")).filter("_fill >= _level")
    at = levels.agg(F.min(F.struct("_fill", "_level")).alias("at")).first()["at"]
    target = F.col("_cap").cast("double")
    if at is not None:
        target = F.least(target, F.lit(at["_level"]) * F.col("_weight"))
    return summed.select("source", "source_size", F.when(F.col("_cap") > 0, target).otherwise(0.0).alias("target"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, times`` of every document, in mix order, with ``source, text_hash``.

    The size is the number of words. Every source deals its documents in an order shuffled by a hash
    of id and text, up to ``most`` times over. A copy's virtual finish time is the words its source has
    dealt by then over the source's target; it is taken at its middle, so that the cut rounds to whole
    documents. As the targets add up to the budget, the sum of all sizes, the queue has served the
    budget at time 1 and is cut there; a cut by the sum of whole documents would let one long document take
    other sources' words. The rows are range-sorted by the time of their first copy, documents left out last.

    Null text has no words, a null source is a source of its own and comes last, documents of no
    words are taken like others (0 words), repeated rows are documents of their own, an empty
    table gives no rows, and other columns are not looked at.
    """
    text = whole(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"),
    )
    rows = stored(rows.withColumn("_turn", F.xxhash64(F.col("doc_id"), F.col("text_hash"), F.lit(seed))), "op5-words")
    by_source = [F.col("source").asc_nulls_last(), F.col("_turn").asc(), F.col("doc_id").asc(), F.col("size").asc()]
    dealt = stored(running(rows, by_source, {"_dealt": "size"}, "op5-order"), "op5-dealt")
    sizes = dealt.groupBy("source").agg(F.sum("size").alias("source_size"), F.min(F.col("_dealt") - F.col("size")).alias("_from"))
    sizes = stored(sizes, "op5-sizes")
    shares = targets(sizes.select("source", "source_size"), weights, most)
    shares = shares.withColumnRenamed("source", "_name")
    known = sizes.join(shares.drop("source_size"), sizes["source"].eqNullSafe(shares["_name"])).drop("_name")
    known = stored(known.withColumnRenamed("source", "_name"), "op5-targets")
    # Spark broadcasts the sources if their measured size allows it, and splits hot ones if not
    served = dealt.join(known, dealt["source"].eqNullSafe(known["_name"])).drop("_name")
    served = stored(served.withColumn("_end", F.col("_dealt") - F.col("_from")).drop("_dealt", "_from", "_turn"), "op5-served")

    turns = F.array(*[F.lit(i) for i in range(most)])
    times = F.transform(turns, lambda i: (i * F.col("source_size") + F.col("_end") - F.col("size") / 2) / F.col("target"))
    times = F.when(F.col("target") > 0, F.filter(times, lambda time: time <= 1)).otherwise(F.array().cast("array<double>"))
    found = served.withColumn("times", times).withColumn("_first", F.get("times", F.lit(0)))
    order = [F.col("_first").asc_nulls_last(), F.col("doc_id").asc(), F.col("text_hash").asc()]
    line = found.repartitionByRange(*order).sortWithinPartitions(*order)
    taken = (F.size("times") * F.col("size")).cast("long").alias("taken")
    return line.select("doc_id", "size", "source_size", "target", taken, "times", "source", "text_hash")


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The rows of the mix: every document as often as the mix takes it, all columns as they came."""
    found = stored(mix(docs, id_column, text_column, source_column, **options), "op5-mix")
    # the same row given twice has one line per copy here, and may have different shares of the mix
    ways = found.groupBy("doc_id", "source", "text_hash")
    ways = ways.agg(F.sum(F.size("times")).alias("_copies"), F.count("*").alias("_rows")).filter("_copies > 0")
    ways = ways.select(*[F.col(c).alias(f"_mix_{c}") for c in ("doc_id", "source", "text_hash")], "_copies", "_rows")
    marked = docs.select(
        as_row(docs), F.col(id_column).alias("_id"), F.col(source_column).alias("_source"), F.xxhash64(whole(text_column)).alias("_hash")
    )
    same = (
        marked["_id"].eqNullSafe(ways["_mix_doc_id"])
        & marked["_source"].eqNullSafe(ways["_mix_source"])
        & (marked["_hash"] == ways["_mix_text_hash"])
    )
    joined = marked.join(ways, same)
    share, rest = F.floor(F.col("_copies") / F.col("_rows")).cast("int"), F.col("_copies") % F.col("_rows")
    lots = share
    if ways.filter(rest != 0).limit(1).count():
        # rows that nothing tells apart: the first ones by position get the copies that are left over
        place = F.row_number().over(Window.partitionBy("_mix_doc_id", "_mix_source", "_mix_text_hash").orderBy(F.lit(1)))
        joined = joined.withColumn("_place", place)
        lots = share + F.when(F.col("_place") <= rest, 1).otherwise(0)
    return joined.withColumn("_lot", F.explode(F.array_repeat(F.lit(1), lots))).select("_row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")
