"""Shards of near equal bytes by a histogram sort: probe, count exactly, refine, exchange once."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.llm.common import stored, table, whole

SHARDS = 24
# Allowed error of a boundary, as a share of one shard's bytes.
TOLERANCE = 0.001
# Probes per boundary and round: a round narrows every bracket by this factor.
PROBES = 16
# Rows one task numbers at most, about.
ROWS_PER_CELL = 100_000
# Low bits of the second key, by which rows of one text and one id differ.
COPY_BITS = (1 << 24) - 1
LOW, HIGH = -(1 << 63), (1 << 63) - 1  # ends of the keys' range


def _cell(key: str, probes: list[int]):
    """Number of probes at or below the key, as a column."""
    edges = np.array(probes, dtype=np.int64)

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.searchsorted(edges, batch.to_numpy(), side="right").astype(np.int32))

    return place(F.col(key))


def _histogram(rows: DataFrame, key: str, probes: list[int]) -> list[tuple[int, int, int, int]]:
    """Non-empty cells between probes: ``least key, greatest key, exact bytes below the cell, and up to its end``."""
    cells = rows.groupBy(_cell(key, probes).alias("cell"))
    cells = cells.agg(F.min(key), F.max(key), F.sum("size")).collect()  # one row per probe
    found, below = [], 0
    for _, least, most, size in sorted(cells):
        found.append((least, most, below, below + size))
        below += size
    return found


def _search(rows: DataFrame, key: str, aims: list[int], slack: float) -> list[tuple[int, int, int, int]]:
    """For every aim a bracket ``low, bytes below low, high, bytes below high``, one key wide or with an end close enough."""
    ends = rows.agg(F.min(key), F.max(key), F.sum("size")).first()
    brackets = [(ends[0], 0, ends[1] + 1, ends[2]) for _ in aims]

    def is_open(aim, bracket):
        low, at_low, high, at_high = bracket
        return high - low > 1 and min(abs(aim - at_low), abs(at_high - aim)) > slack

    while True:
        probes = set()
        for aim, bracket in zip(aims, brackets):
            if is_open(aim, bracket):
                low, _, high, _ = bracket
                probes.update(low + (high - low) * i // (PROBES + 1) for i in range(PROBES + 2))
        if not probes:
            return brackets
        cells = _histogram(rows, key, sorted(p for p in probes if p <= HIGH))
        for i, (aim, bracket) in enumerate(zip(aims, brackets)):
            if is_open(aim, bracket):
                least, most, below, upto = next(c for c in cells if c[3] > aim)
                brackets[i] = (least, below, most + 1, upto)


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """``shards - 1`` boundaries ``(key, tie)``: a row lies below one if its ``(_key, _tie)`` does.

    The boundary is put between two keys, so that equal texts stay together, if that meets the tolerance;
    only then is the one key in the way cut by its second part.
    """
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return []
    aims = [total * i // shards for i in range(1, shards)]
    slack = tolerance * total / shards
    found: list[tuple[int, int] | None] = [None] * len(aims)
    cut: dict[int, list[tuple[int, int]]] = {}
    for i, (aim, (low, at_low, high, at_high)) in enumerate(zip(aims, _search(rows, "_key", aims, slack))):
        near = min((abs(aim - at_low), low), (abs(at_high - aim), high))
        if near[0] <= slack or high - low > 1:
            found[i] = (near[1], LOW)
        else:
            cut.setdefault(low, []).append((i, aim - at_low))
    for key, wanted in cut.items():  # at most one key per boundary
        inside = rows.filter(F.col("_key") == F.lit(key))
        brackets = _search(inside, "_tie", [aim for _, aim in wanted], slack)
        for (i, aim), (low, at_low, high, at_high) in zip(wanted, brackets):
            tie = min((abs(aim - at_low), low), (abs(at_high - aim), high))[1]
            found[i] = (key, tie) if tie <= HIGH else (key + 1, LOW)
    return sorted(found)


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: near equal bytes per shard, slots gapless from 0.

    The sort key is a hash of the text, then one of the id, then one of the row's number, fixed once the keys are
    written: a boundary can lie between equal rows too. Every round counts the exact bytes below
    all candidate boundaries in one map-side combined aggregate and narrows the brackets, until each
    boundary is within the tolerance or lies between two neighbouring keys. Then the rows are exchanged
    once, by shard and by a cell that an even hash picks, so no group of equal texts decides how many
    rows a task numbers.

    A null text has 8 bytes like an empty one and checksum 0; null ids are a key like any other;
    repeated rows get slots of their own; an empty table gives no rows; other columns are not looked at.
    """
    text = whole(text_column).cast("binary")
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_key"),
        F.xxhash64(F.lit(4), F.col(id_column)).bitwiseAND(F.lit(~COPY_BITS))
        .bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(COPY_BITS))).alias("_tie"),
    )
    rows = stored(rows, "op4-keys")
    edges = splitters(rows, shards, tolerance)
    keys = np.array([k for k, _ in edges], dtype=object)
    ties = np.array([t for _, t in edges], dtype=object)

    @F.pandas_udf("int")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        shard = np.zeros(len(key), dtype=np.int32)
        for k, t in zip(keys, ties):  # a boundary each
            shard += k <= HIGH and (key.to_numpy() > k) | ((key.to_numpy() == k) & (tie.to_numpy() >= t))
        return pd.Series(shard)

    cells = max(16, math.ceil(rows.count() / shards / ROWS_PER_CELL))
    dealt = rows.withColumn("shard", place("_key", "_tie"))
    dealt = dealt.withColumn("_cell", F.pmod(F.xxhash64("_tie", "_key"), F.lit(cells)).cast("int"))
    dealt = stored(dealt, "op4-dealt")
    cell = dealt.groupBy("shard", "_cell").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cell.select("shard", "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy("shard", "_cell").orderBy("_key", "_tie", "doc_id")
    numbered = dealt.withColumn("_place", F.row_number().over(order))
    # one row per shard and cell
    slots = numbered.join(F.broadcast(starts), ["shard", "_cell"])
    return slots.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_place") - 1).cast("long").alias("slot")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_documents(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
