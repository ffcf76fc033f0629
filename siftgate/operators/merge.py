"""Upsert of staged rows into a target by key and row hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftgate.spec import STAGE_COLUMNS, TIMESTAMP_COLUMNS


def latest_per_key(stage: DataFrame, grain: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last one in ``order``.

    Spark keeps one row per key and task before the shuffle (``row_number() <= 1``).
    """
    window = Window.partitionBy(*grain).orderBy(*order)
    return stage.withColumn("key_rank", F.row_number().over(window)).filter("key_rank = 1").drop("key_rank")


# What the upsert does with a row: on either side alone, with another hash, with the same.
ACTION = """CASE WHEN t_row IS NULL THEN 'insert' WHEN s_row IS NULL THEN 'keep'
  WHEN t_etl_row_hash <> s_etl_row_hash THEN 'update' ELSE 'unchanged' END AS action"""


def _sides(target: DataFrame, stage: DataFrame, grain: Sequence[str]) -> tuple[DataFrame, DataFrame, Column]:
    t = target.selectExpr("true AS t_row", *[f"`{c}` AS `t_{c}`" for c in target.columns])
    s = stage.selectExpr("true AS s_row", *[f"`{c}` AS `s_{c}`" for c in stage.columns])
    return t, s, F.expr(" AND ".join(f"`t_{g}` = `s_{g}`" for g in grain))


def _merged(joined: DataFrame, columns: Sequence[str], now: Column) -> DataFrame:
    """Columns of the new target, chosen by ``action``; ``columns`` are the target's."""
    chosen = [
        F.expr(f"if(action IN ('insert', 'update'), `s_{c}`, `t_{c}`) AS `{c}`") for c in columns if c not in TIMESTAMP_COLUMNS
    ]
    created = F.when(F.col("action") == "insert", now).otherwise(F.col("t_etl_created_at"))
    updated = F.when(F.col("action") == "update", now).otherwise(F.col("t_etl_updated_at"))
    return joined.select(*chosen, created.alias("etl_created_at"), updated.alias("etl_updated_at"), "action")


def merge_frames(target: DataFrame, stage: DataFrame, grain: Sequence[str], now: Column) -> DataFrame:
    """The target after the upsert, with the ``action`` taken per row.

    Matched rows with another hash take all staged columns; matched rows with the same hash
    stay as they are, file name included; new keys are added. Keys must be unique on both sides.
    """
    t, s, on = _sides(target, stage, grain)
    return _merged(t.join(s, on, "full_outer").selectExpr("*", ACTION), target.columns, now)


def merge_small_stage(target: DataFrame, stage: DataFrame, grain: Sequence[str], now: Column) -> DataFrame:
    """Same rows as ``merge_frames`` without shuffling the target.

    For a stage below Spark's own broadcast threshold: a left join from the target, plus the
    staged keys that a key-only scan of the target does not find. Spark still decides by size
    whether to broadcast, so a wrong guess costs a shuffle and no more.
    """
    t, s, on = _sides(target, stage, grain)
    existing = _merged(t.join(s, on, "left").selectExpr("*", ACTION), target.columns, now)
    found = target.select(*grain).join(stage.select(*grain), list(grain), "left_semi")
    new = stage.join(found, list(grain), "left_anti")
    nothing = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `t_{f.name}`" for f in target.schema.fields]
    added = new.selectExpr(*[f"`{c}` AS `s_{c}`" for c in stage.columns], *nothing, "'insert' AS action")
    return existing.unionByName(_merged(added, target.columns, now))


def merge_actions(target: DataFrame, stage: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Staged rows with the action a merge would take; reads keys and hashes of the target only."""
    keys = target.select(*grain, F.col("etl_row_hash").alias("target_hash"))
    action = (
        F.when(F.col("target_hash").isNull(), "insert")
        .when(F.col("target_hash") != F.col("etl_row_hash"), "update")
        .otherwise("unchanged")
    )
    return stage.join(keys, list(grain), "left").withColumn("action", action).drop("target_hash")


def merge_counts(actions: DataFrame, by: Sequence[str] = ("source_filename",)) -> DataFrame:
    return actions.groupBy(*by).agg(
        F.count_if(F.col("action") == "insert").alias("target_inserts"),
        F.count_if(F.col("action") == "update").alias("target_updates"),
        F.count_if(F.col("action") == "unchanged").alias("target_unchanged"),
    )


def new_rows(target: DataFrame, stage: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Insert-only load: staged rows whose key the target does not have."""
    return stage.join(target.select(*grain), list(grain), "left_anti")


def passed_only(stage: DataFrame, passed_files: DataFrame) -> DataFrame:
    """Publish gate: good rows of files that passed every check."""
    return stage.filter("is_valid").join(passed_files.select("source_filename"), "source_filename", "left_semi")


def without_file(target: DataFrame, source_filename: str) -> DataFrame:
    """Back a file out: the target without the rows it last wrote."""
    return target.filter(~F.col("source_filename").eqNullSafe(F.lit(source_filename)))


def stage_columns(fields: Sequence[str]) -> list[str]:
    return [*fields, *STAGE_COLUMNS]
