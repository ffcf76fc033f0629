"""Exact top-k by inner product: tiled matrix products, selection per tile, merged as a tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.llm.common import stored, table

TOP = 5
# Vectors in a tile: bounds the product of a step to QUERY_ROWS x SHARD_STEP numbers.
QUERY_ROWS, SHARD_ROWS, SHARD_STEP = 2048, 16384, 2048
# Lists that one merge step takes together.
FAN_IN = 16
EXACT = 1 << 53
# Score of a query with itself: below all others.
OWN = -np.iinfo(np.int64).max


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal or unequal length as one matrix; missing places are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while every sum stays below 2**53."""
    width = min(queries.shape[1], rows.shape[1])
    queries, rows = queries[:, :width], rows[:, :width]
    most = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0))
    if most * max(width, 1) < EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row by row the places of the best scores, smaller ids first among equal ones."""
    if scores.shape[1] > top:
        least = -np.partition(-scores, top - 1, axis=1)[:, top - 1]
    else:
        least = np.full(len(scores), OWN)
    for i, bound in enumerate(least):
        places = np.flatnonzero(scores[i] >= bound)
        yield i, places[np.lexsort((ids[places], -scores[i, places]))][:top]


def _tile(top: int):
    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            query_ids, ids = left["_id"].to_numpy(), right["_row_id"].to_numpy()
            queries, rows = _matrix(left["_v"]), _matrix(right["_row"])
            best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)
            for start in range(0, len(ids), SHARD_STEP):
                part = ids[start : start + SHARD_STEP]
                scores = _scores(queries, rows[start : start + SHARD_STEP])
                scores[query_ids[:, None] == part[None, :]] = OWN
                for i, places in _best(scores, part, top):
                    keep = places[scores[i, places] != OWN]
                    known, values = best[i]
                    names = np.concatenate([known, part[keep]])
                    points = np.concatenate([values, scores[i, keep]])
                    order = np.lexsort((names, -points))[:top]
                    best[i] = names[order], points[order]
            out["query_id"] = np.repeat(query_ids, [len(n) for n, _ in best])
            out["vec_id"] = np.concatenate([n for n, _ in best])
            out["score"] = np.concatenate([s for _, s in best])
        shard = right["_shard"][0].as_py() if right.num_rows else 0
        size = len(out["query_id"])
        return pa.table(
            {
                "query_id": pa.array(out["query_id"], pa.int64()),
                "vec_id": pa.array(out["vec_id"], pa.int64()),
                "score": pa.array(out["score"], pa.int64()),
                "list": pa.array(np.full(size, shard, dtype=np.int64)),
            }
        )

    return tile


def _kept(lists: DataFrame, keys: list[str], top: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return lists.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def top_k(
    vectors: DataFrame,
    is_query: str,
    top: int = TOP,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's best rows by integer inner product, its own left out.

    Components become ``floor(scale * x)``. Queries and rows are dealt into tiles; a task multiplies
    one tile of queries with one shard of rows and keeps the best of each query, and the lists of the
    shards are merged sixteen at a time. ``is_query`` is a SQL condition.

    Vectors that are null or hold null or non-finite components take no part, nor do null ids; rows
    that repeat id and vector count once, all rows of the query's id are its own; shorter vectors
    count as filled up with zeros; scores are 64-bit whole numbers; equal ones go to the smaller id; an empty table gives no rows;
    other columns are not looked at.
    """
    vector = F.col(vector_column)
    # null for a null component, so that the filter drops those vectors too
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(id_column).isNotNull() & finite)
    whole_numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = rows.select(F.col(id_column).cast("long").alias("_id"), whole_numbers.alias("_v"), F.expr(is_query).alias("_asks"))
    rows = stored(rows.dropDuplicates(["_id", "_v"]), "op9-rows")
    asked, every = rows.filter("_asks").count(), rows.count()
    tiles, shards = max(1, math.ceil(asked / QUERY_ROWS)), max(1, math.ceil(every / SHARD_ROWS))
    own = F.pmod(F.xxhash64("_id"), F.lit(tiles)).cast("long")
    shard = F.pmod(F.xxhash64(F.lit(9), "_id", "_v"), F.lit(shards)).cast("long")
    all_tiles, all_shards = (F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) for n in (tiles, shards))
    left = rows.filter("_asks").select("_id", "_v", own.alias("_tile"), all_shards.alias("_shard"))
    right = rows.select(F.col("_id").alias("_row_id"), F.col("_v").alias("_row"), all_tiles.alias("_tile"), shard.alias("_shard"))
    pairs = left.groupBy("_tile", "_shard").cogroup(right.groupBy("_tile", "_shard"))
    lists = pairs.applyInArrow(_tile(top), "query_id long, vec_id long, score long, list long")
    while shards > 1:
        shards = math.ceil(shards / FAN_IN)
        lists = lists.withColumn("list", F.floor(F.col("list") / FAN_IN))
        lists = _kept(lists, ["query_id", "list"], top).drop("rank")
    return _kept(lists, ["query_id"], top).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
