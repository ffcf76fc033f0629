"""Near duplicates by SimHash: fingerprints of shingles, linked by a binary trie self-join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.llm.common import as_row, stored, table, whole, with_groups
from siftgate.llm.components import components

SHINGLE, SEED, BITS = 4, 42, 64
DISTANCE = 4
# Fingerprints that one task joins, about; and the size from which one bucket is split again.
CELL_ROWS, BUCKET_ROWS = 32_768, 131_072
LEAST_CELLS = 64
# Node pairs held at once; more are worked off piece by piece.
FRONTIER = 1 << 21


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 majority bits of the hashes of all word shingles; 0 without words."""
    words = text.encode().lower().split()  # of bytes: lowers A-Z only, splits at the six ASCII white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends.tolist()
    last = ends[min(shingle, len(words)) - 1 :]
    hashed = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, last)]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashed), 1 << 16):
        part = np.array(hashed[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashed)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def trie_links(keys: np.ndarray, prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of fingerprints with one key and at most ``distance`` differing bits.

    The sorted fingerprints are a binary trie: a node is a stretch that shares a key and leading bits.
    Pairs of nodes go down together, from each key's root paired with itself. Where the two branches
    differ a pair's error grows by one, and it is dropped once the error passes the distance. A pair of
    leaves is finished by counting the differing bits at once. Input is sorted by key, fingerprint.
    """
    n = len(prints)
    fresh = np.concatenate([[True], keys[1:] != keys[:-1]]) if n else np.zeros(0, bool)
    low = np.flatnonzero(fresh)
    high = np.append(low[1:], n)
    wide = high - low > 1
    stack = [(BITS - 1, low[wide], high[wide], low[wide], high[wide], np.zeros(wide.sum(), np.int8))]
    while stack:
        bit, a0, a1, b0, b1, error = stack.pop()
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            for part in (slice(0, half), slice(half, None)):
                stack.append((bit, a0[part], a1[part], b0[part], b1[part], error[part]))
            continue
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1) & (a0 != b0)
        if leaf.any():
            a, b = a0[leaf], b0[leaf]
            close = _popcount(prints[a] ^ prints[b]) <= distance
            if close.any():
                yield a[close], b[close]
        go = ~leaf & ~((a0 == b0) & (a1 - a0 == 1))
        a0, a1, b0, b1, error = a0[go], a1[go], b0[go], b1[go], error[go]
        if not len(a0):
            continue
        split_a, split_b = _split(prints, a0, a1, bit), _split(prints, b0, b1, bit)
        same = a0 == b0
        branches = (
            (a0, split_a, b0, split_b, error),
            (split_a, a1, split_b, b1, error),
            (a0, split_a, split_b, b1, error + 1),
            (split_a, a1, b0, split_b, np.where(same, distance + 1, error + 1)),  # a pair with itself: one of the two
        )
        down = [np.concatenate(parts) for parts in zip(*branches)]
        keep = (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= distance)
        stack.append((bit - 1, *[x[keep] for x in down]))


def _split(prints: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """First place in each stretch whose bit is set; all stretches share the bits above."""
    low, high = low.copy(), high.copy()
    mask = np.uint64(1 << bit)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        is_set = (prints[np.minimum(middle, len(prints) - 1)] & mask) != 0
        high = np.where(open_ & is_set, middle, high)
        low = np.where(open_ & ~is_set, middle + 1, low)


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Least place reachable, given links and what is known already."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _cell_links(distance: int):
    def join(cell: pa.Table) -> pa.Table:
        """Within a task's buckets: each linked fingerprint with the least of its group."""
        keys, prints = cell["key"].to_numpy(), cell["print"].to_numpy().view(np.uint64)
        order = np.lexsort((prints, keys))
        keys, prints = keys[order], prints[order]
        root = np.arange(len(prints))
        for a, b in trie_links(keys, prints, distance):
            root = _roots(len(prints), a, b, root)
        moved = np.flatnonzero(root != np.arange(len(prints)))
        return pa.table({"a": prints[moved].view(np.int64), "b": prints[root[moved]].view(np.int64)})

    return join


def _masks(bits: list[int], parts: int) -> list[int]:
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _bucketed(prints: DataFrame, distance: int) -> DataFrame:
    """``key, print``: two fingerprints within the distance share a key, as they agree in one of distance + 1 parts.

    The fingerprints of a large bucket are cut again, by the same rule, in the bits that its key leaves open.
    """
    masks = _masks(list(range(BITS)), distance + 1)
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(masks)]))
    dealt = prints.select("print", parts.alias("_p"))
    dealt = dealt.select(F.xxhash64("_p.part", F.col("print").bitwiseAND(F.col("_p.mask"))).alias("key"), "print", "_p.part")
    dealt = stored(dealt, "op3-buckets")
    sizes = dealt.groupBy("key").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > BUCKET_ROWS)
    sizes = stored(sizes, "op3-large")
    if not sizes.limit(1).count():
        return dealt.select("key", "print")
    found = with_groups(dealt, sizes, ["key"], "_rows", F.col("print"))
    cuts = []
    for mask in masks:
        rest = [b for b in range(BITS) if not mask >> b & 1]
        cuts.append(F.array(*[F.lit(_signed(m)) for m in _masks(rest, distance + 1)]))
    again = found.filter("_rows IS NOT NULL")
    again = again.select("key", "print", F.posexplode(F.element_at(F.array(*cuts), F.col("part") + 1)).alias("_i", "_mask"))
    again = again.select(F.xxhash64("key", "_i", F.col("print").bitwiseAND(F.col("_mask"))).alias("key"), "print")
    return stored(found.filter("_rows IS NULL").select("key", "print").union(again), "op3-buckets")


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links that join up all distinct fingerprints within the distance, at most one per bucket and fingerprint."""
    rows = _bucketed(prints, distance)
    cells = max(LEAST_CELLS, math.ceil(rows.count() / CELL_ROWS))
    dealt = rows.withColumn("cell", F.pmod("key", F.lit(cells)))
    return dealt.groupBy("cell").applyInArrow(_cell_links(distance), "a long, b long")


def _printer(shingle: int, seed: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle, seed) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["doc_id", "text_hash", "print"])

    return fingerprints


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, text_hash, print, component_id, kept``: every document with the smallest id it is linked to.

    Fingerprints link at ``distance`` or fewer differing bits; documents of one fingerprint are
    linked, also those without words (fingerprint 0). Fingerprints are gathered before anything else, so
    copies cost one row. Of a component the document with the smallest id (then text hash) is kept.

    Null and empty texts have fingerprint 0, null ids sort first among kept ones and never name a
    component, rows that repeat id and text are one document, an empty table gives no rows, and other
    columns are not looked at.
    """
    text = whole(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = rows.mapInArrow(_printer(shingle, seed), "doc_id long, text_hash long, print long")
    rows = stored(rows, "op3-prints")
    first = F.min(F.struct("doc_id", "text_hash")).alias("_first")
    prints = rows.groupBy("print").agg(F.min("doc_id").alias("_least"), first, F.count("*").alias("_size"))
    prints = stored(prints, "op3-distinct")
    roots = components(fingerprint_links(prints.select("print"), distance)).withColumnRenamed("node", "print")
    nodes = prints.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    nodes = stored(nodes, "op3-nodes")
    parts = nodes.groupBy("root").agg(F.min("_least").alias("component_id"), F.min("_first").alias("_keep"), F.count("*").alias("_nodes"))
    known = with_groups(nodes.select("print", "root", "_size"), stored(parts, "op3-parts"), ["root"], "_nodes", F.col("print"))
    known = stored(known.select("print", "component_id", "_keep", "_size"), "op3-known")
    found = with_groups(rows, known, ["print"], "_size", F.xxhash64("doc_id", "text_hash"))
    kept = F.col("_keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_keep.text_hash") == F.col("text_hash"))
    return found.select("doc_id", "text_hash", "print", "component_id", kept.alias("kept"))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One document of each component, all columns as they came."""
    found = stored(near_duplicates(docs, id_column, text_column, **options), "op3-found")
    kept = found.filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"))
    digest = F.xxhash64(whole(text_column))
    marked = docs.select(as_row(docs), F.col(id_column).cast("long").alias("_id"), digest.alias("_hash"))
    same = marked["_id"].eqNullSafe(kept["_kept_id"]) & (marked["_hash"] == kept["_kept_hash"])
    left = marked.join(kept, same, "left_semi")
    if kept.groupBy("_kept_id", "_kept_hash").count().filter("count > 1").limit(1).count():
        left = left.dropDuplicates(["_id", "_hash"])  # one document given several times
    return left.select("_row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    printed = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")
