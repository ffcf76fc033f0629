"""Many small values as one row: what a batch of documents sends to one task of an exchange."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard


def portions(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where a column's bytes add up to about ``size``."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size)))
            yield batch.slice(at, end - at)
            at = end


def planes(values: np.ndarray) -> bytes:
    """Differences of whole numbers, byte by byte, so that what is alike lies together."""
    return np.diff(values.astype(np.int64), prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def values_of(planes: bytes) -> np.ndarray:
    raw = np.frombuffer(planes, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(raw).view("<i8").ravel())


def packed(columns: list[np.ndarray], blob: bytes = b"") -> bytes:
    parts = [planes(c) for c in columns] + [blob]
    head = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.compress(head + b"".join(parts), 3)


def unpacked(row: bytes, columns: int) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.decompress(row)
    at = 8 * (columns + 1)
    parts = []
    for size in np.frombuffer(raw[:at], "<i8").tolist():
        parts.append(raw[at : at + size])
        at += size
    return [values_of(p) for p in parts[:-1]], parts[-1]


def sliced(keys: np.ndarray, ranges: int, bits: int) -> list[tuple[int, slice]]:
    """Stretches of sorted keys in equal ranges of the key, found by binary search."""
    edges = np.array([(1 << bits) * i // ranges for i in range(ranges + 1)], dtype=np.int64)
    cuts = np.searchsorted(keys, edges)
    return [(i, slice(a, b)) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


ROW = "shard long, known boolean, rows binary"


def packed_rows(shards, known, rows) -> pa.RecordBatch:
    columns = [pa.array(shards, pa.int64()), pa.array(known, pa.bool_()), pa.array(rows, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "known", "rows"])
