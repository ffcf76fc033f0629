"""Sequences of neighbouring documents: tokens, a Hilbert key of the hashed document vector, one range sort."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.llm.common import table, whole
from siftgate.session import scratch_path

LENGTH = 1024
END = 0
# Dimensions of the projection and bits of each: together the bits of the key.
DIMS, BITS = 4, 15
# Projections of this many standard units fill most of a dimension's range.
SPREAD = 4.0
# Longer texts go through the tokenizers library itself: the faster one may recurse on them.
LONG_TEXT = 200_000
RANKS, TOKENIZER = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
# Sequence numbers of a task: its own in the upper bits.
SEQUENCE_BITS = 40


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _special(path: str) -> list[str]:
    return [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]


@functools.cache
def _ranks(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, path: str, ranks_path: str | None) -> np.ndarray:
    """Ids of a text without special tokens added, then the end id.

    The two files hold one vocabulary; the ranks give the same ids several times faster. A text that
    spells a special token, or a very long one, is left to the tokenizer file.
    """
    if ranks_path is None or len(text) > LONG_TEXT or any(s in text for s in _special(path)):
        ids = _tokenizer(path).encode(text, add_special_tokens=False).ids
    else:
        ids = _ranks(ranks_path).encode_ordinary(text)
    ids.append(END)
    return np.array(ids, dtype="<u4")


@functools.cache
def _signs(size: int = 1 << 16) -> np.ndarray:
    """Signs of each hashed token id in DIMS dimensions, 0 or 1 each, side by side in one number."""
    hashed = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    return sum(((hashed >> np.uint64(40 + i)) & np.uint64(1)) << np.uint64(16 * i) for i in range(DIMS))


def project(ids: np.ndarray) -> np.ndarray:
    """Mean of the tokens' sign vectors, -1 to 1."""
    sums = np.zeros(DIMS)
    for at in range(0, len(ids), (1 << 16) - 1):  # no dimension can run over
        side_by_side = int(_signs()[ids[at : at + (1 << 16) - 1] & 0xFFFF].sum())
        sums += [side_by_side >> 16 * i & 0xFFFF for i in range(DIMS)]
    return 2 * sums / max(1, len(ids)) - 1


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (rows), all rows at once.

    From the highest bit down: a dimension's set bit inverts the first dimension's lower bits, a clear
    one swaps them with its own; then neighbouring dimensions are Gray-coded and the bits interleaved.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        lower = bit - 1
        for i in range(dims):
            is_set = (x[i] & bit) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & lower)
            x[0] ^= np.where(is_set, lower, swap)
            x[i] ^= swap if i else 0
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _encoder(path: str, ranks_path: str | None):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, ids = [], []
            for text in batch.column(1).to_pylist():
                found = token_ids(text, path, ranks_path)
                points.append(project(found))
                # ids of this vocabulary fit into two bytes
                ids.append((found.astype("<u2") if not len(found) or found.max() < 1 << 16 else found).tobytes())
                ids[-1] += b"\x02" if len(ids[-1]) == 2 * len(found) else b"\x04"
            cells = np.tanh(np.array(points).reshape(-1, DIMS) * SPREAD) * 0.5 + 0.5
            keys = hilbert_keys(np.minimum((cells * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))
            columns = [batch.column(0).cast(pa.int64()), pa.array(keys), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "_key", "_ids"])

    return encode


def _unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids[:-1], dtype=f"<u{ids[-1]}")


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, row_id long"
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def _packer(length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts the stream of a task's documents every ``length`` ids; the rest into powers of two."""
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        row, offset = sequence - 1, 0
        rows: list[tuple] = []
        waiting: list[tuple] = []  # pieces of the sequence that is not full yet

        def piece(doc, start, ids, total, row, number, at):
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            return doc, start, len(ids), crc, total, number, at, row

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(NAMES)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

        for batch in batches:
            for doc, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = _unpacked(packed.as_py())
                start, row = 0, row + 1
                while start < len(ids):
                    part = ids[start : start + length - offset]
                    waiting.append((doc, start, part, len(ids), row, offset))
                    start, offset = start + len(part), offset + len(part)
                    if offset == length:
                        rows.extend(piece(*w[:5], sequence, w[5]) for w in waiting)
                        waiting.clear()
                        sequence, offset = sequence + 1, 0
            yield flushed()
        size = 1 << max(0, offset.bit_length() - 1)
        at = 0
        for doc, start, part, total, number, _ in waiting:
            while len(part):
                cut = part[: size - at]
                rows.append(piece(doc, start, cut, total, number, sequence, at))
                offset -= len(cut)
                start, part, at = start + len(cut), part[len(cut) :], at + len(cut)
                if at == size:
                    sequence, at = sequence + 1, 0
                    size = 1 << max(0, offset.bit_length() - 1)
        yield flushed()

    return pack


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """Pieces of documents in sequences, neighbours along the curve next to each other; ``row_id`` tells repeated rows apart.

    Each document becomes token ids (an end id included) and the mean of its tokens' hashed sign
    vectors in four dimensions. The rows are range-sorted once by the point's place on the Hilbert curve
    and then by id, and every task cuts its stretch of the curve into full sequences. What is left at
    its end is cut into sequences of falling powers of two, so nothing is padded. ``ranks_path`` may
    name the same vocabulary as ranks.

    Null text counts as empty and has the end id only; null ids sort first; equal texts are
    neighbours; repeated rows are packed each; an empty table gives no rows; other columns are not looked at.
    """
    if path is None:
        path, ranks_path = tokenizer_path(), tokenizer_path(RANKS)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole(text_column))
    encoded = rows.mapInArrow(_encoder(path, ranks_path), "doc_id long, _key long, _ids binary")
    place = scratch_path(spark, "op2-ids")
    encoded.write.option("compression", "zstd").parquet(place)
    encoded = spark.read.schema(encoded.schema).parquet(place)
    # the checksum only orders rows that share an id
    order = ["_key", "doc_id", "_tie"]
    line = encoded.withColumn("_tie", F.crc32("_ids")).repartitionByRange(*order).sortWithinPartitions(*order)
    return line.select("doc_id", "_ids").mapInArrow(_packer(length), SCHEMA)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
