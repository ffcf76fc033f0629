"""Two tokenizers over the same texts: which tokens cover each other, and how often corpus-wide."""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.llm.common import stored, table, whole
from siftgate.llm.packed import packed, portions, unpacked

# The vocabularies: A's as ranks and as the tokenizer file, which very long texts go through; B's pieces.
RANKS, TOKENIZER, PIECES = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"
LONG_TEXT = 200_000
# Bytes of text that are aligned together.
PORTION = 1 << 20
# A pair of ids as one number: B's in the lower bits.
B_BITS = 16
# Groups with more links than this are counted id by id, not token by token.
WIDE_GROUP = 64


@dataclass(frozen=True)
class Vocabularies:
    """Where the three files lie; ``None`` means the public ones."""

    ranks: str | None = None
    tokenizer: str | None = None
    pieces: str | None = None


def _place(path: str | None, name: str) -> str:
    import public_tokenizers

    return path or public_tokenizers.path(name)


class Coders:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, files: Vocabularies):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(_place(files.ranks, RANKS), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self._a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._file = _place(files.tokenizer, TOKENIZER)
        self._b = sentencepiece.SentencePieceProcessor(model_file=_place(files.pieces, PIECES))
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # ids as text: followed by a comma inside a group's side, by another sign at its end
        names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = [n + "," for n in names] + [n + "|" for n in names] + [n + ";" for n in names]

    def _piece(self, number: int) -> bytes:
        piece = self._b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(number) else piece.replace("▁", " ").encode()

    @functools.cached_property
    def _long(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self._file)
        found.encode_special_tokens = True
        return found

    def a_ids(self, text: str) -> list[int]:
        """Ids of a blank and the text; what spells a special token is plain text."""
        if len(text) > LONG_TEXT:
            return self._long.encode(" " + text, add_special_tokens=False).ids
        return self._a.encode_ordinary(" " + text)

    def both(self, texts: Sequence[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text on both sides; none where a side does not spell the text again."""
        b_ids = self._b.encode([t or "" for t in texts], num_threads=1)
        a_out, b_out = [], []
        for text, b in zip(texts, b_ids):
            a = self.a_ids(text) if text else []
            want = b" " + text.encode() if text else b""
            same = bool(text) and all(
                b"".join(map(known.__getitem__, ids)) == want for known, ids in ((self.a_bytes, a), (self.b_bytes, b))
            )
            a_out.append(a if same else [])
            b_out.append(b if same else [])
        return a_out, b_out


@functools.cache
def coders(files: Vocabularies) -> Coders:
    return Coders(files)


def _flat(ids: Sequence[Sequence[int]], sizes: np.ndarray) -> pd.DataFrame:
    """Tokens of all documents of a batch: document, id, where the bytes start and end along the batch."""
    counts = np.array([len(i) for i in ids], np.int64)
    flat = np.array(list(itertools.chain.from_iterable(ids)), np.int64)
    doc = np.repeat(np.arange(len(ids)), counts)
    # a document's tokens fill its bytes, so the lengths add up along the batch
    end = np.cumsum(sizes[flat])
    return pd.DataFrame({"doc": doc, "id": flat, "start": end - sizes[flat], "end": end, "token": np.arange(len(flat))})


@dataclass
class Aligned:
    """A batch of documents: tokens of both sides with the number of their group along the batch."""

    docs: int
    a: pd.DataFrame
    b: pd.DataFrame
    a_group: np.ndarray
    b_group: np.ndarray
    groups: int

    def per_doc(self, frame: pd.DataFrame) -> np.ndarray:
        return np.bincount(frame["doc"], minlength=self.docs)

    @functools.cached_property
    def group_doc(self) -> np.ndarray:
        found = np.zeros(self.groups, np.int64)
        found[self.a_group] = self.a["doc"]
        return found


def align(a_ids: Sequence[Sequence[int]], b_ids: Sequence[Sequence[int]], tables: Coders) -> Aligned:
    """Groups of tokens between places where both sides end a token.

    As-of merges, keyed by document, find for each token's start the other side's token that covers it; the union of
    both directions is all overlaps. Overlapping tokens that end alike end a group.
    """
    a, b = _flat(a_ids, tables.a_sizes), _flat(b_ids, tables.b_sizes)
    places = ["doc", "start"]
    forward = pd.merge_asof(a[places], b[[*places, "token"]], on="start", by="doc")["token"].to_numpy(np.int64)
    backward = pd.merge_asof(b[places], a[[*places, "token"]], on="start", by="doc")["token"].to_numpy(np.int64)
    a_end, b_end = a["end"].to_numpy(), b["end"].to_numpy()
    groups = []
    # tokens of one side that end as a token does that covers their start, or whose start they cover
    for end, covered, other, covers in ((a_end, forward, b_end, backward), (b_end, backward, a_end, forward)):
        alike = (other[covered] == end).astype(np.int64)
        alike[covers[end[covers] == other]] = 1
        groups.append(np.cumsum(alike) - alike)
    count = int(groups[0][-1]) + 1 if len(a) else 0
    return Aligned(len(a_ids), a, b, groups[0], groups[1], count)


def group_texts(found: Aligned, tables: Coders) -> list[str]:
    """Each document's groups as text: ``a1,a2|b1;a3|b2,b3``, ids in order."""
    width = len(tables.names) // 3
    a_count = np.bincount(found.a_group, minlength=found.groups)
    b_count = np.bincount(found.b_group, minlength=found.groups)
    # a group's tokens stand together, A's before B's
    before_a = np.cumsum(b_count) - b_count
    before_b = np.cumsum(a_count)
    line = np.zeros(len(found.a) + len(found.b), np.int64)
    a_last = np.append(found.a_group[1:] != found.a_group[:-1], True)[: len(found.a)]
    b_last = np.append(found.b_group[1:] != found.b_group[:-1], True)[: len(found.b)]
    line[np.arange(len(found.a)) + before_a[found.a_group]] = found.a["id"].to_numpy() + width * a_last
    line[np.arange(len(found.b)) + before_b[found.b_group]] = found.b["id"].to_numpy() + 2 * width * b_last
    names = list(map(tables.names.__getitem__, line.tolist()))
    ends = np.cumsum(found.per_doc(found.a) + found.per_doc(found.b)).tolist()
    return ["".join(names[start:end])[:-1] for start, end in zip([0, *ends], ends)]


def _weighted(group: np.ndarray, ids: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and number of equal tokens; only tokens of wide groups are put together."""
    many = wide[group]
    if not many.any():
        return group, ids, np.ones(len(ids), np.int64)
    merged, counts = np.unique(group[many] << 20 | ids[many], return_counts=True)
    all_groups = np.concatenate([group[~many], merged >> 20])
    order = np.argsort(all_groups, kind="stable")
    all_ids = np.concatenate([ids[~many], merged & ((1 << 20) - 1)])
    weights = np.concatenate([np.ones((~many).sum(), np.int64), counts])
    return all_groups[order], all_ids[order], weights[order]


def linked_pairs(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair of ids and number of links, documents in order: each pair of a document once."""
    a_count = np.bincount(found.a_group, minlength=found.groups)
    b_count = np.bincount(found.b_group, minlength=found.groups)
    wide = a_count * b_count > WIDE_GROUP
    a_group, a_id, a_weight = _weighted(found.a_group, found.a["id"].to_numpy(), wide)
    b_group, b_id, b_weight = _weighted(found.b_group, found.b["id"].to_numpy(), wide)
    b_here = np.bincount(b_group, minlength=found.groups)
    b_start = np.cumsum(b_here) - b_here
    times = b_here[a_group]
    total = int(times.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
    b_at = np.repeat(b_start[a_group], times) + inside
    pair = np.repeat(a_id, times) << B_BITS | b_id[b_at]
    doc = np.repeat(found.group_doc[a_group], times)
    links = np.repeat(a_weight, times) * b_weight[b_at]
    order = np.lexsort((pair, doc))
    pair, doc, links = pair[order], doc[order], links[order]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1]))[:total])
    return doc[first], pair[first], np.add.reduceat(links, first) if total else links


def _documents(batches: Iterator[pa.RecordBatch], tables: Coders) -> Iterator[tuple[list, Aligned]]:
    for batch in portions(batches, 1, PORTION):
        yield batch.column(0).to_pylist(), align(*tables.both(batch.column(1).to_pylist()), tables)


def token_groups(docs: DataFrame, id_column="doc_id", text_column="text", files: Vocabularies = Vocabularies()) -> DataFrame:
    """``doc_id, groups``: each document's groups of covering tokens as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = coders(files)
        for ids, found in _documents(batches, tables):
            columns = [pa.array(ids, pa.int64()), pa.array(group_texts(found, tables), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "groups"])

    return docs.select(F.col(id_column).cast("long"), whole(text_column)).mapInArrow(run, "doc_id long, groups string")


PORTIONS = "portion long, docs binary, pairs array<long>, holders array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
NAMES = [field.split()[0] for field in RESULT.split(", ")]
DIGEST = 32


def _portions(files: Vocabularies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per portion: its documents' own figures and links, packed, and the pairs that it has."""
        tables = coders(files)
        own = TaskContext.get().partitionId() << 32
        for number, (ids, found) in enumerate(_documents(batches, tables)):
            n_a, n_b = found.per_doc(found.a), found.per_doc(found.b)
            n_groups = np.bincount(found.group_doc, minlength=found.docs)
            doc, pair, links = linked_pairs(found)
            pairs, place, holders = np.unique(pair, return_inverse=True, return_counts=True)
            n_links = np.bincount(doc, links, minlength=found.docs).astype(np.int64)
            texts = group_texts(found, tables)
            blob = b"".join(hashlib.sha256(t.encode()).digest() if t else bytes(DIGEST) for t in texts)
            named = np.array([i is not None for i in ids], np.int64)
            columns = [np.array([i or 0 for i in ids], np.int64), named, n_a, n_b, n_groups, n_links]
            columns += [np.bincount(doc, minlength=found.docs), place, links]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([own + number], pa.int64()),
                    pa.array([packed(columns, blob)], pa.binary()),
                    pa.array([pairs], pa.list_(pa.int64())),
                    pa.array([holders], pa.list_(pa.int64())),
                ],
                names=["portion", "docs", "pairs", "holders"],
            )

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each portion, with the counts of its pairs added up over their links."""
    for batch in batches:
        for row in range(batch.num_rows):
            (ids, named, n_a, n_b, n_groups, n_links, sizes, place, links), blob = unpacked(batch.column(0)[row].as_py(), 9)
            replies = batch.column(1)[row].values
            count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if replies is not None and len(replies):
                order = np.argsort(replies.field("pos").to_numpy())
                count, best = (replies.field(n).to_numpy()[order].astype(np.int64) for n in ("n", "best"))
            doc = np.repeat(np.arange(len(ids)), sizes)
            n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            np.add.at(n_best, doc, links * best[place])
            np.add.at(count_sum, doc, links * count[place])
            hashes = [blob[i * DIGEST : (i + 1) * DIGEST].hex() if n_a[i] else "" for i in range(len(ids))]
            numbers = [n_a, n_b, n_groups, n_links, n_best, count_sum]
            columns = [pa.array(ids, pa.int64(), mask=named == 0), *[pa.array(c, pa.int64()) for c in numbers], pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)


def align_documents(docs: DataFrame, id_column="doc_id", text_column="text", files: Vocabularies = Vocabularies()) -> DataFrame:
    """One row per document: tokens of both sides, groups, links, and how common the linked pairs of ids are.

    A portion of documents is aligned together and written as one row, with its own dictionary of pairs. Only
    dictionaries are exchanged: pairs to be counted over all documents, counts back to the portions that asked. An
    id has at most as many partners as the other vocabulary has entries, so the best of them is a bounded group.

    Null and empty texts, and those that a tokenizer does not spell again byte by byte, have zeros and an
    empty hash; repeated rows are documents of their own; null ids stay null; an empty table gives no rows; other
    columns are not looked at.
    """
    rows = docs.select(F.col(id_column).cast("long"), whole(text_column))
    aligned = stored(rows.mapInArrow(_portions(files), PORTIONS), "op12-portions")
    held = aligned.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.holders").alias("n"))
    counts = held.groupBy("pair").agg(F.sum("n").alias("n"))
    a_id = F.shiftright("pair", B_BITS)
    best = (F.col("n") == F.max("n").over(Window.partitionBy(a_id))).cast("int")
    asked = aligned.select("portion", F.posexplode("pairs").alias("pos", "pair"))
    replies = asked.join(counts.select("pair", "n", best.alias("best")), "pair")
    replies = replies.groupBy("portion").agg(F.collect_list(F.struct("pos", "n", "best")).alias("replies"))
    joined = aligned.select("portion", "docs").join(replies, "portion", "left")
    return joined.select("docs", "replies").mapInArrow(_answered, RESULT)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))
