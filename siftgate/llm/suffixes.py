"""Repeated byte strings: suffix arrays per shard, common prefixes, shards merged by binary search."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.llm.common import NULL_ID, stored, table, whole, with_groups
from siftgate.llm.packed import ROW, packed, packed_rows, portions, sliced, unpacked
from siftgate.session import scratch_path

LENGTH = 50
# Bytes of an anchor: each string of LENGTH bytes has the least hash of its GRAM-byte pieces.
GRAM = 16
# Bytes looked at together (they fit a processor's cache), bytes of documents collapsed together, and
# bytes of one suffix array.
PIECE, PORTION, SHARD = 1 << 16, 1 << 23, 1 << 20
# Bytes of documents, and anchors, for one task of the two exchanges, about.
RANGE_BYTES, RANGE_ANCHORS, LEAST_RANGES = 1 << 24, 1 << 15, 64
# Batches that name an anchor from which its strings are dealt one by one.
HOT = 50_000
# A place in a piece and an anchor's hash share one number.
POSITION_BITS = 24
HASH_BITS = 64 - POSITION_BITS
# Places in a text, doubled at most: Spark's values end at 2**31 bytes.
PLACE = "<u4"


# Anchors --------------------------------------------------------------------------------------------


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place."""
    n = len(data) - GRAM + 1
    x = data.astype(np.uint64)
    for shift in (1, 2, 4):
        x = x[:-shift] | (x[shift:] << np.uint64(8 * shift))
    x = x[:n] * np.uint64(0x9E3779B97F4A7C15) ^ (x[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x


def anchors(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``hash, place, first start, last start`` of the anchors of all valid starts of strings.

    A string's anchor is the leftmost of its pieces with the least hash, so equal strings have it at the same
    place. Anchors move to the right with the start; the starts of one anchor are a stretch.
    """
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = _grams(data)
    least &= ~low
    least |= np.arange(len(least), dtype=np.uint64)
    window, reach = length - GRAM + 1, 1
    while 2 * reach <= window:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < window:
        least = np.minimum(least[: len(least) - (window - reach)], least[window - reach :])
    starts = np.flatnonzero(valid[: len(least)])
    least = least[starts]
    place = (least & low).astype(np.int64)
    fresh = np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(place) else []
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    # least hashes are small numbers: spread them over the whole range again
    spread = (least[first] >> np.uint64(POSITION_BITS)) * np.uint64(0x9E3779B97F4A7C15) & np.uint64((1 << HASH_BITS) - 1)
    return spread.astype(np.int64), place[first], starts[first], starts[last]


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end: ``bytes, valid starts, number of the text of each part, (begin, offset) of each part``.

    Long texts are cut into parts that overlap by one byte less than a string, so each start is in one part.
    """
    parts: list[tuple[int, int, bytes]] = []
    size = 0

    def laid():
        data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        begins = np.cumsum([0] + [len(p) for _, _, p in parts])
        valid = np.zeros(len(data), bool)
        for begin, end in zip(begins, begins[1:]):
            valid[begin : max(begin, end - length + 1)] = True
        return data, valid, np.array([i for i, _, _ in parts]), np.array([begins[:-1], [o for _, o, _ in parts]]).T

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[at : at + PIECE + length - 1]
            if len(part) < length:
                continue
            if parts and size + len(part) > 2 * PIECE:
                yield laid()
                parts, size = [], 0
            parts.append((i, at, part))
            size += len(part)
    if parts:
        yield laid()


def _text_anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``number of the text, hash, place, first start, last start`` in each text, and the piece's bytes and offsets."""
    for data, valid, owner, parts in _pieces(texts, length):
        found, place, first, last = anchors(data, valid, length)
        part = np.searchsorted(parts[:, 0], first, side="right") - 1
        shift = parts[part, 1] - parts[part, 0]
        yield owner[part], found, place + shift, first + shift, last + shift, data, shift


def _per_document(ids: np.ndarray, hashes: np.ndarray | None, columns: list[np.ndarray]) -> pa.Table:
    """One row per document (id, or id and hash of the text) with its values packed."""
    keys = [ids] if hashes is None else [ids, hashes]
    order = np.lexsort((columns[0], *reversed(keys)))
    keys, values = [k[order] for k in keys], np.stack([c[order] for c in columns], axis=1).astype(PLACE)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    found = [values[a:b].tobytes() for a, b in zip(first, [*first[1:], len(order)])]
    names = ["_id", "_hash"][: len(keys)]
    columns = {n: pa.array(k[first], pa.int64()) for n, k in zip(names, keys)}
    return pa.table(columns | {"_found": pa.array(found, pa.binary())})


FOUND = "_id long, _hash long, _found binary"


# First exchange: anchors that several documents have ------------------------------------------------


def _emit_anchors(length: int, ranges: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1, PORTION):
            ids = batch.column(0).to_numpy()
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            least: dict[bytes, int] = {}
            for i, text in zip(ids.tolist(), texts):
                least[text] = min(i, least.get(text, i))
            # of equal texts the least document speaks for all
            speaks = [n for n, text in enumerate(texts) if least[text] == ids[n]]
            ids = ids[speaks]
            found = [x[:3] for x in _text_anchors([texts[n] for n in speaks], length)]
            if not found:
                continue
            owner, anchor, place = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((place, ids[owner], anchor))
            owner, anchor, place = owner[order], anchor[order], place[order]
            doc = ids[owner]
            group = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]])) - 1
            first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            shared = (np.maximum.reduceat(doc, first) > np.minimum.reduceat(doc, first))[group]
            lead = np.zeros(len(doc), bool)
            lead[first] = True
            out: tuple[list, list, list] = ([], [], [])
            # what this batch has twice needs no answer; one line of it tells the others
            for known, keep in ((True, shared), (False, ~shared | lead)):
                a, d, p = anchor[keep], doc[keep], place[keep]
                for shard, part in sliced(a, ranges, HASH_BITS):
                    by_doc = np.lexsort((p[part], d[part]))
                    out[0].append(shard)
                    out[1].append(known)
                    out[2].append(packed([x[part][by_doc] for x in (a, d, p)]))
            yield packed_rows(*out)

    return emit


def _share_anchors(hot: int):
    def share(cell: pa.Table) -> pa.Table:
        """Places of the anchors that more than one document has; odd numbers mark anchors with very many."""
        done, asked = [], []
        for known, row in zip(cell["known"].to_pylist(), cell["rows"].to_pylist()):
            (done if known else asked).append(unpacked(row, 3)[0])
        none = [np.zeros(0, np.int64)] * 3
        # known places of an anchor with very many lines are marked as well
        known_anchor, known_doc, known_place = (np.concatenate(x) for x in zip(*done, none))
        anchor, doc, place = (np.concatenate(x) for x in zip(*asked, none))
        order = np.lexsort((doc, anchor))
        anchor, doc, place = anchor[order], doc[order], place[order]
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(anchor)))
        several = crowded = np.zeros(0, bool)
        if len(first):
            several = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
            crowded = sizes > hot
        keep = np.repeat(several, sizes)
        mark = np.repeat(crowded, sizes)[keep]
        mark_known = np.isin(known_anchor, anchor[first][crowded])
        found = np.concatenate([place[keep] * 2 + mark, known_place * 2 + mark_known])
        return _per_document(np.concatenate([doc[keep], known_doc]), None, [found])

    return share


# Second exchange: the strings around them -------------------------------------------------------------


def _emit_contexts(length: int, ranges: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2, 3 * PORTION):
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            places = [np.unique(np.frombuffer(b"".join(x), PLACE)).astype(np.int64) for x in batch.column(3).to_pylist()]
            base = 1 << 40
            wanted = np.concatenate([i * base + p for i, p in enumerate(places)])
            lines: dict[tuple[int, bytes], list[int]] = {}
            parts: list[tuple[np.ndarray, ...]] = []
            count = 0
            for owner, anchor, place, first, last, data, shift in _text_anchors(texts, length):
                key = owner * base + place * 2
                near = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)]
                hot = near == key + 1
                raw = data.tobytes()
                calm = np.flatnonzero(near == key)
                columns = [x[calm].tolist() for x in (anchor, first - shift, last - shift + length)]
                for n, (way, start, end) in enumerate(zip(*columns), count):
                    lines.setdefault((way, raw[start:end]), []).append(n)
                parts.append((owner[calm], first[calm]))
                count += len(calm)
                for i in np.flatnonzero(hot).tolist():  # each string goes its own way
                    begins = np.arange(first[i], last[i] + 1)
                    for n, start in enumerate((begins - shift[i]).tolist(), count):
                        string = raw[start : start + length]
                        way = int.from_bytes(hashlib.blake2b(string, digest_size=5).digest(), "big")
                        lines.setdefault((way, string), []).append(n)
                    parts.append((np.full(len(begins), owner[i]), begins))
                    count += len(begins)
            if not lines:
                continue
            owner, begin = (np.concatenate(x) for x in zip(*parts))
            doc, text = np.array(ids)[owner], np.array(hashes)[owner]
            ways, contexts, rows, late = _first_documents(lines, doc)
            out: tuple[list, list, list] = ([], [], [])
            if len(late[0]):
                stretch = [doc[late[0]], text[late[0]], begin[late[0]], begin[late[0]] + late[1]]
                out[0].append(ids[0] % ranges)
                out[1].append(True)
                out[2].append(packed([c[np.argsort(stretch[0], kind="stable")] for c in stretch]))
            order = np.argsort(ways, kind="stable")
            columns = [ways[order], doc[rows][order], text[rows][order], begin[rows][order], np.array([len(c) for c in contexts])[order]]
            for shard, part in sliced(columns[0], ranges, HASH_BITS):
                out[0].append(shard)
                out[1].append(False)
                out[2].append(packed([c[part] for c in columns], b"".join([contexts[i] for i in order[part].tolist()])))
            yield packed_rows(*out)

    return emit


def _first_documents(lines: dict[tuple[int, bytes], list[int]], doc: np.ndarray) -> tuple:
    """Of the rows of equal contexts ``anchor, context, row`` of the least document's, and ``row, size`` of all others."""
    ways, contexts, rows, late, sizes = [], [], [], [], []
    for (way, context), line in lines.items():
        if len(line) > 1:
            numbers = np.array(line)
            least = doc[numbers] == doc[numbers].min()
            others = numbers[~least].tolist()
            late += others
            sizes += [len(context)] * len(others)
            line = numbers[least].tolist()
        for row in line:
            ways.append(way)
            contexts.append(context)
            rows.append(row)
    return np.array(ways, np.int64), contexts, np.array(rows, np.int64), (np.array(late, np.int64), np.array(sizes, np.int64))


def _windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number, zeros beyond the end."""
    x = np.concatenate([data, np.zeros(7, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        x = (x[:-shift] << np.uint64(8 * shift)) | x[shift:]
    return x


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by what follows them, to at least ``depth`` bytes.

    Larsson and Sadakane's refinement: sorted by eight bytes at first, then only groups that are still
    together are sorted again, by the rank of the place as many bytes further on, which doubles the depth.
    """
    n = len(data)
    x = _windows(data)
    order = np.argsort(x, kind="stable")
    x = x[order]
    # beyond the end counts as less than any byte: the last places come first among equal ones
    fresh = np.ones(n, bool)
    fresh[1:] = (x[1:] != x[:-1]) | (order[1:] > n - 8) | (order[:-1] > n - 8)
    if n >= 8:
        order, fresh = _ends_first(order, fresh, x, n)
    else:
        order = np.array(sorted(range(n), key=lambda i: data[i:].tobytes()), dtype=np.int64)
        fresh[:] = True
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    # a place's rank is the first number of its group
    rank = np.empty(n + 1, np.int64)
    rank[order] = first
    rank[n] = -1
    reach = 8
    while reach < depth:
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        spots = np.flatnonzero(tied)
        if not len(spots):
            break
        places = order[spots]
        key = rank[places] * (n + 1) + rank[np.minimum(places + reach, n)] + 1
        again = np.argsort(key, kind="stable")
        places, key = places[again], key[again]
        order[spots] = places
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[spots] = new
        rank[places] = np.maximum.accumulate(np.where(new, spots, 0))
        reach *= 2
    return order


def _ends_first(order: np.ndarray, fresh: np.ndarray, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Puts the last seven places, which the zeros beyond the end make look like longer ones, before those."""
    late = np.flatnonzero(order > n - 8)
    for at in late.tolist():
        start = np.searchsorted(x, x[at])
        same = order[start : np.searchsorted(x, x[at], side="right")]
        short = np.sort(same[same > n - 8])[::-1]
        order[start : start + len(same)] = np.concatenate([short, same[same <= n - 8]])
        fresh[start : start + len(same)] = False
        fresh[start : start + len(short) + 1] = True
    return order, fresh[:n]


def common_prefixes(data: np.ndarray, order: np.ndarray, enough: int | None = None) -> np.ndarray:
    """Length of what each place in the order shares with the one before it, exact at least up to ``enough``.

    Kasai's observation: one place further on in the text, beside its neighbour one place further on too, one
    byte less is shared. So only places where the neighbour changes are compared, the rest count down.
    """
    n = len(order)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    x = _windows(data)
    most = n if enough is None else 4 * enough
    heads = np.ones(n, bool)
    heads[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0)
    shared = np.zeros(n, np.int64)
    compare = heads & (before >= 0)
    while True:
        places = np.flatnonzero(compare)
        shared[places] = _shared(x, places, before[places], n, most)
        run = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        counted = shared[run] - (np.arange(n) - run)
        # counted down to nothing, or from a comparison that was cut off: compared anew
        compare = ~heads & ((counted < 0) | ((shared[run] >= most) & (counted < (enough or 0))))
        if not compare.any():
            return np.where(heads, shared, counted)[order]
        heads |= compare


def _shared(x: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, most: int) -> np.ndarray:
    """Equal bytes from two places on, eight at a time."""
    length = np.zeros(len(a), np.int64)
    room = n - np.maximum(a, b)
    open_ = np.arange(len(a))
    while len(open_):
        at = length[open_]
        differ = x[a[open_] + at] ^ x[b[open_] + at]
        equal = np.full(len(open_), 8, np.int64)
        for k in range(8):
            equal -= (differ >> np.uint64(8 * k)) != 0
        length[open_] = at = np.minimum(at + equal, room[open_])
        open_ = open_[(differ == 0) & (at < room[open_]) & (at < most)]
    return length


def _strings(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return np.ascontiguousarray(data[starts[:, None] + np.arange(length)]).view(f"S{length}").ravel()


def _repeated(contexts: list[bytes], doc: np.ndarray, length: int) -> tuple[np.ndarray, list[bytes]]:
    """Of each context the stretch from its first to its last string that another document may have too.

    Strings are compared by a hash: what it tells apart does not repeat. The rest is for the suffix arrays.
    """
    sizes = np.array([len(c) for c in contexts])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"".join(contexts), np.uint8)
    row = np.repeat(np.arange(len(contexts)), sizes - length + 1)
    counts = np.cumsum(sizes - length + 1)
    start = np.arange(counts[-1]) - np.repeat(counts - (sizes - length + 1), sizes - length + 1) + begin[row]
    words = _windows(data)
    mixed = np.zeros(len(start), np.uint64)
    for at in [*range(0, length - 8, 8), length - 8]:
        mixed = (mixed ^ words[start + at]) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed, kind="stable")
    mixed, owner = mixed[order], doc[row][order]
    new = np.ones(len(order), bool)
    new[1:] = mixed[1:] != mixed[:-1]
    first = np.flatnonzero(new)
    several = np.minimum.reduceat(owner, first) < np.maximum.reduceat(owner, first)
    again = np.zeros(len(order), bool)
    again[order] = np.repeat(several, np.diff(np.append(first, len(order))))
    low = np.full(len(contexts), len(data))
    high = np.full(len(contexts), -1)
    np.minimum.at(low, row[again], (start - begin[row])[again])
    np.maximum.at(high, row[again], (start - begin[row])[again])
    cut = [c[a : b + length] if b >= 0 else b"" for c, a, b in zip(contexts, low.tolist(), high.tolist())]
    return np.where(high >= 0, low, 0), cut


class _Shard:
    """Contexts laid end to end, with the least document of each string in them."""

    def __init__(self, doc, contexts: list[bytes], length: int):
        sizes = np.array([len(c) for c in contexts])
        self.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.data = np.frombuffer(b"".join(contexts), np.uint8)
        row = np.repeat(np.arange(len(contexts)), sizes)
        starts = np.arange(len(self.data)) - self.begin[row] <= sizes[row] - length
        order = suffix_array(self.data, length)
        shared = common_prefixes(self.data, order, length)
        group = np.cumsum(shared < length)
        keep = starts[order]
        self.place, group = order[keep], group[keep]
        self.row = row[self.place]
        self.first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        self.group = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
        self.least = np.minimum.reduceat(doc[self.row], self.first)


def _mark_contexts(length: int, shard_bytes: int):
    def mark(cell: pa.Table) -> pa.Table:
        """Stretches of each document that earlier documents have."""
        marks: list[tuple] = []
        asked, blobs = [], []
        for known, row in zip(cell["known"].to_pylist(), cell["rows"].to_pylist()):
            if known:
                marks.append(tuple(unpacked(row, 4)[0]))
            else:
                columns, blob = unpacked(row, 5)
                ends = np.cumsum(columns[4])
                asked.append(columns[:4])
                blobs += [blob[a:b] for a, b in zip((ends - columns[4]).tolist(), ends.tolist())]
        if asked:
            anchor, doc, text, begin = (np.concatenate(x) for x in zip(*asked))
            for cut in (None, _repeated):
                if cut is not None and len(blobs):  # of what is left, the stretch with strings that may repeat
                    first, blobs = cut(blobs, doc, length)
                    keep = np.array([i for i, blob in enumerate(blobs) if blob], np.int64)
                    anchor, doc, text, begin = anchor[keep], doc[keep], text[keep], (begin + first)[keep]
                    blobs = [blobs[i] for i in keep.tolist()]
                lines: dict[tuple[int, bytes], list[int]] = {}
                for i, key in enumerate(zip(anchor.tolist(), blobs)):
                    lines.setdefault(key, []).append(i)
                contexts = Counter(way for way, _ in lines)
                ways, blobs, rows, late = _first_documents(lines, doc)
                marks.append((doc[late[0]], text[late[0]], begin[late[0]], begin[late[0]] + late[1]))
                # an anchor's only context: nothing else can hold its strings
                keep = np.array([i for i, way in enumerate(ways.tolist()) if contexts[way] > 1], np.int64)
                rows, anchor, blobs = rows[keep], ways[keep], [blobs[i] for i in keep.tolist()]
                doc, text, begin = doc[rows], text[rows], begin[rows]
            order = np.argsort(anchor, kind="stable")
            sizes = np.cumsum([len(blobs[i]) for i in order])
            total = int(sizes[-1]) if len(sizes) else 0
            cuts = np.unique(np.searchsorted(sizes, np.arange(0, total + shard_bytes, shard_bytes)))
            lots = [order[a:b] for a, b in zip(cuts, [*cuts[1:], len(order)]) if a < b]
            # anchors on both sides of a cut: their strings are looked up in one sorted list
            seams = np.unique(np.concatenate([anchor[lot[:1]] for lot in lots[1:]])) if lots[1:] else np.zeros(0, np.int64)
            merged, least = np.zeros(0, f"S{length}"), np.zeros(0, np.int64)
            waiting = []
            for lot in lots:
                shard = _Shard(doc[lot], [blobs[i] for i in lot.tolist()], length)
                row = lot[shard.row]
                start = shard.place - shard.begin[shard.row] + begin[row]
                on_seam = np.isin(anchor[row], seams)
                first = np.isin(anchor[row[shard.first]], seams)
                names = _strings(shard.data, shard.place[shard.first[first]], length)
                merged, least = _merge(merged, least, names, shard.least[first])
                waiting.append((names, (np.cumsum(first) - 1)[shard.group][on_seam], row[on_seam], start[on_seam]))
                late = ~on_seam & (shard.least[shard.group] < doc[row])
                marks.append(_stretches(doc[row[late]], text[row[late]], start[late], length))
            for names, group, row, start in waiting:
                if len(names):
                    late = least[np.searchsorted(merged, names)][group] < doc[row]
                    marks.append(_stretches(doc[row[late]], text[row[late]], start[late], length))
        if not marks:
            return _per_document(*[np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 2)
        ids, hashes, begins, ends = (np.concatenate(x) for x in zip(*marks))
        return _per_document(ids, hashes, [begins, ends])

    return mark


def _merge(names: np.ndarray, values: np.ndarray, more: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted lists of strings with their least documents as one: the shorter is found in the longer by binary search."""
    at = np.searchsorted(names, more)
    known = np.zeros(len(more), bool)
    if len(names):
        known = names[np.minimum(at, len(names) - 1)] == more
    values = values.copy()
    np.minimum.at(values, at[known], others[known])
    return np.insert(names, at[~known], more[~known]), np.insert(values, at[~known], others[~known])


def _stretches(doc, text, start, length: int) -> tuple[np.ndarray, ...]:
    """Covered stretches of strings that start next to each other."""
    order = np.lexsort((start, text, doc))
    doc, text, start = doc[order], text[order], start[order]
    if not len(doc):
        return doc, text, start, start
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (start[1:] > start[:-1] + length)])
    first = np.flatnonzero(new)
    return doc[first], text[first], start[first], np.maximum.reduceat(start, first) + length


# The whole ------------------------------------------------------------------------------------------


def cut_spans(found: list[bytes], size: int) -> list[tuple[int, int]]:
    """Maximal stretches, from packed ``begin, end`` pairs that may overlap or touch."""
    spans: list[list[int]] = []
    for begin, end in sorted(np.frombuffer(b"".join(found), PLACE).reshape(-1, 2).tolist()):
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    return [(a, min(b, size)) for a, b in spans]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, 2, PORTION):
        out: tuple[list, ...] = ([], [], [], [])
        for text, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            raw = text.encode()
            spans = cut_spans(found, len(raw))
            kept, at = hashlib.sha256(), 0
            for begin, end in spans:
                kept.update(raw[at:begin])
                at = end
            kept.update(raw[at:])
            flat = [x for span in spans for x in span]
            for column, value in zip(out, (sum(b - a for a, b in spans), len(spans), kept.hexdigest(), flat)):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        columns = [batch.column(0), batch.column(1), *[pa.array(v, k) for v, k in zip(out, kinds)]]
        yield pa.RecordBatch.from_arrays(columns, names=["_id", "_hash", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    shard_bytes: int = SHARD,
    hot: int = HOT,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``: bytes in strings that a smaller id has too.

    Only strings around shared anchors can repeat, so a first exchange finds the anchors (one in eighteen
    bytes, content picks them) that several documents have, and a second one brings the bytes around them
    together, in ranges of the anchor's hash. Equal texts and equal contexts stand for each other, and what a
    hash of each string tells to be single is cut off. Anchors that then have several contexts are worked off in shards of bounded size: a suffix array by refinement, common
    prefixes, groups of equal strings with their least document. Strings of
    anchors that a cut between shards parts are merged by binary search in a sorted list. What a batch of
    documents has several times is settled there and sent on once; strings of anchors that very many
    batches have travel one by one. Work follows the text, not the number of pairs.

    Null text counts as empty, texts shorter than the length lose nothing, a null id counts as below
    all others, rows of one id do not cut each other, rows that repeat id and text get the same
    line, an empty table gives no rows, and other columns are not looked at.
    """
    spark = docs.sparkSession
    text = whole(text_column)
    keyed = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text")
    )
    light = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(text).alias("_hash"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("_whole"),
    )
    light = stored(light, "op8-light")
    # equal texts: all but the least document's go as a whole
    leads = light.groupBy("_whole").agg(F.min("_id").alias("_lead"), F.first("_hash").alias("_lead_hash"), F.count("*").alias("_copies"))
    leads = stored(leads, "op8-leads")
    size = light.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(LEAST_RANGES, math.ceil(size / RANGE_BYTES))
    emitted = keyed.select("_id", "_text").mapInArrow(_emit_anchors(length, ranges), ROW)
    shared = emitted.groupBy("shard").applyInArrow(_share_anchors(hot), "_id long, _found binary")
    shared = stored(shared, "op8-shared")
    places = shared.groupBy("_id").agg(F.collect_list("_found").alias("_places"))
    places = places.join(leads.select(F.col("_lead").alias("_id"), F.col("_lead_hash").alias("_hash")), "_id")
    counted = shared.agg(F.sum(F.octet_length("_found") / 4)).first()[0] or 0

    # documents with a shared anchor, of equal texts the least one's
    joined = keyed.join(places, ["_id", "_hash"]).select("_id", "_hash", "_text", "_places")
    place = scratch_path(spark, "op8-texts")
    joined.write.option("compression", "zstd").parquet(place)
    texts = spark.read.schema(joined.schema).parquet(place)
    ranges = max(LEAST_RANGES, math.ceil(counted / RANGE_ANCHORS))
    contexts = texts.mapInArrow(_emit_contexts(length, ranges), ROW)
    marks = stored(contexts.groupBy("shard").applyInArrow(_mark_contexts(length, shard_bytes), FOUND), "op8-marks")
    marks = marks.groupBy("_id", "_hash").agg(F.collect_list("_found").alias("_marks"))
    cut = texts.select("_id", "_hash", "_text").join(marks, ["_id", "_hash"]).select("_id", "_hash", "_text", "_marks")
    cut = cut.mapInArrow(_remove, "_id long, _hash long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
    cut = stored(cut, "op8-cut").dropDuplicates(["_id", "_hash"])
    led = with_groups(light, leads.drop("_lead_hash"), ["_whole"], "_copies", F.xxhash64("_id", "_hash"))
    found = led.join(cut, ["_id", "_hash"], "left")
    gone = (F.col("_id") > F.col("_lead")) & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.lit(0).cast("long"), F.col("n_bytes"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, hashlib.sha256().hexdigest()).otherwise(F.coalesce("kept_sha256", "_whole")).alias("kept_sha256"),
        F.when(gone, all_of_it).otherwise(F.coalesce("spans", F.array().cast("array<long>"))).alias("spans"),
    )


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("spans")
