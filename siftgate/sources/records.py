"""Records of delimited files whose quoted cells hold line breaks, read split by split.

Whether a line starts inside a quoted cell depends on all lines before it. But what a whole split does to that
state is two bits: where it ends if it starts outside, and if it starts inside. One scan folds every split into
its two bits; a window over the splits of a file, a few bytes each, gives every split its true start; then a second
scan cuts records. Lines never leave their task, only records that reach over the end of a split are put together.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.operators.rows import BLOCK, SEQUENCE
from siftgate.session import BROADCAST_ROWS, scratch_path
from siftgate.sources.paths import charset, literal_paths, scanned_name, scanned_path

# Encodings whose line breaks are single bytes and whose every byte string can be decoded.
SPLITTABLE = ("utf-8", "iso-8859-1")
LF, CRLF, OTHER = "\n", "\r\n", "other"


def can_split(path: str, encoding: str, newline: str) -> bool:
    """Whether several tasks can share the file: packed files and lone carriage returns have no lines to split at."""
    return newline in (LF, CRLF) and not path.lower().endswith(".gz") and charset(encoding) in SPLITTABLE


def line_edges(lines: pa.Array, delimiter: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines that end inside a quoted cell if they start outside one, and those that end outside if they start inside.

    Doubled quotes never change that, so they go first. A cell is quoted if a quote is its first character; what
    follows its closing quote is not.
    """
    count = len(lines)
    opens, closes = np.zeros(count, bool), np.zeros(count, bool)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if not len(quoted):
        return opens, closes
    mark = re.escape(delimiter)
    bare = pc.replace_substring(lines.take(pa.array(quoted)), '""', "")

    def left_open(text: pa.Array) -> np.ndarray:
        without = pc.replace_substring_regex(text, f'(^|{mark})"[^"]*"', "\\1")
        return pc.match_substring_regex(without, f'(^|{mark})"').to_numpy(zero_copy_only=False)

    opens[quoted] = left_open(bare)
    # from the closing quote on, a line is as one that starts outside, in the middle of a cell
    ends = pc.match_substring(bare, '"').to_numpy(zero_copy_only=False)
    rest = pc.replace_substring_regex(bare, '^[^"]*"', "x", max_replacements=1)
    closes[quoted] = ends & ~left_open(rest)
    return opens, closes


def _joined(lines: pa.Array) -> str:
    return "\n".join(lines.to_pylist())


class _Cutter:
    """Cuts the lines of one split into records; what is open is kept as pieces."""

    def __init__(self, delimiter: str, inside: bool):
        self.delimiter, self.inside = delimiter, inside
        self.pieces: list[str] = []

    def cut(self, lines: pa.Array) -> pa.Array:
        """Records that these lines complete, the one first that was open before them."""
        opens, closes = line_edges(lines, self.delimiter)
        closing, opening = np.flatnonzero(closes), np.flatnonzero(opens)
        first, start = None, 0
        if self.inside:
            if not len(closing):
                self.pieces.append(_joined(lines))
                return lines.slice(0, 0)
            start = int(closing[0]) + 1
            self.pieces.append(_joined(lines.slice(0, start)))
            first, self.pieces, self.inside = "\n".join(self.pieces), [], False
        begins = np.ones(len(lines), bool)
        begins[:start] = False
        at, end = start, len(lines)
        while (i := np.searchsorted(opening, at)) < len(opening):
            opened = int(opening[i])
            j = np.searchsorted(closing, opened + 1)
            if j == len(closing):
                self.pieces, self.inside, end = [_joined(lines.slice(opened))], True, opened
                break
            at = int(closing[j]) + 1
            begins[opened + 1 : at] = False
        places = np.flatnonzero(begins[:end])
        if len(places) == end - start:
            records = lines.slice(start, end - start)
        else:
            offsets = np.append(places, end).astype(np.int32)
            records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), "\n")
        return records if first is None else pa.concat_arrays([pa.array([first], records.type), records])


def split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Pieces of batches that are of one split: the split's name and place, and the piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = pc.fill_null(batch.column(0).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        blocks = batch.column(1).to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            piece = batch.slice(start, end - start)
            yield (piece.column(0)[0].as_py(), piece.column(1)[0].as_py()), piece


def lines_of(spark: SparkSession, paths: Sequence[str], encoding: str, newline: str) -> DataFrame:
    """``source_filename, file_block, value`` of every line; within a task the lines of a split follow one another."""
    value = F.make_valid_utf8("value") if charset(encoding) == "utf-8" else F.decode(F.col("value").cast("binary"), charset(encoding))
    if newline == CRLF:
        value = F.regexp_replace(value, r"\r\z", "")
    scan = spark.read.option("lineSep", "\n").text(literal_paths(paths))
    return scan.select(scanned_name().alias("source_filename"), F.col("_metadata.file_block_start").alias(BLOCK), value.alias("value"))


def with_splits(lines: DataFrame, splits: DataFrame, count: int, how: str = "inner") -> DataFrame:
    """Lines with what is known of their splits; those of a split still follow one another.

    Splits are broadcast up to the fixed bound. Beyond it lines are exchanged, and sorted again.
    """
    keys = ["source_filename", BLOCK]
    if count <= BROADCAST_ROWS:
        return lines.join(F.broadcast(splits), keys, how)
    placed = lines.withColumn("_line", F.monotonically_increasing_id()).join(splits, keys, how)
    return placed.sortWithinPartitions(*keys, "_line").drop("_line")


STARTS = f"source_filename string, {BLOCK} long, starts_inside boolean, closes_at long, owner long"
SPLITS = f"source_filename string, {BLOCK} long, ends_outside boolean, ends_inside boolean, closes_at long"


def _fold(delimiter: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each split: whether it ends inside a cell, for both ways to start, and its first closing line."""
        found: dict[tuple, list] = {}
        for split, piece in split_runs(batches):
            state = found.setdefault(split, [False, True, None, 0])
            opens, closes = line_edges(piece.column(2), delimiter)
            opening, closing = np.flatnonzero(opens), np.flatnonzero(closes)
            if len(closing) and state[2] is None:
                state[2] = state[3] + int(closing[0])
            for start in (0, 1):
                inside, at = state[start], 0
                while True:
                    turns = closing if inside else opening
                    i = np.searchsorted(turns, at)
                    if i == len(turns):
                        break
                    inside, at = not inside, int(turns[i]) + 1
                state[start] = inside
            state[3] += piece.num_rows
        rows = [(*split, *state[:3]) for split, state in found.items()]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["source_filename", BLOCK, "ends_outside", "ends_inside", "closes_at"])

    return run


def split_starts(lines: DataFrame, delimiter: str) -> DataFrame:
    """Per split: ``starts_inside``, ``closes_at`` and the split ``owner`` in which the record it starts in began.

    A split keeps the state, turns it, or sets it. The state before a split is what the last one that set it left,
    turned as often as splits since then turn it.
    """
    splits = lines.mapInArrow(_fold(delimiter), SPLITS)
    before = Window.partitionBy("source_filename").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("ends_outside") == F.col("ends_inside")
    turns = (F.col("ends_outside") & ~F.col("ends_inside")).cast("int")
    turned = splits.withColumn("turned", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    left = F.last(F.when(sets, F.col("ends_outside").cast("int") - F.col("turned")), ignorenulls=True).over(before)
    started = turned.withColumn("starts_inside", F.pmod(F.coalesce(left, F.lit(0)) + F.col("turned"), F.lit(2)) == 1)
    begins = F.when(~F.col("starts_inside") | F.col("closes_at").isNotNull(), F.col(BLOCK))
    owner = F.last(begins, ignorenulls=True).over(before)
    return started.select("source_filename", BLOCK, "starts_inside", "closes_at", owner.alias("owner"))


HEADS = f"source_filename string, owner long, {BLOCK} long, head string"


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split that starts inside a record: the text up to the line that ends it."""
    texts: dict[tuple, list[str]] = {}
    seen: dict[tuple, int] = {}
    owners: dict[tuple, int] = {}
    for split, piece in split_runs(batches):
        at, closes_at = seen.get(split, 0), piece.column(3)[0].as_py()
        count = piece.num_rows if closes_at is None else max(0, min(piece.num_rows, closes_at + 1 - at))
        if count:
            texts.setdefault(split, []).append(_joined(piece.column(2).slice(0, count)))
        seen[split], owners[split] = at + piece.num_rows, piece.column(4)[0].as_py()
    rows = [(split[0], owners[split], split[1], "\n".join(pieces)) for split, pieces in texts.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds)]
    yield pa.RecordBatch.from_arrays(columns, names=["source_filename", "owner", BLOCK, "head"])


RECORDS = f"source_filename string, {BLOCK} long, {SEQUENCE} long, record string, is_open boolean"


def _records(delimiter: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records that begin in each split, numbered in it; the last may be open. Empty lines are none."""
        now, cutter, count, dropped = None, None, 0, False

        def handed(records: pa.Array, is_open: bool) -> pa.RecordBatch | None:
            nonlocal count, dropped
            if dropped and len(records):  # the end of a record that another split has
                records, dropped = records.slice(1), False
            records = records.filter(pc.not_equal(records, ""))
            if not len(records):
                return None
            size, count = len(records), count + len(records)
            columns = [
                pa.repeat(pa.scalar(now[0], pa.string()), size),
                pa.repeat(pa.scalar(now[1], pa.int64()), size),
                pa.array(np.arange(count - size, count)),
                records.cast(pa.string()),
                pa.repeat(pa.scalar(is_open), size),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["source_filename", BLOCK, SEQUENCE, "record", "is_open"])

        def rest() -> pa.RecordBatch | None:
            if cutter is None or not cutter.inside or dropped:
                return None
            return handed(pa.array(["\n".join(cutter.pieces)]), True)

        for split, piece in split_runs(batches):
            if split != now:
                if (last := rest()) is not None:
                    yield last
                now, count, dropped = split, 0, piece.column(3)[0].as_py()
                cutter = _Cutter(delimiter, dropped)
            if (found := handed(cutter.cut(piece.column(2)), False)) is not None:
                yield found
            if dropped:
                cutter.pieces.clear()
        if (last := rest()) is not None:
            yield last

    return run


def split_records(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str, newline: str = LF) -> DataFrame:
    """``source_filename, file_block, block_sequence, record``: the text of every record of the files, headers included.

    Files are read three times at most, by all tasks: to fold splits, to fetch the beginnings of splits that start
    inside a record (only if there are any), and to cut records. Splits have to be the same each time:
    ``steady_splits`` sees to that, and a split that is not known stops the job.
    """
    lines = lines_of(spark, paths, encoding, newline)
    place = scratch_path(spark, "splits")
    split_starts(lines, delimiter).write.parquet(place)
    starts = spark.read.schema(STARTS).parquet(place)
    count, inside = starts.agg(F.count("*"), F.count_if("starts_inside")).first()
    known = with_splits(lines, starts.select("source_filename", BLOCK, "starts_inside"), count, "left")
    unknown = F.raise_error(F.lit("The splits of a file changed while it was read")).cast("boolean")
    started = known.withColumn("starts_inside", F.coalesce("starts_inside", unknown))
    records = started.mapInArrow(_records(delimiter), RECORDS)
    if not inside:
        return records.drop("is_open")
    wanted = starts.filter("starts_inside").select("source_filename", BLOCK, "closes_at", "owner")
    heads = with_splits(lines, wanted, inside).mapInArrow(_heads, HEADS)
    pieces = F.array_sort(F.collect_list(F.struct(BLOCK, "head")))
    tails = heads.groupBy("source_filename", F.col("owner").alias(BLOCK)).agg(
        F.array_join(F.transform(pieces, lambda p: p["head"]), "\n").alias("tail")
    )
    # written, so that Spark knows their size and need not exchange all records to find out
    place = scratch_path(spark, "tails")
    tails.write.parquet(place)
    tails = spark.read.schema(tails.schema).parquet(place)
    # open records alone look for their tails
    key = F.when(F.col("is_open"), F.col(BLOCK))
    joined = records.withColumn("_open", key).alias("r").join(
        tails.alias("t"), (F.col("r.source_filename") == F.col("t.source_filename")) & (F.col("r._open") == F.col(f"t.{BLOCK}")), "left"
    )
    text = F.when(F.col("t.tail").isNotNull(), F.concat("r.record", F.lit("\n"), "t.tail")).otherwise(F.col("r.record"))
    return joined.select("r.source_filename", f"r.{BLOCK}", f"r.{SEQUENCE}", text.alias("record"))


def drop_headers(records: DataFrame) -> DataFrame:
    """Without the first record of every file, which is where its first split begins."""
    return records.filter(~((F.col(BLOCK) == 0) & (F.col(SEQUENCE) == 0)))


def newline_of(first_line: str) -> str:
    """Kind of line break of a file, from its text up to the first line feed."""
    if "\r" not in first_line:
        return LF
    return CRLF if first_line.index("\r") == len(first_line.rstrip("\n")) - 1 else OTHER


HEADERS = "path string, header array<string>, newline string"


def first_records(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str) -> DataFrame:
    """``path, header, newline`` of every file by a scan: lines of a file's first split until the first record ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[str, list[str]] = {}
        kinds: dict[str, str] = {}
        inside: dict[str, bool] = {}
        for (path, _), piece in split_runs(batches):
            lines = heads.setdefault(path, [])
            if lines and not inside[path]:
                continue
            for line in piece.column(2):
                lines.append(line.as_py().decode(encoding, "replace"))
                opens, closes = line_edges(pa.array(lines[-1:]), delimiter)
                # the line feed itself is not in the line
                kinds.setdefault(path, newline_of(lines[0]))
                inside[path] = not closes[0] if inside.get(path) else bool(opens[0])
                if not inside[path]:
                    break
        texts = {p: "\n".join(x.removesuffix("\r") if kinds[p] == CRLF else x for x in lines) for p, lines in heads.items()}
        found = [next(csv.reader(io.StringIO(t, newline=""), delimiter=delimiter), []) for t in texts.values()]
        columns = [pa.array(texts, pa.string()), pa.array(found, pa.list_(pa.string())), pa.array([kinds[p] for p in texts], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "header", "newline"])

    scan = spark.read.option("encoding", charset(encoding)).option("lineSep", "\n").text(literal_paths(paths))
    place = F.col("_metadata.file_block_start")
    lines = scan.filter(place == 0).select(scanned_path().alias("path"), place.alias(BLOCK), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(run, HEADERS)
