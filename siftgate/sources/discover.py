"""Which files are there, whose are they, and which were loaded before."""

from __future__ import annotations

import hashlib
import json
import logging
import re
import string
import uuid
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.functions.messages import AMBIGUOUS_SOURCE
from siftgate.operators.rows import BLOCK
from siftgate.session import BROADCAST_ROWS, escaped, glob_files, is_directory, path_exists, qualified, scratch_path, steady_splits
from siftgate.sources.paths import can_open, file_name, file_system, literal_paths, scanned_name
from siftgate.sources.records import split_runs, with_splits
from siftgate.spec import SourceSpec, glob_regex

log = logging.getLogger(__name__)

# What the loader takes, compound endings first.
EXTENSIONS = {
    ".csv.gz": "csv",
    ".json.gz": "json",
    ".csv": "csv",
    ".json": "json",
    ".xlsx": "excel",
}

# Declarations whose patterns are tried on every file name.
FEW_SOURCES = 64

# Bytes of a file in one archived row.
CHUNK_BYTES = 8 * 1024 * 1024

# Few large rows: sizes are checked after every row, not after the usual hundred. Bytes stay as they are.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 1,
    "parquet.block.size.row.check.min": 1,
    "parquet.block.size.row.check.max": 1,
    "parquet.enable.dictionary": "false",
    "compression": "uncompressed",
}

def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """Files directly in a directory: path, name, size, time. Contents are not read."""
    if not path_exists(spark, directory):
        raise FileNotFoundError(f"Directory not found: {directory}")
    if not is_directory(spark, directory):
        raise ValueError(f"Path is not a directory: {directory}")
    listed = spark.read.format("binaryFile").load(*literal_paths([directory]))
    unscanned = spark.createDataFrame(unscanned_files(spark, directory), "path string, length long, modificationTime timestamp")
    return describe_files(listed.select("path", "length", "modificationTime").unionByName(unscanned))


def unscanned_files(spark: SparkSession, directory: str) -> list[tuple[str, int, datetime]]:
    """Path, size and time of the files directly in a directory that a scan passes over.

    Those are files of length zero and names that start with ``_``; both must be reported.
    """
    full = qualified(spark, directory).rstrip("/")
    found = {s[0]: s for s in glob_files(spark, f"{escaped(full)}/_*")}
    found |= {s[0]: s for s in _empty_files(spark, full)}
    return list(found.values())


def _empty_files(spark: SparkSession, full: str) -> list[tuple[str, int, datetime]]:
    if can_open([full]):
        try:
            filesystem, name = file_system(full)
            scheme = full[: len(full) - len(name)] if full.endswith(name) else full.split("/", 1)[0]
            listed = filesystem.get_file_info(fs.FileSelector(name))
            empty = [(scheme + f.path, 0, f.mtime) for f in listed if f.is_file and f.size == 0]
            return [e for e in empty if not e[0].rsplit("/", 1)[-1].startswith(".")]
        except Exception:
            log.warning("%s is listed by Spark", full, exc_info=True)
    # a file that the index has and the scan has not is empty
    scan = spark.read.format("binaryFile").load(*literal_paths([full]))
    indexed = spark.createDataFrame([(unquote(p),) for p in scan.inputFiles()], "path string")
    missed = indexed.join(scan.select("path"), "path", "left_anti").collect()
    return [s for row in missed for s in glob_files(spark, escaped(row.path))]


def describe_files(files: DataFrame) -> DataFrame:
    """Adds name, extension and format to rows of the binary file source."""
    name = file_name("path")
    endings = "|".join(e.replace(".", "\\.") for e in EXTENSIONS)
    compound = F.regexp_extract(F.lower(name), f"({endings})$", 1)
    last = F.regexp_extract(F.lower(name), r"(\.[^.]+)$", 1)
    extension = F.when(compound != "", compound).otherwise(last)
    kinds = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    return files.select(
        "path",
        name.alias("source_filename"),
        F.col("length").alias("file_bytes"),
        F.col("modificationTime").alias("modified_at"),
        extension.alias("extension"),
        kinds[extension].alias("file_format"),
    )


def supported(files: DataFrame) -> DataFrame:
    return files.filter(F.col("file_format").isNotNull() & ~F.col("source_filename").startswith("."))


def _literal_end(pattern: str) -> tuple[bool, str]:
    """The longer of what a pattern begins and ends with literally: whether it is the beginning, and the text."""
    head = re.split(r"[*?\[]", pattern, maxsplit=1)[0]
    tail = re.split(r"[*?\]]", pattern)[-1] if len(head) < len(pattern) else pattern
    return (True, head) if len(head) >= len(tail) else (False, tail)


def _matched_by_projection(files: DataFrame, sources: Sequence[SourceSpec]) -> DataFrame:
    """Adds ``matches``, one regular expression per declaration: nothing is joined."""
    found = F.array(*[F.when(F.col("source_filename").rlike(s.name_regex), F.lit(s.table)) for s in sources])
    return files.withColumn("matches", F.array_compact(found))


def _matched_by_index(files: DataFrame, sources: Sequence[SourceSpec]) -> DataFrame:
    """The same for many declarations: names are joined to patterns by literal beginnings and ends, then those few are tried."""
    spark = files.sparkSession
    letters = string.ascii_uppercase, string.ascii_lowercase
    fold = str.maketrans(*letters)
    rows, sizes = [], set()
    for number, source in enumerate(sources):
        for pattern in source.patterns:
            at_start, text = _literal_end(pattern)
            rows.append((number, source.table, glob_regex(pattern), at_start, text.translate(fold)))
            sizes.add((at_start, len(text)))
    patterns = spark.createDataFrame(rows, "number int, match string, regex string, at_start boolean, key string")
    patterns = F.broadcast(patterns) if len(rows) <= BROADCAST_ROWS else patterns
    name = F.translate("source_filename", *letters)
    keys = [
        F.struct(F.lit(at_start).alias("at_start"), (F.left(name, F.lit(n)) if at_start else F.right(name, F.lit(n))).alias("key"))
        for at_start, n in sorted(sizes)
    ]
    asked = files.select("path", "source_filename", F.explode(F.array(*keys)).alias("k")).select("path", "source_filename", "k.*")
    found = asked.join(patterns, ["at_start", "key"]).filter(F.regexp_like("source_filename", F.col("regex")))
    listed = F.array_sort(F.collect_set(F.struct("number", "match")))
    by_file = found.groupBy("path").agg(F.transform(listed, lambda m: m["match"]).alias("matches"))
    none = F.array().cast("array<string>")
    return files.join(by_file, "path", "left").select(*files.columns, F.coalesce("matches", none).alias("matches"))


def route(files: DataFrame, sources: Iterable[SourceSpec]) -> DataFrame:
    """Adds the table each file belongs to.

    Few declarations are part of the plan, one regular expression each; many are joined by what their patterns
    begin or end with. No match leaves ``table_name`` null; several matches, or a format the
    declaration does not read, leave an error.
    """
    sources = list(sources)
    many = len(sources) > FEW_SOURCES
    matched = (_matched_by_index if many else _matched_by_projection)(files, sources)
    kinds = {s.table: "any" if s.reader else s.format for s in sources}
    reader_of = F.from_json(F.lit(json.dumps(kinds)), "map<string, string>")  # one value, however many tables
    only = F.when(F.size("matches") == 1, F.get("matches", F.lit(0)))
    several = F.size("matches") > 1
    misfit = ~reader_of[only].isin("any") & (reader_of[only] != F.col("file_format"))
    hidden = (F.size("matches") == 1) & F.col("source_filename").startswith("_")
    message = F.when(
        several,
        F.concat(
            F.lit("Multiple sources match file '"),
            F.col("source_filename"),
            F.lit("': "),
            F.array_join("matches", ", "),
        ),
    ).when(
        misfit,
        F.concat(F.lit("No "), reader_of[only], F.lit(" reader for file '"), F.col("source_filename"), F.lit("'")),
    ).when(hidden, F.concat(F.lit("Spark reads no names that start with _: '"), F.col("source_filename"), F.lit("'")))
    return matched.select(
        *files.columns,
        only.alias("table_name"),
        F.size("matches").alias("match_count"),
        F.when(message.isNotNull(), F.lit(AMBIGUOUS_SOURCE)).alias("error_type"),
        message.alias("error_message"),
    )


def already_loaded(files: DataFrame, target: DataFrame) -> DataFrame:
    """Files whose name stands on any row of a target, or of its table of file names."""
    return files.join(target.select("source_filename").distinct(), "source_filename", "left_semi")


def not_loaded(files: DataFrame, target: DataFrame) -> DataFrame:
    names = target.select("source_filename").distinct()
    return files.join(names, "source_filename", "left_anti")


def archive_raw(
    spark: SparkSession,
    files: Sequence[tuple[str, int]],
    destination: str,
    chunk_bytes: int = CHUNK_BYTES,
    by_scan: bool = False,
) -> None:
    """Copies files, given as (path, bytes), into the raw zone before anything else happens.

    Every file, whatever its size and kind, is kept byte by byte: rows ``copy_id, source_filename, file_offset,
    bytes, chunk_digest`` below ``chunks``, written by the executors, and then one row per file below ``files``
    with its size and the digest of its chunks' digests. A copy is there once its ``files`` row is. Executors
    open the files; where they cannot, or ``by_scan``, a scan gives the same chunks and digests.
    """
    copy_id = uuid.uuid4().hex
    target = f"{destination}/chunks/copy_id={copy_id}"
    openable = not by_scan and can_open([p for p, _ in files])
    if openable:
        try:
            _opened_chunks(spark, files, chunk_bytes).write.options(**LARGE_ROWS).parquet(target)
        except Exception:
            log.warning("%d raw files are copied by a scan", len(files), exc_info=True)
            openable = False
    if not openable:
        with steady_splits(spark):
            _scanned_chunks(spark, files, chunk_bytes).write.mode("overwrite").options(**LARGE_ROWS).parquet(target)
    chunks = spark.read.schema(CHUNK).parquet(target)
    digests = raw_digests(chunks, "chunk_digest").withColumn("copy_id", F.lit(copy_id))
    digests.coalesce(1).write.mode("append").parquet(f"{destination}/files")


CHUNK = "source_filename string, file_offset long, bytes binary, chunk_digest string"


def _opened_chunks(spark: SparkSession, files: Sequence[tuple[str, int]], chunk_bytes: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                filesystem, name = file_system(row["path"])
                with filesystem.open_input_file(name) as source:
                    content = source.read_at(chunk_bytes, row["file_offset"]) if row["file_bytes"] else b""
                values = [row["source_filename"], row["file_offset"], content, hashlib.sha256(content).hexdigest()]
                kinds = [pa.string(), pa.int64(), pa.binary(), pa.string()]
                columns = [pa.array([v], k) for v, k in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["source_filename", "file_offset", "bytes", "chunk_digest"])

    listed = spark.createDataFrame(list(files), "path string, file_bytes long")
    places = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("file_bytes") - 1, F.lit(0)), F.lit(chunk_bytes).cast("long"))
    pieces = listed.select("path", "file_bytes", file_name("path").alias("source_filename"), F.explode(places).alias("file_offset"))
    count = sum(max(1, -(-size // chunk_bytes)) for _, size in files)
    parts = min(count, 4 * spark.sparkContext.defaultParallelism)
    return pieces.repartition(parts, "path", "file_offset").mapInArrow(read, CHUNK)


# Packed files as they are: a codec that leaves bytes alone takes the place of the one that unpacks. The name of its
# setting differs between the plain and the shaded library.
AS_IT_IS = {
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": ".gz",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".gz",
}

BYTE_ORDER_MARK = b"\xef\xbb\xbf"

PIECE = "source_filename string, chunk long, file_offset long, bytes binary"


def _byte_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``source_filename, file_block, value`` of every stretch of bytes between line feeds, whatever the bytes are."""
    scan = spark.read.options(**AS_IT_IS).option("lineSep", "\n").text(literal_paths(paths))
    return scan.select(scanned_name().alias("source_filename"), F.col("_metadata.file_block_start").alias(BLOCK), F.col("value").cast("binary").alias("value"))


def _split_places(lines: DataFrame, files: Sequence[tuple[str, int]]) -> DataFrame:
    """Per split: the offset of its first byte in the file, and what a scan of lines leaves out at the file's ends.

    Lines give all bytes but the line feed that a file may lack at its end and a byte order mark at its beginning.
    The listed length tells which: they have different sizes, and so have both together.
    """
    spark = lines.sparkSession
    sizes = [(p.rsplit("/", 1)[-1], size) for p, size in files]
    listed = spark.createDataFrame(sizes, "source_filename string, file_bytes long")
    splits = lines.groupBy("source_filename", BLOCK).agg(F.sum(F.octet_length("value") + 1).alias("split_bytes"))
    whole = Window.partitionBy("source_filename")
    before = whole.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.join(listed, "source_filename").select(
        "source_filename",
        BLOCK,
        "file_bytes",
        "split_bytes",
        F.coalesce(F.sum("split_bytes").over(before), F.lit(0)).alias("lines_before"),
        (F.col("file_bytes") - F.sum("split_bytes").over(whole)).alias("missing"),
        (F.col(BLOCK) == F.max(BLOCK).over(whole)).alias("is_last"),
    )
    changed = F.raise_error(F.concat(F.lit("The file changed while it was read: "), "source_filename")).cast("boolean")
    mark = F.when(F.col("missing").isin(2, 3), True).when(F.col("missing").isin(0, -1), False).otherwise(changed)
    return placed.select(
        "source_filename",
        BLOCK,
        "file_bytes",
        (F.col("lines_before") + F.when(mark & (F.col("lines_before") > 0), 3).otherwise(0)).alias("split_offset"),
        (mark & (F.col("lines_before") == 0)).alias("has_mark"),
        (F.col("is_last") & F.col("missing").isin(-1, 2)).alias("lacks_end"),
    )


def _cut_bytes(chunk_bytes: int, wanted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bytes of each split cut where the file's chunks end: those of whole chunks, or of parts of chunks, as wanted."""
        split, parts, size, at, length, lacks_end = None, [], 0, 0, 0, False

        def cut(end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, size, at
            held = b"".join(parts)
            if end and lacks_end:
                held = held[:-1]
            taken = 0
            while taken < len(held) and at < length:
                number = at // chunk_bytes
                stop = min((number + 1) * chunk_bytes, length)
                if stop - at > len(held) - taken and not end:
                    break
                piece = held[taken : taken + stop - at]
                is_whole = at == number * chunk_bytes and at + len(piece) == stop
                if is_whole == wanted:
                    row = [[split[0]], [number], [at], [piece]]
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["source_filename", "chunk", "file_offset", "bytes"])
                taken, at = taken + len(piece), at + len(piece)
            parts, size = [held[taken:]], len(held) - taken

        for key, piece in split_runs(batches):
            if key != split:
                if split is not None:
                    yield from cut(True)
                split, parts, size = key, [], 0
                length, at, has_mark, lacks_end = (piece.column(i)[0].as_py() for i in (3, 4, 5, 6))
                if has_mark:
                    parts, size = [BYTE_ORDER_MARK], len(BYTE_ORDER_MARK)
            for start in range(0, piece.num_rows, 1024):
                lines = piece.column(2).slice(start, 1024).to_pylist()
                parts += [b"\n".join(lines), b"\n"]
                size += sum(map(len, lines)) + len(lines)
                if size > chunk_bytes:  # the last byte may be a line feed that is not there
                    yield from cut(False)
        if split is not None:
            yield from cut(True)

    return run


def _scanned_chunks(spark: SparkSession, files: Sequence[tuple[str, int]], chunk_bytes: int) -> DataFrame:
    """The same chunks where only Spark can read, from a scan of lines: no value is larger than a chunk or a line.

    A first scan gives the place of every split in its file, a second the chunks that lie within a split; a
    third the parts of the others, two to a split, which alone are exchanged to be put together.
    """
    lines = _byte_lines(spark, [p for p, size in files if size])
    path = scratch_path(spark, "places")
    _split_places(lines, files).write.parquet(path)
    places = spark.read.parquet(path)
    count = places.count()
    unknown = F.raise_error(F.lit("The splits of a file changed while it was read")).cast("long")
    placed = with_splits(lines, places, count, "left").withColumn("file_bytes", F.coalesce("file_bytes", unknown))
    whole = placed.mapInArrow(_cut_bytes(chunk_bytes, True), PIECE).select("source_filename", "file_offset", "bytes")
    parts = placed.mapInArrow(_cut_bytes(chunk_bytes, False), PIECE)
    listed = F.array_sort(F.collect_list(F.struct("file_offset", "bytes")))
    joined = parts.groupBy("source_filename", "chunk").agg(listed.alias("parts")).select(
        "source_filename",
        F.col("parts")[0]["file_offset"].alias("file_offset"),
        F.reduce("parts", F.lit(b""), lambda found, part: F.concat(found, part["bytes"])).alias("bytes"),
    )
    # files without a line: empty ones, and a mark alone
    sizes = [(p.rsplit("/", 1)[-1], size) for p, size in files if size in (0, len(BYTE_ORDER_MARK))]
    listed = spark.createDataFrame(sizes, "source_filename string, file_bytes long")
    empty = listed.join(places, "source_filename", "left_anti").select(
        "source_filename", F.lit(0).cast("long").alias("file_offset"), F.when(F.col("file_bytes") == 0, b"").otherwise(BYTE_ORDER_MARK).alias("bytes")
    )
    return whole.unionByName(joined).unionByName(empty).withColumn("chunk_digest", F.sha2("bytes", 256))


def raw_digests(chunks: DataFrame, digest: str) -> DataFrame:
    """``source_filename, file_bytes, chunks, digest`` per file; offsets and digests of one file fit into a row."""
    listed = F.array_sort(F.collect_list(F.struct("file_offset", F.col(digest).alias("digest"))))
    joined = F.array_join(F.transform(listed, lambda c: c["digest"]), "")
    return chunks.groupBy("source_filename").agg(
        F.sum(F.length("bytes")).cast("long").alias("file_bytes"),
        F.count("*").alias("chunks"),
        F.sha2(joined.cast("binary"), 256).alias("digest"),
    )


def archived_chunks(spark: SparkSession, destination: str) -> DataFrame:
    """Chunks of all complete copies; a file is its chunks in the order of their offsets."""
    chunks = spark.read.schema(f"{CHUNK}, copy_id string").parquet(f"{destination}/chunks")
    copies = spark.read.parquet(f"{destination}/files").select("copy_id", "source_filename")
    return chunks.join(copies, ["copy_id", "source_filename"])


def raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .text(literal_paths(paths))
        .select(
            scanned_name().alias("source_filename"),
            F.col("_metadata.file_block_start").alias("file_block"),
            F.monotonically_increasing_id().alias("block_sequence"),
            "value",
        )
    )
