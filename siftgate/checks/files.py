"""Checks of readers and whole loads: a table is written out as files and read back."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftgate.checks.common import DIRTY_ORDERS, Query, export_csv, files_sql, many_splits, paths_in, table
from siftgate.functions.text import row_hash
from siftgate.operators import validate
from siftgate.operators.rows import SEQUENCE
from siftgate.plans import load
from siftgate.session import make_directory, path_exists, qualified, scratch_path, steady_splits
from siftgate.sources import discover, workbook_source
from siftgate.sources.csv_source import read_csv
from siftgate.sources.excel_source import CELLS, excel_headers, read_excel
from siftgate.sources.paths import file_system
from siftgate.sources.tables import Warehouse
from siftgate.spec import FieldSpec, Registry, SourceSpec
from siftgate.streaming import directory

CHECKS: dict[str, tuple[Query, str | None]] = {}


def scanned(spark: SparkSession, folder: str, source: SourceSpec) -> DataFrame:
    """Stage rows of every file in a folder."""
    raw, _ = load.scan(spark, source, paths_in(spark, folder))
    return load.drop_skipped(load.staged(raw, source), source)


# --- discovery and raw zone ---------------------------------------------------------------

ORDER_TEXT = {
    "o_orderkey": "CAST(o_orderkey AS STRING)",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING)",
    "o_orderdate": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "o_orderpriority": "o_orderpriority",
}
ORDER_LINE = "concat(" + ", ',', ".join(ORDER_TEXT.values()) + ")"
HEADER_LINE = ",".join(ORDER_TEXT)
ORDER_FILES = files_sql("orders")


def order_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in ORDER_TEXT.items()])


def _discover(spark, sf):
    plain = export_csv(spark, order_text(spark, sf), "listed")
    zipped = export_csv(spark, order_text(spark, sf), "listed-gz", files=4, compression="gzip")
    listed = discover.list_files(spark, plain).unionByName(discover.list_files(spark, zipped))
    sizes = F.when(F.col("extension") == ".csv", F.col("file_bytes"))
    return discover.supported(listed).groupBy("extension", "file_format").agg(
        F.count("*").alias("files"), F.sum(sizes).alias("plain_bytes")
    )


CHECKS["discover_files"] = (
    _discover,
    f"""SELECT '.csv' AS extension, 'csv' AS file_format, {ORDER_FILES} AS files,
      CAST(sum(strlen({ORDER_LINE}) + 1) + {ORDER_FILES} * {len(HEADER_LINE) + 1} AS BIGINT) AS plain_bytes FROM orders
    UNION ALL SELECT '.csv.gz', 'csv', {files_sql("orders", 4)}, NULL""",
)

CHECKS["raw_zone"] = (
    lambda spark, sf: discover.raw_lines(spark, paths_in(spark, export_csv(spark, order_text(spark, sf), "raw"))).select("value"),
    f"SELECT {ORDER_LINE} AS value FROM orders UNION ALL SELECT '{HEADER_LINE}' FROM range({ORDER_FILES})",
)


# Bytes of an archived row in the check: files lie below and above it.
CHECK_CHUNK = 64 * 1024


def _raw_files(spark, sf):
    """Archives plain and packed files, then compares the stored chunks with the sizes and digests noted."""
    plain = export_csv(spark, order_text(spark, sf), "raw")
    packed = export_csv(spark, order_text(spark, sf), "raw-gz", compression="gzip")
    archive = scratch_path(spark, "archive")
    listed = discover.supported(discover.list_files(spark, plain).unionByName(discover.list_files(spark, packed))).collect()
    discover.archive_raw(spark, [(r.path, r.file_bytes) for r in listed], archive, CHECK_CHUNK)
    noted = spark.read.parquet(f"{archive}/files").select("source_filename", "file_bytes", "chunks", "digest")
    chunks = discover.archived_chunks(spark, archive).withColumn("again", F.sha2("bytes", 256))
    intact = discover.raw_digests(chunks, "again").join(noted, noted.columns, "left_semi")
    plain_bytes = F.sum(F.when(F.col("source_filename").endswith(".csv"), F.col("file_bytes")))
    return intact.agg(F.count("*").alias("intact_files"), plain_bytes.alias("total_bytes"))


CHECKS["raw_zone_files"] = (
    _raw_files,
    f"""SELECT 2 * {ORDER_FILES} AS intact_files, CAST(sum(strlen({ORDER_LINE}) + 1) + {ORDER_FILES} * {len(HEADER_LINE) + 1} AS BIGINT) AS total_bytes
    FROM orders""",
)


def _raw_by_scan(spark, sf):
    """The same files archived both ways, the scan in many splits: whose sizes, chunks and digests agree."""
    plain = export_csv(spark, order_text(spark, sf), "raw")
    packed = export_csv(spark, order_text(spark, sf), "raw-gz", compression="gzip")
    listed = discover.supported(discover.list_files(spark, plain).unionByName(discover.list_files(spark, packed))).collect()
    files = [(r.path, r.file_bytes) for r in listed]
    noted = []
    with many_splits(spark, sum(size for _, size in files)):
        for by_scan in (False, True):
            archive = scratch_path(spark, "archive")
            discover.archive_raw(spark, files, archive, CHECK_CHUNK, by_scan)
            noted.append(spark.read.parquet(f"{archive}/files").select("source_filename", "file_bytes", "chunks", "digest"))
    plain_bytes = F.sum(F.when(F.col("source_filename").endswith(".csv"), F.col("file_bytes")))
    return noted[1].join(noted[0], noted[0].columns, "left_semi").agg(F.count("*").alias("equal_files"), plain_bytes.alias("total_bytes"))


CHECKS["raw_zone_by_scan"] = (_raw_by_scan, CHECKS["raw_zone_files"][1].replace("intact_files", "equal_files"))

# --- CSV ----------------------------------------------------------------------------------

DOCUMENTS = SourceSpec(
    "documents_loaded",
    ("*.csv",),
    (
        FieldSpec("doc_id", "int"),
        FieldSpec("text"),
        FieldSpec("lang"),
        FieldSpec("source"),
        FieldSpec("n_chars", "int"),
    ),
    ("doc_id",),
)


def _csv(spark, sf):
    """Whole texts with quotes and line breaks, through the multi-line reader."""
    folder = export_csv(spark, table(spark, sf, "documents"), "documents", long_rows=True)
    stage = scanned(spark, folder, DOCUMENTS)
    return stage.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"), "is_valid")


CHECKS["csv_scan"] = (
    _csv,
    "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5, true AS is_valid FROM documents",
)


def _split_csv(spark, sf):
    """The same texts from few large files, each read by many tasks: records reach over line breaks and splits."""
    folder = export_csv(spark, table(spark, sf, "documents"), "documents", files=2, long_rows=True)
    sizes = {r.path: r.file_bytes for r in discover.list_files(spark, folder).filter("file_format = 'csv'").collect()}
    path = scratch_path(spark, "documents-stage")
    header = [f.name for f in DOCUMENTS.fields]
    with many_splits(spark, sum(sizes.values())), steady_splits(spark):
        raw = read_csv(spark, list(sizes), DOCUMENTS, header, sizes=sizes, whole_bytes=0)
        load.staged(raw, DOCUMENTS).write.parquet(path)
    return spark.read.parquet(path)


def _split_cells(spark, sf):
    stage = _split_csv(spark, sf)
    return stage.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"), "is_valid")


CHECKS["csv_split_scan"] = (_split_cells, CHECKS["csv_scan"][1])


def _split_numbers(spark, sf):
    """Row numbers of those files: from 2, without gaps or repeats in any of them."""
    numbered = load.number_rows(_split_csv(spark, sf), DOCUMENTS)
    by_file = numbered.groupBy("source_filename").agg(
        F.count("*").alias("n"), F.min("file_row_number").alias("first"), F.max("file_row_number").alias("last"),
        F.count_distinct("file_row_number").alias("numbers"),
    )
    good = (F.col("first") == 2) & (F.col("last") == F.col("n") + 1) & (F.col("numbers") == F.col("n"))
    return by_file.agg(F.sum("n").alias("records"), F.count_if(~good).alias("bad_files"))


CHECKS["csv_split_row_numbers"] = (_split_numbers, "SELECT count(*) AS records, 0::BIGINT AS bad_files FROM documents")

ORDERS = SourceSpec(
    "orders_loaded",
    ("*.csv", "*.csv.gz"),
    (
        FieldSpec("o_orderkey", "int"),
        FieldSpec("o_orderstatus", max_length=1),
        FieldSpec("o_totalprice", "decimal", precision=12, scale=2),
        FieldSpec("o_orderdate", "date"),
        FieldSpec("o_orderpriority", max_length=20),
    ),
    ("o_orderkey",),
    multiline=False,
)
ORDERS_SQL = """SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


def order_columns(stage: DataFrame, *more: Column) -> DataFrame:
    day = F.col("o_orderdate").cast("string").alias("o_orderdate")
    return stage.select("o_orderkey", "o_orderstatus", "o_totalprice", day, "o_orderpriority", *more)


CHECKS["csv_gzip_scan"] = (
    lambda spark, sf: order_columns(
        scanned(spark, export_csv(spark, order_text(spark, sf), "zipped", compression="gzip"), ORDERS)
    ),
    ORDERS_SQL,
)

UNITS_ROWS = 2


def _with_unit_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    first = True
    for frame in frames:
        if first:
            units = pd.DataFrame([["unit"] * len(frame.columns)] * UNITS_ROWS, columns=frame.columns)
            yield units
            first = False
        yield frame


def _skipped(spark, sf):
    """Every file starts with two rows of units under its header."""
    plain = order_text(spark, sf).repartition(8)
    folder = export_csv(spark, plain.mapInPandas(_with_unit_rows, plain.schema), "units", files=None)
    source = SourceSpec(**{**ORDERS.__dict__, "skip_rows": UNITS_ROWS})
    return order_columns(scanned(spark, folder, source))


CHECKS["csv_skip_rows"] = (_skipped, ORDERS_SQL)

CUSTOMERS = SourceSpec(
    "customers_loaded",
    ("*.csv",),
    (
        FieldSpec("customer_id", "int", column="Cust Key"),
        FieldSpec("name", column="NAME"),
        FieldSpec("balance", "decimal", column="Account Balance", precision=12, scale=2),
    ),
    ("customer_id",),
)


def _renamed(spark, sf):
    """Aliased headers in another letter case, a repeated header, and columns nobody asked for."""
    plain = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS `Nation`", "CAST(c_acctbal AS DECIMAL(12, 2)) AS `account balance`", "c_custkey AS `CUST KEY`",
        "'old' AS `name`", "c_name AS `Name`", "c_mktsegment AS segment",
    )
    spark_case = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        folder = export_csv(spark, plain, "renamed")
    finally:
        spark.conf.set("spark.sql.caseSensitive", spark_case)
    return scanned(spark, folder, CUSTOMERS).select("customer_id", "name", "balance")


CHECKS["rename_prune"] = (
    _renamed,
    "SELECT c_custkey AS customer_id, c_name AS name, CAST(c_acctbal AS DECIMAL(12, 2)) AS balance FROM customer",
)


def _etl_columns(spark, sf):
    folder = export_csv(spark, order_text(spark, sf), "etl")
    stage = scanned(spark, folder, ORDERS)
    runs = spark.createDataFrame([(n.rsplit("/", 1)[-1], 7) for n in paths_in(spark, folder)], "source_filename string, file_load_log_id long")
    return stage.join(F.broadcast(runs), "source_filename").select(
        "o_orderkey", F.lower(F.hex("etl_row_hash")).alias("etl_row_hash"), "file_load_log_id", F.col("source_filename").rlike(r"^part-.*\.csv$").alias("is_named")
    )


CHECKS["etl_columns"] = (
    _etl_columns,
    """SELECT o_orderkey, sha256(concat_ws('|', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderpriority,
      o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR))) AS etl_row_hash, CAST(7 AS BIGINT) AS file_load_log_id,
      true AS is_named FROM orders""",
)


def _row_numbers(spark, sf):
    """Orders in key order over eight files; file number and row number give the place overall."""
    plain = order_text(spark, sf)
    ordered = plain.repartitionByRange(8, F.col("o_orderkey").cast("bigint")).sortWithinPartitions(F.col("o_orderkey").cast("bigint"))
    folder = export_csv(spark, ordered, "numbered", files=None)
    raw, _ = load.scan(spark, ORDERS, paths_in(spark, folder))
    numbered = load.number_rows(raw, ORDERS)
    lengths = numbered.groupBy("source_filename").agg(F.max("file_row_number").alias("last_row"))
    # a running sum over eight file names
    before = Window.orderBy("source_filename").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("source_filename", F.coalesce(F.sum(F.col("last_row") - 1).over(before), F.lit(0)).alias("start"))
    return numbered.join(F.broadcast(starts), "source_filename").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), (F.col("start") + F.col("file_row_number") - 1).alias("place")
    )


CHECKS["file_row_number"] = (
    _row_numbers,
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS place FROM orders",
)

def _with_header(lines: DataFrame, header: str) -> DataFrame:
    """The first line of every partition, and so of every file, gets a header before it."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # lower bits count within a partition
    return lines.select(F.when(first, F.concat(F.lit(f"{header}\n"), "line")).otherwise(F.col("line")).alias("line"))


RAGGED = SourceSpec(
    "ragged", ("*.txt",), (FieldSpec("doc_id", "int"), FieldSpec("text"), FieldSpec("lang")), ("doc_id",)
)


def _ragged(spark, sf):
    """Whole texts as quoted cells, in records of which a third has a cell too many and a third one too few."""
    text = "concat('\"', replace(text, '\"', '\"\"'), '\"')"
    rest = "CASE doc_id % 3 WHEN 0 THEN concat(',', lang, ',more') WHEN 1 THEN '' ELSE concat(',', lang) END"
    lines = table(spark, sf, "documents").selectExpr(f"concat(CAST(doc_id AS STRING), ',', {text}, {rest}) AS line")
    folder = scratch_path(spark, "ragged")
    _with_header(lines.repartition("line"), "doc_id,text,lang").write.text(folder)
    paths = [r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    raw, _ = load.scan(spark, RAGGED, paths)
    kinds = F.array_join(F.transform("validation_errors", lambda e: e["error_type"]), ",")
    # a record with too many cells is judged by its shape alone
    return load.staged(raw, RAGGED).select(
        "doc_id", F.md5("text").alias("text_md5"), "lang", "is_valid", F.coalesce(kinds, F.lit("")).alias("kinds")
    )


CHECKS["csv_ragged"] = (
    _ragged,
    """SELECT doc_id, md5(text) AS text_md5, CASE WHEN doc_id % 3 <> 1 THEN lang END AS lang, doc_id % 3 = 2 AS is_valid,
      CASE doc_id % 3 WHEN 0 THEN 'too_many_columns' WHEN 1 THEN 'string_type' ELSE '' END AS kinds FROM documents""",
)

# --- JSON ---------------------------------------------------------------------------------

DOCUMENT_RECORDS = 5000


def _write_documents(spark: SparkSession, records: DataFrame, key: str, label: str) -> str:
    """One JSON document per 5000 keys, one document per file."""
    numbered = records.withColumn("document", F.floor(F.col(key) / DOCUMENT_RECORDS))
    fields = [c for c in records.columns]
    entries = F.array_sort(F.collect_list(F.struct(*fields)))
    body = F.concat(F.lit('{"entries": {"item": '), F.to_json(entries, {"ignoreNullFields": "false"}), F.lit("}}"))
    path = scratch_path(spark, label)
    numbered.groupBy("document").agg(body.alias("value")).write.partitionBy("document").text(path)
    return path


ENTRIES = SourceSpec(
    "entries",
    ("*.json",),
    (
        FieldSpec("key", "int"),
        FieldSpec("price", "float", nullable=True),
        FieldSpec("status"),
        FieldSpec("day", "date"),
    ),
    ("key",),
    format="json",
    array_path="entries.item",
)


def _json_array(spark, sf):
    records = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS key", "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price", "o_orderstatus AS status",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS day",
    )
    folder = _write_documents(spark, records, "key", "entries")
    paths = [r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    raw, _ = load.scan(spark, ENTRIES, paths)
    return load.staged(raw, ENTRIES).select(
        "key", "price", "status", F.col("day").cast("string").alias("day"), "is_valid", (F.col(SEQUENCE) + 1).alias("row_number")
    )


CHECKS["json_array_scan"] = (
    _json_array,
    f"""SELECT o_orderkey AS key, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, o_orderstatus AS status,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, true AS is_valid,
      row_number() OVER (PARTITION BY o_orderkey // {DOCUMENT_RECORDS} ORDER BY o_orderkey) AS row_number FROM orders""",
)

NESTED = SourceSpec(
    "nested",
    ("*.json",),
    (
        FieldSpec("order_key", "int"),
        FieldSpec("order_info_status"),
        FieldSpec("parts_0_price", "float"),
        FieldSpec("parts_1_price", "float"),
        FieldSpec("codes"),
    ),
    ("order_key",),
    format="json",
    json_lines=True,
)


def _json_flatten(spark, sf):
    """Nested objects, a list of objects and a list of scalars per record, one record per line."""
    records = table(spark, sf, "orders").selectExpr(
        "named_struct('Key', o_orderkey, 'info', named_struct('Status', o_orderstatus)) AS order",
        "array(named_struct('price', o_totalprice), named_struct('price', CAST(o_custkey AS DOUBLE))) AS parts",
        "array(o_custkey, o_orderkey) AS codes",
    )
    folder = scratch_path(spark, "nested")
    records.write.json(folder)
    return scanned(spark, folder, NESTED).select(*NESTED.field_names)


CHECKS["json_flatten"] = (
    _json_flatten,
    """SELECT o_orderkey AS order_key, o_orderstatus AS order_info_status, o_totalprice AS parts_0_price,
      CAST(o_custkey AS DOUBLE) AS parts_1_price, concat('[', o_custkey, ',', o_orderkey, ']') AS codes FROM orders""",
)

MIXED = SourceSpec(
    "mixed",
    ("*",),
    (FieldSpec("id", "int"), FieldSpec("info_status"), FieldSpec("note", nullable=True)),
    ("id",),
    format="json",
    array_path="",
)


def _json_mixed(spark, sf):
    """Keys that differ from record to record in spelling and nesting, and one that few records have."""
    key, status = "CAST(o_orderkey AS STRING)", "concat('\"', o_orderstatus, '\"')"
    shapes = (
        f"concat('{{\"Id\": ', {key}, ', \"info\": {{\"status\": ', {status}, '}}}}')",
        f"concat('{{\"id\": ', {key}, ', \"INFO\": {{\"Status\": ', {status}, '}}, \"note\": null}}')",
        f"concat('{{\"ID\": ', {key}, ', \"info_status\": ', {status}, ', \"Note\": \"n\"}}')",
    )
    # the first record of a document has all declared keys
    choice = f"CASE WHEN o_orderkey % {DOCUMENT_RECORDS} = 0 THEN {shapes[2]} " + " ".join(
        f"WHEN o_orderkey % 3 = {i} THEN {shape}" for i, shape in enumerate(shapes)
    ) + " END"
    records = table(spark, sf, "orders").selectExpr("o_orderkey", f"{choice} AS record", f"o_orderkey DIV {DOCUMENT_RECORDS} AS document")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "record"))), lambda r: r["record"])
    body = F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]"))
    folder = scratch_path(spark, "mixed")
    records.groupBy("document").agg(body.alias("value")).write.partitionBy("document").text(folder)
    paths = [r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    raw, _ = load.scan(spark, MIXED, paths)
    kinds = F.array_join(F.transform("validation_errors", lambda e: e["error_type"]), ",")
    return load.staged(raw, MIXED).select("id", "info_status", "note", F.coalesce(kinds, F.lit("")).alias("kinds"))


# Only the third spelling carries a note; a record without the key is rejected, one with a null is not.
CHECKS["json_mixed_keys"] = (
    _json_mixed,
    f"""SELECT o_orderkey AS id, o_orderstatus AS info_status, CASE WHEN third THEN 'n' END AS note,
      CASE WHEN NOT third AND o_orderkey % 3 = 0 THEN 'missing' ELSE '' END AS kinds
    FROM (SELECT *, o_orderkey % {DOCUMENT_RECORDS} = 0 OR o_orderkey % 3 = 2 AS third FROM orders) AS o""",
)

# What a JSON value must look like to pass as text, whole number, number and boolean.
JSON_VALUES = {
    "click": "concat('\"', CAST(user_id AS STRING), '\"')",
    "error": "CAST(user_id AS STRING)",
    "purchase": "concat(CAST(user_id AS STRING), '.5')",
    "signup": "'true'",
    "view": "'null'",
}
_JSON_RESULTS = {
    # event type: value as whole number, then the error of each reading
    "click": ("user_id", None, None, None, "bool_parsing"),
    "error": ("user_id", "string_type", None, None, "bool_parsing"),
    "purchase": ("NULL", "string_type", "int_from_float", None, "bool_type"),
    "signup": ("1", "string_type", None, None, None),
    "view": ("NULL", "string_type", "int_type", "float_type", "bool_type"),
}


def _json_types(spark, sf):
    """The same value read as four types; numbers stay numbers until a field asks for them."""
    choice = "CASE event_type " + " ".join(f"WHEN '{e}' THEN {v}" for e, v in JSON_VALUES.items()) + " END"
    names = ("as_text", "as_int", "as_float", "as_bool")
    lines = table(spark, sf, "events").selectExpr(
        f"concat('{{\"event_id\": ', CAST(event_id AS STRING), " + ", ".join(f"', \"{n}\": ', {choice}" for n in names) + ", '}') AS value"
    )
    folder = scratch_path(spark, "typed")
    lines.write.text(folder)
    fields = tuple(FieldSpec(n, t) for n, t in zip(names, ("str", "int", "float", "bool")))
    source = SourceSpec("typed", ("*",), (FieldSpec("event_id", "int"), *fields), ("event_id",), format="json", json_lines=True)
    paths = [r.path for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    raw, _ = load.scan(spark, source, paths)
    checked = validate.validate(raw, source.fields, carry=())

    def error_of(name: str):
        return F.try_element_at(F.filter("errors", lambda e: e["column_name"] == name), F.lit(1))["error_type"].alias(f"{name}_error")

    return checked.select("event_id", F.col("as_int").alias("int_value"), *[error_of(n) for n in names])


def _json_case(position: int) -> str:
    quote = lambda v: "NULL" if v is None else f"'{v}'"
    return "CASE event_type " + " ".join(
        f"WHEN '{e}' THEN {r[0] if position == 0 else quote(r[position])}" for e, r in _JSON_RESULTS.items()
    ) + " END"


# Users 0 and 1 read as booleans, as text and as numbers.
CHECKS["validate_json_types"] = (
    _json_types,
    f"""SELECT event_id, CAST({_json_case(0)} AS BIGINT) AS int_value, {_json_case(1)} AS as_text_error, {_json_case(2)} AS as_int_error,
      {_json_case(3)} AS as_float_error,
      CASE WHEN event_type IN ('click', 'error') AND user_id IN (0, 1) THEN NULL ELSE {_json_case(4)} END AS as_bool_error FROM events""",
)

# --- Excel --------------------------------------------------------------------------------

WORKBOOK_ROWS = 500
_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook(sheets: dict[str, list[list]]) -> bytes:
    """A small .xlsx file with inline texts; numbers stay numbers, None leaves a cell out."""

    def column(i: int) -> str:
        return (column(i // 26 - 1) if i >= 26 else "") + chr(ord("A") + i % 26)

    def cell(value, r: int, c: int) -> str:
        where = f"{column(c)}{r}"
        if isinstance(value, bool):
            return f'<c r="{where}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{where}"><v>{value!r}</v></c>'
        return f'<c r="{where}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed, links = [], []
        for n, (name, lines) in enumerate(sheets.items(), 1):
            body = "".join(
                f'<row r="{r}">' + "".join(cell(v, r, c) for c, v in enumerate(line) if v is not None) + "</row>"
                for r, line in enumerate(lines, 1)
            )
            book.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="{_SHEET}"><sheetData>{body}</sheetData></worksheet>')
            listed.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
            links.append(f'<Relationship Id="rId{n}" Type="{_RELATIONS}/worksheet" Target="worksheets/sheet{n}.xml"/>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_SHEET}" xmlns:r="{_RELATIONS}"><sheets>{"".join(listed)}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{"".join(links)}</Relationships>')
    return out.getvalue()


PARTS = SourceSpec(
    "parts",
    ("*.xlsx",),
    (
        FieldSpec("sku", "int", column="SKU"),
        FieldSpec("name", column="Product Name"),
        FieldSpec("price", "float", column="Price"),
        FieldSpec("stocked", "date", column="Stocked"),
        FieldSpec("updated", "timestamp", column="Last Updated"),
    ),
    ("sku",),
    format="excel",
    sheet="Products",
    skip_rows=1,
)


def _workbooks(spark, sf):
    """Parts in workbooks of 500, each with a sheet of notes, a header and a row of units."""
    folder = qualified(spark, scratch_path(spark, "workbooks"))
    plain = table(spark, sf, "part").selectExpr(
        "p_partkey", "p_name", "p_retailprice", "p_size", f"CAST(p_partkey DIV {WORKBOOK_ROWS} AS BIGINT) AS book"
    )

    def write(group: pd.DataFrame) -> pd.DataFrame:
        lines = [["Price", "SKU", "Last Updated", "Product Name", "Stocked"], ["EUR", "-", "-", "-", "-"]]
        for row in group.sort_values("p_partkey").itertuples():
            lines.append([row.p_retailprice, int(row.p_partkey), 45306 + row.p_size / 64, row.p_name, int(45306 + row.p_size)])
        content = workbook({"Notes": [["not this sheet"]], "Products": lines})
        filesystem, root = file_system(folder)
        filesystem.create_dir(root, recursive=True)
        with filesystem.open_output_stream(f"{root}/inventory_{group['book'].iloc[0]}.xlsx") as out:
            out.write(content)
        return group[["book"]].head(1)

    # by number, as Spark would leave so few bytes to few tasks; a task writes up to 64 books then
    books = -(-plain.count() // WORKBOOK_ROWS)
    tasks = max(1, min(books, 8 * spark.sparkContext.defaultParallelism), books // 64)
    plain.repartition(tasks, "book").groupBy("book").applyInPandas(write, "book long").count()
    return folder


def _part_rows(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "sku", "name", "price", F.col("stocked").cast("string").alias("stocked"), F.unix_seconds("updated").alias("updated"), "file_row_number",
        "is_valid",
    )


def _excel(spark, sf):
    return _part_rows(load.number_rows(scanned(spark, _workbooks(spark, sf), PARTS), PARTS))


CHECKS["excel_scan"] = (
    _excel,
    f"""SELECT p_partkey AS sku, p_name AS name, p_retailprice AS price, CAST(DATE '1899-12-30' + (45306 + p_size) AS VARCHAR) AS stocked,
      CAST(45306 AS BIGINT) * 86400 - 2209161600 + CAST(p_size * 1350 AS BIGINT) AS updated,
      row_number() OVER (PARTITION BY p_partkey // {WORKBOOK_ROWS} ORDER BY p_partkey) + 2 AS file_row_number, true AS is_valid FROM part""",
)


def _excel_format(spark, sf):
    """The same workbooks through the format of their own, as batch and as stream."""
    workbook_source.register(spark)
    folder, root = _workbooks(spark, sf), scratch_path(spark, "sheets")
    stream = spark.readStream.format("workbook").option("sheet", PARTS.sheet).load(folder)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/stream").option("path", f"{root}/cells").trigger(
        availableNow=True
    ).start().awaitTermination()
    # parsed once, as in a load: header and records both come from what is written
    spark.read.format("workbook").option("sheet", PARTS.sheet).load(folder).write.parquet(f"{root}/batch")
    batch, streamed = (spark.read.schema(CELLS).parquet(f"{root}/{way}") for way in ("batch", "cells"))
    (header,) = {tuple(r.header) for r in excel_headers(batch).collect()}
    found = [
        _part_rows(load.number_rows(load.drop_skipped(load.staged(read_excel(cells, PARTS, header), PARTS), PARTS), PARTS))
        for cells in (batch, streamed)
    ]
    return found[0].withColumn("way", F.lit("batch")).unionByName(found[1].withColumn("way", F.lit("stream")))


CHECKS["excel_format"] = (
    _excel_format,
    f"SELECT * FROM ({CHECKS['excel_scan'][1]}) AS scan, (VALUES ('batch'), ('stream')) AS ways(way)",
)

# --- whole loads --------------------------------------------------------------------------

DIRTY_FEED = SourceSpec(
    "orders_loaded",
    ("*.csv",),
    (
        FieldSpec("order_key", "int"),
        FieldSpec("customer", "int"),
        FieldSpec("price", "decimal", ge=0, precision=18, scale=2),
        FieldSpec("order_date", "date"),
        FieldSpec("status", allowed=("F", "O", "P")),
    ),
    ("order_key",),
    audit_sql="SELECT CASE WHEN SUM(CASE WHEN price >= 0 THEN 1 ELSE 0 END) = COUNT(*) THEN 1 ELSE 0 END AS not_negative FROM {table}",
    error_threshold=0.9,
    multiline=False,
)
OLD_PRICE = "CAST(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice - 1 ELSE o_totalprice END AS DECIMAL(18, 2))"


def _loaded(spark: SparkSession, sf: str, kind: type[Warehouse] = Warehouse) -> tuple[DataFrame, Warehouse]:
    """Dirty orders as files, loaded over a target that knows the delivered ones already."""
    root = scratch_path(spark, "warehouse")
    warehouse = kind(spark, root)
    orders = table(spark, sf, "orders")
    known = orders.filter("o_orderstatus = 'F'").selectExpr(
        "o_orderkey AS order_key", "o_custkey AS customer", f"{OLD_PRICE} AS price", "CAST(o_orderdate AS DATE) AS order_date",
        "o_orderstatus AS status",
    )
    seeded = known.select(
        "*",
        row_hash([(f.name, f.spark_type) for f in DIRTY_FEED.fields]).alias("etl_row_hash"),
        F.lit("first.csv").alias("source_filename"),
        F.lit(0).cast("bigint").alias("file_load_log_id"),
        F.timestamp_seconds(F.lit(1000)).alias("etl_created_at"),
        F.lit(None).cast("timestamp").alias("etl_updated_at"),
    )
    warehouse.commit(DIRTY_FEED, seeded)
    folder = export_csv(spark, orders.selectExpr(*[f"{e} AS {n}" for n, e in DIRTY_ORDERS.items()]), "dirty", files=3)
    results = load.load_directory(spark, Registry([DIRTY_FEED]), folder, warehouse)
    return results, warehouse


_DIRTY_LOAD_SQL = f"""cells AS (SELECT *, {DIRTY_ORDERS["customer"]} = 'not_a_number' OR o_orderkey % 23 = 0 OR o_orderkey % 31 = 0
    OR o_orderkey % 29 = 0 AS bad, {OLD_PRICE} AS old_price, CAST(o_totalprice AS DECIMAL(18, 2)) AS new_price, o_orderstatus = 'F' AS known
  FROM orders)"""


def _load_summary(spark, sf):
    """What the run says about its files, added up."""
    results, _ = _loaded(spark, sf)
    counters = ("records_processed", "validation_errors", "records_stage_loaded", "target_inserts", "target_updates")
    return results.agg(
        F.count("*").alias("files"), F.count_if("success").alias("successful"), *[F.sum(c).alias(c) for c in counters]
    )


CHECKS["load_summary"] = (
    _load_summary,
    f"""WITH {_DIRTY_LOAD_SQL} SELECT {files_sql("orders", 3)} AS files, {files_sql("orders", 3)} AS successful, count(*) AS records_processed,
      count(*) FILTER (WHERE bad) AS validation_errors, count(*) FILTER (WHERE NOT bad) AS records_stage_loaded,
      count(*) FILTER (WHERE NOT bad AND NOT known) AS target_inserts,
      count(*) FILTER (WHERE NOT bad AND known AND old_price <> new_price) AS target_updates FROM cells""",
)


def _load_target(spark, sf):
    """The published table after the run."""
    _, warehouse = _loaded(spark, sf)
    return warehouse.target(DIRTY_FEED).select(
        "order_key", "customer", "price", F.col("order_date").cast("string").alias("order_date"), "status",
        (F.col("source_filename") == "first.csv").alias("untouched"), F.col("etl_updated_at").isNotNull().alias("updated"),
    )


CHECKS["load_directory"] = (
    _load_target,
    f"""WITH {_DIRTY_LOAD_SQL} SELECT o_orderkey AS order_key, o_custkey AS customer, CASE WHEN bad THEN old_price ELSE new_price END AS price,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderstatus AS status,
      known AND (bad OR old_price = new_price) AS untouched, known AND NOT bad AND old_price <> new_price AS updated
    FROM cells WHERE known OR NOT bad""",
)


class BreaksOnce(Warehouse):
    """A warehouse whose first merge breaks before its commit, as when an executor's last try fails."""

    def upsert(self, *args) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/broke"):
            make_directory(self.spark, f"{self.root}/broke")
            raise RuntimeError("broken once")
        return super().upsert(*args)


def _load_retry(spark, sf):
    """The same load while its merge breaks once: files are taken apart, nothing is lost or kept twice."""
    results, warehouse = _loaded(spark, sf, BreaksOnce)
    letters = warehouse.dead_letters()
    copies = spark.read.parquet(f"{warehouse.root}/raw/{DIRTY_FEED.table}/files")
    log = warehouse.run_log()
    counted = results.agg(
        F.count_if("success").alias("successful"), F.sum("validation_errors").alias("reported"),
        F.sum("target_inserts").alias("target_inserts"), F.sum("target_updates").alias("target_updates"),
    )
    each = {
        "stored": letters.count(), "letter_files": letters.select("source_filename").distinct().count(), "copies": copies.count(),
        "logged": log.filter("success AND ended_at IS NOT NULL").count(), "target_rows": warehouse.target(DIRTY_FEED).count(),
    }
    return counted.select("*", *[F.lit(v).cast("bigint").alias(n) for n, v in each.items()])


CHECKS["load_retry"] = (
    _load_retry,
    f"""WITH {_DIRTY_LOAD_SQL} SELECT {files_sql("orders", 3)} AS successful, count(*) FILTER (WHERE bad) AS reported,
      count(*) FILTER (WHERE NOT bad AND NOT known) AS target_inserts,
      count(*) FILTER (WHERE NOT bad AND known AND old_price <> new_price) AS target_updates,
      count(*) FILTER (WHERE bad) AS stored, {files_sql("orders", 3)} AS letter_files, {files_sql("orders", 3)} AS copies, {files_sql("orders", 3)} AS logged,
      count(*) FILTER (WHERE known OR NOT bad) AS target_rows FROM cells""",
)


def _streamed(spark, sf):
    """The first files are loaded, more arrive, and a second run takes only those."""
    orders = order_text(spark, sf)
    folder, root = scratch_path(spark, "watched"), scratch_path(spark, "warehouse")
    warehouse, registry = Warehouse(spark, root), Registry([ORDERS])
    for part in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        orders.filter(part).repartition(4).write.mode("append").option("header", True).csv(folder)
        directory.watch(spark, registry, folder, warehouse, f"{root}/stream").awaitTermination()
    runs = warehouse.run_log().agg(F.count_if("success").alias("loaded_files"), F.count("*").alias("all_files"))
    counts = runs.first()
    return order_columns(
        warehouse.target(ORDERS),
        F.lit(counts.loaded_files).cast("bigint").alias("loaded_files"),
        F.lit(counts.all_files).cast("bigint").alias("all_files"),
    )


CHECKS["stream_ingest"] = (
    _streamed,
    f"SELECT *, CAST(8 AS BIGINT) AS loaded_files, CAST(8 AS BIGINT) AS all_files FROM ({ORDERS_SQL}) AS o",
)


def _streamed_and_moved(spark, sf):
    """The same in two runs; the files of the first are moved aside as the second begins."""
    orders = order_text(spark, sf)
    folder, root = scratch_path(spark, "watched"), scratch_path(spark, "warehouse")
    aside = scratch_path(spark, "aside")
    warehouse, registry = Warehouse(spark, root), Registry([ORDERS])
    for part in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        orders.filter(part).repartition(4).write.mode("append").option("header", True).csv(folder)
        directory.watch(spark, registry, folder, warehouse, f"{root}/stream", move_to=aside).awaitTermination()
    moved = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(aside).count()
    left = discover.supported(discover.list_files(spark, folder)).count()
    return order_columns(
        warehouse.target(ORDERS), F.lit(moved).cast("bigint").alias("moved_files"), F.lit(left).cast("bigint").alias("left_files")
    )


CHECKS["stream_move_files"] = (
    _streamed_and_moved,
    f"SELECT *, CAST(4 AS BIGINT) AS moved_files, CAST(4 AS BIGINT) AS left_files FROM ({ORDERS_SQL}) AS o",
)

ROUTED_TABLES = 2000


def _route_many(spark, sf):
    """File names of all orders' customers, routed among two thousand declarations: some overlap, some do not exist."""
    sources = [SourceSpec(f"customer_{i}", (f"Cust{i}_*.csv", f"*_old{i}.csv"), (FieldSpec("k"),), ("k",)) for i in range(ROUTED_TABLES)]
    sources.append(SourceSpec("thousands", ("*_1????0.csv",), (FieldSpec("k"),), ("k",)))
    name = "concat(if(o_orderkey % 7 = 0, concat('x_old', o_custkey), concat('CUST', o_custkey, '_', o_orderkey)), '.csv')"
    files = table(spark, sf, "orders").selectExpr(
        f"concat('/in/', o_orderkey, '/', {name}) AS path", f"{name} AS source_filename", "'csv' AS file_format"
    )
    routed = discover.route(files, sources)
    return routed.groupBy("table_name", "match_count", "error_type").agg(F.count("*").alias("files"))


CHECKS["route_many"] = (
    _route_many,
    f"""WITH hits AS (SELECT o_custkey, o_custkey < {ROUTED_TABLES} AS own,
        o_orderkey % 7 <> 0 AND regexp_full_match(CAST(o_orderkey AS VARCHAR), '1....0') AS thousand FROM orders)
    SELECT CASE WHEN own AND NOT thousand THEN concat('customer_', o_custkey) WHEN thousand AND NOT own THEN 'thousands' END AS table_name,
      CAST(own AS INTEGER) + CAST(thousand AS INTEGER) AS match_count,
      CASE WHEN own AND thousand THEN 'ValueError' END AS error_type, count(*) AS files FROM hits GROUP BY 1, 2, 3""",
)
