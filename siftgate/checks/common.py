"""Shared inputs of the checks. Expressions here are read the same way by Spark and by SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.operators import validate
from siftgate.operators.rows import BLOCK, SEQUENCE
from siftgate.plans.load import SPLIT_BYTES, staged
from siftgate.session import scratch_path
from siftgate.sources.csv_source import SHAPE
from siftgate.spec import FieldSpec, SourceSpec

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The exports of a check have so many rows in a file at most; the SQL counts files the same way.
ROWS_PER_FILE = 1_000_000
# Where rows may be long, nor more bytes of cells than about this, as one task writes a file.
FILE_BYTES = 256 * 1024 * 1024


def files_sql(table_name: str, least: int = 8) -> str:
    """Number of files an export of a table has, as SQL text."""
    return f"(SELECT greatest({least}, CAST(ceil(count(*) / {ROWS_PER_FILE}.0) AS BIGINT)) FROM {table_name})"


def files_for(rows: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Number of files that rows are spread over, by their count and by the bytes of their cells."""
    cells = [F.coalesce(F.octet_length(rows[i].cast("string")), F.lit(0)) for i in range(len(rows.columns))]
    count, size = rows.agg(F.count("*"), F.sum(sum(cells, F.lit(0).cast("bigint")))).first()
    return max(-(-count // ROWS_PER_FILE), -(-(size or 0) // file_bytes))


def export_csv(spark: SparkSession, rows: DataFrame, label: str, files: int | None = 8, long_rows: bool = False, **options) -> str:
    """Writes rows as CSV files with headers into a scratch folder; returns the folder.

    There are ``files`` files, more if there are many rows; ``files=None`` keeps the partitions as they
    are, one file each. With ``long_rows`` bytes are counted, too.
    """
    path = scratch_path(spark, label)
    spread = rows if files is None else rows.repartition(max(files, files_for(rows) if long_rows else -(-rows.count() // ROWS_PER_FILE)))
    writer = spread.write.option("header", True).option("quote", '"').option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.options(**options).csv(path)
    return path


@contextmanager
def many_splits(spark: SparkSession, total_bytes: int, least: int = 64 * 1024) -> Iterator[None]:
    """Scans cut files of so many bytes into about 64 splits, so that small tables too have files of several; large ones have more."""
    size = str(min(SPLIT_BYTES, max(least, total_bytes // 64)))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for name in names:
        spark.conf.set(name, size)
    try:
        yield
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def paths_in(spark: SparkSession, folder: str) -> list[str]:
    from siftgate.sources.discover import list_files

    return [r.path for r in list_files(spark, folder).filter("file_format IS NOT NULL").select("path").collect()]


# Orders as they might come in files: one file per priority, with faulty cells put in. The
# urgent file is the worst one. Every order is in it.
DIRTY_ORDERS = {
    "order_key": "CAST(o_orderkey AS STRING)",
    "customer": "CASE WHEN o_orderkey % 17 = 0 OR (o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0) "
    "THEN 'not_a_number' ELSE CAST(o_custkey AS STRING) END",
    "price": "CASE WHEN o_orderkey % 23 = 0 THEN 'n/a' WHEN o_orderkey % 31 = 0 THEN '-5' "
    "ELSE CAST(o_totalprice AS STRING) END",
    "order_date": "CASE WHEN o_orderkey % 29 = 0 THEN 'invalid_date' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "status": "o_orderstatus",
}
ORDER_FILE = "concat('orders_', replace(lower(o_orderpriority), ' ', '_'), '.csv')"
ORDER_ROW = "o_orderkey + 2"

ORDERS_FEED = SourceSpec(
    table="orders_loaded",
    patterns=("orders_*.csv",),
    fields=(
        FieldSpec("order_key", max_length=20),
        FieldSpec("customer", "int"),
        FieldSpec("price", "decimal", ge=0, precision=18, scale=2),
        FieldSpec("order_date", "date"),
        FieldSpec("status", allowed=("F", "O", "P")),
    ),
    grain=("order_key",),
    error_threshold=0.3,
    owners=("orders@example.com",),
)

# The same verdicts in SQL: one error column per field, null when the cell is fine.
DIRTY_SQL = f"""dirty AS (
  SELECT o_orderkey, {ORDER_FILE} AS source_filename, {ORDER_ROW} AS file_row_number,
         {', '.join(f'{e} AS {n}' for n, e in DIRTY_ORDERS.items())}
  FROM orders
), judged AS (
  SELECT *,
    CASE WHEN customer = 'not_a_number' THEN 'int_parsing' END AS customer_error,
    CASE WHEN price = 'n/a' THEN 'decimal_parsing' WHEN price = '-5' THEN 'greater_than_equal' END AS price_error,
    CASE WHEN order_date = 'invalid_date' THEN 'date_parsing' END AS order_date_error
  FROM dirty
), verdicts AS (
  SELECT *, customer_error IS NULL AND price_error IS NULL AND order_date_error IS NULL AS is_valid FROM judged
)"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty orders in the shape every reader delivers."""
    return table(spark, sf_dir, "orders").selectExpr(
        f"{ORDER_FILE} AS source_filename",
        f"CAST(0 AS BIGINT) AS {BLOCK}",
        f"o_orderkey AS {SEQUENCE}",
        f"{ORDER_ROW} AS file_row_number",
        f"CAST(NULL AS STRING) AS {SHAPE}",
        *[f"{expression} AS {name}" for name, expression in DIRTY_ORDERS.items()],
    )


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(dirty_orders(spark, sf_dir), ORDERS_FEED, carry=["file_row_number"])


def checked_field(spark: SparkSession, sf_dir: str, name: str, key: str, text: str, spec: FieldSpec) -> DataFrame:
    """``key, value, error_type`` of one text expression over a whole table."""
    raw = table(spark, sf_dir, name).selectExpr(key, f"{text} AS {spec.name}")
    checked = validate.validate(raw, [spec], carry=[key])
    return checked.select(
        key,
        F.when(F.size("errors") == 0, F.col(spec.name)).alias("value"),
        F.try_element_at("errors", F.lit(1))["error_type"].alias("error_type"),
    )
