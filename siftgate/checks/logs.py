"""Checks of the run log, dead letters and reports. Every event stands for a run or a dead letter."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftgate.checks.common import Query, table
from siftgate.operators import logs
from siftgate.sources import discover, headers
from siftgate.spec import FieldSpec, SourceSpec

CHECKS: dict[str, tuple[Query, str | None]] = {}

K = "CAST(replace(replace(props, '{\"k\": ', ''), '}', '') AS INT)"
EVENT_FILE = "concat(event_type, '_', CAST(user_id AS STRING), '.csv')"

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _fold(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "event_id", *[F.when(F.col("event_type") == e, F.col("value")).alias(f"last_{e}") for e in EVENT_TYPES]
    )
    return logs.fold_events(events, "user_id", "event_id", [f"last_{e}" for e in EVENT_TYPES])


CHECKS["run_log_fold"] = (
    _fold,
    "SELECT user_id, "
    + ", ".join(f"arg_max(value, event_id) FILTER (WHERE event_type = '{e}') AS last_{e}" for e in EVENT_TYPES)
    + " FROM events GROUP BY user_id",
)

# Run k gets as far as its number says; the highest ones are done, or were duplicates.
RUN_COLUMNS = {
    "id": "event_id",
    "source_filename": EVENT_FILE,
    "duplicate_skipped": "CASE WHEN k >= 95 THEN true END",
    "archive_copy_success": "CASE WHEN k >= 10 AND k < 95 THEN true END",
    "processing_success": "CASE WHEN k >= 25 AND k < 95 THEN true WHEN k >= 10 AND k < 95 THEN false END",
    "stage_load_success": "CASE WHEN k >= 40 AND k < 95 THEN true END",
    "audit_success": "CASE WHEN k >= 55 AND k < 95 THEN true WHEN k >= 40 AND k < 95 THEN false END",
    "merge_success": "CASE WHEN k >= 70 AND k < 95 THEN true END",
    "success": "CASE WHEN k >= 75 AND k < 95 THEN true WHEN k < 95 THEN false END",
    "error_type": "CASE WHEN k < 10 THEN 'OSError' WHEN k < 25 THEN 'Missing Header' WHEN k < 40 THEN 'Validation Threshold Exceeded' "
    "WHEN k < 55 THEN 'Audit Failed' WHEN k < 70 THEN 'Grain Validation Error' WHEN k < 75 THEN 'KeyError' "
    "WHEN k >= 95 THEN 'Duplicate File Detected' END",
    "error_message": "CASE WHEN k < 75 OR k >= 95 THEN concat('run ', CAST(event_id AS STRING), ' of ', repeat(event_type, k)) END",
}
_RUNS_SQL = "runs AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in RUN_COLUMNS.items()) + f" FROM (SELECT *, {K} AS k FROM events) AS e)"


def _runs(spark, sf):
    return table(spark, sf, "events").withColumn("k", F.expr(K)).selectExpr(
        "*", *[f"{e} AS {n}" for n, e in RUN_COLUMNS.items()]
    )


CHECKS["run_report"] = (
    lambda spark, sf: logs.run_report(
        _runs(spark, sf).select(
            *RUN_COLUMNS,
            F.col("ts").cast("timestamp").alias("started_at"),
            F.timestamp_add("SECOND", F.col("k"), F.col("ts").cast("timestamp")).alias("ended_at"),
            *[F.lit(None).cast("bigint").alias(c) for c in logs.COUNTERS],
        ),
        "%rr%",
    ).select(
        "file_load_id",
        F.col("start_date").cast("string").alias("start_date"),
        "source_filename",
        F.col("run_time").cast("string").alias("run_time"),
        "stage_failed_at",
        "failure_reason",
    ),
    f"""WITH {_RUNS_SQL}
    SELECT id AS file_load_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS start_date, source_filename,
      printf('INTERVAL ''0 00:%02d:%02d'' DAY TO SECOND', CAST(floor(k / 60) AS INTEGER), k % 60) AS run_time,
      CASE WHEN k >= 95 THEN 'Duplicate File' WHEN k >= 75 THEN NULL WHEN k < 10 THEN 'Archive Copy' WHEN k < 25 THEN 'Processing'
        WHEN k < 40 THEN 'Stage Load' WHEN k < 55 THEN 'Audit' WHEN k < 70 THEN 'Publish' ELSE 'Unknown' END AS stage_failed_at,
      error_type AS failure_reason
    FROM runs WHERE source_filename LIKE '%rr%'""",
)

CHECKS["batch_totals"] = (
    lambda spark, sf: logs.batch_totals(_runs(spark, sf)),
    f"""WITH {_RUNS_SQL} SELECT count(*) AS files, count(*) FILTER (WHERE success) AS successful,
      count(*) FILTER (WHERE success IS NOT true) AS failed FROM runs""",
)

CHECKS["failure_summary"] = (
    lambda spark, sf: logs.code_failures(_runs(spark, sf)),
    f"""WITH {_RUNS_SQL} SELECT id, concat('• ', source_filename, ' (log_id: ', id, '): ', error_type, ' - ',
      CASE WHEN length(error_message) > 200 THEN concat(left(error_message, 200), '...') ELSE error_message END) AS line
    FROM runs WHERE error_type IN ('OSError', 'KeyError')""",
)

CHECKS["failure_totals"] = (
    lambda spark, sf: logs.failure_summary(_runs(spark, sf)),
    f"""WITH {_RUNS_SQL}, counted AS (
      SELECT count(*) FILTER (WHERE error_type IN ('OSError', 'KeyError')) AS failure_count, count(*) AS total_count FROM runs)
    SELECT *, printf('File processing completed with %d failure(s) out of %d file(s).', failure_count, total_count) AS summary FROM counted""",
)

CHECKS["notification_rows"] = (
    lambda spark, sf: logs.notifications(
        _runs(spark, sf),
        F.when(F.col("event_type") == "view", F.array(F.lit("a@example.com"), F.lit("b@example.com")))
        .when(F.col("event_type") == "click", F.array(F.lit("c@example.com")))
        .otherwise(F.array().cast("array<string>")),
    ).withColumn("recipients", F.array_join("recipients", ",")),
    f"""WITH {_RUNS_SQL} SELECT id, source_filename, error_type, error_message,
      CASE event_type WHEN 'view' THEN 'a@example.com,b@example.com' ELSE 'c@example.com' END AS recipients
    FROM runs WHERE event_type IN ('view', 'click') AND error_type IS NOT NULL AND error_type NOT IN ('OSError', 'KeyError')""",
)

# --- dead letters -------------------------------------------------------------------------


def _letters(spark, sf):
    return table(spark, sf, "events").selectExpr(
        f"{EVENT_FILE} AS source_filename", "event_id + 2 AS file_row_number", f"user_id * 100 + {K} AS file_load_log_id",
        "map('props', props) AS file_record_data", "value AS validation_errors", "ts AS failed_at", "event_type",
    )


def _cleanup(spark, sf):
    letters = _letters(spark, sf)
    reloaded = (
        letters.filter(F.col("event_type").isin("purchase", "view"))
        .groupBy("source_filename")
        .agg((F.floor(F.min("file_load_log_id") / 100) * 100 + 20).alias("file_load_log_id"))
    )
    kept = [
        logs.cleanup(letters, reloaded, mode).select("source_filename", "file_row_number").withColumn("mode", F.lit(mode))
        for mode in ("older", "all")
    ]
    return kept[0].unionByName(kept[1])


CHECKS["dlq_cleanup"] = (
    _cleanup,
    f"""WITH letters AS (SELECT *, {EVENT_FILE} AS source_filename, {K} AS k,
        min({K}) OVER (PARTITION BY event_type, user_id) AS first_k FROM events)
    SELECT source_filename, event_id + 2 AS file_row_number, 'older' AS mode FROM letters
      WHERE NOT (event_type IN ('purchase', 'view') AND k < 20)
    UNION ALL SELECT source_filename, event_id + 2, 'all' FROM letters
      WHERE NOT (event_type IN ('purchase', 'view') AND first_k < 20)""",
)


def _orphans(spark, sf):
    letters = _letters(spark, sf)
    log = letters.filter(F.col("event_type") == "signup").select(F.col("file_load_log_id").alias("id"))
    return logs.orphans(letters, log).select("source_filename", "file_row_number", "file_load_log_id")


CHECKS["dlq_orphans"] = (
    _orphans,
    f"""SELECT {EVENT_FILE} AS source_filename, event_id + 2 AS file_row_number, user_id * 100 + {K} AS file_load_log_id FROM events
    WHERE user_id * 100 + {K} NOT IN (SELECT user_id * 100 + {K} FROM events WHERE event_type = 'signup')""",
)

CHECKS["dlq_report"] = (
    lambda spark, sf: logs.dead_letter_report(_letters(spark, sf), "error_8.csv").select(
        "file_row_number", F.col("file_record_data")["props"].alias("props"), F.unix_micros(F.col("failed_at").cast("timestamp")).alias("failed_at")
    ),
    f"""SELECT event_id + 2 AS file_row_number, props, epoch_us(ts) AS failed_at FROM events WHERE {EVENT_FILE} = 'error_8.csv'
    ORDER BY file_row_number""",
)

# --- files known by name ------------------------------------------------------------------


def _known(spark, sf):
    files = table(spark, sf, "events").selectExpr(f"{EVENT_FILE} AS source_filename").distinct()
    target = table(spark, sf, "orders").selectExpr(
        "concat(CASE WHEN o_orderstatus = 'F' THEN 'view_' ELSE 'click_' END, CAST(o_custkey AS STRING), '.csv') AS source_filename"
    )
    loaded = discover.already_loaded(files, target).withColumn("duplicate", F.lit(True))
    return loaded.unionByName(discover.not_loaded(files, target).withColumn("duplicate", F.lit(False)))


CHECKS["already_processed"] = (
    _known,
    f"""WITH files AS (SELECT DISTINCT {EVENT_FILE} AS source_filename FROM events)
    SELECT source_filename, source_filename IN (
      SELECT concat(CASE WHEN o_orderstatus = 'F' THEN 'view_' ELSE 'click_' END, CAST(o_custkey AS STRING), '.csv') FROM orders) AS duplicate
    FROM files""",
)

# One event is one file name; every kind of match comes up.
FILE_NAMES = """CASE event_type WHEN 'purchase' THEN concat('sales_', CAST(event_id AS STRING), '.csv')
  WHEN 'click' THEN concat('Customers-', CAST(event_id AS STRING), '.CSV')
  WHEN 'view' THEN concat('ledger_', CAST(event_id AS STRING), CASE WHEN value < 10 THEN '.xlsx' ELSE '.json' END)
  WHEN 'error' THEN concat('notes_', CAST(event_id AS STRING), '.csv.gz')
  ELSE concat('SALES_old_', CAST(event_id AS STRING), '.csv') END"""


def _feed(table_name: str, pattern: str, kind: str = "csv") -> SourceSpec:
    return SourceSpec(table_name, (pattern,), (FieldSpec("id"),), ("id",), format=kind)


def _routed(spark, sf):
    named = table(spark, sf, "events").selectExpr(
        f"{FILE_NAMES} AS path", "CAST(event_id AS BIGINT) AS length", "CAST(ts AS TIMESTAMP) AS modificationTime"
    )
    feeds = [
        _feed("transactions", "sales_*.csv"),
        _feed("old_transactions", "sales_old_*[!x].csv"),
        _feed("customers", "customers-*.csv"),
        _feed("ledger", "ledger_?*", "json"),
    ]
    routed = discover.route(discover.supported(discover.describe_files(named)), feeds)
    return routed.select("source_filename", "extension", "file_format", "table_name", "match_count", "error_type", "error_message")


CHECKS["route_files"] = (
    _routed,
    f"""WITH named AS (SELECT *, {FILE_NAMES} AS source_filename FROM events)
    SELECT source_filename,
      CASE WHEN event_type = 'view' THEN CASE WHEN value < 10 THEN '.xlsx' ELSE '.json' END WHEN event_type = 'error' THEN '.csv.gz' ELSE '.csv' END AS extension,
      CASE WHEN event_type = 'view' THEN CASE WHEN value < 10 THEN 'excel' ELSE 'json' END ELSE 'csv' END AS file_format,
      CASE event_type WHEN 'purchase' THEN 'transactions' WHEN 'click' THEN 'customers' WHEN 'view' THEN 'ledger' END AS table_name,
      CAST(CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 0 ELSE 1 END AS INTEGER) AS match_count,
      CASE WHEN event_type = 'signup' OR (event_type = 'view' AND value < 10) THEN 'ValueError' END AS error_type,
      CASE WHEN event_type = 'signup' THEN concat('Multiple sources match file ''', source_filename, ''': transactions, old_transactions')
        WHEN event_type = 'view' AND value < 10 THEN concat('No json reader for file ''', source_filename, '''') END AS error_message
    FROM named""",
)

# One order is the header of one file.
HEADERS = {
    "1-URGENT": "array('Order Key', 'STATUS', 'price', 'note')",
    "2-HIGH": "array('', '  ', NULL)",
    "3-MEDIUM": "array('order key', 'note')",
    "4-NOT SPECIFIED": "array()",
    "5-LOW": "array('1', '-2', '')",
}
HEADED = SourceSpec(
    "headed", ("*.csv",), (FieldSpec("key", column="Order Key"), FieldSpec("status"), FieldSpec("price", "float")), ("key",)
)


def _headers(spark, sf):
    choice = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN CAST({h} AS ARRAY<STRING>)" for p, h in HEADERS.items()) + " END"
    files = table(spark, sf, "orders").selectExpr("concat('in/', CAST(o_orderkey AS STRING), '.csv') AS path", f"{choice} AS header")
    plain = headers.check_headers(files, HEADED).withColumn("spreadsheet", F.lit(False))
    sheets = headers.check_headers(files, HEADED, spreadsheet=True).withColumn("spreadsheet", F.lit(True))
    return plain.unionByName(sheets).select("path", "spreadsheet", "error_type", "error_message")


_HEADER_SQL = """SELECT concat('in/', o_orderkey, '.csv') AS path, {sheet} AS spreadsheet,
  CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '3-MEDIUM' THEN 'Missing Columns' WHEN '5-LOW' THEN '{low}' ELSE 'Missing Header' END AS error_type,
  CASE o_orderpriority WHEN '2-HIGH' THEN concat('{blank} in {kind} file: in/', o_orderkey, '.csv')
    WHEN '3-MEDIUM' THEN concat('Missing required fields in .CSV file ', o_orderkey, '.csv', chr(10), 'Required fields: order key, price, status', chr(10), 'Missing fields: price, status')
    WHEN '4-NOT SPECIFIED' THEN concat('No headers found in {kind} file: in/', o_orderkey, '.csv')
    WHEN '5-LOW' THEN CASE WHEN {sheet} THEN concat('{blank} in {kind} file: in/', o_orderkey, '.csv') ELSE
      concat('Missing required fields in .CSV file ', o_orderkey, '.csv', chr(10), 'Required fields: order key, price, status', chr(10), 'Missing fields: order key, price, status') END
  END AS error_message FROM orders"""

CHECKS["header_check"] = (
    _headers,
    _HEADER_SQL.format(sheet="false", low="Missing Columns", kind="CSV", blank="Whitespace-only headers")
    + " UNION ALL "
    + _HEADER_SQL.format(sheet="true", low="Missing Header", kind="Excel", blank="Empty or invalid column headers"),
)


def _missing(spark, sf):
    """Headers made of the words of every document, checked against the words a feed declares."""
    words = ("the", "and", "que", "der", "Les", "of")
    feed = SourceSpec("words", ("*",), tuple(FieldSpec(f"w{i}", column=w) for i, w in enumerate(words)), ("w0",))
    lists = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("header"))
    return lists.select("doc_id", F.array_join(headers.missing_columns(F.col("header"), feed), ",").alias("missing"))


CHECKS["missing_columns"] = (
    _missing,
    "WITH lists AS (SELECT doc_id, string_split(lower(text), ' ') AS header FROM documents) SELECT doc_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT list_contains(header, '{w}') THEN '{w}' END" for w in ("and", "der", "les", "of", "que", "the"))
    + ") AS missing FROM lists",
)
