"""Checks of record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftgate.checks.common import DIRTY_SQL, ORDERS_FEED, Query, checked_field, staged_orders, table
from siftgate.functions.text import clean_email, clean_phone, excel_serial_to_date, excel_serial_to_timestamp, row_hash
from siftgate.functions.messages import RECORD_ERRORS
from siftgate.operators import logs, validate
from siftgate.spec import FieldSpec

CHECKS: dict[str, tuple[Query, str | None]] = {}

INT_TEXT = """CASE o_orderkey % 12
  WHEN 0 THEN 'not_a_number' WHEN 1 THEN concat(CAST(o_custkey AS STRING), '.0')
  WHEN 2 THEN concat(' ', CAST(o_custkey AS STRING), ' ') WHEN 3 THEN concat('+', CAST(o_custkey AS STRING))
  WHEN 4 THEN '' WHEN 5 THEN concat(CAST(o_custkey AS STRING), '.5')
  WHEN 6 THEN concat(CAST(o_custkey AS STRING), 'e3') WHEN 7 THEN NULL
  WHEN 8 THEN concat('1_000', CAST(o_custkey AS STRING)) WHEN 9 THEN concat('9999999999999999999', CAST(o_custkey AS STRING))
  WHEN 10 THEN concat('00', CAST(o_custkey AS STRING)) ELSE CAST(o_custkey AS STRING) END"""

CHECKS["validate_int"] = (
    lambda spark, sf: checked_field(spark, sf, "orders", "o_orderkey", INT_TEXT, FieldSpec("cell", "int")),
    f"""WITH cells AS (SELECT o_orderkey, {INT_TEXT} AS cell FROM orders),
    shaped AS (SELECT *, regexp_matches(trim(cell), '^[+-]?[0-9]+(_[0-9]+)*([.]0+)?$') AS whole FROM cells),
    typed AS (SELECT *, CASE WHEN whole THEN
        TRY_CAST(regexp_replace(replace(trim(cell), '_', ''), '[.]0+$', '') AS BIGINT) END AS value FROM shaped)
    SELECT o_orderkey, value,
      CASE WHEN cell IS NULL THEN 'int_type' WHEN value IS NOT NULL THEN NULL
           WHEN whole THEN 'int_parsing_size' ELSE 'int_parsing' END AS error_type FROM typed""",
)

FLOAT_TEXT = """CASE o_orderkey % 10
  WHEN 0 THEN concat(CAST(o_custkey AS STRING), 'd') WHEN 1 THEN concat(CAST(o_custkey AS STRING), 'e2')
  WHEN 2 THEN concat('.', CAST(o_custkey AS STRING)) WHEN 3 THEN concat(CAST(o_custkey AS STRING), '.')
  WHEN 4 THEN '' WHEN 5 THEN concat('0x', CAST(o_custkey AS STRING)) WHEN 6 THEN NULL
  WHEN 7 THEN concat('1_0', CAST(o_custkey AS STRING), '.5') WHEN 8 THEN concat(' -', CAST(o_totalprice AS STRING), ' ')
  ELSE CAST(o_totalprice AS STRING) END"""

CHECKS["validate_float"] = (
    lambda spark, sf: checked_field(spark, sf, "orders", "o_orderkey", FLOAT_TEXT, FieldSpec("cell", "float")),
    f"""WITH cells AS (SELECT o_orderkey, {FLOAT_TEXT} AS cell FROM orders),
    shaped AS (SELECT *, regexp_matches(trim(cell),
      '^[+-]?([0-9]+(_[0-9]+)*[.]?([0-9]+(_[0-9]+)*)?|[.][0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?$') AS number FROM cells)
    SELECT o_orderkey, CASE WHEN number THEN CAST(replace(trim(cell), '_', '') AS DOUBLE) END AS value,
      CASE WHEN cell IS NULL THEN 'float_type' WHEN number THEN NULL ELSE 'float_parsing' END AS error_type
    FROM shaped""",
)

BOOL_TEXT = """CASE o_orderkey % 16
  WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN 'YES' WHEN 3 THEN 'no' WHEN 4 THEN 'on' WHEN 5 THEN 'OFF'
  WHEN 6 THEN 't' WHEN 7 THEN 'F' WHEN 8 THEN 'y' WHEN 9 THEN 'N' WHEN 10 THEN '1' WHEN 11 THEN '0'
  WHEN 12 THEN ' true' WHEN 13 THEN NULL WHEN 14 THEN CAST(o_custkey + 2 AS STRING) ELSE '' END"""

CHECKS["validate_bool"] = (
    lambda spark, sf: checked_field(spark, sf, "orders", "o_orderkey", BOOL_TEXT, FieldSpec("cell", "bool")),
    f"""WITH cells AS (SELECT o_orderkey, {BOOL_TEXT} AS cell FROM orders),
    typed AS (SELECT *, CASE WHEN lower(cell) IN ('1', 'on', 't', 'true', 'y', 'yes') THEN true
      WHEN lower(cell) IN ('0', 'off', 'f', 'false', 'n', 'no') THEN false END AS value FROM cells)
    SELECT o_orderkey, value, CASE WHEN cell IS NULL THEN 'bool_type' WHEN value IS NULL THEN 'bool_parsing' END AS error_type
    FROM typed""",
)

DECIMAL_TEXT = """CASE o_orderkey % 9
  WHEN 0 THEN 'nan' WHEN 1 THEN '-Infinity' WHEN 2 THEN concat('1_0', CAST(o_custkey AS STRING))
  WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN concat(CAST(o_custkey AS STRING), 'e2')
  WHEN 6 THEN concat('99999999999999', CAST(o_custkey + 10 AS STRING)) WHEN 7 THEN concat('$', CAST(o_totalprice AS STRING))
  ELSE CAST(o_totalprice AS STRING) END"""

CHECKS["validate_decimal"] = (
    lambda spark, sf: checked_field(
        spark, sf, "orders", "o_orderkey", DECIMAL_TEXT, FieldSpec("cell", "decimal", precision=12, scale=2)
    ),
    f"""WITH cells AS (SELECT o_orderkey, {DECIMAL_TEXT} AS cell FROM orders),
    shaped AS (SELECT *, regexp_matches(cell, '^[0-9_.]+(e[0-9]+)?$') AS number FROM cells),
    typed AS (SELECT *, CASE WHEN number THEN TRY_CAST(replace(cell, '_', '') AS DECIMAL(12, 2)) END AS value FROM shaped)
    SELECT o_orderkey, value,
      CASE WHEN cell IS NULL THEN 'decimal_type' WHEN value IS NOT NULL THEN NULL
           WHEN lower(cell) IN ('nan', '-infinity') THEN 'finite_number'
           WHEN number THEN 'decimal_max_digits' ELSE 'decimal_parsing' END AS error_type FROM typed""",
)

ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
DATE_TEXT = f"""CASE o_orderkey % 10
  WHEN 0 THEN 'invalid_date' WHEN 1 THEN replace({ORDER_DAY}, '-', '') WHEN 2 THEN concat({ORDER_DAY}, 'T10:30:00')
  WHEN 3 THEN concat({ORDER_DAY}, ' 23:59:59.5+02:00') WHEN 4 THEN '2023-02-30' WHEN 5 THEN '' WHEN 6 THEN NULL
  WHEN 7 THEN concat(' ', {ORDER_DAY}) WHEN 8 THEN replace({ORDER_DAY}, '-', '/') ELSE {ORDER_DAY} END"""

CHECKS["validate_date"] = (
    lambda spark, sf: checked_field(spark, sf, "orders", "o_orderkey", DATE_TEXT, FieldSpec("cell", "date")).select(
        "o_orderkey", F.col("value").cast("string").alias("value"), "error_type"
    ),
    f"""WITH cells AS (SELECT o_orderkey, {DATE_TEXT} AS cell FROM orders),
    typed AS (SELECT *, CASE
        WHEN regexp_matches(cell, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ][0-9:.+]+)?$') THEN TRY_CAST(left(cell, 10) AS DATE)
        WHEN regexp_matches(cell, '^[0-9]{{8}}$') THEN CAST(TRY_STRPTIME(cell, '%Y%m%d') AS DATE) END AS value FROM cells)
    SELECT o_orderkey, CAST(value AS VARCHAR) AS value,
      CASE WHEN cell IS NULL THEN 'date_type' WHEN value IS NULL THEN 'date_parsing' END AS error_type FROM typed""",
)

EVENT_TIME = "concat(CAST(CAST(ts AS DATE) AS STRING), '@10:20:30')"
TIMESTAMP_TEXT = f"""CASE event_id % 8
  WHEN 0 THEN replace({EVENT_TIME}, '@', 'T') WHEN 1 THEN replace({EVENT_TIME}, '@', ' ')
  WHEN 2 THEN concat(replace({EVENT_TIME}, '@', 'T'), 'Z') WHEN 3 THEN concat(replace({EVENT_TIME}, '@', 'T'), '+02:00')
  WHEN 4 THEN {EVENT_TIME} WHEN 5 THEN CAST(CAST(ts AS DATE) AS STRING) WHEN 6 THEN NULL
  ELSE concat(replace({EVENT_TIME}, '@', 'T'), '.250') END"""

CHECKS["validate_timestamp"] = (
    lambda spark, sf: checked_field(
        spark, sf, "events", "event_id", TIMESTAMP_TEXT, FieldSpec("cell", "timestamp")
    ).select("event_id", F.unix_micros("value").alias("value"), "error_type"),
    f"""WITH cells AS (SELECT event_id, ts, {TIMESTAMP_TEXT} AS cell FROM events)
    SELECT event_id, CASE event_id % 8 WHEN 4 THEN NULL WHEN 6 THEN NULL
        WHEN 3 THEN epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) + 30030000000
        WHEN 5 THEN epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))
        WHEN 7 THEN epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) + 37230250000
        ELSE epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) + 37230000000 END AS value,
      CASE WHEN cell IS NULL THEN 'timestamp_type' WHEN event_id % 8 = 4 THEN 'datetime_parsing' END AS error_type
    FROM cells""",
)

CUSTOMER_NAME = "replace(c_name, '#', '.')"
EMAIL_TEXT = f"""CASE c_custkey % 9
  WHEN 0 THEN concat({CUSTOMER_NAME}, '@Example.COM') WHEN 1 THEN concat({CUSTOMER_NAME}, 'example.com')
  WHEN 2 THEN concat({CUSTOMER_NAME}, '@localhost') WHEN 3 THEN concat('.', {CUSTOMER_NAME}, '@example.com')
  WHEN 4 THEN concat({CUSTOMER_NAME}, '@-bad.com') WHEN 5 THEN concat(' ', {CUSTOMER_NAME}, '+tag@mail.example.org ')
  WHEN 6 THEN concat({CUSTOMER_NAME}, '@ex ample.com') WHEN 7 THEN NULL ELSE concat(c_mktsegment, '@example.co.uk') END"""

CHECKS["validate_email"] = (
    lambda spark, sf: checked_field(spark, sf, "customer", "c_custkey", EMAIL_TEXT, FieldSpec("cell", "email")),
    f"""WITH cells AS (SELECT c_custkey, {EMAIL_TEXT} AS cell FROM customer),
    shaped AS (SELECT *, length(trim(cell)) <= 254 AND length(split_part(trim(cell), '@', 1)) <= 64 AND regexp_matches(trim(cell),
      '^[A-Za-z0-9!#$%&''*+/=?^_`{{|}}~-]+([.][A-Za-z0-9!#$%&''*+/=?^_`{{|}}~-]+)*@([A-Za-z0-9]([A-Za-z0-9-]{{0,61}}[A-Za-z0-9])?[.])+[A-Za-z][A-Za-z0-9-]{{0,61}}[A-Za-z0-9]$')
      AS good FROM cells)
    SELECT c_custkey, CASE WHEN good THEN concat(split_part(trim(cell), '@', 1), '@', lower(split_part(trim(cell), '@', 2))) END AS value,
      CASE WHEN cell IS NULL THEN 'string_type' WHEN NOT good THEN 'value_error' END AS error_type FROM shaped""",
)


def _required(spark, sf):
    """A required and a nullable reading of the same cells."""
    text = "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_totalprice AS STRING) END"
    required = checked_field(spark, sf, "orders", "o_orderkey", text, FieldSpec("cell", "float"))
    nullable = checked_field(spark, sf, "orders", "o_orderkey", text, FieldSpec("cell", "float", nullable=True))
    return required.withColumn("nullable", F.lit(False)).unionByName(nullable.withColumn("nullable", F.lit(True)))


CHECKS["validate_required"] = (
    _required,
    """SELECT o_orderkey, nullable, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS value,
      CASE WHEN o_orderstatus = 'F' THEN 'float_parsing' WHEN o_orderstatus = 'P' AND NOT nullable THEN 'float_type' END AS error_type
    FROM (SELECT *, false AS nullable FROM orders UNION ALL SELECT *, true FROM orders) AS readings""",
)

CHECKS["validate_length"] = (
    lambda spark, sf: checked_field(spark, sf, "documents", "doc_id", "text", FieldSpec("cell", max_length=500)).select(
        "doc_id", F.length("value").alias("value_length"), "error_type"
    ),
    """SELECT doc_id, CASE WHEN length(text) <= 500 THEN CAST(length(text) AS INTEGER) END AS value_length,
      CASE WHEN length(text) > 500 THEN 'string_too_long' END AS error_type FROM documents""",
)


def _range(spark, sf):
    spec = FieldSpec("cell", "decimal", ge=0, lt=9000, precision=12, scale=2)
    return checked_field(spark, sf, "customer", "c_custkey", "CAST(c_acctbal AS STRING)", spec)


CHECKS["validate_range"] = (
    _range,
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal < 9000 THEN CAST(c_acctbal AS DECIMAL(12, 2)) END AS value,
      CASE WHEN c_acctbal >= 9000 THEN 'less_than' WHEN c_acctbal < 0 THEN 'greater_than_equal' END AS error_type
    FROM customer""",
)

CHECKS["validate_allowed"] = (
    lambda spark, sf: checked_field(
        spark, sf, "part", "p_partkey", "p_type", FieldSpec("cell", allowed=("ECONOMY", "STANDARD", "PROMO"))
    ),
    """SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN p_type END AS value,
      CASE WHEN p_type NOT IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'literal_error' END AS error_type FROM part""",
)

PHONE = "concat(' (', CAST(c_custkey AS STRING), ') ', c_name, ' x', CAST(c_nationkey AS STRING))"


def _cleaners(spark, sf):
    rows = table(spark, sf, "customer")
    return rows.select(
        "c_custkey",
        clean_phone(F.expr(PHONE)).alias("phone"),
        clean_phone(F.col("c_mktsegment")).alias("no_digits"),
        clean_email(F.concat(F.lit("  "), F.col("c_name"), F.lit("@EXAMPLE.com "))).alias("email"),
    )


CHECKS["clean_phone_email"] = (
    _cleaners,
    f"""SELECT c_custkey, regexp_replace({PHONE}, '[^0-9+]', '', 'g') AS phone, c_mktsegment AS no_digits,
      lower(concat(c_name, '@EXAMPLE.com')) AS email FROM customer""",
)


def _split(spark, sf):
    stage = staged_orders(spark, sf)
    return stage.select(
        "source_filename",
        "file_row_number",
        "is_valid",
        F.when(F.col("is_valid"), F.col("customer")).alias("customer"),
        F.when(F.col("is_valid"), F.col("price")).alias("price"),
        F.when(F.col("is_valid"), F.col("order_date").cast("string")).alias("order_date"),
    )


CHECKS["valid_invalid_split"] = (
    _split,
    f"""WITH {DIRTY_SQL}
    SELECT source_filename, file_row_number, is_valid, CASE WHEN is_valid THEN CAST(customer AS BIGINT) END AS customer,
      CASE WHEN is_valid THEN CAST(price AS DECIMAL(18, 2)) END AS price, CASE WHEN is_valid THEN order_date END AS order_date
    FROM verdicts""",
)


def _dead_letters(spark, sf):
    rejected = staged_orders(spark, sf).filter(~F.col("is_valid")).withColumn("file_load_log_id", F.lit(1).cast("bigint"))
    letters = logs.dead_letters(rejected, ORDERS_FEED.table, F.current_timestamp())
    joined = lambda c: F.array_join(F.transform("validation_errors", lambda e: e[c]), ",")
    return letters.select(
        "source_filename",
        "file_row_number",
        "target_table_name",
        F.array_join(F.array_sort(F.map_keys("file_record_data")), ",").alias("record_columns"),
        F.col("file_record_data")["order_key"].alias("order_key"),
        joined("column_name").alias("column_names"),
        joined("column_value").alias("column_values"),
        joined("error_type").alias("error_types"),
        F.get_json_object(F.to_json("validation_errors"), "$[0].error_msg").alias("first_message"),
        validate.errors_text(F.col("validation_errors")).startswith("[{column_name: ").alias("is_text"),
    )


CHECKS["dlq_rows"] = (
    _dead_letters,
    f"""WITH {DIRTY_SQL}
    SELECT source_filename, file_row_number, 'orders_loaded' AS target_table_name,
      concat_ws(',', CASE WHEN customer_error IS NOT NULL THEN 'customer' END, CASE WHEN order_date_error IS NOT NULL THEN 'order_date' END,
        'order_key', CASE WHEN price_error IS NOT NULL THEN 'price' END) AS record_columns,
      order_key,
      concat_ws(',', CASE WHEN customer_error IS NOT NULL THEN 'customer' END, CASE WHEN price_error IS NOT NULL THEN 'price' END,
        CASE WHEN order_date_error IS NOT NULL THEN 'order_date' END) AS column_names,
      concat_ws(',', CASE WHEN customer_error IS NOT NULL THEN customer END, CASE WHEN price_error IS NOT NULL THEN price END,
        CASE WHEN order_date_error IS NOT NULL THEN order_date END) AS column_values,
      concat_ws(',', customer_error, price_error, order_date_error) AS error_types,
      CASE coalesce(customer_error, price_error, order_date_error)
        WHEN 'int_parsing' THEN 'input should be a valid integer, unable to parse string as an integer'
        WHEN 'decimal_parsing' THEN 'input should be a valid decimal'
        WHEN 'greater_than_equal' THEN 'input should be greater than or equal to 0'
        ELSE 'value is not a valid date' END AS first_message,
      true AS is_text
    FROM verdicts WHERE NOT is_valid""",
)


def _gate(spark, sf):
    counts = validate.file_counts(staged_orders(spark, sf))
    return validate.threshold_gate(counts, ORDERS_FEED.error_threshold).select(
        "source_filename", "records_processed", "validation_errors", "error_type", "error_message"
    )


CHECKS["error_rate_gate"] = (
    _gate,
    f"""WITH {DIRTY_SQL},
    counted AS (SELECT source_filename, count(*) AS records_processed, count(*) FILTER (WHERE NOT is_valid) AS validation_errors
      FROM verdicts GROUP BY source_filename)
    SELECT *, CASE WHEN validation_errors / records_processed > 0.3 THEN 'Validation Threshold Exceeded' END AS error_type,
      CASE WHEN validation_errors / records_processed > 0.3 THEN
        printf('Validation error rate (%.2f%%) exceeds threshold (30.00%%) for file: %s. Total Records Processed: %d, Failed Records: %d.',
          100.0 * validation_errors / records_processed, source_filename, records_processed, validation_errors) END AS error_message
    FROM counted""",
)

CHECKS["sample_errors"] = (
    lambda spark, sf: validate.sample_errors(staged_orders(spark, sf).filter(~F.col("is_valid"))).select(
        "source_filename", "sample", "file_row_number", F.col("validation_errors")[0]["error_type"].alias("error_type")
    ),
    f"""WITH {DIRTY_SQL}
    SELECT source_filename, CAST(row_number() OVER files AS INTEGER) AS sample, file_row_number,
      coalesce(customer_error, price_error, order_date_error) AS error_type
    FROM verdicts WHERE NOT is_valid
    WINDOW files AS (PARTITION BY source_filename ORDER BY file_row_number) QUALIFY row_number() OVER files <= 6""",
)

CHECKS["sample_error_texts"] = (
    lambda spark, sf: validate.sample_texts(validate.sample_errors(staged_orders(spark, sf).filter(~F.col("is_valid")))),
    f"""WITH {DIRTY_SQL}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY source_filename ORDER BY file_row_number) AS place FROM verdicts WHERE NOT is_valid
    ), texts AS (
      SELECT source_filename, place, concat('row ', file_row_number, ': [', concat_ws(', ',
          CASE WHEN customer_error IS NOT NULL THEN concat('{{column_name: customer, column_value: ', customer,
            ', error_type: int_parsing, error_msg: {RECORD_ERRORS["int_parsing"]}}}') END,
          CASE price_error WHEN 'decimal_parsing' THEN '{{column_name: price, column_value: n/a, error_type: decimal_parsing, error_msg: {RECORD_ERRORS["decimal_parsing"]}}}'
            WHEN 'greater_than_equal' THEN '{{column_name: price, column_value: -5, error_type: greater_than_equal, error_msg: input should be greater than or equal to 0}}' END,
          CASE WHEN order_date_error IS NOT NULL THEN concat('{{column_name: order_date, column_value: ', order_date,
            ', error_type: date_parsing, error_msg: {RECORD_ERRORS["date_parsing"]}}}') END),
        '] record: {{', concat_ws(', ', CASE WHEN customer_error IS NOT NULL THEN concat('customer: ', customer) END,
          CASE WHEN order_date_error IS NOT NULL THEN concat('order_date: ', order_date) END, concat('order_key: ', order_key),
          CASE WHEN price_error IS NOT NULL THEN concat('price: ', price) END), '}}') AS line
      FROM numbered WHERE place <= 6
    ) SELECT source_filename, string_agg(line, '; ' ORDER BY place) AS sample_errors FROM texts GROUP BY source_filename""",
)

CHECKS["stage_counts"] = (
    lambda spark, sf: validate.file_counts(staged_orders(spark, sf)),
    f"""WITH {DIRTY_SQL}
    SELECT source_filename, count(*) AS records_processed, count(*) FILTER (WHERE NOT is_valid) AS validation_errors,
      count(*) FILTER (WHERE is_valid) AS records_stage_loaded FROM verdicts GROUP BY source_filename""",
)


def _row_hash(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderpriority", F.lit("|"), "o_orderstatus")).alias("note"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
        (F.col("o_orderstatus") == "F").alias("done"),
    )
    fields = [(f.name, f.dataType) for f in rows.schema.fields]
    return rows.select("o_orderkey", F.lower(F.hex(row_hash(fields))).alias("etl_row_hash"))


CHECKS["row_hash"] = (
    _row_hash,
    """SELECT o_orderkey, sha256(concat_ws('|', CAST(epoch_us(o_orderdate) AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
      CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END,
      CASE WHEN o_orderstatus <> 'P' THEN concat(o_orderpriority, chr(92), '|', o_orderstatus) ELSE '' END,
      CAST(o_orderkey AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR))) AS etl_row_hash FROM orders""",
)


def _serials(spark, sf):
    serial = F.col("p_retailprice") + 44000
    return table(spark, sf, "part").select(
        "p_partkey",
        excel_serial_to_date(serial).cast("string").alias("day"),
        F.unix_seconds(excel_serial_to_timestamp(serial + F.col("p_size") / 64)).alias("seconds"),
    )


CHECKS["excel_serial_dates"] = (
    _serials,
    """SELECT p_partkey, CAST(DATE '1899-12-30' + CAST(floor(p_retailprice + 44000) AS INTEGER) AS VARCHAR) AS day,
      CAST(floor(p_retailprice + 44000 + p_size / 64) AS BIGINT) * 86400 - 2209161600
        + CAST(floor((p_retailprice + 44000 + p_size / 64 - floor(p_retailprice + 44000 + p_size / 64)) * 86400) AS BIGINT) AS seconds
    FROM part""",
)
