"""Checks of audits, keys and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftgate.checks.common import DIRTY_SQL, ORDERS_FEED, Query, staged_orders, table
from siftgate.functions.text import row_hash
from siftgate.operators import audit, merge, validate
from siftgate.session import scratch_path
from siftgate.sources.tables import Warehouse, empty_target
from siftgate.spec import Audit, FieldSpec, SourceSpec

CHECKS: dict[str, tuple[Query, str | None]] = {}

# --- keys ---------------------------------------------------------------------------------


def _orders_by_priority(spark, sf):
    return table(spark, sf, "orders").withColumn("source_filename", F.col("o_orderpriority"))


def _lines_by_flag(spark, sf):
    return table(spark, sf, "lineitem").withColumn("source_filename", F.concat(F.lit("lines_"), "l_returnflag"))


def _single(spark, sf, stats=lambda stage, grain: audit.grain_stats(audit.key_groups(stage, grain), grain)):
    stage = _orders_by_priority(spark, sf).withColumn(
        "customer", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    )
    unique, nulls = stats(stage, ["o_orderkey"]), stats(stage, ["customer"])
    return unique.withColumn("grain", F.lit("o_orderkey")).unionByName(nulls.withColumn("grain", F.lit("customer")))


CHECKS["grain_unique_single"] = (
    _single,
    """WITH keyed AS (
      SELECT o_orderpriority AS source_filename, 'o_orderkey' AS grain, o_orderkey AS k FROM orders
      UNION ALL SELECT o_orderpriority, 'customer', CASE WHEN o_orderstatus <> 'P' THEN o_custkey END FROM orders)
    SELECT source_filename, grain, count(*) AS key_rows, count(DISTINCT k) + CAST(bool_or(k IS NULL) AS BIGINT) AS distinct_keys,
      count(*) FILTER (WHERE k IS NULL) AS null_keys, CAST(count(DISTINCT k) = count(*) AS INTEGER) AS grain_unique
    FROM keyed GROUP BY ALL""",
)

# The same verdicts from hashes of the keys.
CHECKS["grain_unique_by_print"] = (lambda spark, sf: _single(spark, sf, audit.unique_by_print), CHECKS["grain_unique_single"][1])

LINE_KEY = ["l_orderkey", "l_linenumber"]

CHECKS["grain_unique_composite"] = (
    lambda spark, sf: audit.grain_stats(audit.key_groups(_lines_by_flag(spark, sf), LINE_KEY), LINE_KEY),
    """SELECT concat('lines_', l_returnflag) AS source_filename, count(*) AS key_rows,
      count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, CAST(0 AS BIGINT) AS null_keys,
      CAST(count(DISTINCT (l_orderkey, l_linenumber)) = count(*) AS INTEGER) AS grain_unique
    FROM lineitem GROUP BY ALL""",
)


def _duplicates(spark, sf):
    groups = audit.key_groups(_lines_by_flag(spark, sf), LINE_KEY)
    by_file = audit.duplicate_examples(groups, LINE_KEY).drop("example")
    whole = audit.duplicate_examples(audit.key_groups(table(spark, sf, "lineitem"), LINE_KEY, by=()), LINE_KEY, by=())
    return by_file.unionByName(whole.withColumn("source_filename", F.lit("all")))


CHECKS["grain_duplicates"] = (
    _duplicates,
    """WITH counted AS (SELECT concat('lines_', l_returnflag) AS source_filename, l_orderkey, l_linenumber, count(*) AS duplicate_count
        FROM lineitem GROUP BY ALL HAVING count(*) > 1
      UNION ALL SELECT 'all', l_orderkey, l_linenumber, count(*) FROM lineitem GROUP BY ALL HAVING count(*) > 1)
    SELECT * FROM counted QUALIFY row_number() OVER (
      PARTITION BY source_filename ORDER BY duplicate_count DESC, l_orderkey, l_linenumber) <= 5""",
)


def _grain_messages(spark, sf):
    stage = _lines_by_flag(spark, sf)
    groups = audit.key_groups(stage, LINE_KEY)
    stats = audit.grain_stats(groups, LINE_KEY)
    return audit.grain_messages(stats, audit.duplicate_examples(groups, LINE_KEY, count=2), LINE_KEY, ["Order", "Line"], "lines")


CHECKS["grain_messages"] = (
    _grain_messages,
    """WITH counted AS (SELECT concat('lines_', l_returnflag) AS source_filename, l_orderkey, l_linenumber, count(*) AS n
        FROM lineitem GROUP BY ALL HAVING count(*) > 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source_filename ORDER BY n DESC, l_orderkey, l_linenumber) AS example FROM counted)
    SELECT source_filename, 'Grain Validation Error' AS error_type,
      concat('Grain values are not unique for file: ', source_filename, chr(10), 'Table: lines', chr(10),
        'Grain columns (file column names): Order, Line', chr(10), 'Example duplicate grain violations:', chr(10),
        string_agg(concat('  - Order: ', l_orderkey, ', Line: ', l_linenumber, ', duplicate_count: ', n), chr(10) ORDER BY example)) AS error_message
    FROM ranked WHERE example <= 2 GROUP BY source_filename""",
)

# --- audits -------------------------------------------------------------------------------

CUSTOMER_FILE = "concat('customers-', lower(c_mktsegment), '.csv')"


def _customers(spark, sf):
    return table(spark, sf, "customer").withColumn("source_filename", F.expr(CUSTOMER_FILE))


def _files_and_an_empty_one(spark: SparkSession, stage: DataFrame) -> DataFrame:
    empty = spark.createDataFrame([("customers-none.csv",)], "source_filename string")
    return stage.select("source_filename").distinct().unionByName(empty)


BALANCE_AUDIT = """
    SELECT CASE WHEN SUM(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) = COUNT(*) THEN 1 ELSE 0 END AS balance_positive,
           CASE WHEN COUNT(DISTINCT c_nationkey) <= 25 THEN 1 ELSE 0 END AS known_nations,
           CASE WHEN MAX(c_acctbal) > 9990 THEN 0 WHEN MAX(c_acctbal) IS NOT NULL THEN 1 END AS below_limit
    FROM {table}
"""


def _audit_sql(spark, sf):
    stage = _customers(spark, sf)
    return audit.audit_sql_by_file(spark, stage, _files_and_an_empty_one(spark, stage), BALANCE_AUDIT)


_AUDITED_FILES = f"""files AS (SELECT DISTINCT {CUSTOMER_FILE} AS source_filename FROM customer UNION ALL SELECT 'customers-none.csv'),
    stage AS (SELECT *, {CUSTOMER_FILE} AS stage_file FROM customer),
    joined AS (SELECT * FROM files LEFT JOIN stage ON source_filename = stage_file)"""
_BALANCE_COLUMNS = """CASE WHEN sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) = count(c_custkey) AND count(c_custkey) > 0 THEN 1 ELSE 0 END AS balance_positive,
      CASE WHEN count(DISTINCT c_nationkey) <= 25 THEN 1 ELSE 0 END AS known_nations,
      CASE WHEN max(c_acctbal) > 9990 THEN 0 WHEN max(c_acctbal) IS NOT NULL THEN 1 END AS below_limit"""

CHECKS["audit_sql"] = (
    _audit_sql,
    f"WITH {_AUDITED_FILES} SELECT source_filename, {_BALANCE_COLUMNS} FROM joined GROUP BY source_filename",
)

# A text that Spark cannot turn into an aggregate over all files.
NESTED_AUDIT = """SELECT CASE WHEN count(*) = (SELECT count(DISTINCT c_custkey) FROM {table}) AND count(*) > 0 THEN 1 ELSE 0 END AS keys_distinct,
  CASE WHEN max(c_acctbal) <= (SELECT max(c_acctbal) FROM {table}) THEN 1 ELSE 0 END AS below_own_limit FROM {table}"""


def _audit_subquery(spark, sf):
    stage = _customers(spark, sf)
    found = audit.audit_sql_by_file(spark, stage, _files_and_an_empty_one(spark, stage), NESTED_AUDIT)
    return found.select("source_filename", "keys_distinct", "below_own_limit")


CHECKS["audit_sql_subquery"] = (
    _audit_subquery,
    f"""WITH {_AUDITED_FILES} SELECT source_filename,
      CASE WHEN count(c_custkey) = count(DISTINCT c_custkey) AND count(c_custkey) > 0 THEN 1 ELSE 0 END AS keys_distinct,
      CASE WHEN max(c_acctbal) IS NOT NULL THEN 1 ELSE 0 END AS below_own_limit
    FROM joined GROUP BY source_filename""",
)

CHECKS["audit_failures"] = (
    lambda spark, sf: audit.failed_audits(_audit_sql(spark, sf), "customers"),
    f"""WITH {_AUDITED_FILES}, results AS (SELECT source_filename, {_BALANCE_COLUMNS} FROM joined GROUP BY source_filename)
    SELECT source_filename, 'Audit Failed' AS error_type,
      concat('Audit checks failed for file: ', source_filename, chr(10), 'Table: customers', chr(10), 'Failed audits: ',
        concat_ws(', ', CASE WHEN balance_positive = 0 THEN 'balance_positive' END, CASE WHEN known_nations = 0 THEN 'known_nations' END,
          CASE WHEN below_limit = 0 THEN 'below_limit' END)) AS error_message
    FROM results WHERE balance_positive = 0 OR known_nations = 0 OR below_limit = 0""",
)


def _all_rows(spark, sf):
    stage = _customers(spark, sf)
    audits = [
        Audit("balance_positive", "sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) = count(*)"),
        Audit("balance_bounded", "count_if(c_acctbal >= -1000) = count(*)"),
    ]
    checked = audit.audit_by_file(stage, _files_and_an_empty_one(spark, stage), audits)
    return checked.select("source_filename", "balance_positive", "balance_bounded")


CHECKS["audit_all_rows"] = (
    _all_rows,
    f"""WITH {_AUDITED_FILES} SELECT source_filename,
      CAST(sum(CASE WHEN c_custkey IS NULL THEN NULL WHEN c_acctbal > 0 THEN 1 ELSE 0 END) = count(c_custkey) AS INTEGER) AS balance_positive,
      CAST(count(*) FILTER (WHERE c_acctbal >= -1000) = count(c_custkey) AS INTEGER) AS balance_bounded
    FROM joined GROUP BY source_filename""",
)


def _bounded_sum(spark, sf):
    stage = _orders_by_priority(spark, sf)
    total = "sum(cast(o_totalprice AS decimal(18,2)))"
    audits = [Audit("below_one_million", f"{total} < 1000000"), Audit("below_all", f"{total} < 1e15")]
    return audit.audit_by_file(stage, stage.select("source_filename").distinct(), audits)


CHECKS["audit_bounded_sum"] = (
    _bounded_sum,
    """SELECT o_orderpriority AS source_filename, CAST(sum(o_totalprice) < 1000000 AS INTEGER) AS below_one_million,
      CAST(sum(o_totalprice) < 1e15 AS INTEGER) AS below_all FROM orders GROUP BY 1""",
)


def _recency(spark, sf):
    """Dates within 30 days before the day of the run, which is given so that it can be repeated."""
    stage = table(spark, sf, "orders").withColumn(
        "source_filename", F.substring(F.col("o_orderdate").cast("date").cast("string"), 1, 7)
    )
    as_of = "date'2001-07-31'"
    recent = f"count_if(cast(o_orderdate AS date) BETWEEN date_sub({as_of}, 30) AND {as_of}) = count(*)"
    return audit.audit_by_file(stage, stage.select("source_filename").distinct(), [Audit("recent", recent)])


CHECKS["audit_recency"] = (
    _recency,
    """SELECT left(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 7) AS source_filename,
      CAST(count(*) FILTER (WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-31' - 30 AND DATE '2001-07-31') = count(*) AS INTEGER) AS recent
    FROM orders GROUP BY 1""",
)

# --- merges -------------------------------------------------------------------------------
# The target holds every order. The stage sends every order again: low-priority ones under a
# new key, urgent ones with another price, the rest unchanged.

PRICED = SourceSpec(
    table="orders_priced",
    patterns=("orders_*.csv",),
    fields=(FieldSpec("order_key", "int"), FieldSpec("status"), FieldSpec("price", "decimal", precision=12, scale=2)),
    grain=("order_key",),
)
_HASHED = [(f.name, f.spark_type) for f in PRICED.fields]
NEW_KEY = "CASE WHEN o_orderpriority = '5-LOW' THEN -o_orderkey - 1 ELSE o_orderkey END"
NEW_PRICE = "CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(12, 2))"
STAGE_FILE = "concat('resent_', o_orderpriority)"


def _target(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS order_key", "o_orderstatus AS status", "CAST(o_totalprice AS DECIMAL(12, 2)) AS price"
    )
    return rows.select(
        "*",
        row_hash(_HASHED).alias("etl_row_hash"),
        F.lit("first").alias("source_filename"),
        F.lit(1).cast("bigint").alias("file_load_log_id"),
        F.timestamp_seconds(F.lit(1000)).alias("etl_created_at"),
        F.lit(None).cast("timestamp").alias("etl_updated_at"),
    )


def _resent(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        f"{NEW_KEY} AS order_key", "o_orderstatus AS status", f"{NEW_PRICE} AS price", f"{STAGE_FILE} AS source_filename"
    )
    return rows.select(
        "order_key", "status", "price", row_hash(_HASHED).alias("etl_row_hash"), "source_filename",
        F.lit(2).cast("bigint").alias("file_load_log_id"),
    )


def _merged(spark: SparkSession, sf: str, upsert) -> DataFrame:
    merged = upsert(_target(spark, sf), _resent(spark, sf), PRICED.grain, F.timestamp_seconds(F.lit(2000)))
    return merged.select(
        "order_key", "status", "price", "source_filename", "file_load_log_id", "action",
        F.unix_seconds("etl_created_at").alias("created"), F.unix_seconds("etl_updated_at").alias("updated"),
        F.length("etl_row_hash").alias("hash_length"),
    )


_MERGED_SQL = f"""WITH stage AS (SELECT {NEW_KEY} AS k, o_orderstatus AS s, {NEW_PRICE} AS p, {STAGE_FILE} AS f FROM orders),
    target AS (SELECT o_orderkey AS k, o_orderstatus AS s, CAST(o_totalprice AS DECIMAL(12, 2)) AS p FROM orders)
    SELECT coalesce(t.k, stage.k) AS order_key, coalesce(stage.s, t.s) AS status, coalesce(stage.p, t.p) AS price,
      CASE WHEN t.k IS NULL OR t.p <> stage.p THEN f ELSE 'first' END AS source_filename,
      CAST(CASE WHEN t.k IS NULL OR t.p <> stage.p THEN 2 ELSE 1 END AS BIGINT) AS file_load_log_id,
      CASE WHEN t.k IS NULL THEN 'insert' WHEN stage.k IS NULL THEN 'keep' WHEN t.p <> stage.p THEN 'update' ELSE 'unchanged' END AS action,
      CAST(CASE WHEN t.k IS NULL THEN 2000 ELSE 1000 END AS BIGINT) AS created,
      CAST(CASE WHEN t.p <> stage.p THEN 2000 END AS BIGINT) AS updated, CAST(32 AS INTEGER) AS hash_length
    FROM target t FULL JOIN stage ON t.k = stage.k"""

CHECKS["merge_upsert"] = (lambda spark, sf: _merged(spark, sf, merge.merge_frames), _MERGED_SQL)
CHECKS["merge_small_stage"] = (lambda spark, sf: _merged(spark, sf, merge.merge_small_stage), _MERGED_SQL)



def _bucketed(spark, sf):
    """The same merge over a table in buckets of its key: joined without an exchange, buckets with changes overwritten."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"), buckets=8)
    warehouse.commit(PRICED, _target(spark, sf))
    warehouse.upsert(PRICED, _resent(spark, sf), F.timestamp_seconds(F.lit(2000)))
    return warehouse.target(PRICED).select("order_key", "status", "price", "source_filename", "file_load_log_id")


CHECKS["merge_bucketed"] = (
    _bucketed,
    f"SELECT order_key, status, price, source_filename, file_load_log_id FROM ({_MERGED_SQL}) AS merged",
)

CHECKS["merge_counts"] = (
    lambda spark, sf: merge.merge_counts(merge.merge_actions(_target(spark, sf), _resent(spark, sf), PRICED.grain)),
    f"""SELECT {STAGE_FILE} AS source_filename, count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS target_inserts,
      count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS target_updates,
      count(*) FILTER (WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT')) AS target_unchanged
    FROM orders GROUP BY 1""",
)

CHECKS["merge_insert_only"] = (
    lambda spark, sf: merge.new_rows(_target(spark, sf), _resent(spark, sf), PRICED.grain).select(
        "order_key", "price", "source_filename"
    ),
    f"""SELECT {NEW_KEY} AS order_key, {NEW_PRICE} AS price, {STAGE_FILE} AS source_filename FROM orders
    WHERE {NEW_KEY} NOT IN (SELECT o_orderkey FROM orders)""",
)


def _created(spark, sf):
    """A first load into a target that is only declared so far."""
    loaded = merge.merge_frames(
        empty_target(spark, PRICED), _resent(spark, sf), PRICED.grain, F.timestamp_seconds(F.lit(2000))
    )
    return loaded.select("order_key", "status", "price", "action", F.col("etl_updated_at").isNull().alias("never_updated"))


CHECKS["empty_target"] = (
    _created,
    f"""SELECT {NEW_KEY} AS order_key, o_orderstatus AS status, {NEW_PRICE} AS price, 'insert' AS action, true AS never_updated FROM orders""",
)


def _last_wins(spark, sf):
    """Line items sent several times under one key: the last shipped one counts."""
    rows = table(spark, sf, "lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date").cast("string"))
    values = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    latest = merge.latest_per_key(rows, LINE_KEY, [F.desc("ship_day"), *[F.desc(v) for v in values]])
    return latest.select(*LINE_KEY, "ship_day", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


CHECKS["multi_file_last_wins"] = (
    _last_wins,
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
      l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
)


def _gate(spark, sf):
    stage = staged_orders(spark, sf)
    verdicts = validate.threshold_gate(validate.file_counts(stage), ORDERS_FEED.error_threshold)
    passed = verdicts.filter(F.col("error_type").isNull())
    return merge.passed_only(stage, passed).select("source_filename", "order_key", "customer", "price")


CHECKS["publish_gate"] = (
    _gate,
    f"""WITH {DIRTY_SQL}, passed AS (SELECT source_filename FROM verdicts GROUP BY 1
      HAVING count(*) FILTER (WHERE NOT is_valid) / count(*) <= 0.3)
    SELECT source_filename, order_key, CAST(customer AS BIGINT) AS customer, CAST(price AS DECIMAL(18, 2)) AS price
    FROM verdicts WHERE is_valid AND source_filename IN (SELECT source_filename FROM passed)""",
)

CHECKS["backout_file"] = (
    lambda spark, sf: merge.without_file(
        _merged(spark, sf, merge.merge_frames), "resent_1-URGENT"
    ).select("order_key", "price", "source_filename"),
    f"SELECT order_key, price, source_filename FROM ({_MERGED_SQL}) AS merged WHERE source_filename <> 'resent_1-URGENT'",
)
