"""Times whole loads of lineitem as CSV, phase by phase, and the headline queries. Prints one JSON line.

The loads use copies of lineitem under new keys up to the two million rows of the published case study.
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from siftgate.checks.common import export_csv, table  # noqa: E402
from siftgate.checks.registry import CHECKS  # noqa: E402
from siftgate.operators.logs import PHASES  # noqa: E402
from siftgate.plans.feeds import CUSTOMERS  # noqa: E402
from siftgate.plans.load import load_directory  # noqa: E402
from siftgate.session import scratch_path  # noqa: E402
from siftgate.sources.tables import Warehouse  # noqa: E402
from siftgate.spec import FieldSpec, Registry, SourceSpec  # noqa: E402

# Rows per second of the published case study: 2,000,000 CSV rows in 110 seconds.
BASELINE_ROWS_PER_SECOND = 18_181
CASE_STUDY_ROWS = 2_000_000
CUSTOMER_ROWS = 2_000_000

HEADLINE = (
    "validate_int", "validate_float", "validate_date", "valid_invalid_split", "dlq_rows", "error_rate_gate",
    "sample_errors", "row_hash", "grain_unique_single", "grain_unique_composite", "grain_duplicates", "audit_sql",
    "merge_upsert", "merge_small_stage", "merge_counts", "multi_file_last_wins", "publish_gate", "csv_scan",
    "csv_gzip_scan", "file_row_number", "json_array_scan", "json_flatten", "json_mixed_keys", "excel_scan",
)

LINES = SourceSpec(
    "lines",
    ("*.csv",),
    (
        FieldSpec("line_id", "int"),
        FieldSpec("l_orderkey", "int"),
        FieldSpec("l_partkey", "int"),
        FieldSpec("l_suppkey", "int"),
        FieldSpec("l_linenumber", "int", ge=1),
        FieldSpec("l_quantity", "float", gt=0),
        FieldSpec("l_extendedprice", "float", ge=0),
        FieldSpec("l_discount", "float"),
        FieldSpec("l_tax", "float"),
        FieldSpec("l_returnflag", max_length=1),
        FieldSpec("l_linestatus", max_length=1),
        FieldSpec("l_shipdate", "date"),
    ),
    ("line_id",),
    audit_sql="SELECT CASE WHEN SUM(CASE WHEN l_quantity > 0 THEN 1 ELSE 0 END) = COUNT(*) THEN 1 ELSE 0 END AS quantity_positive FROM {table}",
    error_threshold=0.1,
    multiline=False,
)


def load_lines(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], int]:
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    copies = -(-CASE_STUDY_ROWS // lines.count())
    lines = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    lines = lines.withColumn("line_id", F.monotonically_increasing_id())
    first = export_csv(spark, lines, "first", files=4)
    changed = lines.withColumn("l_tax", F.when(F.col("l_returnflag") == "R", F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    second = export_csv(spark, changed, "second", files=4)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    seconds: dict[str, float] = {}
    rows = 0
    for name, folder in (("load", first), ("reload", second)):
        started = time.time()
        results = load_directory(spark, Registry([LINES]), folder, warehouse).collect()
        seconds[name] = time.time() - started
        assert all(r.success for r in results), results
        rows = sum(r.records_processed for r in results)
        last = warehouse.run_log().filter(F.col("source_filename").isin([r.source_filename for r in results])).collect()
        for phase in PHASES:
            spans = [(r[f"{phase}_ended_at"] - r[f"{phase}_started_at"]).total_seconds() for r in last]
            seconds[f"{name}_{phase}"] = max(spans)
    return seconds, rows


def load_customers(spark: SparkSession, sf_dir: str) -> tuple[float, int]:
    """One wide file with quoted line breaks, of the size of the case study; many tasks share it."""
    plain = table(spark, sf_dir, "customer")
    copies = -(-CUSTOMER_ROWS // plain.count())
    rows = plain.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).selectExpr(
        "monotonically_increasing_id() AS `Index`", "concat(c_custkey, '-', copy) AS `Customer Id`", "c_name AS `First Name`",
        "c_mktsegment AS `Last Name`", "concat(c_name, ',\n\"Ltd\"') AS `Company`", "concat('City ', c_nationkey) AS `City`",
        "'Country' AS `Country`", "'397.884.0519x718' AS `Phone 1`", "'+1 (5) 6' AS `Phone 2`",
        "concat(' Ann', c_custkey, '@Example.COM ') AS `Email`", "'2021-07-26' AS `Subscription Date`", "'http://example.com/' AS `Website`",
    )
    source = dataclasses.replace(CUSTOMERS, patterns=("*.csv",))
    folder = export_csv(spark, rows.coalesce(1), "customers", files=None)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    started = time.time()
    (result,) = load_directory(spark, Registry([source]), folder, warehouse).collect()
    assert result.success, result
    return time.time() - started, result.records_processed


def load_table(spark: SparkSession, sf_dir: str, name: str, key: str, label: str) -> None:
    plain = table(spark, sf_dir, name)
    source = SourceSpec(
        name,
        ("*.csv",),
        tuple(FieldSpec(c, "int" if kind in ("int", "bigint") else "str") for c, kind in plain.dtypes),
        (key,),
        audit_sql="SELECT COUNT(*) AS any_rows FROM {table}",
        multiline=False,
    )
    warehouse = Warehouse(spark, scratch_path(spark, label))
    for part in ("first", "second"):
        load_directory(spark, Registry([source]), export_csv(spark, plain, part, files=1), warehouse).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siftgate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="siftgate-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # a first load of the smallest table, so that JVM start-up is not taken for work
    load_table(spark, sf_dir, "nation", "n_nationkey", "warm")
    load_seconds, rows = load_lines(spark, sf_dir)
    customer_seconds, customer_rows = load_customers(spark, sf_dir)
    seconds = {"load": load_seconds["load"], "reload": load_seconds["reload"], "load_one_wide_file": customer_seconds}
    for name in sys.argv[1:] or HEADLINE:
        started = time.time()
        CHECKS[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = time.time() - started
    spark.stop()
    rate = rows / load_seconds["load"]
    print(
        json.dumps(
            {
                "metric": "total seconds of loads and headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "phases": {k: round(v, 3) for k, v in load_seconds.items() if k not in seconds},
                "rows_loaded": rows,
                "rows_per_second": round(rate),
                "wide_file_rows": customer_rows,
                "wide_file_rows_per_second": round(customer_rows / customer_seconds),
                "reference_rows_per_second": BASELINE_ROWS_PER_SECOND,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "warm_up": "two loads of nation, not timed",
            }
        )
    )


if __name__ == "__main__":
    main()
