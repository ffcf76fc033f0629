"""Whole loads of small files: every outcome a file can have."""

import dataclasses
import gzip
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from siftgate.checks.files import workbook
from siftgate.functions.text import clean_phone
from siftgate.operators import logs, merge
from siftgate.plans import feeds, load
from siftgate.session import setting
from siftgate.sources.tables import Warehouse, write_jdbc
from siftgate.spec import Audit, FieldSpec, Registry, SourceSpec

HEADER = "transaction_id,customer_id,product_sku,quantity,unit_price,total_amount,sale_date,sales_rep\n"
TOLERANT = dataclasses.replace(feeds.SALES, error_threshold=1.0, owners=("sales@example.com",))


def sale(key, quantity="1", price="2.5", amount="5.0", day="2024-01-15", rep="Ann"):
    return f"{key},C1,SKU1,{quantity},{price},{amount},{day},{rep}\n"


class Place:
    """An input folder, a warehouse, and loads from one into the other."""

    def __init__(self, spark, path, *sources, buckets=3):
        self.spark, self.inputs = spark, path / "in"
        self.inputs.mkdir()
        self.registry = Registry(list(sources))
        self.warehouse = Warehouse(spark, str(path / "warehouse"), buckets=buckets)

    def put(self, name, content):
        data = content if isinstance(content, bytes) else content.encode()
        (self.inputs / name).write_bytes(data)

    def load(self):
        results = load.load_directory(self.spark, self.registry, str(self.inputs), self.warehouse)
        return {r.source_filename: r for r in results.collect()}

    def rows(self, source):
        return {tuple(r[g] for g in source.grain): r for r in self.warehouse.target(source).collect()}

    def letters(self):
        return self.warehouse.dead_letters().orderBy("source_filename", "file_row_number").collect()


@pytest.fixture
def place(spark, tmp_path):
    return lambda *sources, **options: Place(spark, tmp_path, *sources, **options)


def test_every_outcome_of_a_csv_file(place):
    here = place(TOLERANT, dataclasses.replace(feeds.SALES, table="old", patterns=("sales_old*.csv",)))
    here.put("sales_good file+1.csv", HEADER + sale("T1") + "\n" + sale("T2", rep='"Ann ""A"", \nB"'))
    here.put("sales_mixed.csv", HEADER + sale("T3") + sale("T4", quantity="not_a_number") + sale("T5") + sale("T6", day="invalid_date"))
    here.put("sales_ragged.csv", HEADER + sale("T7") + "T8,C1\n" + sale("T9").strip() + ",\n" + sale("T10", rep=""))
    here.put("sales_empty.csv", "")
    here.put("sales_blank.csv", " , ,\n1,2,3\n")
    here.put("sales_lacking.csv", "transaction_id,customer_id\nT1,C1\n")
    here.put("sales_twice.csv", HEADER + sale("T11") + sale("T11"))
    here.put("sales_negative.csv", HEADER + sale("T12", amount="-1"))
    here.put("sales_header_only.csv", HEADER)
    here.put("sales_old_1.csv", HEADER)
    here.put("notes.csv", "a,b\n")
    here.put("sales_x.txt", "a,b\n")
    here.put(".sales_hidden.csv", HEADER)
    results = here.load()
    assert {n: r.error_type for n, r in results.items()} == {
        "sales_good file+1.csv": None,
        "sales_mixed.csv": None,
        "sales_ragged.csv": None,
        "sales_empty.csv": "Missing Header",
        "sales_blank.csv": "Missing Header",
        "sales_lacking.csv": "Missing Columns",
        "sales_twice.csv": "Grain Validation Error",
        "sales_negative.csv": "Audit Failed",
        "sales_header_only.csv": "Audit Failed",
        "sales_old_1.csv": "ValueError",
    }
    assert "No headers found" in results["sales_empty.csv"].error_message
    assert "Whitespace-only headers" in results["sales_blank.csv"].error_message
    assert "transaction_id: T11, duplicate_count: 2" in results["sales_twice.csv"].error_message
    assert "Failed audits: total_amount_positive" in results["sales_negative.csv"].error_message
    assert set(here.rows(TOLERANT)) == {(k,) for k in ("T1", "T2", "T3", "T5", "T7", "T10")}
    assert here.rows(TOLERANT)[("T2",)].sales_rep == 'Ann "A", \nB'
    assert here.rows(TOLERANT)[("T1",)].source_filename == "sales_good file+1.csv"
    assert here.rows(TOLERANT)[("T10",)].sales_rep == ""
    assert [(r.source_filename, r.file_row_number, r.file_record_data, [e.error_type for e in r.validation_errors]) for r in here.letters()] == [
        ("sales_mixed.csv", 3, {"transaction_id": "T4", "quantity": "not_a_number"}, ["int_parsing"]),
        ("sales_mixed.csv", 5, {"transaction_id": "T6", "sale_date": "invalid_date"}, ["date_parsing"]),
        ("sales_ragged.csv", 3, {"transaction_id": "T8", "product_sku": None, "quantity": None, "unit_price": None,
          "total_amount": None, "sale_date": None, "sales_rep": None},
         ["string_type", "int_type", "float_type", "float_type", "date_type", "string_type"]),
        ("sales_ragged.csv", 4, {"transaction_id": "T9"}, ["too_many_columns"]),
    ]
    for r in results.values():
        if r.success:
            assert r.records_processed == r.records_stage_loaded + r.validation_errors
            assert r.target_inserts + r.target_updates == r.records_stage_loaded
    told = load.notifications(here.spark.createDataFrame(list(results.values()), load.RESULTS), here.registry).collect()
    assert {t.source_filename for t in told} == {n for n, r in results.items() if r.error_type not in (None, "ValueError")}
    assert all(t.recipients == ["sales@example.com"] for t in told)
    report = {r.source_filename: r.stage_failed_at for r in logs.run_report(here.warehouse.run_log()).collect()}
    assert report["sales_mixed.csv"] is None
    assert report["sales_empty.csv"] == "Processing"
    assert report["sales_twice.csv"] == report["sales_negative.csv"] == "Audit"


def test_threshold_then_corrected_file(place):
    strict = dataclasses.replace(feeds.SALES, error_threshold=0.25)
    here = place(strict)
    bad = HEADER + sale("T1") + sale("T2", quantity="x") + sale("T3", price="y") + sale("T4")
    here.put("sales_a.csv", bad)
    here.put("sales_b.csv", HEADER + sale("B1", quantity="x") + sale("B2") + sale("B3") + sale("B4"))
    results = here.load()
    assert results["sales_a.csv"].error_type == "Validation Threshold Exceeded"
    message = results["sales_a.csv"].error_message
    assert "(50.00%) exceeds threshold (25.00%)" in message and "row 3: [{column_name: quantity" in message
    assert "record: {quantity: x, transaction_id: T2}" in message
    # a rate equal to the threshold passes
    assert results["sales_b.csv"].success
    assert {(r.source_filename, r.file_row_number) for r in here.letters()} == {
        ("sales_a.csv", 3), ("sales_a.csv", 4), ("sales_b.csv", 2),
    }
    # the corrected file replaces the dead letters of the failed run
    here.put("sales_a.csv", HEADER + sale("T1") + sale("T2") + sale("T3") + sale("T4", quantity="z"))
    results = here.load()
    assert results["sales_a.csv"].success
    assert results["sales_b.csv"].success is None and results["sales_b.csv"].error_type == "Duplicate File Detected"
    assert {(r.source_filename, r.file_row_number) for r in here.letters()} == {("sales_a.csv", 5), ("sales_b.csv", 2)}
    assert set(here.rows(strict)) == {(k,) for k in ("T1", "T2", "T3", "B2", "B3", "B4")}


def test_back_out_and_load_again(place):
    here = place(TOLERANT)
    here.put("sales_a.csv", HEADER + sale("T1") + sale("T2", quantity="x") + sale("T3") + sale("T4", day="invalid_date"))
    assert here.load()["sales_a.csv"].success
    here.put("sales_a.csv", HEADER + sale("T1") + sale("T2") + sale("T3") + sale("T4"))
    assert here.load()["sales_a.csv"].error_type == "Duplicate File Detected"
    load.back_out(here.warehouse, TOLERANT, "sales_a.csv")
    assert here.load()["sales_a.csv"].target_inserts == 4
    assert len(here.rows(TOLERANT)) == 4 and here.letters() == []
    log = here.warehouse.run_log()
    assert [r.duplicate_skipped for r in log.orderBy("id").collect()] == [None, True, None]


@pytest.mark.parametrize("buckets", [1, 4])
def test_merge_updates_inserts_and_leaves_alone(place, buckets):
    here = place(TOLERANT, buckets=buckets)
    here.put("sales_a.csv", HEADER + sale("T1") + sale("T2") + sale("T3"))
    here.load()
    here.put("sales_b.csv", HEADER + sale("T2") + sale("T3", amount="9.5") + sale("T4"))
    first = here.load()["sales_b.csv"]
    assert (first.target_inserts, first.target_updates) == (1, 1)
    rows = here.rows(TOLERANT)
    assert {k[0]: r.source_filename for k, r in rows.items()} == {
        "T1": "sales_a.csv", "T2": "sales_a.csv", "T3": "sales_b.csv", "T4": "sales_b.csv",
    }
    assert rows[("T3",)].total_amount == 9.5 and rows[("T3",)].etl_updated_at is not None
    assert rows[("T3",)].etl_created_at == rows[("T1",)].etl_created_at and rows[("T4",)].etl_updated_at is None
    # the same rows under a new name change nothing, and the file is known from then on
    written = files_of(here)
    here.put("sales_c.csv", HEADER + sale("T2") + sale("T3", amount="9.5") + sale("T4"))
    again = here.load()["sales_c.csv"]
    assert (again.success, again.target_inserts, again.target_updates) == (True, 0, 0)
    assert here.rows(TOLERANT) == rows and files_of(here) == written
    assert here.load()["sales_c.csv"].error_type == "Duplicate File Detected"


def files_of(here):
    """Files of the targets, by bucket."""
    root = pathlib.Path(here.warehouse.root)
    return {str(p.relative_to(root)) for p in root.glob("targets/*/buckets-*/etl_bucket=*/*.parquet")}


def test_a_small_load_writes_its_buckets_only(place):
    here = place(TOLERANT, buckets=8)
    here.put("sales_a.csv", HEADER + "".join(sale(f"T{i}") for i in range(200)))
    here.load()
    before = files_of(here)
    assert len(before) == 8
    here.put("sales_b.csv", HEADER + sale("T7", amount="9.5"))
    here.load()
    after = files_of(here)
    (old,), (new,) = before - after, after - before
    assert old.rsplit("/", 1)[0] == new.rsplit("/", 1)[0] and len(here.rows(TOLERANT)) == 200
    here.put("sales_c.csv", HEADER + sale("N1"))
    here.load()
    # nothing piles up: a bucket stays one file
    assert len(files_of(here)) == 8 and len(here.rows(TOLERANT)) == 201
    assert load.back_out(here.warehouse, TOLERANT, "sales_c.csv") == 1
    assert len(here.rows(TOLERANT)) == 200 and ("N1",) not in here.rows(TOLERANT)
    # a file whose rows are all of a bucket leaves none of it
    load.back_out(here.warehouse, TOLERANT, "sales_b.csv")
    load.back_out(here.warehouse, TOLERANT, "sales_a.csv")
    assert files_of(here) == set() and here.rows(TOLERANT) == {}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_merge_does_not_exchange_the_target(spark, place):
    here = place(TOLERANT, buckets=8)
    here.put("sales_a.csv", HEADER + "".join(sale(f"T{i}") for i in range(200)))
    here.load()
    target = here.warehouse.target(TOLERANT)
    columns = merge.stage_columns(TOLERANT.field_names)
    stage = target.select(*columns).filter("quantity = 1").repartition(3)
    # as for tables that are too large to broadcast
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plans = [plan_of(f) for f in (merge.merge_frames(target, stage, TOLERANT.grain, F.current_timestamp()), merge.merge_actions(target, stage, TOLERANT.grain))]
    for plan in plans:
        # one exchange by key, that of the stage
        assert plan.count("hashpartitioning(") == 1, plan


def test_partitions_that_a_dead_driver_left_aside_are_put_back(place):
    here = place(TOLERANT, buckets=4)
    here.put("sales_a.csv", HEADER + "".join(sale(f"T{i}") for i in range(50)))
    here.load()
    rows = here.rows(TOLERANT)
    folder = pathlib.Path(here.warehouse.root) / "targets/transactions/buckets-4"
    (folder / ".spark-staging-1").mkdir()
    # one is removed already and the new one not there yet
    (folder / "etl_bucket=2").rename(folder / ".spark-staging-1/etl_bucket=2")
    assert len(here.rows(TOLERANT)) < 50
    here.put("sales_b.csv", HEADER + sale("T1"))
    assert here.load()["sales_b.csv"].success
    assert here.rows(TOLERANT) == rows and not list(folder.glob(".spark*"))


def test_a_declared_field_may_be_added(place, spark):
    here = place(TOLERANT)
    here.put("sales_a.csv", HEADER + sale("T1"))
    here.load()
    wider = dataclasses.replace(TOLERANT, fields=(*TOLERANT.fields, FieldSpec("note", nullable=True, column="sales_rep")))
    here.registry.sources[:] = [wider]
    here.put("sales_b.csv", HEADER + sale("T2", rep="Bo"))
    assert here.load()["sales_b.csv"].success
    assert {k[0]: r.note for k, r in here.rows(wider).items()} == {"T1": None, "T2": "Bo"}


def archive_copies(here, source):
    return sorted(r.source_filename for r in here.spark.read.parquet(f"{here.warehouse.root}/raw/{source.table}/files").collect())


def broken_once(method, after=False):
    """The method, breaking the first time it is called."""
    calls = []

    def call(self, *args, **options):
        calls.append(1)
        if len(calls) > 1 or after:
            found = method(self, *args, **options)
        if len(calls) == 1:
            raise RuntimeError("broken once")
        return found

    return call


@pytest.mark.parametrize("method, after", [("upsert", False), ("finish", False), ("_overwrite", False), ("_overwrite", True), ("_note_files", False), ("append_run_log", False), ("drop_dead_letters", False)])
def test_a_job_that_breaks_once_loses_nothing(place, monkeypatch, method, after):
    strict = dataclasses.replace(feeds.SALES, error_threshold=0.5)
    here = place(strict)
    here.put("sales_good.csv", HEADER + sale("T1") + sale("T2") + sale("T3", quantity="x"))
    here.put("sales_more.csv", HEADER + sale("T4"))
    here.put("sales_bad.csv", HEADER + sale("B1", quantity="x") + sale("B2", price="y"))
    monkeypatch.setattr(Warehouse, method, broken_once(getattr(Warehouse, method), after))
    results = here.load()
    assert {n: (r.success, r.error_type) for n, r in results.items()} == {
        "sales_good.csv": (True, None), "sales_more.csv": (True, None), "sales_bad.csv": (False, "Validation Threshold Exceeded"),
    }
    assert set(here.rows(strict)) == {("T1",), ("T2",), ("T4",)}
    assert [(r.source_filename, r.file_row_number) for r in here.letters()] == [
        ("sales_bad.csv", 2), ("sales_bad.csv", 3), ("sales_good.csv", 4),
    ]
    assert archive_copies(here, strict) == ["sales_bad.csv", "sales_good.csv", "sales_more.csv"]
    log = {r.source_filename: r for r in here.warehouse.run_log().collect()}
    assert {n: r.success for n, r in log.items()} == {n: r.success for n, r in results.items()}
    assert all(r.ended_at is not None for r in log.values())
    again = here.load()
    assert again["sales_good.csv"].error_type == again["sales_more.csv"].error_type == "Duplicate File Detected"
    ids = [r.id for r in here.warehouse.run_log().collect()]
    assert len(ids) == len(set(ids)) == 6


def test_files_are_staged_once_though_their_merge_breaks(place, monkeypatch):
    here = place(TOLERANT)
    for name in "abc":
        here.put(f"sales_{name}.csv", HEADER + sale(f"T{name}") + sale(f"U{name}", quantity="x"))
    staged, audited, real = [], [], Warehouse.upsert
    scan, check = load.scan, load._audit
    monkeypatch.setattr(load, "scan", lambda *args: staged.append(1) or scan(*args))
    monkeypatch.setattr(load, "_audit", lambda *args: audited.append(1) or check(*args))

    def breaks(self, source, stage, *args):
        if stage.filter("source_filename = 'sales_b.csv'").count():
            raise RuntimeError("broken for b")
        return real(self, source, stage, *args)

    monkeypatch.setattr(Warehouse, "upsert", breaks)
    results = here.load()
    assert {n: (r.success, r.error_type, r.target_inserts) for n, r in results.items()} == {
        "sales_a.csv": (True, None, 1), "sales_b.csv": (False, "RuntimeError", None), "sales_c.csv": (True, None, 1),
    }
    assert len(staged) == len(audited) == 1 and set(here.rows(TOLERANT)) == {("Ta",), ("Tc",)}
    assert [r.source_filename for r in here.letters()] == ["sales_a.csv", "sales_c.csv"]
    monkeypatch.setattr(Warehouse, "upsert", real)
    assert here.load()["sales_b.csv"].success and set(here.rows(TOLERANT)) == {("Ta",), ("Tb",), ("Tc",)}


def test_a_load_that_died_is_closed_by_the_next(place, monkeypatch):
    here = place(TOLERANT)
    here.put("sales_a.csv", HEADER + sale("T1"))
    real = Warehouse.append_run_log

    def dies(self, rows):
        if self._partitions(TOLERANT):
            raise KeyboardInterrupt
        real(self, rows)

    monkeypatch.setattr(Warehouse, "append_run_log", dies)
    with pytest.raises(KeyboardInterrupt):
        here.load()
    monkeypatch.setattr(Warehouse, "append_run_log", real)
    (row,) = here.warehouse.run_log().collect()
    assert row.success is None and row.ended_at is None and row.table_name == "transactions"
    assert here.load()["sales_a.csv"].error_type == "Duplicate File Detected"
    first, second = here.warehouse.run_log().orderBy("id").collect()
    assert first.success and first.ended_at is not None and (second.id, second.duplicate_skipped) == (2, True)


def test_a_load_that_died_after_its_commit_is_published_by_the_next(place, monkeypatch):
    here = place(TOLERANT)
    here.put("sales_a.csv", HEADER + sale("T1"))
    here.load()
    here.put("sales_b.csv", HEADER + sale("T1", amount="9.5") + sale("T2"))
    real = Warehouse._overwrite

    def dies(self, source, rows):
        raise KeyboardInterrupt

    monkeypatch.setattr(Warehouse, "_overwrite", dies)
    with pytest.raises(KeyboardInterrupt):
        here.load()
    monkeypatch.setattr(Warehouse, "_overwrite", real)
    assert here.warehouse.is_pending(TOLERANT) and set(here.rows(TOLERANT)) == {("T1",)}
    assert here.load()["sales_b.csv"].error_type == "Duplicate File Detected"
    assert set(here.rows(TOLERANT)) == {("T1",), ("T2",)} and not here.warehouse.is_pending(TOLERANT)
    runs = {r.id: r for r in here.warehouse.run_log().collect()}
    assert runs[3].success and runs[3].source_filename == "sales_b.csv"


def test_the_run_log_is_folded(place):
    here = place(TOLERANT)
    for i in range(3):
        here.put(f"sales_{i}.csv", HEADER + sale(f"T{i}"))
        here.load()
    before = sorted(here.warehouse.run_log().collect())
    assert not here.warehouse.fold_run_log(event_files=100)
    for _ in range(2):
        assert here.warehouse.fold_run_log(event_files=0 if _ == 0 else -1)
        assert sorted(here.warehouse.run_log().collect()) == before and here.warehouse.next_run_id() == 7
    results = here.load()
    assert {r.error_type for r in results.values()} == {"Duplicate File Detected"} and [r.id for r in results.values()] == [7, 8, 9]
    assert here.warehouse.fold_run_log(event_files=1)
    log = here.warehouse.run_log().orderBy("id").collect()
    assert [r.id for r in log] == [*range(1, 10)] and sorted(log[:6]) == before
    root = pathlib.Path(here.warehouse.root) / "file_load_log"
    assert len(list(root.glob("folded/upto=*"))) == 2 and len(list(root.glob("since=*"))) <= 2
    # a load that breaks off while folding leaves the log as it was
    (root / "folded/upto=99999999999999999999").mkdir()
    assert here.warehouse.run_log().count() == 9


def test_names_and_sizes_that_spark_passes_over(place):
    here = place(TOLERANT, dataclasses.replace(feeds.SALES, table="under", patterns=("_under*.csv",)))
    here.put("_under_1.csv", HEADER + sale("T1"))
    here.put("_SUCCESS", "")
    here.put("sales_none.csv", "")
    results = here.load()
    assert {n: r.error_type for n, r in results.items()} == {"_under_1.csv": "ValueError", "sales_none.csv": "Missing Header"}
    from siftgate.streaming import directory

    here.put("sales_new.csv", HEADER + sale("T2"))
    here.put("sales_zero.csv", "")
    checkpoint = f"{here.warehouse.root}/stream"
    directory.watch(here.spark, here.registry, str(here.inputs), here.warehouse, checkpoint).awaitTermination()
    log = {r.source_filename: (r.success, r.error_type) for r in here.warehouse.run_log().collect()}
    assert log["sales_new.csv"] == (True, None) and log["sales_zero.csv"] == (False, "Missing Header")


def test_audit_text_with_a_subquery(place):
    text = "SELECT CASE WHEN count(*) = (SELECT count(DISTINCT customer_id) FROM {table}) THEN 1 ELSE 0 END AS customers_distinct FROM {table}"
    source = dataclasses.replace(feeds.SALES, audits=(), audit_sql=text)
    here = place(source)
    here.put("sales_a.csv", HEADER + sale("T1"))
    here.put("sales_b.csv", HEADER + sale("T2") + sale("T3"))
    results = here.load()
    assert results["sales_a.csv"].success and results["sales_b.csv"].error_type == "Audit Failed"
    assert not [t for t in here.spark.catalog.listTables() if t.isTemporary and t.name.startswith("siftgate_")]


def test_same_key_in_two_files_of_a_run(place):
    here = place(TOLERANT)
    here.put("sales_a.csv", HEADER + sale("T1", rep="first") + sale("T2", rep="first"))
    here.put("sales_b.csv", HEADER + sale("T1", rep="second"))
    import os

    os.utime(here.inputs / "sales_a.csv", (1000, 1000))
    os.utime(here.inputs / "sales_b.csv", (2000, 2000))
    results = here.load()
    assert all(r.success for r in results.values())
    assert {k[0]: r.sales_rep for k, r in here.rows(TOLERANT).items()} == {"T1": "second", "T2": "first"}


def test_a_broken_file_does_not_stop_the_others(place):
    source = dataclasses.replace(feeds.SALES, patterns=("sales_*.csv", "sales_*.csv.gz"))
    here = place(source)
    here.put("sales_a.csv", HEADER + sale("T1"))
    here.put("sales_b.csv.gz", gzip.compress((HEADER + sale("T2")).encode()))
    whole = gzip.compress((HEADER + "".join(sale(f"X{i}") for i in range(20000))).encode())
    here.put("sales_c.csv.gz", whole[: len(whole) // 2])
    results = here.load()
    assert results["sales_a.csv"].success and results["sales_b.csv.gz"].success
    assert results["sales_c.csv.gz"].success is False and results["sales_c.csv.gz"].error_type not in (None, "Missing Header")
    assert set(here.rows(source)) == {("T1",), ("T2",)}
    failures = logs.code_failures(here.spark.createDataFrame(list(results.values()), load.RESULTS)).collect()
    assert [f.line.split(" (")[0] for f in failures] == ["• sales_c.csv.gz"]


def test_customers_are_cleaned(place):
    here = place(feeds.CUSTOMERS)
    header = "Index,Customer Id,First Name,Last Name,Company,City,Country,Phone 1,Phone 2,Email,Subscription Date,Website\n"
    here.put("customers-1.csv", header + "1,C1,Ann,Lee,Lee Ltd,Rome,Italy,397.884.0519x718,+1 (5) 6, Ann@Example.COM ,2021-07-26,http://x/\n")
    assert here.load()["customers-1.csv"].success
    row = here.rows(feeds.CUSTOMERS)[("C1",)]
    assert (row.phone_one, row.phone_two, row.email) == ("3978840519718", "+156", "ann@example.com")


def test_phone_without_digits_stays(spark):
    assert spark.createDataFrame([("n/a",), ("",)], "p string").select(clean_phone(F.col("p"))).collect() == [("n/a",), ("",)]


ENTRY = {
    "entry_id": 1, "account_code": "A", "account_name": "Cash", "debit_amount": 10.5, "credit_amount": None,
    "description": "x", "transaction_date": "2024-01-15", "reference_number": "R1",
}


def test_ledgers(place):
    source = dataclasses.replace(feeds.LEDGER, patterns=("ledger_*.json", "ledger_*.json.gz"), error_threshold=0.5)
    here = place(source)
    second = ENTRY | {"entry_id": 2, "credit_amount": 3}
    here.put("ledger_a.json", json.dumps({"entries": {"item": [ENTRY, second]}}))
    here.put("ledger_b.json.gz", gzip.compress(json.dumps({"entries": [ENTRY | {"entry_id": 3}]}).encode()))
    # other spelling of keys, one wrong type, one absent key
    spelled = [{k.upper(): v for k, v in (ENTRY | {"entry_id": n}).items()} for n in (4, 5, 6)]
    spelled[1]["ACCOUNT_CODE"] = 5
    spelled[1].pop("DEBIT_AMOUNT")
    here.put("ledger_c.json", json.dumps({"entries": {"item": spelled}}))
    here.put("ledger_d.json", json.dumps({"entries": {"item": [{"entry_id": 1, "account_code": "A"}]}}))
    here.put("ledger_e.json", json.dumps({"entries": {"item": [ENTRY | {"entry_id": 9}] * 2}}))
    here.put("ledger_f.json", json.dumps({"entries": {"item": []}}))
    results = here.load()
    assert {n: r.error_type for n, r in results.items()} == {
        "ledger_a.json": None, "ledger_b.json.gz": None, "ledger_c.json": None, "ledger_d.json": "Missing Columns",
        "ledger_e.json": "Grain Validation Error", "ledger_f.json": "ValueError",
    }
    assert set(here.rows(source)) == {(n,) for n in (1, 2, 3, 4, 6)}
    (letter,) = here.letters()
    assert letter.file_row_number == 2
    assert [(e.column_name, e.error_type) for e in letter.validation_errors] == [("account_code", "string_type"), ("debit_amount", "missing")]
    assert letter.file_record_data == {"entry_id": "5", "account_code": "5", "debit_amount": None}


def test_inventories(place):
    here = place(feeds.INVENTORY)
    header = ["SKU", "Product Name", "Category", "Price", "Stock Qty", "Supplier", "Last Updated"]
    units = ["-"] * 7
    row = ["S1", "Lamp", "Home", 9.5, 3, "Acme", 45306.5]
    here.put("inventory_a.xlsx", workbook({"Products": [header, units, row, ["S2", "Pen", "Office", "1.5", "2", "Acme", "2024-01-16 18:00:00"]]}))
    here.put("inventory_b.xlsx", workbook({"Products": [["", None, " "], ["a", "b", "c"]]}))
    here.put("inventory_c.xlsx", workbook({"Products": [["SKU", "Product Name"], units, ["S3", "x"]]}))
    here.put("inventory_d.xlsx", workbook({"Products": [header, units, ["S4", "x", "y", 1, 1, "z", 45306], ["S4", "x", "y", 1, 1, "z", 45306]]}))
    here.put("inventory_e.xlsx", workbook({"Products": [header, units, ["S5", "x", "y", "cheap", 1.5, 7, 45306]]}))
    results = here.load()
    assert {n: r.error_type for n, r in results.items()} == {
        "inventory_a.xlsx": None, "inventory_b.xlsx": "Missing Header", "inventory_c.xlsx": "Missing Columns",
        "inventory_d.xlsx": "Grain Validation Error", "inventory_e.xlsx": "Validation Threshold Exceeded",
    }
    rows = here.rows(feeds.INVENTORY)
    assert [str(rows[(s,)].last_updated) for s in ("S1", "S2")] == ["2024-01-15 12:00:00", "2024-01-16 18:00:00"]
    (letter,) = here.letters()
    assert letter.file_row_number == 3
    assert [(e.column_name, e.error_type) for e in letter.validation_errors] == [
        ("Price", "float_parsing"), ("Stock Qty", "int_from_float"), ("Supplier", "string_type"),
    ]


def test_own_reader_and_grouped_audits(place):
    def read(spark, paths, source):
        rows = spark.read.option("sep", "|").csv(paths).toDF("key", "amount")
        return rows.select(
            F.col("_metadata.file_name").alias("source_filename"), F.lit(0).cast("bigint").alias("file_block"),
            F.monotonically_increasing_id().alias("block_sequence"), F.lit(None).cast("string").alias("shape_error"), "key", "amount",
        )

    source = SourceSpec(
        "piped", ("piped_*.csv",), (FieldSpec("key"), FieldSpec("amount", "decimal")), ("key",), reader=read,
        audits=(Audit("bounded", "sum(amount) < 100"),),
    )
    here = place(source)
    here.put("piped_a.csv", "a|1\nb|2\n")
    here.put("piped_b.csv", "c|99\nd|2\n")
    results = here.load()
    assert results["piped_a.csv"].success and results["piped_b.csv"].error_type == "Audit Failed"
    assert set(here.rows(source)) == {("a",), ("b",)}


def test_missing_directory_and_empty_directory(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(FileNotFoundError):
        load.load_directory(spark, Registry([feeds.SALES]), str(tmp_path / "none"), warehouse)
    (tmp_path / "file").write_text("x")
    with pytest.raises(ValueError):
        load.load_directory(spark, Registry([feeds.SALES]), str(tmp_path / "file"), warehouse)
    (tmp_path / "in").mkdir()
    assert load.load_directory(spark, Registry([feeds.SALES]), str(tmp_path / "in"), warehouse).count() == 0


def test_jdbc_options():
    class Writer:
        def __init__(self):
            self.seen = {}

        def __getattr__(self, name):
            def call(*args, **kwargs):
                self.seen[args[0] if name == "option" else name] = args[1] if name == "option" else (args or kwargs)
                return self

            return call

    class Rows:
        write = Writer()

    write_jdbc(Rows, "jdbc:postgresql://db/x", "public.t", properties={"user": "u"})
    seen = Rows.write.seen
    assert seen["url"] == "jdbc:postgresql://db/x" and seen["dbtable"] == "public.t"
    assert (seen["batchsize"], seen["numPartitions"], seen["options"]) == (10_000, 16, {"user": "u"})
    assert "save" in seen
