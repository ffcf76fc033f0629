"""Readers: places of records, ragged rows, paths, plans."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from siftgate.checks import common, files
from siftgate.functions.text import excel_serial_to_date, excel_serial_to_timestamp, truncate
from siftgate.operators import merge, rows, validate
from siftgate.plans import load
from siftgate.sources import discover, excel_source, headers, records, workbook_source
from siftgate.sources.csv_source import read_csv
from siftgate.sources.json_source import flat_paths, records_at
from siftgate.spec import FieldSpec, SourceSpec, glob_regex

LINES = SourceSpec("lines", ("*.csv",), (FieldSpec("n", "int"), FieldSpec("text")), ("n",), multiline=False)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "2000")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def write_lines(path, name, count, skip=0):
    body = "".join(f"u{i},unit\n" for i in range(skip)) + "".join(f"{i},text {i}\n" + ("\n" if i % 7 == 0 else "") for i in range(count))
    (path / name).write_text("n,text\n" + body)
    return f"file:{path / name}"


def test_row_numbers_over_many_splits(spark, tmp_path, small_splits):
    paths = [write_lines(tmp_path, f"f{k}.csv", 900 + k) for k in range(3)]
    raw, _ = load.scan(spark, LINES, paths)
    assert raw.rdd.getNumPartitions() > 6
    numbered = load.number_rows(raw, LINES)
    assert numbered.count() == 2703
    assert numbered.filter(F.col("file_row_number") != F.col("n").cast("bigint") + 2).count() == 0


def test_skipped_rows_over_many_splits(spark, tmp_path, small_splits):
    source = dataclasses.replace(LINES, skip_rows=400)
    paths = [write_lines(tmp_path, f"f{k}.csv", 500, skip=400) for k in range(2)]
    raw, _ = load.scan(spark, source, paths)
    stage = load.drop_skipped(load.staged(raw, source), source)
    assert stage.filter("is_valid").count() == stage.count() == 1000


def test_multiline_records_count_once(spark, tmp_path):
    source = dataclasses.replace(LINES, multiline=True)
    (tmp_path / "a.csv").write_text('n,text\n0,"a\n\nb"\n\n1,"c ""d"", e"\n2,\n')
    raw, _ = load.scan(spark, source, [f"file:{tmp_path}/a.csv"])
    found = load.number_rows(raw, source).orderBy("file_row_number").select("file_row_number", "n", "text").collect()
    assert [tuple(r) for r in found] == [(2, "0", "a\n\nb"), (3, "1", 'c "d", e'), (4, "2", "")]


def test_ragged_rows_and_repeated_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('N,x,n,Text\n1,_,2\n1,_,2,t\n1,_,2,"a,b",\n1,_,2,"q""",r,s\n')
    raw = read_csv(spark, [f"file:{tmp_path}/a.csv"], LINES, ["N", "x", "n", "Text"])
    found = raw.orderBy("block_sequence").select("n", "text", "shape_error").collect()
    assert [tuple(r) for r in found] == [
        ("2", None, None), ("2", "t", None), ("2", "a,b", "too_many_columns"), ("2", 'q"', "too_many_columns"),
    ]


def test_awkward_header_names(spark, tmp_path):
    for header in (["n.x", "text", "a b"], ["n.x", "text", "source_filename"], ["n.x", "text", "te`xt"], ["n.x", "text", "TEXT"]):
        source = dataclasses.replace(LINES, fields=(FieldSpec("n", column="N.X"), FieldSpec("text")))
        (tmp_path / "a.csv").write_text(",".join(header) + "\n1,t,t\n")
        raw, _ = load.scan(spark, source, [f"file:{tmp_path}/a.csv"])
        assert [(r.n, r.text) for r in raw.collect()] == [("1", "t")]


def test_delimiter_and_encoding(spark, tmp_path):
    source = dataclasses.replace(LINES, delimiter=";", encoding="latin-1")
    (tmp_path / "a.csv").write_bytes("n;text\n1;é,ü\n".encode("latin-1"))
    raw, verdicts = load.scan(spark, source, [f"file:{tmp_path}/a.csv"])
    assert [(r.n, r.text) for r in raw.collect()] == [("1", "é,ü")]


def test_headers_on_workers_and_by_scan_agree(spark, tmp_path, monkeypatch):
    paths = [write_lines(tmp_path, f"f{k}.csv", k) for k in range(5)]
    (tmp_path / "broken.csv").write_text('n,"te\n""x"",t",z\n1,2,3\n')
    paths.append(f"file:{tmp_path / 'broken.csv'}")
    workers = headers.csv_headers(spark, paths, LINES).collect()
    scan = records.first_records(spark, paths, LINES.delimiter, LINES.encoding).collect()
    assert sorted(map(tuple, workers)) == sorted(map(tuple, scan))
    assert ["n", 'te\n"x",t', "z"] in [r.header for r in workers]

    def refused(path):
        raise PermissionError(path)

    monkeypatch.setattr(headers, "file_system", refused)
    monkeypatch.setattr(headers, "open_text", lambda path, encoding: refused(path))
    assert sorted(map(tuple, headers.csv_headers(spark, paths, LINES).collect())) == sorted(map(tuple, workers))


def test_a_very_long_cell_in_a_ragged_record(spark, tmp_path):
    long = "x,y" * 340_000
    quotes = '""' * 300_000
    (tmp_path / "a.csv").write_text(f'n,text\n1,"{long}",z\n2\n3,"{quotes}a,b",z\n4,"{long}"\n"5","a"",b"\n6,"","c,d"\n')
    raw = read_csv(spark, [f"file:{tmp_path}/a.csv"], LINES, ["n", "text"])
    found = raw.orderBy("block_sequence").select("n", F.length("text"), "shape_error").collect()
    assert [tuple(r) for r in found] == [
        ("1", len(long), "too_many_columns"), ("2", None, None), ("3", 300_003, "too_many_columns"), ("4", len(long), None),
        ("5", 4, None), ("6", 0, "too_many_columns"),
    ]


def test_many_declarations_are_routed_as_few(spark):
    import random

    chance = random.Random(4)
    words = ["a", "B", "sales", "É", "x[1]", "é", "10"]
    made = ["".join(chance.choices([*words, "*", "?", "[ab]", "[!z]", ".csv", "_"], k=chance.randrange(1, 6))) for _ in range(300)]
    sources = [SourceSpec(f"t{i}", tuple(made[i : i + 2]), (FieldSpec("k"),), ("k",)) for i in range(0, 300, 2)]
    sources.append(SourceSpec("same", ("sales*", "*sales"), (FieldSpec("k"),), ("k",)))
    names = ["".join(chance.choices([*words, "c", ".csv", ".CSV", "_", "Sales"], k=chance.randrange(1, 6))) for _ in range(500)]
    files = spark.createDataFrame([(f"/in/{i}/{n}", n, "csv") for i, n in enumerate(names)], "path string, source_filename string, file_format string")
    few, many = (sorted(map(tuple, way(files, sources).collect())) for way in (discover._matched_by_projection, discover._matched_by_index))
    assert few == many and max(len(r[-1]) for r in few) > 1
    plan = plan_of(discover.route(files, [dataclasses.replace(s, table=f"{s.table}_{k}") for s in sources for k in range(35)]))
    assert "(?is)" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_globs():
    import re

    assert re.search(glob_regex("sales_*.csv"), "SALES_1.CSV")
    assert not re.search(glob_regex("sales_*.csv"), "sales_1.csv.gz")
    assert not re.search(glob_regex("sales_*.csv"), "old_sales_1.csv")
    assert re.search(glob_regex("a?[0-9][!x].csv"), "ab1y.csv") and not re.search(glob_regex("a?[0-9][!x].csv"), "ab1x.csv")
    assert re.search(glob_regex("a[.csv"), "a[.csv")


def test_json_paths(spark):
    def found(document, path):
        frame = spark.createDataFrame([(json.dumps(document),)], "j string").select(F.parse_json("j").alias("v"))
        out = frame.select(F.explode(records_at(F.col("v"), path)).alias("r")).select(F.to_json("r")).collect()
        return [json.loads(r[0]) for r in out]

    assert found([{"a": 1}, {"a": 2}], "item") == [{"a": 1}, {"a": 2}]
    assert found({"e": {"item": [{"a": 1}, {"a": 2}]}}, "e.item") == [{"a": 1}, {"a": 2}]
    assert found({"e": [{"a": 1}]}, "e.item") == [{"a": 1}]
    assert found({"e": {"item": {"a": 1}}}, "e.item") == [{"a": 1}]
    assert found({"e": [{"x": [{"a": 1}, {"a": 2}]}, {"x": [{"a": 3}]}, {}]}, "e.item.x.item") == [{"a": 1}, {"a": 2}, {"a": 3}]
    assert found({"e": [[{"a": 1}], [{"a": 2}]]}, "e.item") == [{"a": 1}, {"a": 2}]
    assert found({"e": {}}, "e.item") == found({}, "e.item") == []


def test_flattened_keys():
    record = {"A": {"B c": 1, "d": {"E": 2}}, "l": [{"x": 1}, {"y": {"z": 2}}, 5], "s": [1, 2], "n": None, "e": []}
    assert flat_paths(record) == {
        "a_b c": "$['A']['B c']", "a_d_e": "$['A']['d']['E']", "l_0_x": "$['l'][0]['x']", "l_1_y_z": "$['l'][1]['y']['z']",
        "l_2": "$['l'][2]", "s": "$['s']", "n": "$['n']", "e": "$['e']",
    }


def test_json_skip_and_lines(spark, tmp_path, small_splits):
    fields = (FieldSpec("n", "int"), FieldSpec("x_y", "float", nullable=True))
    lines = SourceSpec("j", ("*",), fields, ("n",), format="json", json_lines=True, skip_rows=3)
    (tmp_path / "a.json").write_text("".join(json.dumps({"N": i, "x": {"Y": i / 2 if i % 3 else None}}) + "\n" for i in range(500)))
    raw, _ = load.scan(spark, lines, [f"file:{tmp_path}/a.json"])
    stage = load.number_rows(load.staged(raw, lines), lines)
    assert stage.filter("is_valid AND file_row_number = n + 1").count() == 500
    assert load.drop_skipped(stage, lines).agg(F.min("n"), F.count("*")).first()[:] == (3, 497)
    whole = dataclasses.replace(lines, json_lines=False, array_path="item")
    (tmp_path / "b.json").write_text(json.dumps([{"n": i, "x": {"y": 1}} for i in range(10)]))
    raw, _ = load.scan(spark, whole, [f"file:{tmp_path}/b.json"])
    numbered = load.number_rows(load.drop_skipped(raw, whole), whole)
    assert sorted(r.file_row_number for r in numbered.collect()) == list(range(4, 11))


def test_excel_serials(spark):
    frame = spark.createDataFrame([(45306.0,), (45306.5,), (45307.75,), (1.0,), (0.25,)], "s double")
    found = frame.select(excel_serial_to_date(F.col("s")).cast("string"), excel_serial_to_timestamp(F.col("s")).cast("string")).collect()
    assert [tuple(r) for r in found] == [
        ("2024-01-15", "2024-01-15 00:00:00"), ("2024-01-15", "2024-01-15 12:00:00"), ("2024-01-16", "2024-01-16 18:00:00"),
        ("1899-12-31", "1899-12-31 00:00:00"), ("1899-12-30", "1899-12-30 06:00:00"),
    ]


def test_truncate(spark):
    frame = spark.createDataFrame([("x" * 200,), ("x" * 201,), (None,)], "t string").select(truncate(F.col("t")).alias("t"))
    assert [r.t for r in frame.collect()] == ["x" * 200, "x" * 200 + "...", None]


@pytest.mark.parametrize("opened", [True, False])
def test_files_are_archived_byte_by_byte(spark, tmp_path, monkeypatch, opened):
    monkeypatch.setattr(discover, "can_open", lambda paths: opened)
    contents = {"big.csv": bytes(range(256)) * 40, "edge.csv.gz": b"z" * 2000, "small.csv": b"no line end", "empty.csv": b""}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    files = [(f"file:{tmp_path / n}", len(c)) for n, c in contents.items()]
    discover.archive_raw(spark, files, str(tmp_path / "raw"), chunk_bytes=1000)
    rows = discover.archived_chunks(spark, str(tmp_path / "raw")).orderBy("source_filename", "file_offset").collect()
    kept = {n: b"".join(bytes(r.bytes) for r in rows if r.source_filename == n) for n in contents}
    assert kept == contents and max(len(r.bytes) for r in rows) == 1000
    noted = {r.source_filename: (r.file_bytes, r.chunks) for r in spark.read.parquet(str(tmp_path / "raw/files")).collect()}
    assert noted == {"big.csv": (10_240, 11), "edge.csv.gz": (2000, 2), "small.csv": (11, 1), "empty.csv": (0, 1)}


def test_both_ways_of_the_archive_give_the_same_chunks(spark, tmp_path, small_splits):
    import gzip
    import random

    chance = random.Random(2)
    mark = b"\xef\xbb\xbf"
    lines = b"".join(b"line %d\n" % i for i in range(1500))
    contents = {
        "lines.csv": lines, "open.csv": lines[:-1], "mark.csv": mark + lines, "both.csv": mark + lines + b"no end",
        "only_mark.csv": mark, "mark_and_end.csv": mark + b"\n", "one_end.csv": b"\n", "ends.csv": b"\n" * 5000, "twice.csv": mark + mark + b"x",
        "random.xlsx": chance.randbytes(9000), "long.csv": b"x" * 7777 + b"\n" + b"y" * 3000, "exact.csv": b"a" * 2999 + b"\n",
        "packed.csv.gz": gzip.compress(chance.randbytes(5000)), "crlf.csv": b"a,b\r\n" * 700, "tiny.json": b"{}", "empty.csv": b"",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    files = [(f"file:{tmp_path / n}", len(c)) for n, c in contents.items()]
    columns = ["source_filename", "file_offset", "bytes", "chunk_digest"]
    ways = []
    for by_scan in (False, True):
        discover.archive_raw(spark, files, str(tmp_path / f"raw{by_scan}"), 1000, by_scan)
        ways.append(sorted(tuple(r) for r in discover.archived_chunks(spark, str(tmp_path / f"raw{by_scan}")).select(*columns).collect()))
        kept = {n: b"".join(bytes(r[2]) for r in ways[-1] if r[0] == n) for n in contents}
        assert kept == contents
    assert ways[0] == ways[1] and max(len(r[2]) for r in ways[1]) == 1000


def test_a_file_that_changes_is_not_archived_by_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a,b\n" * 100)
    with pytest.raises(Exception, match="changed while it was read"):
        discover.archive_raw(spark, [(f"file:{tmp_path / 'a.csv'}", 390)], str(tmp_path / "raw"), by_scan=True)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    from siftgate.checks import tables
    from siftgate.checks.common import staged_orders

    sf = "/root/testdata/sf0.001"
    samples = plan_of(validate.sample_errors(staged_orders(spark, sf).filter(~F.col("is_valid"))))
    assert "WindowGroupLimit" in samples and samples.index("Final") < samples.index("Partial")
    latest = plan_of(merge.latest_per_key(tables._resent(spark, sf), ["order_key"], [F.desc("price")]))
    assert "Partial" in latest
    small = plan_of(merge.merge_small_stage(tables._target(spark, sf), tables._resent(spark, sf), ["order_key"], F.current_timestamp()))
    assert "Exchange hashpartitioning" not in small
    counts = plan_of(validate.file_counts(staged_orders(spark, sf)))
    assert "partial_count" in counts
    from siftgate.checks.registry import CHECKS

    for name in ("route_files", "merge_counts", "audit_sql", "dlq_cleanup", "publish_gate", "header_check"):
        assert "CartesianProduct" not in plan_of(CHECKS[name][0](spark, sf))
    keys = plan_of(merge.merge_actions(tables._target(spark, sf), tables._resent(spark, sf), ["order_key"]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double" in keys


def test_offsets_do_not_depend_on_partitions(spark):
    frame = spark.range(1000).selectExpr("'f' AS source_filename", "id DIV 100 AS file_block", "id * 3 AS block_sequence", "id AS n")
    for parts in (1, 7):
        numbered = rows.add_row_number(frame.repartition(parts), rows.block_offsets(frame.repartition(parts)), 2)
        # ids rise by three here, so only the first record of each split can be checked
        assert numbered.filter("n % 100 = 0 AND file_row_number <> n + 2").count() == 0


def test_json_keys_are_read_by_record(spark, tmp_path):
    fields = (FieldSpec("id", "int"), FieldSpec("info_name"), FieldSpec("l_1_x", nullable=True), FieldSpec("odd key's", nullable=True), FieldSpec("v_w", nullable=True))
    source = SourceSpec("j", ("*",), fields, ("id",), format="json", array_path="")
    records = [
        {"Id": 1, "info": {"name": "a"}, "l": [{"x": "p"}, {"x": "q"}], "Odd key's": "o", "v": {"W": "deep"}},
        {"id": 2, "INFO": {"name": "b"}, "L": [{"y": 1}, {"X": "r"}], "v": "flat", "v_w": "own"},
        {"id": 3, "info_name": "c", "l": [], "v": [1], "odd key's": None},
    ]
    (tmp_path / "a.json").write_text(json.dumps(records))
    for i in range(4):  # files with different optional keys are one scan
        (tmp_path / f"b{i}.json").write_text(json.dumps([{"id": 10 + i, "info": {"name": "z"}, "l_1_x": "1", "odd key's": "2", "V_w": "3", f"more{i}": 1}]))
    paths = [f"file:{tmp_path}/{n}.json" for n in ("a", "b0", "b1", "b2", "b3")]
    raw, verdicts = load.scan(spark, source, paths)
    assert all(v.error_type is None for v in verdicts)
    found = {r.id.text: [c and c.text for c in (r.info_name, r.l_1_x, r["odd key's"], r.v_w)] for r in raw.collect()}
    assert found == {
        "1": ["a", "q", "o", "deep"], "2": ["b", "r", None, "own"], "3": ["c", None, None, None], **{str(10 + i): ["z", "1", "2", "3"] for i in range(4)},
    }
    assert plan_of(raw).count("Scan parquet") == 1


def test_long_rows_are_exported_to_more_files(spark):
    rows = spark.range(100).selectExpr("id", "repeat('x', 1000) AS text", "CAST(NULL AS STRING) AS nothing")
    assert common.files_for(rows, 20_000) == 6 and common.files_for(rows) == 1 and common.files_for(rows.limit(0)) == 0


def test_splits_of_large_files_stay_small(spark):
    name = "spark.sql.files.maxPartitionBytes"
    with common.many_splits(spark, 1 << 20):
        assert int(spark.conf.get(name)) == 1 << 16
    with common.many_splits(spark, 1 << 40):
        assert int(spark.conf.get(name)) == load.SPLIT_BYTES


def test_each_file_begins_with_a_header_written_without_python(spark, tmp_path):
    lines = spark.range(40).selectExpr("concat('line ', id, if(id % 2 = 0, '\n\"', '')) AS line").repartition(3)
    headed = files._with_header(lines, "head,er")
    assert "Python" not in (plan := headed._jdf.queryExecution().toString()) and "MapInPandas" not in plan
    headed.write.text(str(tmp_path / "lines"))
    found = [p.read_text() for p in (tmp_path / "lines").glob("*.txt")]
    assert len(found) == 3 and all(t.startswith("head,er\nline ") and t.count("head,er") == 1 for t in found)
    assert sorted("".join(t.removeprefix("head,er\n") for t in found)) == sorted("".join(r.line + "\n" for r in lines.collect()))


def test_sheets_of_many_workbooks_share_tasks():
    reader = workbook_source.WorkbookReader({"path": "/in", "sheet": "a\nb"})
    books = [(0, f"/in/{i}.xlsx") for i in range(1000)]
    parts = reader.partitions_of(books)
    assert [s for p in parts for s in p.sheets] == [(path, sheet) for _, path in books for sheet in "ab"]
    assert len(parts) <= 2 * workbook_source.TASKS and len(reader.partitions_of(books[:3])) == 6
    assert max(len(p.sheets) for p in reader.partitions_of(books * 50)) == workbook_source.SHEETS


def test_header_of_a_workbook_reads_cells_once(spark):
    cells = spark.createDataFrame([("b", 3, [("x", "string")]), ("b", 2, [("H", "string")])], excel_source.CELLS)
    found = excel_source.excel_headers(cells)
    assert [(r.path, r.header) for r in found.collect()] == [("b", ["H"])]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
