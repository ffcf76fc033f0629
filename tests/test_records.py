"""Records over many splits: the same rows as when one task reads a file."""

import csv
import dataclasses
import io
import random

import pyarrow as pa
import pytest

from siftgate.plans import load
from siftgate.sources import headers, records
from siftgate.sources.csv_source import read_csv
from siftgate.spec import FieldSpec, SourceSpec

FEED = SourceSpec("cells", ("*.csv",), tuple(FieldSpec(c) for c in "abc"), ("a",))


@pytest.fixture
def tiny_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "700")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def written(path, rows, delimiter=",", newline="\n", encoding="utf-8", quoting=csv.QUOTE_MINIMAL):
    text = io.StringIO(newline="")
    csv.writer(text, delimiter=delimiter, lineterminator=newline, quoting=quoting).writerows([["a", "b", "c"], *rows])
    path.write_bytes(text.getvalue().encode(encoding))
    return f"file:{path}"


def cells(chance, delimiter, newline, long=40):
    parts = ["x", "yy", '"', '""', delimiter, newline, " ", "'", "", "é"]
    return ["".join(chance.choices(parts, k=chance.choice([0, 1, 3, 8, long]))) for _ in range(3)]


def both(spark, path, source, newline="\n"):
    ways = []
    for least in (0, 1 << 40):
        raw = read_csv(spark, [path], source, ["a", "b", "c"], newline, whole_bytes=least)
        numbered = load.number_rows(raw, source).orderBy("file_row_number")
        ways.append([tuple(r) for r in numbered.select("file_row_number", "a", "b", "c", "shape_error").collect()])
    return ways


@pytest.mark.parametrize("delimiter, newline, encoding, quoting", [
    (",", "\n", "utf-8", csv.QUOTE_MINIMAL),
    (";", "\r\n", "utf-8-sig", csv.QUOTE_MINIMAL),
    ("|", "\n", "latin-1", csv.QUOTE_ALL),
    ("\t", "\r\n", "utf-8", csv.QUOTE_ALL),
])
def test_random_cells(spark, tmp_path, tiny_splits, delimiter, newline, encoding, quoting):
    chance = random.Random(11)
    rows = [[str(i), *cells(chance, delimiter, newline)[1:]] for i in range(700)]
    path = written(tmp_path / "a.csv", rows, delimiter, newline, encoding, quoting)
    source = dataclasses.replace(FEED, delimiter=delimiter, encoding=encoding)
    (head,) = headers.csv_headers(spark, [path], source).collect()
    assert (head.header, head.newline) == (["a", "b", "c"], newline)
    split, whole = both(spark, path, source, head.newline)
    assert split == whole
    # line breaks of the file's kind are one line feed in a cell
    assert [r[1:4] for r in split] == [tuple(c.replace(newline, "\n") for c in r) for r in rows]


def test_records_larger_than_splits(spark, tmp_path, tiny_splits):
    long = "line, with \"quotes\"\n" * 300
    rows = [["1", long, "x"], ["2", "y", ""], ["3", "z\n", long], ["4", long, long], ["5", "", "end"]]
    split, whole = both(spark, written(tmp_path / "a.csv", rows), FEED)
    assert split == whole and [list(r[1:4]) for r in split] == rows


@pytest.mark.parametrize("body", [
    '1,5" pipe,x\n2,"a\nb",y\n3,c"d"e,"f\ng"\n' * 60,  # quotes inside plain cells
    '1,"a"b,c\n2,"x\ny",z\n' * 60,  # text behind a closing quote
    '\n\n1,a,b\n\n2,"\n\n",c\n\n' * 60,  # empty lines outside and inside of cells
    '1,a\n2,"b\nc",d,e\n3\n' * 60,  # too few and too many cells
    '1,a,b\n2,c,d',  # no line feed at the end
    '1,"a\n\nb",""\n2,"""","x"""\n3,"""\n""",y\n' * 60,
])
def test_odd_files(spark, tmp_path, tiny_splits, body):
    (tmp_path / "a.csv").write_text("a,b,c\n" + body)
    split, whole = both(spark, f"file:{tmp_path / 'a.csv'}", FEED)
    assert split == whole and split


def test_a_cell_that_never_closes(spark, tmp_path, tiny_splits):
    """It takes the rest of the file on both ways; only the last line feed is not kept where lines are scanned."""
    (tmp_path / "a.csv").write_text("a,b,c\n" + "1,a,b\n" * 200 + '2,"never closed\n' + "3,c,d\n" * 200)
    split, whole = both(spark, f"file:{tmp_path / 'a.csv'}", FEED)
    assert split[:-1] == whole[:-1] and len(split) == 201
    assert [c and c.rstrip("\n") for c in split[-1][1:]] == [c and c.rstrip("\n") for c in whole[-1][1:]]


def test_a_plan_without_exchange_of_lines(spark, tmp_path, tiny_splits):
    path = written(tmp_path / "a.csv", [["1", "x\ny", "z"]] * 400)
    raw = read_csv(spark, [path], FEED, ["a", "b", "c"], whole_bytes=0)
    assert raw.rdd.getNumPartitions() > 4
    assert raw.count() == 400


def test_splits_that_change_stop_the_job(spark, tmp_path, tiny_splits):
    path = written(tmp_path / "a.csv", [["1", "x\ny", "z"]] * 400)
    raw = read_csv(spark, [path], FEED, ["a", "b", "c"], whole_bytes=0)
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{name}", "900")
    with pytest.raises(Exception, match="splits of a file changed"):
        raw.collect()


def test_what_cannot_be_split(spark, tmp_path):
    assert not records.can_split("x.csv.gz", "utf-8", "\n")
    assert not records.can_split("x.csv", "utf-16", "\n")
    assert not records.can_split("x.csv", "utf-8", records.OTHER)
    (tmp_path / "mac.csv").write_bytes(b'a,b,c\r1,"x\ry",z\r')
    path = f"file:{tmp_path / 'mac.csv'}"
    for head in (headers.csv_headers(spark, [path], FEED), records.first_records(spark, [path], ",", "utf-8")):
        (found,) = head.collect()
        assert (found.header, found.newline) == (["a", "b", "c"], records.OTHER)
    raw, _ = load.scan(spark, FEED, [path])
    assert [(r.a, r.b, r.c) for r in raw.collect()] == [("1", "x\ny", "z")]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_long_header_records_on_both_ways(spark, tmp_path, newline):
    long = "\n".join(f"line {i}" for i in range(1300))
    (tmp_path / "a.csv").write_bytes((f'a,"{long}",c\n1,2,3\n').replace("\n", newline).encode())
    path = f"file:{tmp_path / 'a.csv'}"
    opened = headers.csv_headers(spark, [path], FEED).collect()
    scanned = records.first_records(spark, [path], ",", "utf-8").collect()
    assert opened[0].newline == scanned[0].newline == newline
    assert [h.replace("\r", "") for h in opened[0].header] == scanned[0].header == ["a", long, "c"]


def test_line_edges():
    lines = ["a,b", 'a,"b', 'b",c', 'a,"b",c', 'x","y', '""', '"""', 'a"b', 'c","d","', '" ,"']
    opens, closes = records.line_edges(pa.array(lines), ",")
    assert opens.tolist() == [False, True, False, False, True, False, True, False, True, False]
    assert closes.tolist() == [False, True, True, True, False, False, True, True, False, False]
