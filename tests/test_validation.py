"""Coercion rules against an independent validator, one value at a time."""

import math
from decimal import Decimal
from typing import Annotated, Literal, Optional

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.operators import validate
from siftgate.spec import FieldSpec, Rule, SourceSpec

pydantic = pytest.importorskip("pydantic")

TEXTS = [
    None, "", " ", "0", "1", "2", "2.0", "2.", "2.00", " 3 ", "\t5\n", "1_000", "1__0", "_1", "1_", "+4", "-0", "--1", "+-1", "- 1",
    "2.5", "1e3", "1E+5", "1e", "e1", ".5", "5.", ".", "1_0.5", "1_0.5_0", "00012", "0x10", "5d", "5f", "5D", "1_0.0", "1.0_0",
    "nan", "NaN", "+nan", "-nan", "inf", "-inf", "Infinity", "-Infinity", "+infinity", "infinit", "true", "True", "TRUE", " true", "yes",
    "No", "on", "OFF", "t", "f", "y", "n", "abc", "9223372036854775807", "-9223372036854775808", "1,000", "$5", "１", "１２", "é",
]

TYPES = {
    "int": int,
    "float": float,
    "bool": bool,
    "decimal": Decimal,
    "str": str,
}


def checked(spark, texts, spec, kinds=None):
    """(value, error kind, error message) per text, through the engine."""
    if kinds is None:
        rows, kind = [(i, t) for i, t in enumerate(texts)], T.StringType()
    else:
        rows = [(i, (t, k)) for i, (t, k) in enumerate(zip(texts, kinds))]
        kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("kind", T.StringType())])
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField(spec.name, kind)])
    frame = validate.validate(spark.createDataFrame(rows, schema), [spec], carry=["i"])
    found = frame.orderBy("i").select(
        spec.name,
        F.try_element_at("errors", F.lit(1))["error_type"].alias("kind"),
        F.try_element_at("errors", F.lit(1))["error_msg"].alias("message"),
    )
    return [tuple(r) for r in found.collect()]


def expected(annotation, value):
    try:
        return pydantic.TypeAdapter(annotation).validate_python(value), None, None
    except pydantic.ValidationError as error:
        first = error.errors()[0]
        return None, first["type"], first["msg"].lower()


def same(got, want):
    if isinstance(want, float) and math.isnan(want):
        return isinstance(got, float) and math.isnan(got)
    if isinstance(want, Decimal):
        return got is not None and abs(got - want) < Decimal("0.00005")
    return got == want


@pytest.mark.parametrize("kind", sorted(TYPES))
@pytest.mark.parametrize("nullable", [False, True])
def test_texts(spark, kind, nullable):
    annotation = Optional[TYPES[kind]] if nullable else TYPES[kind]
    spec = FieldSpec("cell", kind, nullable=nullable, precision=38, scale=4)
    for text, got in zip(TEXTS, checked(spark, TEXTS, spec)):
        want = expected(annotation, text)
        if kind in ("int", "float", "decimal") and text and any(c in "１２" for c in text):
            continue  # digits of other scripts: not accepted here
        assert same(got[0] if got[1] is None else None, want[0]), (text, got, want)
        assert got[1:] == want[1:], (text, got, want)


JSON_VALUES = [("5", "integer", 5), ("2.5", "number", 2.5), ("2.0", "number", 2.0), ("true", "boolean", True), ("false", "boolean", False),
               ("x", "string", "x"), ("7", "string", "7"), (None, "null", None), ("0", "integer", 0), ("1", "integer", 1), ("1.0", "number", 1.0),
               ("0.5", "number", 0.5)]


@pytest.mark.parametrize("kind", sorted(TYPES))
def test_typed_cells(spark, kind):
    texts, kinds, values = zip(*JSON_VALUES)
    for value, got in zip(values, checked(spark, texts, FieldSpec("cell", kind, precision=38, scale=4), kinds)):
        want = expected(TYPES[kind], value)
        assert same(got[0] if got[1] is None else None, want[0]), (value, got, want)
        assert got[1:] == want[1:], (value, got, want)


CONSTRAINED = [
    (FieldSpec("cell", "str", max_length=3), Annotated[str, pydantic.Field(max_length=3)], ["", "abc", "abcd", "é\U0001d7d9b", "a\U0001f600bcd", None]),
    (FieldSpec("cell", "int", ge=0, le=10), Annotated[int, pydantic.Field(ge=0, le=10)], ["-1", "0", "10", "11", "x", None]),
    (FieldSpec("cell", "int", gt=0, lt=10), Annotated[int, pydantic.Field(gt=0, lt=10)], ["0", "1", "9", "10"]),
    (FieldSpec("cell", "float", ge=0.5), Annotated[float, pydantic.Field(ge=0.5)], ["0.4", "0.5", "nan", "inf", "-inf"]),
    (FieldSpec("cell", "float", lt=100, nullable=True), Optional[Annotated[float, pydantic.Field(lt=100)]], [None, "99.9", "100", "nan"]),
    (FieldSpec("cell", allowed=("a", "b", "c")), Literal["a", "b", "c"], ["a", "d", "", None]),
    (FieldSpec("cell", allowed=("it's",)), Literal["it's"], ["it's", "its"]),
]


@pytest.mark.parametrize("spec,annotation,texts", CONSTRAINED)
def test_constraints(spark, spec, annotation, texts):
    for text, got in zip(texts, checked(spark, texts, spec)):
        want = expected(annotation, text)
        assert (got[1:] == want[1:]) or (spec.allowed == ("it's",) and got[1] == want[1]), (text, got, want)
        if got[1] is None:
            assert got[0] == want[0]


def test_oversize_integer_is_an_error(spark):
    got = checked(spark, ["9223372036854775808", "9" * 30, "1" + "0" * 25 + ".0"], FieldSpec("cell", "int"))
    assert [g[:2] for g in got] == [(None, "int_parsing_size")] * 3


def test_dates_and_times(spark):
    texts = ["2024-01-15", "20240115", "2024-01-15T10:00:00Z", "2024-02-30", "15/01/2024", "invalid_date", "2024-01-15T99:00:00", "", None]
    got = checked(spark, texts, FieldSpec("cell", "date"))
    assert [str(g[0]) if g[1] is None else g[1] for g in got] == (
        ["2024-01-15"] * 3 + ["date_parsing"] * 5 + ["date_type"]
    )
    got = checked(spark, ["15/01/2024", "2024-01-15"], FieldSpec("cell", "date", formats=("dd/MM/yyyy",)))
    assert [str(g[0]) for g in got] == ["2024-01-15"] * 2


def test_timestamps_without_zone_are_utc_in_any_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        spec = FieldSpec("cell", "timestamp")
        frame = spark.createDataFrame([("2024-01-15 12:00:00",), ("2024-01-15T13:00:00+01:00",), ("2024-01-15T12:00Z",)], "cell string")
        seconds = validate.validate(frame, [spec]).select(F.unix_seconds("cell")).collect()
        assert {r[0] for r in seconds} == {1705320000}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_emails(spark):
    good = ["a@b.co", "First.Last+tag@Mail.Example.COM", " x@example.org ", "o'brien@example.com"]
    bad = ["a@b", "a b@example.com", ".a@example.com", "a..b@example.com", "a@-x.com", "@example.com", "a@", "", "a@@b.com", "x" * 65 + "@example.com"]
    got = checked(spark, good + bad, FieldSpec("cell", "email"))
    assert [g[0] for g in got[:4]] == ["a@b.co", "First.Last+tag@mail.example.com", "x@example.org", "o'brien@example.com"]
    assert {g[1] for g in got[4:]} == {"value_error"}


def test_user_rules_and_cleaners(spark):
    even = Rule("odd_number", "Value must be even", lambda v: v % 2 != 0)
    got = checked(spark, ["4", "5", "x", None], FieldSpec("cell", "int", rules=(even,), nullable=True))
    assert [g[1] for g in got] == [None, "odd_number", "int_parsing", None]
    assert got[1][2] == "value must be even"
    got = checked(spark, ["#1"], FieldSpec("cell", "int", clean=(lambda c: F.replace(c, F.lit("#"), F.lit("")),)))
    assert got[0][:2] == (1, None)


def test_all_errors_of_a_record_and_its_key_are_kept(spark):
    source = SourceSpec(
        "t", ("*",), (FieldSpec("key", column="Key"), FieldSpec("a", "int", column="A"), FieldSpec("b", "float"), FieldSpec("c")), ("key",)
    )
    raw = spark.createDataFrame([("k1", "x", "y", "fine"), ("k2", "1", "2", "fine")], "key string, a string, b string, c string")
    stage = validate.with_verdict(validate.validate(raw, source.fields), source).orderBy("key").collect()
    assert [r.is_valid for r in stage] == [False, True]
    assert [(e.column_name, e.column_value, e.error_type) for e in stage[0].validation_errors] == [
        ("A", "x", "int_parsing"), ("b", "y", "float_parsing"),
    ]
    assert stage[0].file_record_data == {"Key": "k1", "A": "x", "b": "y"}
    assert stage[1].validation_errors is None and stage[1].file_record_data is None


@pytest.mark.parametrize("make", [
    lambda: SourceSpec("t", ("*",), (FieldSpec("a"),), ("b",)),
    lambda: SourceSpec("t", ("*",), (FieldSpec("a"),), ()),
    lambda: SourceSpec("t", ("*",), (FieldSpec("a"),), ("a",), format="xml"),
    lambda: FieldSpec("a", "list"),
])
def test_wrong_declarations(make):
    with pytest.raises(ValueError):
        make()


def test_wide_grain_warns():
    names = ("a", "b", "c", "d")
    with pytest.warns(UserWarning):
        SourceSpec("t", ("*",), tuple(FieldSpec(n) for n in names), names)
