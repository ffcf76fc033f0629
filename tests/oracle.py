"""Compares a registered query with its SQL: names, row count, values in any order."""

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def _types(kind):
    kind = kind.upper()
    for names, one in (
        (("BIGINT", "LONG"), "BIGINT"),
        (("INTEGER", "INT"), "INTEGER"),
        (("VARCHAR", "STRING"), "VARCHAR"),
        (("DOUBLE",), "DOUBLE"),
    ):
        if kind in names:
            return one
    return kind


def compare(spark, con, query, sql, sf_dir):
    """Returns a text that says what differs, or None; also the row count."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    cursor = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    if sorted(described) != names:
        return f"columns {names} vs {sorted(described)}", 0
    kinds = dict(frame.dtypes)
    wrong = {n: (kinds[n], described[n]) for n in names if _types(kinds[n]) != _types(described[n])}
    got_rows = frame.select(*[f"`{n}`" for n in names]).collect()
    order = [list(described).index(n) for n in names]
    got = Counter(tuple(_plain(v) for v in r) for r in got_rows)
    want = Counter(tuple(_plain(r[i]) for i in order) for r in expected_rows)
    if wrong:
        return f"types {wrong}", len(got_rows)
    if got != want:
        only_got, only_want = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{names}: {len(got_rows)} rows vs {len(expected_rows)}\n  got  {only_got}\n  want {only_want}", len(got_rows)
    return None, len(got_rows)
