"""Text helpers: cleaners that run before validation, cuts, row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftgate.functions.coerce import WHITESPACE


def clean_phone(text: Column) -> Column:
    """Digits and plus signs only; the input itself when nothing would be left."""
    kept = F.regexp_replace(text, r"[^\p{Nd}+]", "")
    return F.when(kept == "", text).otherwise(kept)


def clean_email(text: Column) -> Column:
    return F.lower(F.btrim(text, F.lit(WHITESPACE)))


def truncate(text: Column, limit: int = 200) -> Column:
    """At most ``limit`` characters, with an ellipsis when something was cut off."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(
        text
    )


def canonical_text(name: str, data_type: T.DataType) -> str:
    """SQL for one text per value, the same in every session; a null reads as empty text."""
    column = f"`{name}`"
    if isinstance(data_type, T.TimestampType):
        text = f"CAST(unix_micros({column}) AS string)"
    elif isinstance(data_type, T.StringType):
        # the separator inside a value must not look like a field boundary
        text = rf"replace(replace({column}, r'\', r'\\'), '|', r'\|')"
    else:
        text = f"CAST({column} AS string)"
    return f"coalesce({text}, '')"


def row_hash(fields: Sequence[tuple[str, T.DataType]]) -> Column:
    """SHA-256 over the fields in name order, as 32 bytes."""
    texts = ", ".join(canonical_text(name, kind) for name, kind in sorted(fields, key=lambda f: f[0]))
    return F.expr(f"unhex(sha2(concat_ws('|', {texts}), 256))")


def excel_serial_to_timestamp(serial: Column) -> Column:
    """Days since 1899-12-30 with a fraction of a day, cut to whole seconds."""
    days = F.when(serial < 0, F.ceil(serial)).otherwise(F.floor(serial)).cast("int")
    fraction = serial - days
    seconds = F.when(fraction > 0, F.floor(fraction * 86400)).otherwise(F.lit(0)).cast("bigint")
    midnight = F.unix_date(F.date_add(F.lit("1899-12-30").cast("date"), days)).cast("bigint") * 86400
    return F.timestamp_seconds(midnight + seconds)


def excel_serial_to_date(serial: Column) -> Column:
    days = F.when(serial < 0, F.ceil(serial)).otherwise(F.floor(serial)).cast("int")
    return F.date_add(F.lit("1899-12-30").cast("date"), days)
