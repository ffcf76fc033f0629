"""Text to typed value, as SQL expressions.

Every function takes a *cell*: the names of the column with its text and, for formats that
have types (JSON, Excel), of the column with its kind. Kinds are ``string integer number
boolean null other``; ``kind=None`` means the format knows only text, so a null text is the
only non-string. Plain values take a ``try_cast``; the regular expressions run only for the
texts that cast refuses. The expressions are text because a wide feed needs thousands of
them, and parsing one text is cheaper than a call into the JVM per operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftgate.functions.messages import FALSE_TEXTS, RECORD_ERRORS, TRUE_TEXTS
from siftgate.spec import FieldSpec

WHITESPACE = " \t\n\r\x0b\x0c"
DIGITS = r"[0-9]+(?:_[0-9]+)*"
INT_TEXT = rf"^[+-]?{DIGITS}(?:\.0+)?$"
FLOAT_TEXT = rf"^[+-]?(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:[eE][+-]?{DIGITS})?$"
NON_FINITE_TEXT = r"(?i)^[+-]?(?:nan|inf|infinity)$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
COMPACT_DATE_TEXT = r"^\d{8}$"
ISO_TIME = r"[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
ISO_ZONE = r"(?:Z|[+-]\d{2}:?\d{2})"
DATETIME_TEXT = rf"^\d{{4}}-\d{{2}}-\d{{2}}{ISO_TIME}{ISO_ZONE}?$"
# Dot-atom local part of at most 64 characters; dotted domain of letter-digit-hyphen labels.
EMAIL_TEXT = (
    r"^(?=.{1,254}$)(?=[^@]{1,64}@)"
    r"[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]+(?:\.[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]+)*"
    r"@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.)+"
    r"\p{L}(?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])$"
)


WHITESPACE_SQL = r"' \t\n\r\u000b\u000c'"
SIGNED_NAN = r"(?i)^[+-]nan$"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(text: str, pattern: str) -> str:
    return f'{text} RLIKE r"{pattern}"'


@dataclass(frozen=True)
class Cell:
    text: str
    kind: str | None = None

    def is_kind(self, *kinds: str) -> str:
        if self.kind is None:
            return f"({self.text} IS NOT NULL)" if "string" in kinds else "false"
        return f"({self.kind} IN ({', '.join(quoted(k) for k in kinds)}))"

    @property
    def is_null(self) -> str:
        return f"({self.text} IS NULL)" if self.kind is None else f"({self.kind} = 'null')"

    @property
    def stripped(self) -> str:
        return f"btrim({self.text}, {WHITESPACE_SQL})"

    @property
    def number(self) -> str:
        return f"try_cast({self.text} AS double)"

    def when(self, kinds: tuple[str, ...], value: str) -> str:
        """The value for cells of these kinds; a format without kinds has strings only."""
        if self.kind is None and "string" in kinds:
            return value
        return f"CASE WHEN {self.is_kind(*kinds)} THEN {value} END"


def _int(cell: Cell, spec: FieldSpec) -> str:
    plain = f"regexp_replace(replace({cell.stripped}, '_', ''), r'\\.0+$', '')"
    parsed = (
        f"coalesce(try_cast({cell.text} AS bigint), "
        f"CASE WHEN {_matches(cell.stripped, INT_TEXT)} THEN try_cast({plain} AS bigint) END)"
    )
    if cell.kind is None:
        return parsed
    return (
        f"CASE WHEN {cell.is_kind('string', 'integer')} THEN {parsed} "
        f"WHEN {cell.is_kind('boolean')} THEN CAST(if({cell.text} = 'true', 1, 0) AS bigint) "
        # doubles are cut to whole numbers through a decimal, which keeps all digits
        f"WHEN {cell.is_kind('number')} AND {cell.number} = floor({cell.number}) "
        f"THEN try_cast(try_cast({cell.text} AS decimal(38,0)) AS bigint) END"
    )


def _int_error(cell: Cell) -> str:
    from_text = f"CASE WHEN {_matches(cell.stripped, INT_TEXT)} THEN 'int_parsing_size' ELSE 'int_parsing' END"
    if cell.kind is None:
        return from_text
    return (
        f"CASE WHEN {cell.is_kind('string')} THEN {from_text} WHEN {cell.is_kind('integer')} THEN 'int_parsing_size' "
        f"WHEN {cell.is_kind('number')} AND {cell.number} <> floor({cell.number}) THEN 'int_from_float' "
        f"WHEN {cell.is_kind('number')} THEN 'int_parsing_size' ELSE 'int_type' END"
    )


def _float(cell: Cell, spec: FieldSpec) -> str:
    # Spark also casts "5d", "5f" and hexadecimal text; those letters take the slow way
    parsed = (
        f"CASE WHEN NOT ({_matches(cell.text, '[dDfFxX]')}) AND try_cast({cell.text} AS double) IS NOT NULL "
        f"THEN try_cast({cell.text} AS double) "
        f"WHEN {_matches(cell.stripped, SIGNED_NAN)} THEN double('NaN') "
        f"WHEN {_matches(cell.stripped, FLOAT_TEXT)} OR {_matches(cell.stripped, NON_FINITE_TEXT)} "
        f"THEN try_cast(replace({cell.stripped}, '_', '') AS double) END"
    )
    if cell.kind is None:
        return parsed
    return (
        f"CASE WHEN {cell.is_kind('string', 'integer', 'number')} THEN {parsed} "
        f"WHEN {cell.is_kind('boolean')} THEN if({cell.text} = 'true', 1D, 0D) END"
    )


def _float_error(cell: Cell) -> str:
    return f"if({cell.is_kind('string')}, 'float_parsing', 'float_type')"


def _bool(cell: Cell, spec: FieldSpec) -> str:
    def listed(values: tuple[str, ...]) -> str:
        return f"lower({cell.text}) IN ({', '.join(quoted(v) for v in values)})"

    parsed = f"CASE WHEN {listed(TRUE_TEXTS)} THEN true WHEN {listed(FALSE_TEXTS)} THEN false END"
    if cell.kind is None:
        return parsed
    return (
        f"CASE WHEN {cell.is_kind('string', 'boolean')} THEN {parsed} WHEN {cell.is_kind('integer', 'number')} "
        f"THEN CASE {cell.number} WHEN 1D THEN true WHEN 0D THEN false END END"
    )


def _bool_error(cell: Cell) -> str:
    if cell.kind is None:
        return "'bool_parsing'"
    whole = f"({cell.is_kind('integer', 'number')} AND {cell.number} = floor({cell.number}))"
    return f"if({cell.is_kind('string')} OR {whole}, 'bool_parsing', 'bool_type')"


def _digits(cell: Cell) -> str:
    """Decimals may have underscores anywhere."""
    return f"replace({cell.stripped}, '_', '')"


def _decimal(cell: Cell, spec: FieldSpec) -> str:
    target = f"decimal({spec.precision},{spec.scale})"
    digits = _digits(cell)
    parsed = (
        f"coalesce(try_cast({cell.text} AS {target}), CASE WHEN {_matches(digits, FLOAT_TEXT)} "
        f"THEN try_cast({digits} AS {target}) END)"
    )
    return cell.when(("string", "integer", "number"), parsed)


def _decimal_error(cell: Cell) -> str:
    return (
        f"CASE WHEN NOT {cell.is_kind('string', 'integer', 'number')} THEN 'decimal_type' "
        f"WHEN {_matches(_digits(cell), NON_FINITE_TEXT)} THEN 'finite_number' "
        f"WHEN {_matches(_digits(cell), FLOAT_TEXT)} THEN 'decimal_max_digits' ELSE 'decimal_parsing' END"
    )


def _as_utc(text: str) -> str:
    """ISO date-time text; without a zone it is UTC, whatever the session's time zone."""
    # Spark reads a zone only after seconds
    full = f"if({_matches(text, '^.{16}($|[Z+-])')}, concat(left({text}, 16), ':00', substring({text}, 17)), {text})"
    zoned = f"if({_matches(text, ISO_ZONE + '$')}, {full}, concat({full}, 'Z'))"
    return f"try_cast({zoned} AS timestamp)"


def _date(cell: Cell, spec: FieldSpec) -> str:
    text = cell.text
    parsed = (
        f"CASE WHEN {_matches(text, DATE_TEXT)} THEN try_cast({text} AS date) "
        f"WHEN {_matches(text, DATETIME_TEXT)} AND {_as_utc(text)} IS NOT NULL THEN try_cast(substring({text}, 1, 10) AS date) "
        f"WHEN {_matches(text, COMPACT_DATE_TEXT)} THEN try_to_date({text}, 'yyyyMMdd') END"
    )
    others = "".join(f", try_to_date({text}, {quoted(f)})" for f in spec.formats)
    return cell.when(("string",), f"coalesce({parsed}{others})" if others else parsed)


def _date_error(cell: Cell) -> str:
    return f"if({cell.is_kind('string')}, 'date_parsing', 'date_type')"


def _timestamp(cell: Cell, spec: FieldSpec) -> str:
    text = cell.text
    parsed = (
        f"CASE WHEN {_matches(text, DATETIME_TEXT)} THEN {_as_utc(text)} "
        f"WHEN {_matches(text, DATE_TEXT)} THEN try_cast(concat({text}, 'T00:00:00Z') AS timestamp) END"
    )
    others = "".join(f", try_to_timestamp({text}, {quoted(f)})" for f in spec.formats)
    return cell.when(("string",), f"coalesce({parsed}{others})" if others else parsed)


def _timestamp_error(cell: Cell) -> str:
    return f"if({cell.is_kind('string')}, 'datetime_parsing', 'timestamp_type')"


def _email(cell: Cell, spec: FieldSpec) -> str:
    local, domain = f"substring_index({cell.stripped}, '@', 1)", f"substring_index({cell.stripped}, '@', -1)"
    normal = f"concat({local}, '@', lower({domain}))"
    return cell.when(("string",), f"CASE WHEN {_matches(cell.stripped, EMAIL_TEXT)} THEN {normal} END")


def _email_error(cell: Cell) -> str:
    return f"if({cell.is_kind('string')}, 'value_error', 'string_type')"


def _string(cell: Cell, spec: FieldSpec) -> str:
    return cell.when(("string",), cell.text)


def _string_error(cell: Cell) -> str:
    return "'string_type'"


# Per field type: its reader, the error of an unreadable value, the error of a null.
TYPES = {
    "str": (_string, _string_error, "string_type"),
    "email": (_email, _email_error, "string_type"),
    "int": (_int, _int_error, "int_type"),
    "float": (_float, _float_error, "float_type"),
    "bool": (_bool, _bool_error, "bool_type"),
    "decimal": (_decimal, _decimal_error, "decimal_type"),
    "date": (_date, _date_error, "date_type"),
    "timestamp": (_timestamp, _timestamp_error, "timestamp_type"),
}


def typed_value(cell: Cell, spec: FieldSpec) -> str:
    """The cell as the field's type; null where it cannot be read as one."""
    return TYPES[spec.type][0](cell, spec)


def message_of(kind: Column) -> Column:
    """The fixed message of an error kind."""
    pairs = ", ".join(f"{quoted(kind)}, {quoted(message)}" for kind, message in RECORD_ERRORS.items())
    return F.expr(f"map({pairs})")[kind]


def _number_text(bound: float) -> str:
    return str(int(bound)) if float(bound).is_integer() else str(bound)


def _choices(values: tuple[str, ...]) -> str:
    marked = [f"'{v}'" for v in values]
    return marked[0] if len(marked) == 1 else ", ".join(marked[:-1]) + " or " + marked[-1]


def _rules(value: str, spec: FieldSpec) -> list[tuple[str, str, str]]:
    """Declared rules as (condition that holds for good values, error kind, message)."""
    rules = []
    if spec.max_length is not None:
        text = f"string should have at most {spec.max_length} characters"
        rules.append((f"length({value}) <= {spec.max_length}", "string_too_long", text))
    # NaN compares as the largest value in Spark, but fulfils no bound
    number = f"AND NOT isnan({value})" if spec.type == "float" else ""
    for attribute, kind, words, sign in (
        ("le", "less_than_equal", "less than or equal to", "<="),
        ("lt", "less_than", "less than", "<"),
        ("ge", "greater_than_equal", "greater than or equal to", ">="),
        ("gt", "greater_than", "greater than", ">"),
    ):
        bound = getattr(spec, attribute)
        if bound is not None:
            text = f"input should be {words} {_number_text(bound)}"
            rules.append((f"({value} {sign} {_number_text(bound)} {number})", kind, text))
    if spec.allowed:
        listed = ", ".join(quoted(v) for v in spec.allowed)
        rules.append((f"{value} IN ({listed})", "literal_error", f"input should be {_choices(spec.allowed)}"))
    return rules


def is_fine(cell: Cell, value: str, spec: FieldSpec) -> Column:
    """True when the typed value is there, or may be missing, and breaks no rule."""
    good = " AND ".join([f"{value} IS NOT NULL", *[holds for holds, _, _ in _rules(value, spec)]])
    if not spec.rules:
        return F.expr(f"({value} IS NULL AND {cell.is_null}) OR ({good})" if spec.nullable else good)
    fine = F.expr(good)
    for rule in spec.rules:
        fine = fine & ~rule.is_bad(F.col(value))
    return (F.expr(f"{value} IS NULL AND {cell.is_null}") | fine) if spec.nullable else fine


NO_TEXT = "CAST(NULL AS string)"


def error_entry(column: str, value: str, kind: str, message: str = NO_TEXT) -> str:
    """One error; the message is null where the kind alone says it (see ``message_of``)."""
    return f"named_struct('column_name', {column}, 'column_value', {value}, 'error_type', {kind}, 'error_msg', {message})"


def field_error(cell: Cell, value: str, spec: FieldSpec) -> Column:
    """First error of one field; null when the value is fine. ``value`` names the typed value."""
    column = quoted(spec.file_column)

    def error(kind: str, message: str = NO_TEXT) -> str:
        return error_entry(column, cell.text, kind, message)

    _, type_error, null_error = TYPES[spec.type]
    on_null, on_type = error(quoted(null_error)), error(type_error(cell))
    if spec.allowed:
        on_null = on_type = error("'literal_error'", quoted(f"input should be {_choices(spec.allowed)}".lower()))
    cases = [
        f"WHEN {value} IS NULL AND {cell.is_null} THEN {'NULL' if spec.nullable else on_null}",
        f"WHEN {value} IS NULL THEN {on_type}",
    ]
    if cell.kind is not None:
        cases.insert(0, f"WHEN {cell.kind} = 'missing' THEN {error_entry(column, NO_TEXT, quoted('missing'))}")
    for holds, kind, message in _rules(value, spec):
        cases.append(f"WHEN NOT ({holds}) THEN {error(quoted(kind), quoted(message.lower()))}")
    declared = F.expr(f"CASE {' '.join(cases)} END")
    own = [
        F.when(
            F.expr(f"{value} IS NOT NULL") & rule.is_bad(F.col(value)),
            F.expr(error(quoted(rule.error_type), quoted(rule.message.lower()))),
        )
        for rule in spec.rules
    ]
    return F.coalesce(declared, *own) if own else declared
