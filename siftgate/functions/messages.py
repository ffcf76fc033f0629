"""Texts shown to people. The error kinds and messages users match on."""

# File error kinds.
MISSING_HEADER = "Missing Header"
MISSING_COLUMNS = "Missing Columns"
THRESHOLD_EXCEEDED = "Validation Threshold Exceeded"
AUDIT_FAILED = "Audit Failed"
GRAIN_ERROR = "Grain Validation Error"
FILE_ERRORS = (MISSING_HEADER, MISSING_COLUMNS, THRESHOLD_EXCEEDED, AUDIT_FAILED, GRAIN_ERROR)
DUPLICATE_FILE = "Duplicate File Detected"

# Not a file error: several declarations claim the same file, or a reader cannot take it.
AMBIGUOUS_SOURCE = "ValueError"

# Texts of file errors, as format strings.
NO_HEADER = "No headers found in %s file: %s"
BLANK_HEADER = "Whitespace-only headers in %s file: %s"
BLANK_SHEET_HEADER = "Empty or invalid column headers in %s file: %s"
NO_DATA = "No data found in file: %s"
LACKING_COLUMNS = "Missing required fields in %s file %s\nRequired fields: %s\nMissing fields: %s"
TOO_MANY_ERRORS = (
    "Validation error rate (%.2f%%) exceeds threshold (%.2f%%) for file: %s. "
    "Total Records Processed: %d, Failed Records: %d."
)
KEYS_NOT_UNIQUE = "Grain values are not unique for file: %s\nTable: %s\nGrain columns (file column names): %s"
KEY_EXAMPLES = "Example duplicate grain violations:\n"
EMPTY_KEYS = "Rows with an empty grain value: %d"
AUDITS_FAILED = "Audit checks failed for file: %s\nTable: %s\nFailed audits: %s"
ALREADY_LOADED = "The file %s has already been processed. To load it again, back out its rows from %s first."
RUN_FAILURES = "File processing completed with %d failure(s) out of %d file(s)."

# Record error kinds and their lower-case messages.
RECORD_ERRORS = {
    "string_type": "input should be a valid string",
    "int_type": "input should be a valid integer",
    "int_parsing": "input should be a valid integer, unable to parse string as an integer",
    "int_parsing_size": "unable to parse input string as an integer, exceeded maximum size",
    "int_from_float": "input should be a valid integer, got a number with a fractional part",
    "float_type": "input should be a valid number",
    "float_parsing": "input should be a valid number, unable to parse string as a number",
    "bool_type": "input should be a valid boolean",
    "bool_parsing": "input should be a valid boolean, unable to interpret input",
    "decimal_type": "decimal input should be an integer, float, string or decimal object",
    "decimal_parsing": "input should be a valid decimal",
    "decimal_max_digits": "decimal input has too many digits",
    "finite_number": "input should be a finite number",
    "date_type": "input should be a valid date",
    "date_parsing": "value is not a valid date",
    "timestamp_type": "input should be a valid datetime",
    "datetime_parsing": "value is not a valid datetime",
    "value_error": "value is not a valid email address",
    "missing": "field required",
    "too_many_columns": "record has more cells than the header",
}

# Texts accepted as booleans, in any letter case.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")
