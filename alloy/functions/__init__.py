"""Column -> Column building blocks (strings, numbers, dates, hashes)."""

from alloy.functions.dates import (
    error_date_key,
    generic_date,
    parse_hhmm,
    parse_mixed_date,
    session_hour,
    session_start,
    time_from_hour,
)
from alloy.functions.hashing import clean_row_hash, hash_text, raw_row_hash
from alloy.functions.numbers import (
    canonical_number_text,
    checked_number_fill,
    is_integral,
    locale_number,
    locale_number_fill,
    locale_number_text,
    numeric_corrupt,
    percent_corrupt,
    percent_ratio,
    round_to_long,
)
from alloy.functions.text import (
    canon,
    has_content,
    is_blank_cell,
    not_blank_or_null,
    snake_case,
    snake_case_col,
    snake_case_columns,
    upper_trim,
    ustrip,
)

__all__ = [
    "canon", "canonical_number_text", "checked_number_fill", "clean_row_hash", "error_date_key", "generic_date", "has_content",
    "hash_text", "is_blank_cell", "is_integral", "locale_number", "locale_number_fill",
    "locale_number_text", "not_blank_or_null", "numeric_corrupt", "parse_hhmm",
    "parse_mixed_date", "percent_corrupt", "percent_ratio", "raw_row_hash", "round_to_long",
    "session_hour", "session_start", "snake_case", "snake_case_col", "snake_case_columns", "time_from_hour",
    "upper_trim", "ustrip",
]
