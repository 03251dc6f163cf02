from gapmend.operators.gaps import (
    coverage,
    key_coverage,
    key_words,
    matched_copies,
    matched_rows,
    missing_keys,
    missing_preview,
    missing_range,
    missing_rows,
    present_key_days,
    rows_in_missing_range,
)
from gapmend.operators.duplicates import (
    dedup,
    duplicate_files,
    duplicate_keys,
    duplicate_occurrences,
    number_rows,
    source_keys_duplicated,
)
from gapmend.operators.ranges import in_range, key_range, resolve_range

__all__ = [
    "coverage",
    "dedup",
    "duplicate_files",
    "duplicate_keys",
    "duplicate_occurrences",
    "in_range",
    "key_coverage",
    "key_range",
    "key_words",
    "matched_copies",
    "matched_rows",
    "missing_keys",
    "missing_preview",
    "missing_range",
    "missing_rows",
    "number_rows",
    "present_key_days",
    "resolve_range",
    "rows_in_missing_range",
    "source_keys_duplicated",
]
