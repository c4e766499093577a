from .text import (
    clean_whitespace,
    is_valid_value,
    js_number_prefix,
    numeric_value,
    rate_pct,
    record_id,
    snake_case_name,
)

__all__ = [
    "clean_whitespace",
    "is_valid_value",
    "js_number_prefix",
    "numeric_value",
    "rate_pct",
    "record_id",
    "snake_case_name",
]
