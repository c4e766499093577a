"""Column expressions for the cleaning rules.

All of these are built-in Spark expressions: they run JVM-side, never in a
Python worker.  On plain columns they are part of whole-stage codegen; inside
array lambdas (the in-row layer forms) they are evaluated outside of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import INVALID_TOKENS, UNKNOWN_FIELD

# Fixed patterns.
# Runs of characters that are neither a Unicode letter nor a Unicode digit
# (underscore included) collapse to one underscore: the native form of
# "replace non-word runs with _, squeeze _ runs".
NON_WORD_RUN = r"[^\p{L}\p{N}]+"
# Java's \s is ASCII whitespace: space, \t, \n, \x0B, \f, \r.
WHITESPACE_RUN = r"\s+"
# A plain decimal number with ASCII digits, optional minus and fraction.
NUMERIC_PATTERN = r"^-?\d+(\.\d+)?$"
# Longest number prefix a browser's parseFloat accepts, after leading
# white space (ASCII, NBSP, BOM, Unicode space separators, LS, PS).
JS_NUMBER_PREFIX = (
    r"^[\t\n\x0B\f\r \x{00A0}\x{FEFF}\p{Zs}\x{2028}\x{2029}]*"
    r"([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def snake_case_name(c) -> Column:
    """Lower-case, non-alphanumeric runs to ``_``, ``_`` trimmed at both
    ends; null or nothing left -> ``unknown_field``."""
    n = F.btrim(F.regexp_replace(F.lower(_col(c)), NON_WORD_RUN, "_"), F.lit("_"))
    return F.coalesce(F.nullif(n, F.lit("")), F.lit(UNKNOWN_FIELD))


def clean_whitespace(c) -> Column:
    """null -> '', ASCII white-space runs -> one space, spaces trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), WHITESPACE_RUN, " "))


def numeric_value(c) -> Column:
    """Double for plain decimal text, else null.  ``try_cast`` keeps the
    regex guard safe under ANSI mode for any text the guard lets through."""
    c = _col(c)
    return F.when(c.rlike(NUMERIC_PATTERN), c.try_cast("double"))


def is_valid_value(c) -> Column:
    """Non-empty and not one of the placeholder tokens (case-sensitive)."""
    c = _col(c)
    return (F.length(c) > 0) & ~c.isin(*INVALID_TOKENS)


def js_number_prefix(c) -> Column:
    """What a browser's ``parseFloat`` returns, as a double; null for NaN."""
    m = F.regexp_extract(F.coalesce(_col(c), F.lit("")), JS_NUMBER_PREFIX, 1)
    return F.when(m != "", m.try_cast("double"))


def rate_pct(part, whole) -> Column:
    """``round(part / whole * 100, 2)`` rounding half to even, 0.0 when the
    whole is zero."""
    part, whole = _col(part), _col(whole)
    return F.when(whole > 0, F.bround(part.cast("double") / whole * 100.0, 2)).otherwise(F.lit(0.0))


def record_id(batch_id, page_key, source_url, record_type, table_index, row_index) -> Column:
    """Deterministic record id: SHA-256 over the record's lineage and position."""
    parts = [
        F.coalesce(_col(batch_id).cast("string"), F.lit("")),
        F.coalesce(_col(page_key).cast("string"), F.lit("")),
        F.coalesce(_col(source_url), F.lit("")),
        F.coalesce(_col(record_type), F.lit("")),
        F.coalesce(_col(table_index).cast("string"), F.lit("")),
        F.coalesce(_col(row_index).cast("string"), F.lit("")),
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)
