"""Scalar column helpers (all JVM-side expressions, no UDFs)."""

from medalloy.functions.casts import cast_error, strict_double, strict_int, strict_long, strict_number_string
from medalloy.functions.dates import (
    date_key,
    date_from_key,
    month_end_from_yyyymm,
    month_ordinal,
    quarter_end,
    quarter_ordinal,
    safe_date,
)
from medalloy.functions.hashing import row_hash
from medalloy.functions.text import normalise_name, sentinel_number, strip_ansi

__all__ = [
    "cast_error", "strict_double", "strict_int", "strict_long", "strict_number_string",
    "date_key", "date_from_key", "month_end_from_yyyymm", "month_ordinal", "quarter_end",
    "quarter_ordinal", "safe_date", "row_hash", "normalise_name", "sentinel_number", "strip_ansi",
]
