"""ANSI-safe typing of all-string columns.

Spark 4 runs with ANSI on: ``cast('.' as double)`` raises. The reference expects
null from a failed cast, so every cast here is a ``try_cast`` behind a strict
numeric pattern (``try_cast('1d' as double)`` is 1.0 in Spark, so the pattern
also rejects Java float suffixes, NaN and Infinity).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted numeric text form (optional sign, digits with an
# optional fraction, optional exponent), surrounding blanks allowed.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strict_number_string(col) -> Column:
    """The trimmed text when it is a plain decimal number, else null."""
    c = _c(col)
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c))


def finite(d: Column) -> Column:
    """NULL for ±Infinity (text like ``1e400`` overflows the double range)."""
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def strict_double(col) -> Column:
    """Text → DOUBLE; null for blank, malformed, NaN or out-of-range input (the pattern
    already rejects NaN/Infinity spellings)."""
    return finite(strict_number_string(col).try_cast("double"))


def strict_long(col) -> Column:
    """Text → BIGINT via double and half-up rounding (sources write ``'529900.0'``)."""
    return F.round(strict_double(col)).try_cast("long")


def strict_int(col) -> Column:
    return F.round(strict_double(col)).try_cast("int")


def cast_error(raw, typed) -> Column:
    """True when a reported (non-null, non-blank) value failed to type."""
    r = _c(raw)
    return r.isNotNull() & (F.trim(r) != F.lit("")) & _c(typed).isNull()
