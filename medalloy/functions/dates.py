"""Date keys and period arithmetic as Spark expressions (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_date(text, fmt: str = "yyyy-MM-dd") -> Column:
    """``try_to_date``: a malformed or impossible date gives null instead of raising."""
    return F.try_to_date(_c(text), fmt)


def date_key(d) -> Column:
    """DATE → INT ``yyyymmdd``."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_from_key(key) -> Column:
    return safe_date(_c(key).cast("string"), "yyyyMMdd")


def month_end_from_yyyymm(text) -> Column:
    """``'202401'`` → 2024-01-31; anything but six digits of a real month → null."""
    t = F.trim(_c(text).cast("string"))
    return F.last_day(F.when(t.rlike(r"^[0-9]{6}$"), safe_date(F.concat(t, F.lit("01")), "yyyyMMdd")))


def quarter_end(year, quarter) -> Column:
    """(year, quarter 1..4) → last day of the quarter; other quarters → null."""
    y, q = _c(year).cast("int"), _c(quarter).cast("int")
    first = F.when(
        q.between(1, 4) & y.between(1, 9999),
        safe_date(F.format_string("%04d-%02d-01", y, q * 3), "yyyy-MM-dd"),
    )
    return F.last_day(first)


def month_ordinal(d) -> Column:
    d = _c(d)
    return (F.year(d) * 12 + F.month(d)).cast("int")


def quarter_ordinal(d) -> Column:
    d = _c(d)
    return (F.year(d) * 4 + F.quarter(d)).cast("int")


def month_end_of(year, month) -> Column:
    """(year, month 1..12) → month-end DATE; other months → null."""
    y, m = _c(year).cast("int"), _c(month).cast("int")
    return F.last_day(F.when(m.between(1, 12) & y.between(1, 9999),
                             safe_date(F.format_string("%04d-%02d-01", y, m), "yyyy-MM-dd")))


def period_date(frequency, year, period) -> Column:
    """Price-index period → period-end DATE, by frequency (T6): 'quarterly' uses periods 1–4,
    'monthly' 1–12; an unknown frequency or an out-of-range period gives null (so a monthly
    period 12 can never reach the quarterly formula)."""
    f = F.lower(F.trim(_c(frequency)))
    return (F.when(f == "quarterly", quarter_end(year, period))
             .when(f == "monthly", month_end_of(year, period)))
