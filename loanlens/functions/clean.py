"""Scalar cleaning and parsing functions (column expressions, JVM-side).

The reference reads every file as text; these turn text into typed values the
tolerant way it does: bad input becomes null instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens that mean "missing".
NULL_TOKENS = ("", "NaN", "XX")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_null(c) -> Column:
    """trim, blank -> null."""
    t = F.trim(_c(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def null_tokens(c, tokens=NULL_TOKENS) -> Column:
    """trim; the missing-value tokens ('', 'NaN', 'XX') -> null."""
    t = F.trim(_c(c))
    return F.when(t.isin(list(tokens)), F.lit(None).cast("string")).otherwise(t)


def try_cast(c, to: str) -> Column:
    """TRY_CAST; for float/double, NaN becomes null as well."""
    v = _c(c).try_cast(to)
    if to in ("double", "float"):
        v = F.when(F.isnan(v), F.lit(None).cast(to)).otherwise(v)
    return v


def parse_num(c) -> Column:
    """Number through double, bad or NaN -> null."""
    return try_cast(blank_null(c), "double")


def parse_int(c) -> Column:
    """Integer through double (so '620.0' -> 620, truncating); bad -> null."""
    return parse_num(c).try_cast("int")


def parse_date(c) -> Column:
    """8 characters ``yyyyMMdd`` -> that date; 6 characters ``yyyyMM`` -> the 1st of the month; else null."""
    t = blank_null(c)
    d8 = F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("date")
    d6 = F.try_to_timestamp(F.concat(t, F.lit("01")), F.lit("yyyyMMdd")).cast("date")
    return F.when(F.length(t) == 8, d8).when(F.length(t) == 6, d6)


def mmyyyy_date(c) -> Column:
    """Period text ``MMYYYY`` (leading zero optional) -> first day of that month."""
    t = F.lpad(F.trim(_c(c)), 6, "0")
    return F.try_to_timestamp(F.concat(F.lit("01"), t), F.lit("ddMMyyyy")).cast("date")


def year_from_mmyyyy(c) -> Column:
    """Year of an ``MMYYYY`` text: ``RIGHT(TRIM(x), 4)`` as int."""
    return F.right(F.trim(_c(c)), F.lit(4)).try_cast("int")


def concat_null_empty(*cols) -> Column:
    """``CONCAT`` of T-SQL: null parts read as empty."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def concat_null_wins(*cols) -> Column:
    """``||``: any null part makes the result null."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def upper_strip(c) -> Column:
    return F.upper(F.trim(_c(c)))


def strip_trailing_zero_decimal(c) -> Column:
    """'12345.0' -> '12345' (text ids read through a float)."""
    return F.regexp_replace(_c(c), r"\.0+$", "")


def zip5(c) -> Column:
    return F.substring(strip_trailing_zero_decimal(c), 1, 5)


def age_years(start, end) -> Column:
    """Whole years from ``start`` to ``end`` (day of month respected)."""
    return F.timestamp_diff("YEAR", _c(start).cast("timestamp"), _c(end).cast("timestamp"))


def months_between_whole(end, start) -> Column:
    """Whole calendar months from ``start`` to ``end``."""
    e, s = _c(end), _c(start)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def shift_days_months(d, months: int) -> Column:
    """The reference's window bounds: a date moved by ``30 x months`` days."""
    return F.date_add(_c(d), 30 * months)
