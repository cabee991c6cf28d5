"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.exprs import clean_double


def project_loan_state(static: DataFrame) -> DataFrame:
    """Plain projection: loan, issuer, state."""
    return static.select("loan_id", "issuer_id", "state_code")


def upcoming_maturities(pool_loans: DataFrame, issuers: DataFrame, *, as_of, months: int = 24,
                        n: int = 20) -> DataFrame:
    """Loans maturing between ``as_of`` and ``as_of`` + ``months``, with the issuer name; the earliest ``n``."""
    start = F.lit(as_of).cast("date") if not isinstance(as_of, F.Column) else as_of
    p = pool_loans.filter(F.col("loan_maturity_date").between(start, F.add_months(start, months)))
    j = p.join(issuers.select("issuer_number", "issuer_name"), "issuer_number")
    out = j.select("issuer_name", "cusip", "property_state", "loan_maturity_date", "unpaid_principal_balance",
                   "months_delinquent")
    return out.orderBy("loan_maturity_date", "cusip", "issuer_name").limit(n)


def latest_snapshot(df: DataFrame, date_col: str = "report_date") -> DataFrame:
    """Rows whose date equals the table's maximum date (uncorrelated scalar subquery)."""
    return df.filter(F.col(date_col) == df.agg(F.max(date_col)).scalar())


def not_blank_filter(df: DataFrame, c: str = "msa") -> DataFrame:
    return df.filter(F.col(c).isNotNull() & (F.col(c) != ""))


def exclude_vintages(df: DataFrame, years=(2005, 2006, 2007), year_col: str = "orig_year") -> DataFrame:
    """Drop origination years in ``years``; a null year is kept (pandas ``~isin`` semantics)."""
    return df.filter(~F.col(year_col).isin(list(years)) | F.col(year_col).isNull())


def seasoned_active_filter(df: DataFrame, *, upb: str = "upb", status: str = "dq_status", age: str = "loan_age",
                           min_age: int = 24) -> DataFrame:
    """UPB > 0, status known, age >= ``min_age`` months (text columns through try_cast)."""
    return df.filter((clean_double(F.col(upb).cast("string")) > 0) & F.col(status).isNotNull()
                     & (clean_double(F.col(age).cast("string")) >= min_age))


def dropna_subset(df: DataFrame, cols) -> DataFrame:
    """Complete cases over ``cols``; NaN counts as missing (pandas semantics)."""
    cond = None
    for c in cols:
        t = dict(df.dtypes)[c]
        ok = F.col(c).isNotNull()
        if t in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def period_slice(df: DataFrame, start=None, end=None, date_col: str = "report_date") -> DataFrame:
    """Inclusive slice ``start <= date <= end``; either end may be open (None)."""
    c = F.col(date_col)
    if start is not None:
        df = df.filter(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(c <= F.lit(end).cast("date"))
    return df
