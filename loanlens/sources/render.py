"""Render loan tables as disclosure-file staging strings and landed pipe files.

The driver data has no text files, so the text sources are exercised on files
that Spark writes from the driver tables: every field a string, blanks for
missing values, one folder per report month named like the disclosure files
(``_file=llmon1_YYYYMM``).  Landed files live in the shared checkpoint folder,
written once per input fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.clean import blank_null
from loanlens.sources.layouts import FNMA_FIELDS, LL_FIELDS, LR_FIELDS, M_FIELDS


def _s(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def _joined(monthly: DataFrame, static: DataFrame | None) -> DataFrame:
    """Loan-months (m) with their static loans (t); without ``static`` the months are stored joined (``reports.joined_loan_months``)."""
    if static is None:
        return monthly.filter(F.col("t2").isNotNull()).select("t", F.col("t2").alias("m"))
    return monthly.alias("m").join(static.alias("t"), F.col("m.loan_id") == F.col("t.loan_id"))


def ll_staging(monthly: DataFrame, static: DataFrame | None, deal=None) -> DataFrame:
    """LL staging rows (55 string fields) from loan-months (m) joined to static loans (t); blank fields are null.

    ``deal`` shuffles the joined rows, which are narrower than what is made of them.  Without ``static`` the months come joined.
    """
    j = _joined(monthly, static)
    j = deal(j) if deal else j
    lid = F.col("m.loan_id")
    msa = F.when(lid % 7 == 0, F.lit("")).when(lid % 7 == 1, F.lit(None)).otherwise((10000 + lid % 50).cast("string"))
    rd, od = F.col("m.report_date"), F.col("t.loan_origination_date")
    age = (F.year(rd) - F.year(od)) * 12 + F.month(rd) - F.month(od)
    vals = {
        "record_type": F.lit("LL"), "cusip_number": F.concat(F.lit("36"), lid.cast("string")),
        "disclosure_sequence_number": lid, "issuer_id": F.col("m.issuer_id"), "agency": F.col("t.agency"),
        "loan_interest_rate": F.col("t.loan_interest_rate"),
        "original_principal_balance": F.col("t.original_principal_balance"),
        "unpaid_principal_balance": F.col("m.unpaid_principal_balance"), "loan_age": age,
        "months_delinquent": F.col("m.months_delinquent"), "loan_to_value": F.col("t.ltv"),
        "credit_score": F.col("t.credit_score"), "down_payment_assistance": F.col("t.down_payment_assistance"),
        "first_time_home_buyer": F.col("t.first_time_home_buyer"), "state_code": F.col("t.state_code"), "msa": msa,
        "current_month_liquidation_flag": F.col("m.current_month_liquidation"),
        "removal_reason": F.col("m.removal_reason"), "as_of_date": F.date_format(rd, "yyyyMM"),
        "loan_origination_date": F.date_format(od, "yyyyMMdd"), "seller_issuer_id": F.col("t.issuer_id"),
    }
    cols = [blank_null(_s(vals[f])).alias(f) if f in vals else F.lit(None).cast("string").alias(f) for f in LL_FIELDS]
    return j.select(*cols, F.concat(F.lit("llmon1_"), F.date_format(rd, "yyyyMM")).alias("_file"))


def lr_staging(monthly: DataFrame, static: DataFrame | None, deal=None) -> DataFrame:
    """LR staging rows (15 string fields) for liquidated loan-months (m); ``deal`` and no ``static`` as in ``ll_staging``."""
    flag = "current_month_liquidation" if static is not None else "t2.current_month_liquidation"
    j = _joined(monthly.filter(F.col(flag) == "Y"), static)
    j = deal(j) if deal else j
    lid, rd = F.col("m.loan_id"), F.col("m.report_date")
    vals = {
        "record_type": F.lit("LR"), "cusip_number": F.concat(F.lit("36"), lid.cast("string")),
        "pool_id": F.concat(F.lit("P"), (lid % 1000).cast("string")), "disclosure_sequence_number": lid,
        "issuer_id": F.col("m.issuer_id"), "report_period": F.date_format(rd, "yyyyMM"),
        "agency_type": F.col("t.agency"), "loan_purpose": F.lit("1"),
        "original_principal_balance": F.col("t.original_principal_balance"),
        "unpaid_principal_balance": F.col("m.unpaid_principal_balance"),
        "liquidation_balance": F.col("m.unpaid_principal_balance"), "removal_reason": F.col("m.removal_reason"),
    }
    cols = [blank_null(_s(vals[f])).alias(f) if f in vals else F.lit(None).cast("string").alias(f) for f in LR_FIELDS]
    return j.select(*cols, F.concat(F.lit("llmonliq1_"), F.date_format(rd, "yyyyMM")).alias("_file"))


def m_staging(pool_loans: DataFrame, issuer_info: DataFrame, deal=None) -> DataFrame:
    """Multifamily 'M' staging rows (76 string fields) from pool snapshots (p); ``deal`` as in ``ll_staging``."""
    p = pool_loans.alias("p")
    j = p.join(issuer_info.alias("i"), F.col("p.issuer_number") == F.col("i.issuer_number"), "left")
    j = deal(j) if deal else j
    lid = F.col("p.cusip")
    fp, mt = F.col("p.first_payment_date"), F.col("p.loan_maturity_date")
    vals = {
        "record_type_indicator": F.lit("M"), "cusip_number": F.concat(F.lit("36"), lid.cast("string")),
        "pool_number": F.concat(F.lit("P"), (lid % 1000).cast("string")), "issuer_number": F.col("p.issuer_number"),
        "issuer_name": F.col("i.issuer_name"), "issuer_state": F.col("i.citystate"),
        "security_interest_rate": F.col("p.loan_interest_rate"), "disclosure_sequence_number": lid,
        "first_payment_date": F.date_format(fp, "yyyyMMdd"),
        "maturity_date_of_loan": F.when(lid % 11 == 0, F.lit("2026XX01")).otherwise(F.date_format(mt, "yyyyMMdd")),
        "loan_interest_rate": F.col("p.loan_interest_rate"),
        "original_principal_balance": F.col("p.original_principal_balance"),
        "unpaid_principal_balance": F.col("p.unpaid_principal_balance"),
        "months_delinquent": F.col("p.months_delinquent"),
        "current_month_liquidation_flag": F.col("p.current_month_liquidation"),
        "removal_reason": F.col("p.removal_reason"), "seller_issuer_id": F.col("p.issuer_number"),
        "property_name": F.concat(F.lit("Property "), lid.cast("string")), "property_state": F.col("p.property_state"),
        "property_zip": F.concat((10000 + lid % 89999).cast("string"), F.lit("1234.0")),
        "msa": F.when(F.col("p.msa") != "", F.concat(F.col("p.msa"), F.lit(".0"))),
        "insurance_type": F.lit("FHA"), "security_rpb": F.col("p.unpaid_principal_balance"),
        "pre_payment_penalty_flag": F.when(lid % 2 == 0, "Y").otherwise("N"),
        "as_of_date": F.col("p.as_of_date"), "green_status": F.lit("N"), "affordable_status": F.lit("Y"),
    }
    cols = [blank_null(_s(vals[f])).alias(f) if f in vals else F.lit(None).cast("string").alias(f) for f in M_FIELDS]
    return j.select(*cols)


def fnma_staging(perf: DataFrame) -> DataFrame:
    """Second-agency performance staging (50 string fields) from the loan-month performance view."""
    rd = F.col("reporting_date")
    vals = {
        "reference_pool_id": F.lit("R1"), "loan_identifier": F.col("loan_id"),
        "monthly_reporting_period": F.concat(F.month(rd).cast("string"), F.year(rd).cast("string")),
        "servicer_name": F.concat(F.lit("Servicer "), (F.col("loan_id") % 7).cast("string")),
        "current_interest_rate": F.col("interest_rate"), "current_actual_upb": F.col("upb"),
        "loan_age": F.col("loan_age"), "remaining_months_to_maturity": (360 - F.col("loan_age")),
        "current_loan_delinquency_status": F.when(F.col("dq_status") >= 6, F.lit("XX")).otherwise(F.col("dq_status")),
        "property_state": F.col("property_state"),
        "origination_date": F.concat(F.lit("01"), F.col("orig_year").cast("string")),
        "borrower_credit_score_at_origination": F.col("credit_score"), "original_upb": F.col("upb"),
    }
    return perf.select(*[blank_null(_s(vals[f])).alias(f) if f in vals else F.lit(None).cast("string").alias(f)
                         for f in FNMA_FIELDS])


def to_lines(staging: DataFrame, fields) -> DataFrame:
    """One ``|``-joined text line per staging row (nulls as empty fields), keeping ``_file``."""
    line = F.concat_ws("|", *[F.coalesce(F.col(f), F.lit("")) for f in fields])
    keep = ["_file"] if "_file" in staging.columns else []
    return staging.select(line.alias("value"), *keep)
