"""Registered scalar-function keys (``fn_*``, §2.12) with their oracles.

Each applies the function to text or values derived from the driver tables, so
it runs over whole tables like any other query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.functions import clean, rules
from loanlens.functions.exprs import rnd
from loanlens.plans.adapter import Tables
from loanlens.plans.catalog import _REASONS_SQL, Q, register
from loanlens.plans.sqlfrag import rnd as rnd_sql


def _messy(t: Tables):
    """Order-derived text in six shapes: money, 'NaN', blanks, 'XX', 'n.0', junk."""
    o = t.raw("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey") % 6
    txt = (F.when(k == 0, F.col("o_totalprice").cast("decimal(14,2)").cast("string"))
           .when(k == 1, F.lit("NaN")).when(k == 2, F.lit("  ")).when(k == 3, F.lit("XX"))
           .when(k == 4, F.concat((F.col("o_orderkey") % 900).cast("string"), F.lit(".0")))
           .otherwise(F.lit("abc")))
    return o.select("o_orderkey", "o_orderdate", txt.alias("txt"))


_MESSY_SQL = """SELECT o_orderkey, o_orderdate, CASE o_orderkey % 6
  WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) WHEN 1 THEN 'NaN' WHEN 2 THEN '  '
  WHEN 3 THEN 'XX' WHEN 4 THEN CAST(o_orderkey % 900 AS VARCHAR) || '.0' ELSE 'abc' END AS txt FROM orders"""


@register("fn_try_cast", Q("""
SELECT event_id, substring(props, 7, 2) AS txt, TRY_CAST(substring(props, 7, 2) AS INTEGER) AS as_int,
  TRY_CAST(substring(props, 7, 2) AS DECIMAL(6,1)) AS as_dec,
  CASE WHEN isnan(TRY_CAST(substring(props, 7, 2) AS DOUBLE)) THEN NULL ELSE TRY_CAST(substring(props, 7, 2) AS DOUBLE) END AS as_double
FROM events"""))
def _fn_try_cast(t: Tables):
    e = t.raw("events").select("event_id", F.substring("props", 7, 2).alias("txt"))
    return e.select("event_id", "txt", clean.try_cast(F.col("txt"), "int").alias("as_int"),
                    clean.try_cast(F.col("txt"), "decimal(6,1)").alias("as_dec"),
                    clean.try_cast(F.col("txt"), "double").alias("as_double"))


@register("fn_null_tokens", Q("""
SELECT o_orderkey, txt, CASE WHEN trim(txt) IN ('', 'NaN', 'XX') THEN NULL ELSE trim(txt) END AS cleaned,
  CASE WHEN trim(txt) = '' THEN NULL ELSE trim(txt) END AS blank_null FROM m""", {"m": _MESSY_SQL}))
def _fn_null_tokens(t: Tables):
    m = _messy(t)
    return m.select("o_orderkey", "txt", clean.null_tokens("txt").alias("cleaned"),
                    clean.blank_null("txt").alias("blank_null"))


@register("fn_parse_num", Q("""
SELECT o_orderkey, txt, CASE WHEN isnan(v) THEN NULL ELSE v END AS num,
  TRY_CAST(trunc(CASE WHEN isnan(v) THEN NULL ELSE v END) AS INTEGER) AS int_val
FROM (SELECT *, TRY_CAST(CASE WHEN trim(txt) = '' THEN NULL ELSE trim(txt) END AS DOUBLE) AS v FROM m) x""",
                          {"m": _MESSY_SQL}))
def _fn_parse_num(t: Tables):
    m = _messy(t)
    return m.select("o_orderkey", "txt", clean.parse_num("txt").alias("num"), clean.parse_int("txt").alias("int_val"))


def _date_text(t: Tables):
    o = t.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k = F.col("o_orderkey") % 4
    txt = (F.when(k == 0, F.date_format("d", "yyyyMMdd")).when(k == 1, F.date_format("d", "yyyyMM"))
           .when(k == 2, F.lit("20261399")).otherwise(F.lit("abc")))
    per = F.concat(F.month("d").cast("string"), F.year("d").cast("string"))
    return o.select("o_orderkey", txt.alias("txt"), per.alias("period"))


_DATE_TEXT_SQL = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d')
  WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m') WHEN 2 THEN '20261399' ELSE 'abc' END AS txt,
  CAST(month(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR) AS period FROM orders"""


@register("fn_parse_date", Q("""
SELECT o_orderkey, txt, CASE WHEN length(trim(txt)) = 8 THEN CAST(try_strptime(trim(txt), '%Y%m%d') AS DATE)
  WHEN length(trim(txt)) = 6 THEN CAST(try_strptime(trim(txt) || '01', '%Y%m%d') AS DATE) END AS parsed FROM d""",
                           {"d": _DATE_TEXT_SQL}))
def _fn_parse_date(t: Tables):
    d = _date_text(t)
    return d.select("o_orderkey", "txt", clean.parse_date("txt").alias("parsed"))


@register("fn_mmyyyy_date", Q("""
SELECT o_orderkey, period, CAST(try_strptime('01' || lpad(trim(period), 6, '0'), '%d%m%Y') AS DATE) AS period_date,
  TRY_CAST(right(trim(period), 4) AS INTEGER) AS period_year FROM d""", {"d": _DATE_TEXT_SQL}))
def _fn_mmyyyy_date(t: Tables):
    d = _date_text(t)
    return d.select("o_orderkey", "period", clean.mmyyyy_date("period").alias("period_date"),
                    clean.year_from_mmyyyy("period").alias("period_year"))


@register("fn_concat", Q("""
SELECT loan_id, concat(CAST(credit_score AS VARCHAR), ' - ', state_code) AS concat_empty,
  CAST(credit_score AS VARCHAR) || ' - ' || state_code AS concat_null FROM loan_static"""))
def _fn_concat(t: Tables):
    s = t.loan_static
    return s.select("loan_id", clean.concat_null_empty("credit_score", F.lit(" - "), "state_code").alias("concat_empty"),
                    clean.concat_null_wins("credit_score", F.lit(" - "), "state_code").alias("concat_null"))


@register("fn_upper_strip", Q("""
SELECT loan_id, upper(trim('  ' || lower(state_code) || ' ')) AS state_upper, left(state_code, 2) AS state_left,
  substring(state_code, 8, 2) AS state_sub FROM loan_static"""))
def _fn_upper_strip(t: Tables):
    s = t.loan_static
    return s.select("loan_id", clean.upper_strip(F.concat(F.lit("  "), F.lower("state_code"), F.lit(" "))).alias("state_upper"),
                    F.left("state_code", F.lit(2)).alias("state_left"), F.substring("state_code", 8, 2).alias("state_sub"))


@register("fn_regex", Q(r"""
SELECT c_custkey, regexp_replace(CAST(c_custkey AS VARCHAR) || '.0', '\.0+$', '') AS id_text,
  substring(regexp_replace(CAST(c_custkey * 1000 AS VARCHAR) || '.00', '\.0+$', ''), 1, 5) AS zip5,
  CAST(regexp_extract('llmon1_' || CAST(1990 + c_custkey % 30 AS VARCHAR) || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '.txt',
    '^llmon\d?_(\d{6})', 1) AS VARCHAR) AS file_month
FROM customer"""))
def _fn_regex(t: Tables):
    c = t.raw("customer").select("c_custkey")
    name = F.concat(F.lit("llmon1_"), (1990 + F.col("c_custkey") % 30).cast("string"),
                    F.lpad((1 + F.col("c_custkey") % 12).cast("string"), 2, "0"), F.lit(".txt"))
    return c.select("c_custkey",
                    clean.strip_trailing_zero_decimal(F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))).alias("id_text"),
                    clean.zip5(F.concat((F.col("c_custkey") * 1000).cast("string"), F.lit(".00"))).alias("zip5"),
                    F.regexp_extract(name, r"^llmon\d?_(\d{6})", 1).alias("file_month"))


@register("fn_round", Q(f"""
SELECT loan_id, {rnd_sql('CAST(original_principal_balance AS DOUBLE) / 7', 2)} AS r2,
  {rnd_sql('CAST(loan_interest_rate AS DOUBLE) / 3', 3)} AS r3,
  ROUND(original_principal_balance * 0.15, 2) AS dec_round FROM loan_static"""))
def _fn_round(t: Tables):
    s = t.loan_static
    return s.select("loan_id", rnd(F.col("original_principal_balance").cast("double") / 7, 2).alias("r2"),
                    rnd(F.col("loan_interest_rate").cast("double") / 3, 3).alias("r3"),
                    F.round(F.col("original_principal_balance") * F.lit(0.15).cast("decimal(3,2)"), 2)
                    .cast("decimal(18,4)").alias("dec_round"))


@register("fn_age_years", Q("""
SELECT cusip, as_of_date, CAST(EXTRACT(YEAR FROM AGE(loan_maturity_date, first_payment_date)) AS BIGINT) AS age_years,
  (year(loan_maturity_date) - year(first_payment_date)) * 12 + month(loan_maturity_date) - month(first_payment_date) AS age_months
FROM pool_loans"""))
def _fn_age_years(t: Tables):
    p = t.pool_loans
    return p.select("cusip", "as_of_date", clean.age_years("first_payment_date", "loan_maturity_date").alias("age_years"),
                    clean.months_between_whole("loan_maturity_date", "first_payment_date").alias("age_months"))


@register("fn_month_arith", Q("""
SELECT loan_id, report_date, CAST(report_date + INTERVAL 24 MONTH AS DATE) AS plus_24m,
  report_date + 90 AS plus_3x30, report_date - 180 AS minus_6x30 FROM loan_monthly"""))
def _fn_month_arith(t: Tables):
    m = t.loan_monthly
    return m.select("loan_id", "report_date", F.add_months("report_date", 24).alias("plus_24m"),
                    clean.shift_days_months(F.col("report_date"), 3).alias("plus_3x30"),
                    clean.shift_days_months(F.col("report_date"), -6).alias("minus_6x30"))


@register("fn_risk_tier", Q("""
SELECT loan_id, (CASE WHEN credit_score IS NULL THEN 'unknown' WHEN credit_score < 680 THEN '<680'
    WHEN credit_score < 740 THEN '680-739' ELSE '740+' END) || ' / ' ||
  (CASE WHEN ltv IS NULL THEN 'unknown' WHEN ltv <= 90 THEN '<=90' ELSE '>90' END) AS book_tier,
  CASE WHEN credit_score IS NULL OR ltv IS NULL THEN NULL ELSE (CASE WHEN credit_score < 680 THEN '<680'
    WHEN credit_score < 740 THEN '680-739' ELSE '740+' END) || ' / ' || (CASE WHEN ltv <= 90 THEN '<=90' ELSE '>90' END) END AS mix_tier,
  CASE WHEN credit_score < 640 THEN '<640' WHEN credit_score < 680 THEN '640-679' WHEN credit_score < 740 THEN '680-739'
    WHEN credit_score >= 740 THEN '740+' END AS fico_bucket,
  CASE WHEN ltv <= 80 THEN '<=80' WHEN ltv <= 90 THEN '80-90' WHEN ltv <= 95 THEN '90-95' WHEN ltv > 95 THEN '95+' END AS ltv_bucket
FROM loan_static"""))
def _fn_risk_tier(t: Tables):
    s = t.loan_static
    return s.select("loan_id", rules.credit_tier(F.col("credit_score"), F.col("ltv")).alias("book_tier"),
                    rules.credit_tier(F.col("credit_score"), F.col("ltv"), None).alias("mix_tier"),
                    rules.fico_bucket(F.col("credit_score")).alias("fico_bucket"),
                    rules.ltv_bucket(F.col("ltv")).alias("ltv_bucket"))


@register("fn_dq_label", Q("""
SELECT loan_id, report_date, CASE WHEN months_delinquent = 0 THEN 'Current' ELSE 'Delinquent' END AS status,
  CASE WHEN months_delinquent = 0 THEN 'Current' WHEN months_delinquent = 1 THEN '30 Days' WHEN months_delinquent = 2 THEN '60 Days'
    WHEN months_delinquent = 3 THEN '90 Days' WHEN months_delinquent >= 4 THEN '120+ Days' ELSE 'Unknown' END AS bucket
FROM loan_monthly"""))
def _fn_dq_label(t: Tables):
    m = t.loan_monthly
    return m.select("loan_id", "report_date", rules.dq_label(F.col("months_delinquent")).alias("status"),
                    rules.dq_bucket(F.col("months_delinquent")).alias("bucket"))


@register("fn_issuer_group", Q("""
SELECT issuer_id, report_date, n, CASE WHEN n < 2500 THEN 'Very Small' WHEN n < 10000 THEN 'Small'
  WHEN n < 75000 THEN 'Medium' WHEN n < 400000 THEN 'Large' ELSE 'Mega' END AS issuer_group
FROM (SELECT issuer_id, report_date, COUNT(*) * 1000 AS n FROM loan_monthly GROUP BY 1, 2) g"""))
def _fn_issuer_group(t: Tables):
    g = t.loan_monthly.groupBy("issuer_id", "report_date").agg((F.count(F.lit(1)) * 1000).alias("n"))
    return g.withColumn("issuer_group", rules.issuer_group(F.col("n")))


@register("fn_case", Q("""
SELECT loan_id, CASE WHEN first_time_home_buyer IS NULL OR first_time_home_buyer IN ('NaN', 'N') THEN 'Repeat Buyer'
    WHEN first_time_home_buyer = 'Y' THEN 'First Time Buyer' END AS buyer,
  CASE WHEN down_payment_assistance IS NULL OR down_payment_assistance IN ('NaN', 'N') THEN 'No Assistance'
    WHEN down_payment_assistance = 'Y' THEN 'Received Assistance' END AS assistance,
  CASE WHEN agency = 'F' THEN 'FHA' WHEN agency = 'V' THEN 'VA' WHEN agency = 'R' THEN 'RD' ELSE 'PIH' END AS insurer_tsql,
  CASE WHEN agency = 'F' THEN 'FHA' WHEN agency = 'V' THEN 'VA' WHEN agency = 'R' THEN 'RD' ELSE agency END AS insurer_pg
FROM loan_static"""))
def _fn_case(t: Tables):
    s = t.loan_static
    return s.select("loan_id", rules.buyer_label(F.col("first_time_home_buyer")).alias("buyer"),
                    rules.assistance_label(F.col("down_payment_assistance")).alias("assistance"),
                    rules.insurer_label(F.col("agency")).alias("insurer_tsql"),
                    rules.insurer_label(F.col("agency"), "pg").alias("insurer_pg"))


@register("fn_coalesce", Q("""
SELECT cusip, as_of_date, COALESCE(removal_reason, 0) AS reason_or_zero, NULLIF(msa, '') AS msa_or_null,
  COALESCE(NULLIF(msa, ''), 'none') AS msa_label FROM pool_loans"""))
def _fn_coalesce(t: Tables):
    p = t.pool_loans
    return p.select("cusip", "as_of_date", F.coalesce("removal_reason", F.lit(0)).alias("reason_or_zero"),
                    F.nullif(F.col("msa"), F.lit("")).alias("msa_or_null"),
                    F.coalesce(F.nullif(F.col("msa"), F.lit("")), F.lit("none")).alias("msa_label"))


@register("fn_cast", Q("""
SELECT loan_id, CAST(original_principal_balance AS DOUBLE) AS opb_double, CAST(ltv AS SMALLINT) AS ltv_small,
  CAST(loan_interest_rate AS DECIMAL(5,2)) AS rate_5_2 FROM loan_static"""))
def _fn_cast(t: Tables):
    s = t.loan_static
    return s.select("loan_id", F.col("original_principal_balance").cast("double").alias("opb_double"),
                    F.col("ltv").cast("smallint").alias("ltv_small"),
                    F.col("loan_interest_rate").cast("decimal(5,2)").alias("rate_5_2"))


@register("fn_label_lookup", Q("""
SELECT g.removal_reason, COALESCE(r.removal_label, 'Code ' || CAST(g.removal_reason AS VARCHAR)) AS label
FROM (SELECT DISTINCT removal_reason FROM pool_loans WHERE removal_reason IS NOT NULL) g
LEFT JOIN reasons r ON r.removal_code = g.removal_reason""", {"reasons": _REASONS_SQL}))
def _fn_label_lookup(t: Tables):
    g = t.pool_loans.select("removal_reason").filter(F.col("removal_reason").isNotNull()).distinct()
    r = rules.removal_reason_table(t.spark)
    j = g.join(F.broadcast(r), g.removal_reason == r.removal_code, "left")
    return j.select("removal_reason", F.coalesce("removal_label", F.concat(F.lit("Code "), F.col("removal_reason").cast("string")))
                    .alias("label"))
