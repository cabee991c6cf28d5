"""Registered queries: one per operator key, each with its DuckDB oracle SQL.

``QUERIES[key] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``.  Every
query reads the driver tables of ``sf_dir`` through the adapter views and runs
over the whole tables.  The oracle strings run in DuckDB on the same Parquet
files with the adapter views inlined as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions import rules
from loanlens.operators import filters, joins, reports, topk
from loanlens.plans.adapter import Tables
from loanlens.plans.sqlfrag import avg_d, cnt_if, money, pct, ratio, rnd
from loanlens.plans.views_sql import with_views
from loanlens.session import cut

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}

# Parameters of the adapter world (driver dates run 1995-01 .. 2001-11).
STATE = "NATION_7"
STATES = ["NATION_3", "NATION_7", "NATION_11"]
AS_OF = "1998-06-01"
TRAIN_END = "1999-12-01"
SHOCK_PRE = "1997-12-01"
SHOCK_WINDOW = ("1998-01-01", "1999-12-01")
EXCLUDE = (1997,)
TREND_MONTHS = ("2001-07-01", "2001-08-01")
UPB = "unpaid_principal_balance"


def register(key: str, sql: str | None):
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[key] = (lambda spark, sf_dir: fn(Tables(spark, sf_dir)), sql)
        return fn
    return deco


def Q(body: str, extra: dict[str, str] | None = None) -> str:
    return with_views(body, extra)


# ---------------------------------------------------------------------------------
# §2.5 aggregate reports
# ---------------------------------------------------------------------------------

PU = "p.unpaid_principal_balance"


@register("issuer_concentration", Q(f"""
SELECT i.issuer_name, COUNT(*) AS pool_count, {money(PU)} AS total_upb,
  {pct(f'SUM({PU})', '(SELECT SUM(unpaid_principal_balance) FROM pool_loans)')} AS pct_of_total_upb
FROM pool_loans p JOIN issuers i ON p.issuer_number = i.issuer_number
GROUP BY i.issuer_name ORDER BY total_upb DESC, i.issuer_name LIMIT 15"""))
def _issuer_concentration(t: Tables):
    return reports.issuer_concentration(t.pool_loans, t.issuers)


@register("geo_concentration", Q(f"""
SELECT property_state, COUNT(*) AS loan_count, {money(UPB)} AS total_upb,
  {pct(f'SUM({UPB})', '(SELECT SUM(unpaid_principal_balance) FROM pool_loans)')} AS pct_of_total_upb,
  {cnt_if('months_delinquent > 0')} AS delinquent_loans,
  {pct(cnt_if('months_delinquent > 0'), 'COUNT(*)')} AS delinquency_rate
FROM pool_loans GROUP BY property_state ORDER BY total_upb DESC, property_state LIMIT 15"""))
def _geo_concentration(t: Tables):
    return reports.geo_concentration(t.pool_loans)


_BUCKET = """CASE WHEN months_delinquent = 0 THEN 'Current' WHEN months_delinquent = 1 THEN '30 Days'
  WHEN months_delinquent = 2 THEN '60 Days' WHEN months_delinquent = 3 THEN '90 Days'
  WHEN months_delinquent >= 4 THEN '120+ Days' ELSE 'Unknown' END"""


@register("dq_buckets", Q(f"""
SELECT {_BUCKET} AS delinquency_bucket, COUNT(*) AS loan_count, {money(UPB)} AS total_upb,
  {pct(f'SUM({UPB})', '(SELECT SUM(unpaid_principal_balance) FROM pool_loans)')} AS pct_of_upb
FROM pool_loans GROUP BY 1 ORDER BY MIN(months_delinquent)"""))
def _dq_buckets(t: Tables):
    return reports.dq_buckets(t.pool_loans)


@register("issuer_dq", Q(f"""
SELECT i.issuer_name, COUNT(*) AS pool_count, {money(PU)} AS total_upb,
  {cnt_if('p.months_delinquent > 0')} AS delinquent_loans,
  {pct(cnt_if('p.months_delinquent > 0'), 'COUNT(*)')} AS delinquency_rate,
  CAST(SUM(CASE WHEN p.months_delinquent >= 3 THEN {PU} ELSE 0 END) AS DECIMAL(38,2)) AS serious_dq_upb
FROM pool_loans p JOIN issuers i ON p.issuer_number = i.issuer_number
GROUP BY i.issuer_name HAVING COUNT(*) >= 10 ORDER BY delinquency_rate DESC, i.issuer_name LIMIT 15"""))
def _issuer_dq(t: Tables):
    return reports.issuer_dq(t.pool_loans, t.issuers)


@register("issuer_state_share", Q(f"""
SELECT i.issuer_name, p.property_state AS top_state, COUNT(*) AS loans_in_state, {money(PU)} AS state_upb,
  {pct('COUNT(*)', '(SELECT COUNT(*) FROM pool_loans p2 WHERE p2.issuer_number = p.issuer_number)')} AS pct_of_issuer_portfolio
FROM pool_loans p JOIN issuers i ON p.issuer_number = i.issuer_number
GROUP BY i.issuer_name, p.property_state, p.issuer_number HAVING COUNT(*) >= 5
ORDER BY pct_of_issuer_portfolio DESC, i.issuer_name, top_state, loans_in_state DESC LIMIT 20"""))
def _issuer_state_share(t: Tables):
    return reports.issuer_state_share(t.pool_loans, t.issuers)


@register("pool_type_mix", Q(f"""
SELECT pool_type, COUNT(*) AS pool_count, {money(UPB)} AS total_upb,
  {rnd(avg_d('loan_interest_rate'), 3)} AS avg_interest_rate,
  {rnd(avg_d('EXTRACT(YEAR FROM AGE(loan_maturity_date, first_payment_date))'), 1)} AS avg_term_years,
  {cnt_if('months_delinquent > 0')} AS delinquent_count
FROM pool_loans GROUP BY pool_type ORDER BY total_upb DESC"""))
def _pool_type_mix(t: Tables):
    return reports.pool_type_mix(t.pool_loans)


@register("state_exposure_what_if", Q(f"""
SELECT '{STATE} Exposure' AS scenario, COUNT(*) AS total_loans, {money(UPB)} AS total_upb,
  {pct(f'SUM({UPB})', '(SELECT SUM(unpaid_principal_balance) FROM pool_loans)')} AS pct_of_portfolio,
  {cnt_if('months_delinquent > 0')} AS currently_delinquent,
  CAST(ROUND(SUM({UPB}) * 0.15, 2) AS DECIMAL(38,2)) AS projected_loss_15pct_severity,
  CAST(ROUND(SUM({UPB}) * 0.25, 2) AS DECIMAL(38,2)) AS projected_loss_25pct_severity
FROM pool_loans WHERE property_state = '{STATE}'"""))
def _state_exposure_what_if(t: Tables):
    return reports.state_exposure_what_if(t.pool_loans, state=STATE)


_EXPOSURE = f"""COUNT(*) AS total_loans, CAST(COALESCE(SUM({UPB}), 0) AS DECIMAL(38,2)) AS total_upb,
  CAST(COALESCE(SUM(CASE WHEN months_delinquent > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS current_dq_loans,
  CAST(COALESCE(SUM(CASE WHEN months_delinquent > 0 THEN {UPB} ELSE 0 END), 0) AS DECIMAL(38,2)) AS current_dq_upb"""


@register("portfolio_exposure", Q(f"SELECT property_state AS state, {_EXPOSURE} FROM pool_loans GROUP BY property_state"))
def _portfolio_exposure(t: Tables):
    return reports.portfolio_exposure(t.pool_loans, by_state=True)


@register("top_issuers_in_state", Q(f"""
SELECT * FROM (SELECT property_state, issuer_name, loan_count, issuer_upb,
  row_number() OVER (PARTITION BY property_state ORDER BY issuer_upb DESC, issuer_name) AS rank
  FROM (SELECT p.property_state, i.issuer_name, COUNT(*) AS loan_count, {money(PU)} AS issuer_upb
        FROM pool_loans p JOIN issuers i ON p.issuer_number = i.issuer_number
        GROUP BY p.property_state, i.issuer_name) g) r WHERE rank <= 5"""))
def _top_issuers_in_state(t: Tables):
    return reports.top_issuers_in_state(t.pool_loans, t.issuers)


@register("top_msas_in_state", Q(f"""
SELECT * FROM (SELECT property_state, msa, loan_count, msa_upb,
  row_number() OVER (PARTITION BY property_state ORDER BY msa_upb DESC, msa) AS rank
  FROM (SELECT property_state, msa, COUNT(*) AS loan_count, {money(UPB)} AS msa_upb
        FROM pool_loans WHERE msa IS NOT NULL AND msa != '' GROUP BY property_state, msa) g) r WHERE rank <= 5"""))
def _top_msas_in_state(t: Tables):
    return reports.top_msas_in_state(t.pool_loans)


def _snapshot_sql(where: str = "", group: str = "") -> str:
    sel = "property_state AS state, " if group else ""
    inner = f"""SELECT {sel}COUNT(*) AS total, {cnt_if('months_delinquent = 0')} AS current,
  {cnt_if('months_delinquent = 1')} AS dq_30, {cnt_if('months_delinquent = 2')} AS dq_60,
  {cnt_if('months_delinquent = 3')} AS dq_90, {cnt_if('months_delinquent >= 4')} AS dq_120plus,
  {money(UPB)} AS total_upb FROM pool_loans {where} {group}"""
    shares = ", ".join(f"{pct(c, 'total')} AS {c}_pct" for c in ["current", "dq_30", "dq_60", "dq_90", "dq_120plus"])
    return Q(f"SELECT *, {shares}, {pct('total - current', 'total')} AS overall_dq_rate FROM ({inner}) s")


@register("dq_snapshot", _snapshot_sql(group="GROUP BY property_state"))
def _dq_snapshot(t: Tables):
    return reports.dq_snapshot(t.pool_loans, by_state=True)


@register("dq_snapshot_state", _snapshot_sql(where=f"WHERE property_state = '{STATE}'"))
def _dq_snapshot_state(t: Tables):
    return reports.dq_snapshot(t.pool_loans, state=STATE)


@register("dq_by_month", Q(f"""
SELECT property_state, as_of_date, COUNT(*) AS total_loans, {cnt_if('months_delinquent > 0')} AS dq_loans,
  CAST(COALESCE(SUM({UPB}), 0) AS DECIMAL(38,2)) AS total_upb,
  CAST(COALESCE(SUM(CASE WHEN months_delinquent > 0 THEN {UPB} ELSE 0 END), 0) AS DECIMAL(38,2)) AS dq_upb,
  {pct(cnt_if('months_delinquent > 0'), 'COUNT(*)', 4)} AS dq_rate
FROM pool_loans GROUP BY property_state, as_of_date"""))
def _dq_by_month(t: Tables):
    return reports.dq_by_month(t.pool_loans)


@register("state_dq_baseline", Q(f"""
SELECT property_state, COUNT(*) AS total, {cnt_if('months_delinquent > 0')} AS dq,
  {pct(cnt_if('months_delinquent > 0'), 'COUNT(*)', 4)} AS dq_rate
FROM pool_loans GROUP BY property_state HAVING COUNT(*) >= 10 ORDER BY dq_rate DESC"""))
def _state_dq_baseline(t: Tables):
    return reports.state_dq_baseline(t.pool_loans)


_REASONS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({k}, '{v}')" for k, v in rules.REMOVAL_REASONS.items()) + ") AS r(removal_code, removal_label)"


@register("removal_breakdown", Q(f"""
SELECT g.removal_reason AS removal_code, COALESCE(r.removal_label, 'Code ' || CAST(g.removal_reason AS VARCHAR)) AS removal_reason,
  loan_count, total_original_balance, total_upb_at_removal, avg_original_balance, avg_upb_at_removal
FROM (SELECT removal_reason, COUNT(*) AS loan_count, {money('original_principal_balance')} AS total_original_balance,
  {money(UPB)} AS total_upb_at_removal, {avg_d('original_principal_balance')} AS avg_original_balance,
  {avg_d(UPB)} AS avg_upb_at_removal
  FROM pool_loans WHERE removal_reason IS NOT NULL AND removal_reason > 0 GROUP BY removal_reason) g
LEFT JOIN reasons r ON r.removal_code = g.removal_reason ORDER BY 1""", {"reasons": _REASONS_SQL}))
def _removal_breakdown(t: Tables):
    return reports.removal_breakdown(t.pool_loans, rules.removal_reason_table(t.spark))


@register("available_months", Q("""
SELECT DISTINCT as_of_date, (SELECT COUNT(DISTINCT as_of_date) FROM pool_loans) AS month_count
FROM pool_loans ORDER BY as_of_date"""))
def _available_months(t: Tables):
    return reports.available_months(t.pool_loans)


_AGE = "((year(t2.report_date) - year(t.loan_origination_date)) * 12 + month(t2.report_date) - month(t.loan_origination_date))"


@register("issuer_level", Q(f"""
SELECT t2.issuer_id, {rnd(avg_d(_AGE), 0)} AS average_loan_seasoning, {rnd(avg_d('t2.' + UPB), 2)} AS average_upb,
  {money('t2.' + UPB)} AS total_upb, {rnd(avg_d('t.loan_interest_rate'), 2)} AS average_interest_rate,
  {rnd(avg_d('t.credit_score'), 0)} AS average_credit_score,
  {cnt_if('t2.months_delinquent = 0')} AS current_loans, {cnt_if('t2.months_delinquent <> 0')} AS delinquent_loans,
  ({ratio(cnt_if('t2.months_delinquent <> 0'), 'COUNT(*)')} * 100) AS delinquency_pct,
  t2.report_date AS reporting_date
FROM loan_monthly t2 JOIN loan_static t ON t.loan_id = t2.loan_id GROUP BY t2.issuer_id, t2.report_date"""))
def _issuer_level(t: Tables):
    return reports.issuer_level(None, t.loan_months)


@register("state_level", Q(f"""
SELECT t.state_code, {rnd(avg_d(_AGE), 0)} AS average_loan_seasoning, {rnd(avg_d('t2.' + UPB), 2)} AS average_upb,
  {money('t2.' + UPB)} AS total_upb, {rnd(avg_d('t.loan_interest_rate'), 2)} AS average_interest_rate,
  {rnd(avg_d('t.credit_score'), 0)} AS average_credit_score,
  {cnt_if('t2.months_delinquent = 0')} AS current_loans, {cnt_if('t2.months_delinquent <> 0')} AS delinquent_loans,
  {pct(cnt_if('t2.months_delinquent <> 0'), 'COUNT(t2.loan_id)')} AS delinquency_pct,
  t2.report_date AS reporting_date
FROM loan_static t LEFT JOIN loan_monthly t2 ON t2.loan_id = t.loan_id GROUP BY t.state_code, t2.report_date"""))
def _state_level(t: Tables):
    return reports.state_level(None, t.loan_months)


def _agency_share_sql(agency: str, p: str) -> str:
    a = f"t.agency = '{agency}'"
    return f"""SELECT t.state_code AS state, COUNT(*) AS state_loans, {cnt_if(a)} AS {p}_loans,
  CAST(SUM(CASE WHEN {a} THEN t2.{UPB} ELSE 0 END) AS DECIMAL(38,2)) AS total_{p}_upb,
  {pct(cnt_if(a), 'COUNT(*)')} AS percent_state_{p},
  {pct(f'CAST(SUM(CASE WHEN {a} THEN t2.{UPB} ELSE 0 END) AS DECIMAL(38,2))', f'SUM(t2.{UPB})')} AS percent_state_upb_{p},
  {cnt_if(a + ' AND t2.months_delinquent <> 0')} AS total_{p}_delinquencies
FROM loan_static t LEFT JOIN loan_monthly t2 ON t2.loan_id = t.loan_id GROUP BY t.state_code"""


@register("agency_share", Q(_agency_share_sql("F", "fha")))
def _agency_share(t: Tables):
    return reports.agency_share(None, t.loan_months, agency="F")


@register("agency_share_va", Q(_agency_share_sql("V", "va")))
def _agency_share_va(t: Tables):
    return reports.agency_share(None, t.loan_months, agency="V")


@register("agency_dq_rate", Q("""
SELECT state, fha_delinquency_rate, (SELECT AVG(r) FROM (SELECT fha_delinquency_rate AS r FROM d
    ORDER BY fha_delinquency_rate DESC NULLS LAST, state LIMIT 10) x) AS top_mean,
  (SELECT AVG(fha_delinquency_rate) FROM d) AS all_mean
FROM d ORDER BY fha_delinquency_rate DESC NULLS LAST, state LIMIT 10""",
                               {"s": _agency_share_sql("F", "fha"),
                                "d": f"SELECT *, {ratio('total_fha_delinquencies', 'fha_loans')} * 100 AS fha_delinquency_rate FROM s"}))
def _agency_dq_rate(t: Tables):
    return reports.agency_dq_rate(reports.agency_share(None, t.loan_months, agency="F"))


_BUYER = """CASE WHEN first_time_home_buyer IS NULL OR first_time_home_buyer IN ('NaN', 'N') THEN 'Repeat Buyer'
  WHEN first_time_home_buyer = 'Y' THEN 'First Time Buyer' END"""
_ASSIST = """CASE WHEN down_payment_assistance IS NULL OR down_payment_assistance IN ('NaN', 'N') THEN 'No Assistance'
  WHEN down_payment_assistance = 'Y' THEN 'Received Assistance' END"""
_INSURER = "CASE WHEN agency = 'F' THEN 'FHA' WHEN agency = 'V' THEN 'VA' WHEN agency = 'R' THEN 'RD' ELSE 'PIH' END"
_BUYERS_SQL = f"""SELECT {_BUYER} AS new_buyer, {_ASSIST} AS assistance, {_INSURER} AS insurer, COUNT(*) AS total_loans,
  {rnd(avg_d('loan_interest_rate'), 2)} AS average_interest_rate FROM loan_static GROUP BY 1, 2, 3"""


@register("buyer_characteristics", Q(_BUYERS_SQL))
def _buyer_characteristics(t: Tables):
    return reports.buyer_characteristics(t.loan_static)


@register("buyer_characteristics_pg", Q(f"""
SELECT CASE WHEN first_time_home_buyer IN ('NaN', 'N') THEN 'Repeat Buyer' WHEN first_time_home_buyer = 'Y' THEN 'First Time Buyer' END AS new_buyer,
  CASE WHEN down_payment_assistance IN ('NaN', 'N') THEN 'No Assistance' WHEN down_payment_assistance = 'Y' THEN 'Received Assistance' END AS assistance,
  CASE WHEN agency = 'F' THEN 'FHA' WHEN agency = 'V' THEN 'VA' WHEN agency = 'R' THEN 'RD' ELSE agency END AS insurer,
  COUNT(*) AS total_loans, {rnd(avg_d('loan_interest_rate'), 2)} AS average_interest_rate,
  {rnd(avg_d('credit_score'), 0)} AS average_credit_score
FROM loan_static GROUP BY 1, 2, 3"""))
def _buyer_characteristics_pg(t: Tables):
    return reports.buyer_characteristics(t.loan_static, dialect="pg")


@register("buyer_rate_pivot", Q("""
SELECT new_buyer, AVG(CASE WHEN insurer = 'FHA' THEN average_interest_rate END) AS fha,
  AVG(CASE WHEN insurer = 'VA' THEN average_interest_rate END) AS va,
  AVG(CASE WHEN insurer = 'RD' THEN average_interest_rate END) AS rd,
  AVG(CASE WHEN insurer = 'PIH' THEN average_interest_rate END) AS pih
FROM b GROUP BY new_buyer""", {"b": _BUYERS_SQL}))
def _buyer_rate_pivot(t: Tables):
    return reports.buyer_rate_pivot(reports.buyer_characteristics(t.loan_static))


@register("existing_vs_new", Q(f"""
SELECT CASE WHEN EXISTS (SELECT 1 FROM new_issuance n WHERE n.loan_id = t2.loan_id) THEN 'New Issuances' ELSE 'Existing Loans' END AS loan_type,
  COUNT(*) AS total_loans, {rnd(avg_d('t2.loan_interest_rate'), 2)} AS average_interest_rate,
  {rnd(ratio(cnt_if("t2.first_time_home_buyer = 'Y'"), 'COUNT(*)'), 2)} AS percent_fthb,
  {rnd(ratio(cnt_if("t2.down_payment_assistance = 'Y'"), 'COUNT(*)'), 2)} AS percent_dpa, t2.state_code
FROM loan_static t2 GROUP BY 1, t2.state_code ORDER BY state_code"""))
def _existing_vs_new(t: Tables):
    return reports.existing_vs_new(t.loan_static, t.new_issuance)


@register("mega_vs_other", Q(f"""
SELECT CASE WHEN t.issuer_group = 'Mega' THEN 'Mega' ELSE 'Non Mega' END AS issuer_group,
  {cnt_if('t2.months_delinquent <> 0')} AS total_delinquencies, {cnt_if("t3.agency = 'F'")} AS fha_loans,
  {cnt_if("t3.agency = 'V'")} AS va_loans, {cnt_if("t3.agency = 'R'")} AS rd_loans, {cnt_if("t3.agency = 'N'")} AS pih_loans,
  COUNT(t3.loan_id) AS total_loans,
  {rnd(ratio(cnt_if("t3.first_time_home_buyer = 'Y'"), 'COUNT(t3.loan_id)'), 2)} AS percent_fthb,
  {rnd(ratio(cnt_if("t3.down_payment_assistance = 'Y'"), 'COUNT(t3.loan_id)'), 2)} AS percent_dpa
FROM loan_static t3 JOIN loan_monthly t2 ON t2.loan_id = t3.loan_id
LEFT JOIN issuer_info t ON t.issuer_number = t3.issuer_id GROUP BY 1"""))
def _mega_vs_other(t: Tables):
    return reports.mega_vs_other(None, t.loan_months, t.issuer_info)


@register("mega_issuer_profile", Q(f"""
SELECT concat(CAST(t.issuer_id AS VARCHAR), ' - ', t3.issuer_name) AS issuer_title,
  {cnt_if('t2.months_delinquent <> 0')} AS total_delinquencies, t3.citystate AS location,
  {rnd(ratio(cnt_if("t.first_time_home_buyer = 'Y'"), 'COUNT(*)'), 2)} AS percent_fthb,
  {rnd(ratio(cnt_if("t.down_payment_assistance = 'Y'"), 'COUNT(*)'), 2)} AS percent_dpa,
  CASE WHEN t3.subservicer <> 'No Subservicer' THEN t4.subservicer_name ELSE 'No Subservicer' END AS subservicer
FROM loan_static t JOIN loan_monthly t2 ON t2.loan_id = t.loan_id
JOIN issuer_info t3 ON t3.issuer_number = t2.issuer_id
LEFT JOIN subservicers t4 ON t4.subservicer_id = t3.subservicer
WHERE t3.issuer_group = 'Mega' GROUP BY 1, 3, 6"""))
def _mega_issuer_profile(t: Tables):
    return reports.mega_issuer_profile(None, t.loan_months, t.issuer_info, t.subservicers)


_ISSUANCE = f"""COUNT(*) AS total_new_issuances, {rnd(avg_d('t.original_principal_balance'), 2)} AS average_opb,
  {money('t.original_principal_balance')} AS total_opb, {rnd(avg_d('t.loan_interest_rate'), 2)} AS average_interest_rate,
  {rnd(avg_d('t.credit_score'), 0)} AS average_credit_score, {cnt_if("t.agency = 'F'")} AS new_fha_issuances,
  {cnt_if("t.agency = 'V'")} AS new_va_issuances, {cnt_if("t.agency = 'R'")} AS new_rd_issuances,
  {cnt_if("t.agency = 'N'")} AS new_pih_issuances"""
_BY_ISSUER_SQL = f"""SELECT concat(CAST(t.issuer_id AS VARCHAR), ' - ', t2.issuer_name) AS issuer_title, {_ISSUANCE}, t.as_of_date
FROM new_issuance t JOIN issuer_info t2 ON t.issuer_id = t2.issuer_number GROUP BY 1, t.as_of_date"""


@register("new_issuance_by_issuer", Q(_BY_ISSUER_SQL))
def _new_issuance_by_issuer(t: Tables):
    return reports.new_issuance_by_issuer(t.new_issuance, t.issuer_info)


@register("new_issuance_agency_totals", Q("""
SELECT 'FHA' AS agency, CAST(SUM(new_fha_issuances) AS BIGINT) AS total_new_issuances FROM b
UNION ALL SELECT 'VA', CAST(SUM(new_va_issuances) AS BIGINT) FROM b
UNION ALL SELECT 'RD', CAST(SUM(new_rd_issuances) AS BIGINT) FROM b
UNION ALL SELECT 'PIH', CAST(SUM(new_pih_issuances) AS BIGINT) FROM b""", {"b": _BY_ISSUER_SQL}))
def _new_issuance_agency_totals(t: Tables):
    return reports.new_issuance_agency_totals(reports.new_issuance_by_issuer(t.new_issuance, t.issuer_info))


NEW_AS_OF = "2001-06-01"


@register("new_issuance_by_state", Q(f"""
SELECT t.state_code, {_ISSUANCE}
FROM new_issuance t JOIN issuer_info t2 ON t.issuer_id = t2.issuer_number
WHERE t.as_of_date = DATE '{NEW_AS_OF}' GROUP BY t.state_code"""))
def _new_issuance_by_state(t: Tables):
    return reports.new_issuance_by_state(t.new_issuance, t.issuer_info, as_of=NEW_AS_OF)


@register("mf_state_concentration", Q(f"""
SELECT property_state, {money(UPB)} AS total_upb, COUNT(*) AS total_loans,
  {rnd(avg_d('loan_interest_rate'), 2)} AS average_interest_rate,
  {cnt_if('months_delinquent <> 0')} AS total_delinquent_loans,
  CAST(SUM(CASE WHEN months_delinquent <> 0 THEN {UPB} ELSE 0 END) AS DECIMAL(38,2)) AS total_delinquent_upb,
  {rnd(f'CAST({money(UPB)} AS DOUBLE) / 1e9', 2)} AS total_upb_bn
FROM pool_loans GROUP BY property_state ORDER BY total_upb DESC"""))
def _mf_state_concentration(t: Tables):
    return reports.mf_state_concentration(t.pool_loans)


_TIER_MIX_SQL = """SELECT issuer_title, tier, COUNT(*) AS loans FROM (
  SELECT concat(CAST(t.issuer_id AS VARCHAR), ' - ', t3.issuer_name) AS issuer_title,
    (CASE WHEN t.credit_score < 680 THEN '<680' WHEN t.credit_score < 740 THEN '680-739' ELSE '740+' END)
    || ' / ' || (CASE WHEN t.ltv <= 90 THEN '<=90' ELSE '>90' END) AS tier
  FROM loan_static t LEFT JOIN issuer_info t3 ON t3.issuer_number = t.issuer_id
  WHERE t3.issuer_group = 'Mega' AND t.credit_score IS NOT NULL AND t.ltv IS NOT NULL) x
GROUP BY issuer_title, tier"""


@register("tier_mix", Q(_TIER_MIX_SQL))
def _tier_mix(t: Tables):
    return reports.tier_mix(t.loan_static, t.issuer_info)


_TIER_MIX_NEW_SQL = _TIER_MIX_SQL.replace("FROM loan_static t LEFT JOIN", "FROM ni t LEFT JOIN").replace(
    "WHERE t3.issuer_group", "WHERE t.as_of_date = (SELECT MAX(as_of_date) FROM ni) AND t3.issuer_group")


@register("tier_mix_new_issuance", Q(_TIER_MIX_NEW_SQL, {"ni": "SELECT * FROM new_issuance"}))
def _tier_mix_new_issuance(t: Tables):
    return reports.tier_mix_new_issuance(t.new_issuance, t.issuer_info)


def _crosstab_sql() -> str:
    cols = ", ".join(f"CAST(SUM(CASE WHEN tier = '{x}' THEN loans ELSE 0 END) AS DOUBLE) AS c{i}"
                     for i, x in enumerate(reports.TIERS))
    tot = " + ".join(f"c{i}" for i in range(len(reports.TIERS)))
    outs = ", ".join(f"c{i} / ({tot}) * 100 AS \"pct {x}\"" for i, x in enumerate(reports.TIERS))
    return Q(f"SELECT issuer_title, {outs} FROM (SELECT issuer_title, {cols} FROM m GROUP BY issuer_title) p",
             {"m": _TIER_MIX_SQL})


@register("tier_mix_crosstab", _crosstab_sql())
def _tier_mix_crosstab(t: Tables):
    return reports.tier_mix_crosstab(reports.tier_mix(t.loan_static, t.issuer_info))


_BOOK_TIER = """(CASE WHEN t.credit_score IS NULL THEN 'unknown' WHEN t.credit_score < 680 THEN '<680'
   WHEN t.credit_score < 740 THEN '680-739' ELSE '740+' END) || ' / ' ||
  (CASE WHEN t.ltv IS NULL THEN 'unknown' WHEN t.ltv <= 90 THEN '<=90' ELSE '>90' END)"""
_RISK_BOOK_SQL = f"""SELECT upper(trim(t.state_code)) AS state_code, {_BOOK_TIER} AS tier, COUNT(*) AS loans,
  {money('t2.' + UPB)} AS {UPB}
FROM loan_monthly t2 JOIN loan_static t ON t.loan_id = t2.loan_id
WHERE t2.report_date = (SELECT MAX(report_date) FROM loan_monthly) GROUP BY 1, 2"""


@register("risk_book", Q(_RISK_BOOK_SQL))
def _risk_book(t: Tables):
    return reports.risk_book(None, t.loan_months)


@register("risk_book_issuer", Q(f"""
SELECT b.*, i.issuer_name, i.issuer_group FROM (
SELECT upper(trim(t.state_code)) AS state_code, {_BOOK_TIER} AS tier, t2.issuer_id, COUNT(*) AS loans,
  {money('t2.' + UPB)} AS {UPB}
FROM loan_monthly t2 JOIN loan_static t ON t.loan_id = t2.loan_id
WHERE t2.report_date = (SELECT MAX(report_date) FROM loan_monthly) GROUP BY 1, 2, 3) b
LEFT JOIN issuer_info i ON i.issuer_number = b.issuer_id"""))
def _risk_book_issuer(t: Tables):
    return reports.risk_book(None, t.loan_months, by_issuer=True, issuer_info=t.issuer_info)


# ---------------------------------------------------------------------------------
# §2.3 projections and filters
# ---------------------------------------------------------------------------------


@register("project_loan_state", Q("SELECT loan_id, issuer_id, state_code FROM loan_static"))
def _project_loan_state(t: Tables):
    return filters.project_loan_state(t.loan_static)


@register("upcoming_maturities", Q(f"""
SELECT i.issuer_name, p.cusip, p.property_state, p.loan_maturity_date, p.{UPB}, p.months_delinquent
FROM pool_loans p JOIN issuers i ON p.issuer_number = i.issuer_number
WHERE p.loan_maturity_date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + INTERVAL 24 MONTH
ORDER BY p.loan_maturity_date, p.cusip, i.issuer_name LIMIT 20"""))
def _upcoming_maturities(t: Tables):
    return filters.upcoming_maturities(t.pool_loans, t.issuers, as_of=AS_OF)


@register("latest_snapshot", Q("SELECT * FROM loan_monthly WHERE report_date = (SELECT MAX(report_date) FROM loan_monthly)"))
def _latest_snapshot(t: Tables):
    return filters.latest_snapshot(t.loan_monthly)


@register("not_blank_filter", Q("SELECT cusip, as_of_date, msa FROM pool_loans WHERE msa IS NOT NULL AND msa != ''"))
def _not_blank_filter(t: Tables):
    return filters.not_blank_filter(t.pool_loans.select("cusip", "as_of_date", "msa"))


@register("exclude_vintages", Q(f"""
SELECT * FROM risk WHERE orig_year NOT IN ({', '.join(map(str, EXCLUDE))}) OR orig_year IS NULL"""))
def _exclude_vintages(t: Tables):
    return filters.exclude_vintages(t.risk, EXCLUDE)


_PERF_SQL = f"""SELECT m.loan_id, m.report_date AS reporting_date, t.state_code AS property_state,
  year(t.loan_origination_date) AS orig_year, t.loan_interest_rate AS interest_rate, t.credit_score,
  m.{UPB} AS upb, m.months_delinquent AS dq_status,
  ((year(m.report_date) - year(t.loan_origination_date)) * 12 + month(m.report_date) - month(t.loan_origination_date)) AS loan_age
FROM loan_monthly m JOIN loan_static t ON t.loan_id = m.loan_id"""


def perf(t: Tables) -> DataFrame:
    """Second-agency performance shape over the adapter: one row per loan-month."""
    j = t.loan_months.filter(F.col("t2").isNotNull())
    return j.select("loan_id", F.col("report_date").alias("reporting_date"), F.col("t.state_code").alias("property_state"),
                    F.year("t.loan_origination_date").alias("orig_year"), F.col("t.loan_interest_rate").alias("interest_rate"),
                    F.col("t.credit_score").alias("credit_score"), F.col(f"t2.{UPB}").alias("upb"),
                    F.col("t2.months_delinquent").alias("dq_status"),
                    reports.loan_age_months(F.col("report_date"), F.col("t.loan_origination_date")).alias("loan_age"))



@register("seasoned_active_filter", Q("SELECT * FROM perf WHERE upb > 0 AND dq_status IS NOT NULL AND loan_age >= 24",
                                      {"perf": _PERF_SQL}))
def _seasoned_active_filter(t: Tables):
    return filters.seasoned_active_filter(perf(t))


@register("dropna_subset", Q("SELECT * FROM econ WHERE unemployment_rate IS NOT NULL AND NOT isnan(hpi_index)"))
def _dropna_subset(t: Tables):
    return filters.dropna_subset(t.econ, ["unemployment_rate", "hpi_index"])


@register("fnma_state_level", Q(f"""
SELECT property_state, reporting_date, {rnd(avg_d('interest_rate'), 2)} AS average_interest_rate,
  {rnd(avg_d('loan_age'), 0)} AS average_loan_seasoning, {rnd(avg_d('credit_score'), 0)} AS average_credit_score,
  {cnt_if('dq_status = 0')} AS current_loans, {cnt_if('dq_status <> 0')} AS delinquent_loans,
  {ratio(cnt_if('dq_status <> 0'), cnt_if('dq_status = 0'))} * 100 AS dq_to_current_pct
FROM perf GROUP BY property_state, reporting_date""", {"perf": _PERF_SQL}))
def _fnma_state_level(t: Tables):
    return reports.fnma_state_level(perf(t))


# ---------------------------------------------------------------------------------
# §2.4 joins
# ---------------------------------------------------------------------------------


@register("join_inner_dim", Q("""
SELECT p.cusip, p.as_of_date, p.issuer_number, i.issuer_name, i.issuer_group FROM pool_loans p
JOIN issuers i ON p.issuer_number = i.issuer_number"""))
def _join_inner_dim(t: Tables):
    j = joins.join_inner_dim(t.pool_loans.select("cusip", "as_of_date", "issuer_number"),
                             t.issuers.select(F.col("issuer_number").alias("inum"), "issuer_name", "issuer_group"),
                             fact_key="issuer_number", dim_key="inum")
    return j.drop("inum")


@register("join_inner_fact", Q(f"""
SELECT t.loan_id, t.state_code, m.report_date, m.{UPB}, m.months_delinquent FROM loan_static t
JOIN loan_monthly m ON m.loan_id = t.loan_id"""))
def _join_inner_fact(t: Tables):
    return joins.join_inner_fact(t.loan_static, t.loan_monthly).select(
        "loan_id", "state_code", "report_date", UPB, "months_delinquent")


@register("join_left", Q("""
SELECT t.loan_id, t.state_code, m.report_date, m.months_delinquent FROM loan_static t
LEFT JOIN loan_monthly m ON m.loan_id = t.loan_id"""))
def _join_left(t: Tables):
    m = t.loan_monthly.select(F.col("loan_id").alias("m_loan_id"), "report_date", "months_delinquent")
    return joins.join_left(t.loan_static.select("loan_id", "state_code"), m, left_key="loan_id",
                           right_key="m_loan_id").drop("m_loan_id")


@register("join_left_filtered", Q(f"""
SELECT t.loan_id, t.state_code, m.report_date AS liquidation_month FROM loan_static t
LEFT JOIN loan_monthly m ON m.loan_id = t.loan_id AND m.current_month_liquidation = 'Y' AND m.report_date = DATE '{AS_OF}'"""))
def _join_left_filtered(t: Tables):
    m = t.loan_monthly.select(F.col("loan_id").alias("m_loan_id"), F.col("report_date").alias("liquidation_month"),
                              "current_month_liquidation")
    cond = (F.col("current_month_liquidation") == "Y") & (F.col("liquidation_month") == F.lit(AS_OF).cast("date"))
    return joins.join_left_filtered(t.loan_static.select("loan_id", "state_code"), m, left_key="loan_id",
                                    right_key="m_loan_id", right_filter=cond).select(
        "loan_id", "state_code", "liquidation_month")


@register("join_multiway", Q(f"""
SELECT t.state_code, t2.report_date AS reporting_date, COUNT(*) AS loans, COUNT(t4.loan_id) AS total_liquidations,
  {cnt_if("t3.issuer_group = 'Mega'")} AS mega_loans, {cnt_if("t5.subservicer_name IS NOT NULL")} AS subserviced
FROM loan_static t JOIN loan_monthly t2 ON t2.loan_id = t.loan_id
JOIN issuer_info t3 ON t3.issuer_number = t.issuer_id
LEFT JOIN subservicers t5 ON t5.subservicer_id = t3.subservicer
LEFT JOIN loan_monthly t4 ON t4.loan_id = t.loan_id AND t4.report_date = t2.report_date AND t4.current_month_liquidation = 'Y'
GROUP BY 1, 2"""))
def _join_multiway(t: Tables):
    s, m, ii, sub = t.loan_static, t.loan_monthly, t.issuer_info, t.subservicers
    liq = m.filter(F.col("current_month_liquidation") == "Y").select(
        F.col("loan_id").alias("l_id"), F.col("report_date").alias("l_date"))
    j = (s.alias("t").join(m.alias("t2"), "loan_id")
         .join(ii, F.col("t.issuer_id") == ii.issuer_number)
         .join(sub, F.col("subservicer") == F.col("subservicer_id"), "left")
         .join(liq, (F.col("loan_id") == F.col("l_id")) & (F.col("t2.report_date") == F.col("l_date")), "left"))
    from loanlens.functions.exprs import cnt_if as ci
    return j.groupBy(F.col("t.state_code").alias("state_code"), F.col("t2.report_date").alias("reporting_date")).agg(
        F.count(F.lit(1)).alias("loans"), F.count("l_id").alias("total_liquidations"),
        ci(F.col("issuer_group") == "Mega").alias("mega_loans"),
        ci(F.col("subservicer_name").isNotNull()).alias("subserviced"))


@register("existence_flag", Q("""
SELECT loan_id, CASE WHEN EXISTS (SELECT 1 FROM new_issuance n WHERE n.loan_id = s.loan_id) THEN 'New Issuances'
  ELSE 'Existing Loans' END AS loan_type FROM loan_static s"""))
def _existence_flag(t: Tables):
    return reports.existence_flag(t.loan_static.select("loan_id"), t.new_issuance)


@register("join_anti", Q("""
SELECT * FROM loan_static s WHERE NOT EXISTS (SELECT 1 FROM loan_monthly m WHERE m.loan_id = s.loan_id)"""))
def _join_anti(t: Tables):
    return joins.join_anti(t.loan_static, t.loan_monthly, ["loan_id"])


@register("join_semi", Q(f"""
SELECT * FROM loan_static s WHERE EXISTS (SELECT 1 FROM loan_monthly m WHERE m.loan_id = s.loan_id
  AND m.report_date = DATE '{AS_OF}')"""))
def _join_semi(t: Tables):
    return joins.join_semi(t.loan_static, t.loan_monthly.filter(F.col("report_date") == F.lit(AS_OF).cast("date")),
                           ["loan_id"])


@register("transition_self_join", Q("""
SELECT cusip, as_of_date, property_state, months_delinquent,
  COUNT(*) OVER w AS later_count, MIN(months_delinquent) OVER w AS later_min_months,
  MAX(months_delinquent) OVER w AS later_max_months,
  MAX(CASE WHEN current_month_liquidation = 'Y' THEN 1 ELSE 0 END) OVER w AS later_liquidated
FROM pool_loans WINDOW w AS (PARTITION BY cusip ORDER BY as_of_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"""))
def _transition_self_join(t: Tables):
    return joins.transition_self_join(t.pool_loans)


@register("join_map", Q(f"""
SELECT p.cusip, p.as_of_date, p.removal_reason, r.removal_label FROM pool_loans p
LEFT JOIN reasons r ON r.removal_code = p.removal_reason""", {"reasons": _REASONS_SQL}))
def _join_map(t: Tables):
    p = t.pool_loans.select("cusip", "as_of_date", "removal_reason")
    return joins.join_map(p, rules.removal_reason_table(t.spark), key="removal_reason",
                          lookup_key="removal_code")


@register("join_panel", Q("""
SELECT r.property_state, r.report_date, r.loan_count, e.unemployment_rate, e.hpi_index
FROM (SELECT property_state, reporting_date AS report_date, CAST(SUM(loan_count) AS BIGINT) AS loan_count FROM risk GROUP BY 1, 2) r
JOIN econ e ON e.state = r.property_state AND e.report_date = r.report_date"""))
def _join_panel(t: Tables):
    r = t.risk.groupBy("property_state", F.col("reporting_date").alias("report_date")).agg(
        F.sum("loan_count").cast("bigint").alias("loan_count"))
    return joins.join_panel(r, t.econ)


# ---------------------------------------------------------------------------------
# §2.7 sorts, limits, set operations
# ---------------------------------------------------------------------------------


@register("order_limit", Q(f"""
SELECT property_state, {money(UPB)} AS total_upb FROM pool_loans GROUP BY property_state
ORDER BY total_upb DESC, property_state LIMIT 5"""))
def _order_limit(t: Tables):
    g = t.pool_loans.groupBy("property_state").agg(F.sum(UPB).cast("decimal(38,2)").alias("total_upb"))
    return topk.order_limit(g, [F.desc("total_upb"), F.asc("property_state")], 5)


@register("nlargest", Q("""
SELECT * FROM (SELECT state, fha_delinquency_rate FROM d) ORDER BY fha_delinquency_rate DESC NULLS LAST, state LIMIT 10""",
                        {"s": _agency_share_sql("F", "fha"),
                         "d": f"SELECT *, {ratio('total_fha_delinquencies', 'fha_loans')} * 100 AS fha_delinquency_rate FROM s"}))
def _nlargest(t: Tables):
    s = reports.agency_share(None, t.loan_months, agency="F")
    d = s.select("state", (F.try_divide(F.col("total_fha_delinquencies").cast("double"),
                                        F.col("fha_loans").cast("double")) * 100).alias("fha_delinquency_rate"))
    return topk.nlargest(d, "fha_delinquency_rate", 10, ["state"])


@register("sort_panel", Q("""
SELECT property_state, reporting_date, fico_bucket, ltv_bucket, loan_count FROM risk
ORDER BY property_state, fico_bucket, ltv_bucket, reporting_date"""))
def _sort_panel(t: Tables):
    r = t.risk.select("property_state", "reporting_date", "fico_bucket", "ltv_bucket", "loan_count")
    return topk.sort_panel(r, ("property_state", "fico_bucket", "ltv_bucket", "reporting_date"))


@register("sort_result", Q(f"""
SELECT state_code, {UPB} AS upb FROM (SELECT state_code, SUM({UPB}) AS {UPB} FROM b GROUP BY state_code)
ORDER BY upb DESC, state_code LIMIT 10""", {"b": _RISK_BOOK_SQL}))
def _sort_result(t: Tables):
    b = reports.risk_book(None, t.loan_months).groupBy("state_code").agg(F.sum(UPB).alias("upb"))
    return topk.sort_result(b, "upb", 10, "state_code")


@register("mean_line", Q("""
SELECT (SELECT AVG(fha_delinquency_rate) FROM d) AS all_mean,
  (SELECT AVG(fha_delinquency_rate) FROM (SELECT fha_delinquency_rate FROM d ORDER BY fha_delinquency_rate DESC NULLS LAST, state LIMIT 10)) AS top_mean""",
                         {"s": _agency_share_sql("F", "fha"),
                          "d": f"SELECT *, {ratio('total_fha_delinquencies', 'fha_loans')} * 100 AS fha_delinquency_rate FROM s"}))
def _mean_line(t: Tables):
    s = reports.agency_share(None, t.loan_months, agency="F")
    d = s.select("state", (F.try_divide(F.col("total_fha_delinquencies").cast("double"),
                                        F.col("fha_loans").cast("double")) * 100).alias("fha_delinquency_rate"))
    # per-state rows read by both means: checkpoint once instead of re-deriving the share twice
    return topk.mean_line(cut(d), "fha_delinquency_rate", 10, "state")


@register("union_all", Q("""
SELECT state, report_date, unemployment_rate FROM econ WHERE year(report_date) < 1998
UNION ALL SELECT state, report_date, unemployment_rate FROM econ WHERE year(report_date) >= 1998
UNION ALL SELECT state, report_date, unemployment_rate FROM econ WHERE report_date IS NULL"""))
def _union_all(t: Tables):
    # the parts together hold every row once
    e, y = t.econ.select("state", "report_date", "unemployment_rate"), F.year("report_date")
    return topk.union_all([e.filter(y < 1998), e.filter(y >= 1998), e.filter(y.isNull())])


@register("distinct_rows", Q("SELECT DISTINCT property_state, as_of_date FROM pool_loans"))
def _distinct_rows(t: Tables):
    return topk.distinct_rows(t.pool_loans, ["property_state", "as_of_date"])


@register("tier_check", Q("""
SELECT tier, CAST(SUM(loan_count) AS BIGINT) AS loan_count, CAST(SUM(dlq90) AS BIGINT) AS dlq90,
  CAST(SUM(dlq90) AS DOUBLE) / CAST(SUM(loan_count) AS DOUBLE) * 100 AS dlq_rate,
  CAST(SUM(loan_count) AS DOUBLE) / CAST((SELECT SUM(loan_count) FROM rt WHERE tier IS NOT NULL) AS DOUBLE) AS mix
FROM rt WHERE tier IS NOT NULL GROUP BY tier""", {"rt": f"""SELECT *, (CASE fico_bucket WHEN '<640' THEN '<680' WHEN '640-679' THEN '<680'
  WHEN '680-739' THEN '680-739' WHEN '740+' THEN '740+' END) || ' / ' || (CASE ltv_bucket WHEN '<=80' THEN '<=90'
  WHEN '80-90' THEN '<=90' WHEN '90-95' THEN '>90' WHEN '95+' THEN '>90' END) AS tier FROM risk
  WHERE orig_year NOT IN ({', '.join(map(str, EXCLUDE))})"""}))
def _tier_check(t: Tables):
    r = filters.exclude_vintages(t.risk, EXCLUDE).filter(F.col("orig_year").isNotNull())
    r = r.withColumn("tier", rules.tier_from_buckets(F.col("fico_bucket"), F.col("ltv_bucket")))
    return reports.tier_check(r.filter(F.col("tier").isNotNull()))
