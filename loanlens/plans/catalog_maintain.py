"""Registered table-maintenance queries (§2.2) with their oracles.

Targets and sources are cut from the driver data by month, the way monthly
files arrive: an existing table holds the months loaded so far and a new file
brings the next month(s).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.functions.clean import mmyyyy_date
from loanlens.operators import maintain
from loanlens.operators.joins import dedupe_first
from loanlens.plans.adapter import Tables
from loanlens.plans.catalog import UPB, Q, register
from loanlens.session import cut
from loanlens.sources import records, render
from loanlens.sources.layouts import FNMA_STATIC_FIELDS, LL_FIELDS
from loanlens.sources.records import content_digest

NOW = "2026-06-01 00:00:00"
MERGE_MONTH = "2000-01-01"
CUT_MONTH = "199901"
GROUP_EDGES = [(500, "Very Small"), (560, "Small"), (600, "Medium"), (650, "Large")]
MF_REPORT = "2001-11-01"

# ---------------------------------------------------------------------------------
# Staging views (Spark) and their SQL twins
# ---------------------------------------------------------------------------------


def ll(t: Tables):
    return render.ll_staging(t.loan_monthly, t.loan_static)


def lr(t: Tables):
    return render.lr_staging(t.loan_monthly, t.loan_static)


def mstg(t: Tables):
    return render.m_staging(t.pool_loans, t.issuer_info)


def fnma(t: Tables):
    from loanlens.plans.catalog import perf

    return render.fnma_staging(perf(t))


_AGE = "CAST((year(m.report_date) - year(t.loan_origination_date)) * 12 + month(m.report_date) - month(t.loan_origination_date) AS VARCHAR)"
LL_SQL = f"""SELECT 'LL' AS record_type, '36' || CAST(m.loan_id AS VARCHAR) AS cusip_number,
  CAST(m.loan_id AS VARCHAR) AS disclosure_sequence_number, CAST(m.issuer_id AS VARCHAR) AS issuer_id, t.agency,
  CAST(t.loan_interest_rate AS VARCHAR) AS loan_interest_rate,
  CAST(t.original_principal_balance AS VARCHAR) AS original_principal_balance,
  CAST(m.unpaid_principal_balance AS VARCHAR) AS unpaid_principal_balance, {_AGE} AS loan_age,
  CAST(m.months_delinquent AS VARCHAR) AS months_delinquent, CAST(t.ltv AS VARCHAR) AS loan_to_value,
  CAST(t.credit_score AS VARCHAR) AS credit_score, t.down_payment_assistance, t.first_time_home_buyer, t.state_code,
  CASE WHEN m.loan_id % 7 IN (0, 1) THEN NULL ELSE CAST(10000 + m.loan_id % 50 AS VARCHAR) END AS msa,
  m.current_month_liquidation AS current_month_liquidation_flag, CAST(m.removal_reason AS VARCHAR) AS removal_reason,
  strftime(m.report_date, '%Y%m') AS as_of_date, strftime(t.loan_origination_date, '%Y%m%d') AS loan_origination_date,
  CAST(t.issuer_id AS VARCHAR) AS seller_issuer_id, m.report_date, m.loan_id, t.loan_origination_date AS orig_date
FROM loan_monthly m JOIN loan_static t ON t.loan_id = m.loan_id"""

LR_SQL = """SELECT '36' || CAST(m.loan_id AS VARCHAR) AS cusip_number, 'P' || CAST(m.loan_id % 1000 AS VARCHAR) AS pool_id,
  CAST(m.loan_id AS VARCHAR) AS disclosure_sequence_number, CAST(m.issuer_id AS VARCHAR) AS issuer_id,
  strftime(m.report_date, '%Y%m') AS report_period, t.agency AS agency_type, '1' AS loan_purpose,
  CAST(t.original_principal_balance AS VARCHAR) AS original_principal_balance,
  CAST(m.unpaid_principal_balance AS VARCHAR) AS unpaid_principal_balance,
  CAST(m.unpaid_principal_balance AS VARCHAR) AS liquidation_balance, CAST(m.removal_reason AS VARCHAR) AS removal_reason,
  m.report_date
FROM loan_monthly m JOIN loan_static t ON t.loan_id = m.loan_id WHERE m.current_month_liquidation = 'Y'"""

FNMA_SQL = """SELECT CAST(loan_id AS VARCHAR) AS loan_identifier,
  CAST(month(reporting_date) AS VARCHAR) || CAST(year(reporting_date) AS VARCHAR) AS monthly_reporting_period,
  'Servicer ' || CAST(loan_id % 7 AS VARCHAR) AS servicer_name, CAST(interest_rate AS VARCHAR) AS current_interest_rate,
  CAST(upb AS VARCHAR) AS current_actual_upb, CAST(loan_age AS VARCHAR) AS loan_age,
  CAST(360 - loan_age AS VARCHAR) AS remaining_months_to_maturity,
  CASE WHEN dq_status >= 6 THEN 'XX' ELSE CAST(dq_status AS VARCHAR) END AS current_loan_delinquency_status,
  property_state, '01' || CAST(orig_year AS VARCHAR) AS origination_date,
  CAST(credit_score AS VARCHAR) AS borrower_credit_score_at_origination, CAST(upb AS VARCHAR) AS original_upb,
  'R1' AS reference_pool_id, reporting_date, loan_id, upb AS upb_num
FROM perf"""

M_SQL = """SELECT CAST(p.cusip AS VARCHAR) AS disclosure_sequence_number, CAST(p.unpaid_principal_balance AS VARCHAR) AS unpaid_principal_balance,
  CAST(p.issuer_number AS VARCHAR) AS issuer_number, strftime(p.first_payment_date, '%Y%m%d') AS first_payment_date,
  CASE WHEN p.cusip % 11 = 0 THEN '2026XX01' ELSE strftime(p.loan_maturity_date, '%Y%m%d') END AS maturity_date_of_loan,
  CAST(p.months_delinquent AS VARCHAR) AS months_delinquent, CAST(p.removal_reason AS VARCHAR) AS removal_reason,
  'N' AS green_status, 'Y' AS affordable_status, p.property_state,
  CAST(10000 + p.cusip % 89999 AS VARCHAR) || '1234.0' AS property_zip,
  CASE WHEN p.msa <> '' THEN p.msa || '.0' END AS msa, 'Property ' || CAST(p.cusip AS VARCHAR) AS property_name,
  'FHA' AS insurance_type, CAST(p.loan_interest_rate AS VARCHAR) AS security_interest_rate,
  CAST(p.original_principal_balance AS VARCHAR) AS original_principal_balance,
  CAST(p.issuer_number AS VARCHAR) AS seller_issuer_id, CAST(p.unpaid_principal_balance AS VARCHAR) AS security_rpb,
  CASE WHEN p.cusip % 2 = 0 THEN 'Y' ELSE 'N' END AS pre_payment_penalty_flag, p.as_of_date
FROM pool_loans p LEFT JOIN issuer_info i ON i.issuer_number = p.issuer_number"""


def _perf_cte():
    from loanlens.plans.catalog import _PERF_SQL

    return {"perf": _PERF_SQL, "fs": FNMA_SQL}


# ---------------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------------


@register("dedupe_first", Q(f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY issuer_id, report_date
  ORDER BY {UPB} DESC, loan_id) AS rn FROM loan_monthly) x WHERE rn = 1"""))
def _dedupe_first(t: Tables):
    return dedupe_first(t.loan_monthly, ["issuer_id", "report_date"], [F.desc(UPB), F.asc("loan_id")])


_PL_COLS = f"cusip, as_of_date, months_delinquent, {UPB}"


@register("insert_if_absent", Q(f"""
SELECT {_PL_COLS} FROM pool_loans WHERE as_of_date < '{CUT_MONTH}'
UNION ALL SELECT {_PL_COLS} FROM pool_loans s WHERE as_of_date >= '199806'
  AND NOT EXISTS (SELECT 1 FROM pool_loans t WHERE t.as_of_date < '{CUT_MONTH}' AND t.cusip = s.cusip AND t.as_of_date = s.as_of_date)"""))
def _insert_if_absent(t: Tables):
    p = t.pool_loans.select("cusip", "as_of_date", "months_delinquent", UPB)
    # the source brings every row twice, the second time with another balance: the smaller one counts
    source = p.filter(F.col("as_of_date") >= "199806")
    source = source.unionByName(source.withColumn(UPB, (F.col(UPB) + 1).cast("decimal(14,2)")))
    return maintain.insert_if_absent(p.filter(F.col("as_of_date") < CUT_MONTH), source, ["cusip", "as_of_date"],
                                     order_by=[F.col(UPB), F.col("months_delinquent")])


@register("append_raw", Q(f"""
SELECT {_PL_COLS} FROM pool_loans WHERE as_of_date < '{CUT_MONTH}'
UNION ALL SELECT {_PL_COLS} FROM pool_loans WHERE as_of_date >= '199806'"""))
def _append_raw(t: Tables):
    p = t.pool_loans.select("cusip", "as_of_date", "months_delinquent", UPB)
    return maintain.append_raw(p.filter(F.col("as_of_date") < CUT_MONTH), p.filter(F.col("as_of_date") >= "199806"))


@register("quarantine", Q("""
SELECT COALESCE(CASE WHEN credit_score IS NULL THEN 'missing_score' WHEN loan_to_value IS NULL THEN 'missing_ltv'
  WHEN msa IS NULL THEN 'missing_msa' END, 'valid') AS reason, COUNT(*) AS rows FROM ll GROUP BY 1""", {"ll": LL_SQL}))
def _quarantine(t: Tables):
    s = ll(t)
    tagged = maintain.quarantine(s, {"missing_score": F.col("credit_score").isNotNull(),
                                     "missing_ltv": F.col("loan_to_value").isNotNull(),
                                     "missing_msa": F.col("msa").isNotNull()})
    return maintain.quarantine_counts(tagged)


@register("quarantine_records", Q("""SELECT CASE WHEN msa IS NULL THEN 'field count' WHEN credit_score IS NULL THEN 'no key' ELSE 'valid' END AS reason,
  COUNT(*) AS rows FROM ll GROUP BY 1""", {"ll": LL_SQL}))
def _quarantine_records(t: Tables):
    """Record lines of which some are cut short and some have a blank key: each is kept with its reason, the others load."""
    from loanlens.plans.catalog_sources import _landed_ll

    at = {f: LL_FIELDS.index(f) for f in ("msa", "credit_score", "disclosure_sequence_number")}
    parts = F.split("value", r"\|", -1)
    blank = lambda f: F.trim(parts.getItem(at[f])) == ""
    key = at["disclosure_sequence_number"]
    keyless = F.concat_ws("|", F.slice(parts, 1, key), F.lit(" "), F.slice(parts, key + 2, len(LL_FIELDS)))
    lines = records.read_lines(t.spark, _landed_ll(t))
    lines = lines.withColumn("value", F.when(blank("msa"), F.substring_index("value", "|", 9)).when(blank("credit_score"), keyless).otherwise(F.col("value")))
    tagged = records.split_records(lines, "LL", LL_FIELDS, key="disclosure_sequence_number")
    return maintain.quarantine_counts(tagged.withColumnRenamed("bad_reason", "_reason"))


_MERGE_CTES = {
    "tg": f"""SELECT loan_id, issuer_id, {UPB}, months_delinquent, report_date,
  CAST(report_date AS TIMESTAMP) AS created_at, CAST(report_date AS TIMESTAMP) AS last_updated FROM (
  SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY report_date DESC) AS rn FROM loan_monthly
  WHERE report_date < DATE '{MERGE_MONTH}') x WHERE rn = 1""",
    "sr": f"""SELECT loan_id, issuer_id, {UPB}, months_delinquent, report_date FROM (
  SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY report_date DESC, {UPB}) AS rn FROM loan_monthly
  WHERE report_date >= DATE '{MERGE_MONTH}') x WHERE rn = 1""",
}


def _merge_sql(preserve: bool, ctes: dict | None = None) -> str:
    ins = "s.loan_id IS NOT NULL"
    cols = ", ".join(f"CASE WHEN {ins} THEN s.{c} ELSE t.{c} END AS {c}"
                     for c in ["issuer_id", UPB, "months_delinquent", "report_date"])
    created = (f"CASE WHEN {ins} AND t.loan_id IS NULL THEN TIMESTAMP '{NOW}' ELSE t.created_at END" if preserve
               else f"CASE WHEN {ins} THEN TIMESTAMP '{NOW}' ELSE t.created_at END")
    return Q(f"""SELECT COALESCE(s.loan_id, t.loan_id) AS loan_id, {cols}, {created} AS created_at,
  CASE WHEN {ins} THEN TIMESTAMP '{NOW}' ELSE t.last_updated END AS last_updated
FROM sr s FULL OUTER JOIN tg t ON s.loan_id = t.loan_id""", ctes or _MERGE_CTES)


def _merge_inputs(t: Tables):
    m = t.loan_monthly.select("loan_id", "issuer_id", UPB, "months_delinquent", "report_date")
    tg = dedupe_first(m.filter(F.col("report_date") < F.lit(MERGE_MONTH).cast("date")), ["loan_id"],
                      [F.desc("report_date")])
    tg = tg.withColumn("created_at", F.col("report_date").cast("timestamp")).withColumn(
        "last_updated", F.col("report_date").cast("timestamp"))
    sr = m.filter(F.col("report_date") >= F.lit(MERGE_MONTH).cast("date"))
    return tg, sr



@register("merge_scd1", _merge_sql(True))
def _merge_scd1(t: Tables):
    tg, sr = _merge_inputs(t)
    return maintain.merge_scd1(tg, sr, ["loan_id"], order_by=[F.desc("report_date"), F.asc(UPB)], now=NOW)


_LATE = {"tg": _MERGE_CTES["tg"], "sr": f"""SELECT s.* FROM (SELECT loan_id, issuer_id, {UPB}, months_delinquent, report_date FROM (
  SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY report_date, {UPB}) AS rn FROM loan_monthly) x WHERE rn = 1) s
  LEFT JOIN (SELECT loan_id AS id, MAX(report_date) AS newest FROM loan_monthly WHERE report_date < DATE '{MERGE_MONTH}' GROUP BY loan_id) n ON n.id = s.loan_id
  WHERE n.newest IS NULL OR s.report_date >= n.newest"""}


@register("merge_scd1_any_order", _merge_sql(True, _LATE))
def _merge_scd1_any_order(t: Tables):
    """The oldest month of each loan comes last: it changes nothing where the table has a newer one."""
    tg, _ = _merge_inputs(t)
    m = t.loan_monthly.select("loan_id", "issuer_id", UPB, "months_delinquent", "report_date")
    return maintain.merge_scd1(tg, m, ["loan_id"], order_by=[F.asc("report_date"), F.asc(UPB)], now=NOW, version="report_date")


@register("split_new_existing", _merge_sql(False))
def _split_new_existing(t: Tables):
    tg, sr = _merge_inputs(t)
    return maintain.split_new_existing(tg, sr, ["loan_id"], order_by=[F.desc("report_date"), F.asc(UPB)], now=NOW)


@register("replace_period", Q(f"""
SELECT * FROM loan_monthly m WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.report_date = m.report_date AND s.loan_id = m.loan_id)
UNION ALL SELECT * FROM src""", {"src": f"""SELECT m.loan_id, m.report_date, m.issuer_id, m.{UPB}, m.months_delinquent + 1 AS months_delinquent,
  m.current_month_liquidation, m.removal_reason FROM loan_monthly m JOIN issuer_info i ON i.issuer_number = m.issuer_id
  WHERE m.report_date = DATE '{MERGE_MONTH}' AND i.issuer_group = 'Mega'"""}))
def _replace_period(t: Tables):
    m = t.loan_monthly
    mega = t.issuer_info.filter(F.col("issuer_group") == "Mega").select(F.col("issuer_number").alias("issuer_id"))
    src = (m.filter(F.col("report_date") == F.lit(MERGE_MONTH).cast("date")).join(mega, "issuer_id", "left_semi")
           .withColumn("months_delinquent", F.col("months_delinquent") + 1))
    return maintain.replace_period(m, src, ["loan_id"])


@register("monthly_projection", Q("""
SELECT disclosure_sequence_number, report_date, CAST(issuer_id AS INTEGER) AS issuer_id,
  CAST(unpaid_principal_balance AS DECIMAL(14,2)) AS unpaid_principal_balance, CAST(loan_age AS INTEGER) AS loan_age_months,
  CAST(months_delinquent AS INTEGER) AS months_delinquent,
  CASE WHEN CAST(months_delinquent AS INTEGER) = 0 THEN 'Current' ELSE 'Delinquent' END AS delinquency_status FROM ll""",
                                  {"ll": LL_SQL}))
def _monthly_projection(t: Tables):
    s = ll(t)
    return maintain.monthly_projection(s, keys=["disclosure_sequence_number", "as_of_date"])


@register("static_projection", Q("""
SELECT disclosure_sequence_number, CAST(issuer_id AS INTEGER) AS issuer_id, state_code, msa,
  CAST(original_principal_balance AS DECIMAL(14,2)) AS original_principal_balance,
  CAST(loan_interest_rate AS DECIMAL(6,3)) AS loan_interest_rate, CAST(loan_to_value AS DECIMAL(7,2)) AS ltv,
  CAST(credit_score AS INTEGER) AS credit_score, loan_origination_date, down_payment_assistance, first_time_home_buyer,
  CAST(seller_issuer_id AS INTEGER) AS seller_issuer_id, agency FROM (
  SELECT *, row_number() OVER (PARTITION BY disclosure_sequence_number ORDER BY as_of_date DESC,
    CAST(unpaid_principal_balance AS DECIMAL(14,2))) AS rn FROM ll) x WHERE rn = 1""", {"ll": LL_SQL}))
def _static_projection(t: Tables):
    static, monthly = t._by_loan()
    return maintain.static_projection(render.ll_staging(monthly, static), tasks=4 * t.write_tasks())  # records are some four times as wide as rows


@register("liquidation_projection", Q("""
SELECT disclosure_sequence_number, report_date, CAST(issuer_id AS INTEGER) AS issuer_id, cusip_number, pool_id,
  agency_type, loan_purpose, CAST(original_principal_balance AS DECIMAL(14,2)) AS original_principal_balance,
  CAST(unpaid_principal_balance AS DECIMAL(14,2)) AS unpaid_principal_balance,
  CAST(liquidation_balance AS DECIMAL(14,2)) AS liquidation_balance, removal_reason FROM lr""", {"lr": LR_SQL}))
def _liquidation_projection(t: Tables):
    static, monthly = t._by_loan()
    s = render.lr_staging(monthly, static)
    # a second delivery of every record with a larger balance: the first one counts
    again = s.withColumn("liquidation_balance", (F.col("liquidation_balance").cast("decimal(14,2)") + 5).cast("string"))
    return maintain.liquidation_projection(s.unionByName(s).unionByName(again), tasks=3 * t.write_tasks())  # every record three times


_FS_COLS = ", ".join(FNMA_STATIC_FIELDS)


@register("fnma_static_insert", Q(f"""
SELECT {', '.join(f if f in ('loan_identifier', 'reference_pool_id', 'origination_date', 'original_upb', 'borrower_credit_score_at_origination', 'property_state') else f'CAST(NULL AS VARCHAR) AS {f}' for f in FNMA_STATIC_FIELDS)}
FROM (SELECT *, row_number() OVER (PARTITION BY loan_identifier ORDER BY reporting_date, CAST(current_actual_upb AS DECIMAL(14,2))) AS rn
  FROM fs) x WHERE rn = 1""", _perf_cte()))
def _fnma_static_insert(t: Tables):
    s = fnma(t)
    per = mmyyyy_date(F.col("monthly_reporting_period"))
    empty = s.select(*FNMA_STATIC_FIELDS).filter(F.lit(False))
    first = maintain.fnma_static_insert(empty, s.filter(per < F.lit("1998-01-01").cast("date")))
    return maintain.fnma_static_insert(first, s)


@register("fnma_monthly_insert", Q("""
SELECT loan_identifier, reporting_date, servicer_name, current_interest_rate, current_actual_upb, loan_age,
  remaining_months_to_maturity, CAST(NULLIF(current_loan_delinquency_status, 'XX') AS SMALLINT) AS current_loan_delinquency_status
FROM fs""", _perf_cte()))
def _fnma_monthly_insert(t: Tables):
    s = fnma(t)
    per = mmyyyy_date(F.col("monthly_reporting_period"))
    empty = maintain.fnma_monthly_insert(
        s.select("loan_identifier").withColumn("reporting_date", F.lit(None).cast("date")).filter(F.lit(False))
        .select("loan_identifier", "reporting_date", *[F.lit(None).cast("string").alias(c) for c in
                ["servicer_name", "current_interest_rate", "current_actual_upb", "loan_age", "remaining_months_to_maturity"]],
                F.lit(None).cast("smallint").alias("current_loan_delinquency_status")),
        s.filter(per < F.lit("1998-01-01").cast("date")))
    return maintain.fnma_monthly_insert(empty, s)


_SM_PERF = """SELECT reporting_date, property_state, TRY_CAST(right(trim(origination_date), 4) AS INTEGER) AS orig_year,
  COUNT(*) AS loan_count,
  CAST(SUM(CASE WHEN TRY_CAST(NULLIF(current_loan_delinquency_status, 'XX') AS SMALLINT) >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS dlq30,
  CAST(SUM(CASE WHEN TRY_CAST(NULLIF(current_loan_delinquency_status, 'XX') AS SMALLINT) >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS dlq90
FROM fs WHERE upb_num > 0 AND current_loan_delinquency_status IS NOT NULL AND TRY_CAST(loan_age AS INTEGER) >= 24
GROUP BY 1, 2, 3"""


@register("additive_merge", Q("SELECT * FROM smp", {**_perf_cte(), "smp": _SM_PERF}))
def _additive_merge(t: Tables):
    s = fnma(t)
    per = mmyyyy_date(F.col("monthly_reporting_period"))
    cut = F.lit("1999-01-01").cast("date")
    target = maintain.state_month_from_perf(s.filter(per < cut))
    return maintain.additive_merge(target, s.filter(per >= cut))


def _by_files(counts, rows, wrong, keys):
    """The additive table after all files came, those of the years before 1999 with wrong rows first and corrected then."""
    values = ["loan_count", "dlq30", "dlq90"]
    old = F.col("file_name") < "1999"
    first = counts(rows.filter(~old).unionByName(wrong(rows.filter(old))))
    none = first.filter(F.lit(False))
    target, given = maintain.additive_replace(none.select(*keys, *values), none, first, keys=keys, values=values)
    given = cut(given)
    return maintain.additive_replace(cut(target), given, counts(rows.filter(old)), keys=keys, values=values)[0]


@register("additive_merge_corrected", Q("SELECT * FROM smp", {**_perf_cte(), "smp": _SM_PERF}))
def _additive_merge_corrected(t: Tables):
    """Monthly files of which the older ones are corrected: their first counts go, the new ones come."""
    s = fnma(t).withColumn("file_name", F.date_format(mmyyyy_date(F.col("monthly_reporting_period")), "yyyyMM"))
    wrong = lambda d: d.withColumn("current_loan_delinquency_status", F.lit("04")).withColumn("property_state", F.concat("property_state", F.lit("?")))
    return _by_files(lambda d: maintain.contributions(d, maintain.state_month_from_perf, file="file_name"), s, wrong,
                     ["reporting_date", "property_state", "orig_year"])


@register("risk_preaggregate_corrected", Q("SELECT * FROM risk"))
def _risk_preaggregate_corrected(t: Tables):
    m = t.loan_monthly.withColumn("file_name", F.date_format("report_date", "yyyyMM"))
    wrong = lambda d: d.withColumn("months_delinquent", F.col("months_delinquent") + 2)
    counts = lambda d: maintain.contributions(d, lambda x, by: maintain.risk_preaggregate(x, t.loan_static, by=by), file="file_name")
    return _by_files(counts, m, wrong, ["reporting_date", "property_state", "orig_year", "fico_bucket", "ltv_bucket"])


@register("risk_preaggregate", Q("SELECT * FROM risk"))
def _risk_preaggregate(t: Tables):
    return maintain.risk_preaggregate(t.loan_monthly, t.loan_static)


_FILES_SQL = """SELECT DISTINCT 'llmon1_' || strftime(report_date, '%Y%m') || '.txt' AS file_name, 'loans' AS file_type, report_date
  FROM loan_monthly
UNION ALL SELECT DISTINCT 'llmonliq1_' || strftime(report_date, '%Y%m') || '.txt', 'liquidations', report_date
  FROM loan_monthly WHERE current_month_liquidation = 'Y'"""


def _files(t: Tables):
    m = t.loan_monthly
    ym = F.date_format("report_date", "yyyyMM")
    loans = m.select(F.concat(F.lit("llmon1_"), ym, F.lit(".txt")).alias("file_name"),
                     F.lit("loans").alias("file_type"), "report_date").distinct()
    liq = (m.filter(F.col("current_month_liquidation") == "Y")
           .select(F.concat(F.lit("llmonliq1_"), ym, F.lit(".txt")).alias("file_name"),
                   F.lit("liquidations").alias("file_type"), "report_date").distinct())
    return loans.unionByName(liq)


@register("load_log_skip", Q(f"""
SELECT * FROM files f WHERE NOT EXISTS (SELECT 1 FROM files l WHERE l.report_date < DATE '1999-01-01' AND l.file_name = f.file_name)""",
                             {"files": _FILES_SQL}))
def _load_log_skip(t: Tables):
    f = _files(t)
    log = f.filter(F.col("report_date") < F.lit("1999-01-01").cast("date"))
    return maintain.load_log_skip(f, log)


@register("load_log_corrected", Q("""SELECT DISTINCT 'llmon1_' || strftime(report_date, '%Y%m') || '.txt' AS file_name FROM loan_monthly
WHERE year(report_date) = 1997 OR report_date >= DATE '1999-01-01'"""))
def _load_log_corrected(t: Tables):
    """Files to load where the log has those before 1999, with other content for 1997: the new and the corrected ones."""
    m = t.loan_monthly.select("loan_id", "report_date", UPB, "months_delinquent", F.concat(F.lit("llmon1_"), F.date_format("report_date", "yyyyMM"), F.lit(".txt")).alias("file_name"))

    def digests(df):
        line = F.xxhash64(F.concat_ws("|", "loan_id", "report_date", UPB, "months_delinquent"))
        return df.groupBy("file_name").agg(content_digest(line).alias("digest"))

    was = m.filter(F.col("report_date") < F.lit("1999-01-01").cast("date"))
    was = was.withColumn(UPB, F.when(F.year("report_date") == 1997, F.col(UPB) + 1).otherwise(F.col(UPB)))
    return maintain.load_log_skip(digests(m), digests(was), keys=["file_name", "digest"]).select("file_name")


@register("issuer_group_update", Q(f"""
SELECT i.issuer_number, i.issuer_name, i.citystate, i.subservicer,
  COALESCE(CASE WHEN c.n IS NULL THEN NULL WHEN c.n < 500 THEN 'Very Small' WHEN c.n < 560 THEN 'Small' WHEN c.n < 600 THEN 'Medium'
    WHEN c.n < 650 THEN 'Large' ELSE 'Mega' END, i.issuer_group) AS issuer_group
FROM issuer_info i LEFT JOIN (SELECT issuer_id, COUNT(*) AS n FROM loan_monthly GROUP BY issuer_id) c ON c.issuer_id = i.issuer_number"""))
def _issuer_group_update(t: Tables):
    return maintain.issuer_group_update(t.issuer_info, t.loan_monthly, edges=GROUP_EDGES)


@register("mf_monthly_build", Q(f"""
SELECT disclosure_sequence_number, unpaid_principal_balance, issuer_number,
  CAST(try_strptime(first_payment_date, '%Y%m%d') AS DATE) AS first_payment_date,
  CAST(try_strptime(maturity_date_of_loan, '%Y%m%d') AS DATE) AS maturity_date_of_loan, months_delinquent,
  CASE WHEN TRY_CAST(months_delinquent AS DOUBLE) = 0 THEN 'Current' ELSE 'Delinquent' END AS delinquency_status,
  removal_reason, green_status, affordable_status, DATE '{MF_REPORT}' AS report_date,
  CAST((2001 - year(CAST(try_strptime(first_payment_date, '%Y%m%d') AS DATE))) * 12 + 11
    - month(CAST(try_strptime(first_payment_date, '%Y%m%d') AS DATE)) AS INTEGER) AS loan_age
FROM ms""", {"ms": M_SQL}))
def _mf_monthly_build(t: Tables):
    return maintain.mf_monthly_build(mstg(t), report_date=MF_REPORT)


@register("mf_static_build", Q(r"""
SELECT disclosure_sequence_number, issuer_number, property_state,
  substring(regexp_replace(property_zip, '\.0+$', ''), 1, 5) AS property_zip, regexp_replace(msa, '\.0+$', '') AS msa,
  property_name, insurance_type, security_interest_rate, original_principal_balance,
  CAST(try_strptime(first_payment_date, '%Y%m%d') AS DATE) AS first_payment_date, seller_issuer_id, security_rpb,
  pre_payment_penalty_flag FROM ms""", {"ms": M_SQL}))
def _mf_static_build(t: Tables):
    return maintain.mf_static_build(mstg(t))
