"""Registered source and sink queries (§2.1) with their oracles.

Text and JSON sources are exercised on files Spark lands from the driver tables
into the shared checkpoint folder (once per input fingerprint): disclosure
record files per month, a second-agency performance file, economic series CSVs,
declaration and alert JSON, an issuer ratio sheet.  Each query reads the landed
files back with the reader under test; the oracle computes the same rows
directly from the tables.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from loanlens.functions import rules
from loanlens.operators import reports
from loanlens.plans import fixtures
from loanlens.plans.adapter import Tables
from loanlens.plans.catalog import _PERF_SQL, UPB, Q, register
from loanlens.plans.catalog_maintain import FNMA_SQL, LL_SQL, LR_SQL, M_SQL, fnma, ll, lr, mstg
from loanlens.plans.sqlfrag import pct
from loanlens.session import scratch_path, shuffles_dropped
from loanlens.sources import feeds, records, render, sinks
from loanlens.sources.layouts import FNMA_FIELDS, LL_FIELDS, LR_FIELDS, LR_KEPT, M_FIELDS, M_ISSUER_POSITIONS, N_FIELDS

US_CODES = sorted(set(rules.STATE_MAP.values()))
_US_LIST = "[" + ", ".join(f"'{c}'" for c in US_CODES) + "]"


def _landed_ll(t: Tables) -> str:
    """LL record files; the rows are dealt by month before they become lines."""
    def lines():
        static, monthly = t._by_loan()
        return render.to_lines(render.ll_staging(monthly, static, deal=_by_month(t, "m.report_date", "m.loan_id")), LL_FIELDS).withColumnRenamed("_file", "file")

    return _land(t, lines, t.landed("ll"))


def _landed_lr(t: Tables) -> str:
    def lines():
        static, monthly = t._by_loan()
        return render.to_lines(render.lr_staging(monthly, static, deal=_by_month(t, "m.report_date", "m.loan_id")), LR_FIELDS).withColumnRenamed("_file", "file")

    return _land(t, lines, t.landed("lr"))


def _by_month(t: Tables, *keys):
    """Deals narrow rows by month and key, so that a month's file gets few parts and no task more than its share."""
    return lambda rows: rows.repartitionByRange(t.write_tasks(), *keys)


def _once(spark, path: str, write) -> str:
    """Run ``write`` unless ``path`` is complete (its ``_SUCCESS`` marker is there)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        write()
    return path


FILES_OPEN = 256  # files that a task writes at once, without a sort of its lines


def _land(t: Tables, lines, path: str, compression: str = "none") -> str:
    """Text files of the frame that ``lines`` makes, one folder per ``file`` value if it has that column.

    Its rows come dealt by file; a task has few of them open at once and sorts no lines.
    """
    def write():
        with rendering(t.spark):
            df = lines()
            w = df.write.mode("overwrite").option("compression", compression)
            (w.partitionBy("file") if "file" in df.columns else w).text(path)

    return _once(t.spark, path, write)


@contextlib.contextmanager
def rendering(spark):
    """The session's settings while lines are rendered and written; their shuffles go when the write ends."""
    # HotSpot leaves methods of more than 8000 bytes uncompiled, and one that renders a wide record is longer
    conf, own = spark.conf, {"spark.sql.maxConcurrentOutputFileWriters": FILES_OPEN, "spark.sql.codegen.hugeMethodLimit": 8000}
    was = {name: conf.get(name, None) for name in own}
    for name, value in own.items():
        conf.set(name, str(value))
    try:
        with shuffles_dropped(spark):
            yield
    finally:
        for name, value in was.items():
            conf.set(name, value) if value is not None else conf.unset(name)


def _n_staging(t: Tables):
    p = t.pool_loans
    lid = F.col("cusip")
    vals = {"record_type": F.lit("N"), "cusip": F.concat(F.lit("36"), lid.cast("string")),
            "pool_number": F.concat(F.lit("P"), (lid % 1000).cast("string")), "pool_indicator": F.lit("X"),
            "pool_type": F.col("pool_type"), "disclosure_seq_number": lid.cast("string"),
            "effective_date": F.date_format("loan_maturity_date", "yyyyMMdd"),
            "security_interest_rate": F.col("loan_interest_rate").cast("string"),
            "mortgage_interest_rate": (F.col("loan_interest_rate") + F.lit(1).cast("decimal(6,3)")).cast("string"),
            "principal_and_interest": (F.col(UPB) * 2).cast("string")}
    return p.select(*[F.coalesce(vals[f], F.lit("")).alias(f) for f in N_FIELDS],
                    F.concat(F.lit("mfplmon1_"), F.col("as_of_date")).alias("file"))


def _landed_mf(t: Tables) -> str:
    """Multifamily record files, M and N records in a file; gzipped, as the lines are mostly separators."""
    def lines():
        m = render.m_staging(t.pool_loans, t.issuer_info, deal=_by_month(t, "p.as_of_date", "p.cusip"))
        m = m.withColumn("_file", F.concat(F.lit("mfplmon1_"), F.col("as_of_date")))
        n = _n_staging(t).withColumnRenamed("file", "_file")  # pool_loans are stored by month
        return render.to_lines(m, M_FIELDS).unionByName(render.to_lines(n, N_FIELDS)).withColumnRenamed("_file", "file")

    return _land(t, lines, t.landed("mf"), compression="gzip")


# ---------------------------------------------------------------------------------
# Disclosure record files
# ---------------------------------------------------------------------------------

LL_USED = ["disclosure_sequence_number", "issuer_id", "agency", "loan_interest_rate", "original_principal_balance",
           "unpaid_principal_balance", "loan_age", "months_delinquent", "loan_to_value", "credit_score",
           "down_payment_assistance", "first_time_home_buyer", "state_code", "msa", "as_of_date",
           "loan_origination_date", "seller_issuer_id", "current_month_liquidation_flag", "removal_reason"]


@register("src_record_file", Q("""
SELECT disclosure_sequence_number, as_of_date, unpaid_principal_balance, credit_score, msa, report_date, 'loans' AS file_type
FROM ll""", {"ll": LL_SQL}))
def _src_record_file(t: Tables):
    path = _landed_ll(t)
    r = records.read_records(t.spark, path, "LL", LL_FIELDS)
    return r.join(F.broadcast(records.file_months(t.spark, path)), "source").select(
        "disclosure_sequence_number", "as_of_date", "unpaid_principal_balance", "credit_score", "msa", "report_date", "file_type")


@register("src_layout_ll", Q(f"SELECT {', '.join(LL_USED)} FROM ll", {"ll": LL_SQL}))
def _src_layout_ll(t: Tables):
    return records.read_records(t.spark, _landed_ll(t), "LL", LL_FIELDS, LL_USED).drop("source")


@register("src_layout_lr", Q(f"SELECT {', '.join(LR_KEPT)}, report_date FROM lr", {"lr": LR_SQL}))
def _src_layout_lr(t: Tables):
    path = _landed_lr(t)
    r = records.read_records(t.spark, path, "LR", LR_FIELDS, LR_KEPT)
    return r.join(F.broadcast(records.file_months(t.spark, path).drop("file_type")), "source").drop("source")


_M_LOAN = ["disclosure_sequence_number", "issuer_number", "unpaid_principal_balance", "months_delinquent",
           "property_state", "msa", "as_of_date", "first_payment_date", "maturity_date_of_loan"]


@register("src_layout_m", Q(f"SELECT {', '.join(_M_LOAN)} FROM ms", {"ms": M_SQL}))
def _src_layout_m(t: Tables):
    return records.read_records(t.spark, _landed_mf(t), "M", M_FIELDS, _M_LOAN).drop("source")


_M_ISSUER = [M_FIELDS[i] for i in M_ISSUER_POSITIONS]


@register("src_layout_m_issuers", Q(f"""
SELECT DISTINCT CAST(p.issuer_number AS VARCHAR) AS issuer_number, i.issuer_name, CAST(NULL AS VARCHAR) AS issuer_address_1,
  CAST(NULL AS VARCHAR) AS issuer_address_2, CAST(NULL AS VARCHAR) AS issuer_city, i.citystate AS issuer_state,
  CAST(NULL AS VARCHAR) AS issuer_zip_code_1, CAST(NULL AS VARCHAR) AS issuer_zip_code_2
FROM pool_loans p LEFT JOIN issuer_info i ON i.issuer_number = p.issuer_number"""))
def _src_layout_m_issuers(t: Tables):
    from loanlens.operators.maintain import m_issuer_rows

    r = records.read_records(t.spark, _landed_mf(t), "M", M_FIELDS)
    return m_issuer_rows(r)


@register("src_layout_n", Q(f"""
SELECT '36' || CAST(cusip AS VARCHAR) AS cusip, 'P' || CAST(cusip % 1000 AS VARCHAR) AS pool_number, 'X' AS pool_indicator,
  pool_type, CAST(cusip AS INTEGER) AS disclosure_seq_number, loan_maturity_date AS effective_date,
  CAST(loan_interest_rate AS DOUBLE) AS security_interest_rate, CAST(loan_interest_rate + 1 AS DOUBLE) AS mortgage_interest_rate,
  CAST({UPB} * 2 AS DOUBLE) AS principal_and_interest FROM pool_loans"""))
def _src_layout_n(t: Tables):
    from loanlens.functions.clean import blank_null, parse_date, parse_int, parse_num

    r = records.read_records(t.spark, _landed_mf(t), "N", N_FIELDS)
    return r.select(blank_null("cusip").alias("cusip"), blank_null("pool_number").alias("pool_number"),
                    blank_null("pool_indicator").alias("pool_indicator"), blank_null("pool_type").alias("pool_type"),
                    parse_int("disclosure_seq_number").alias("disclosure_seq_number"),
                    parse_date("effective_date").alias("effective_date"),
                    parse_num("security_interest_rate").alias("security_interest_rate"),
                    parse_num("mortgage_interest_rate").alias("mortgage_interest_rate"),
                    parse_num("principal_and_interest").alias("principal_and_interest"))


_FNMA_USED = ["loan_identifier", "monthly_reporting_period", "servicer_name", "current_interest_rate",
              "current_actual_upb", "loan_age", "remaining_months_to_maturity", "current_loan_delinquency_status",
              "property_state", "origination_date", "borrower_credit_score_at_origination"]


@register("src_fnma_perf", Q(f"SELECT {', '.join(_FNMA_USED)} FROM fs", {
    "perf": _PERF_SQL, "fs": FNMA_SQL}))
def _src_fnma_perf(t: Tables):
    s = fnma(t)
    # five trailing columns past the 50 kept, as in the full file
    line = F.concat(F.concat_ws("|", *[F.coalesce(F.col(f), F.lit("")) for f in FNMA_FIELDS]), F.lit("|x|y|z|w|v"))
    path = _land(t, lambda: s.select(line.alias("value")), t.landed("fnma"))
    return feeds.read_fnma_perf(t.spark, path).select(*_FNMA_USED)


def _landed_ll_zip(t: Tables) -> str:
    """The landed LL record files, each part packed into a zip archive with a small readme member."""
    path, spark = t.landed("ll_zip"), t.spark

    def pack():
        fixtures.pack_zip_archives(spark, _landed_ll(t), path, member_note="loan-level disclosure records, pipe delimited")
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()

    return _once(spark, path, pack)


@register("src_zip_member", Q("""
SELECT disclosure_sequence_number, as_of_date, unpaid_principal_balance, credit_score, msa, report_date, 'loans' AS file_type
FROM ll""", {"ll": LL_SQL}))
def _src_zip_member(t: Tables):
    path = _landed_ll_zip(t)
    r = records.parse_records(records.read_zip_members(t.spark, path), "LL", LL_FIELDS)
    return r.join(F.broadcast(records.file_months(t.spark, path, source="path")), "source").select(
        "disclosure_sequence_number", "as_of_date", "unpaid_principal_balance", "credit_score", "msa", "report_date", "file_type")


_MONTHS_SQL = """SELECT DISTINCT 'loans' AS file_type, report_date FROM loan_monthly
UNION SELECT DISTINCT 'liquidations', report_date FROM loan_monthly WHERE current_month_liquidation = 'Y'"""


@register("src_report_month", Q(_MONTHS_SQL))
def _src_report_month(t: Tables):
    # file names come from a listing, not from the lines
    files = records.list_files(t.spark, [_landed_ll(t), _landed_lr(t)]).select(F.col("path").alias("source"))
    return records.classify_required(files).select("file_type", "report_date").distinct()


_INBOX_SQL = """SELECT 'loans' AS file_type, report_date, strftime(report_date, '%Y%m') AS month FROM loan_monthly GROUP BY report_date
UNION ALL SELECT 'liquidations', report_date, strftime(report_date, '%Y%m') FROM loan_monthly
WHERE current_month_liquidation = 'Y' GROUP BY report_date"""


@register("src_inbox", Q(f"""SELECT file_type, report_date, CASE WHEN file_type = 'liquidations' THEN 'flat'
  WHEN CAST(right(month, 2) AS INTEGER) % 3 = 0 THEN 'zip' ELSE 'nested' END AS place, CAST(1 AS BIGINT) AS listed FROM ({_INBOX_SQL}) f"""))
def _src_inbox(t: Tables):
    """Every file of an inbox with flat, nested and zipped files is listed once."""
    files = records.inbox_files(t.spark, fixtures.inbox(t))
    place = F.when(F.lower("file_name").endswith(".zip"), "zip").when(F.col("depth") == 1, "flat").otherwise("nested")
    g = files.groupBy("file_type", "report_date", place.alias("place")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("path").alias("d"))
    return g.select("file_type", "report_date", "place", F.expr("n div d").alias("listed"))


@register("src_new_issuance", Q("""
SELECT disclosure_sequence_number, unpaid_principal_balance, state_code, DATE '2001-12-01' AS as_of_date FROM ll
WHERE report_date >= DATE '2001-01-01'""", {"ll": LL_SQL}))
def _src_new_issuance(t: Tables):
    r = feeds.read_new_issuance(t.spark, _landed_ll(t), as_of="2001-12-01", since="2001-01-01")
    return r.select("disclosure_sequence_number", "unpaid_principal_balance", "state_code", "as_of_date")


# ---------------------------------------------------------------------------------
# Economic series, declarations, alerts, ratio sheet
# ---------------------------------------------------------------------------------


def _landed_econ(t: Tables) -> tuple[str, str]:
    e = t.econ
    bad = (F.year("report_date") == 1999) & (F.month("report_date") == 7)
    ur = e.select(F.concat("state", F.lit("UR")).alias("series"),
                  F.date_format("report_date", "yyyy-MM-dd").alias("observation_date"),
                  F.when(bad, F.lit(".")).otherwise(F.col("unemployment_rate").cast("string")).alias("value"))
    hpi = e.filter(F.month("report_date").isin(3, 6, 9, 12)).select(
        F.concat("state", F.lit("STHPI")).alias("series"),
        F.date_format("report_date", "yyyy-MM-dd").alias("observation_date"),
        F.col("hpi_index").cast("string").alias("value"))
    out = []
    for name, df in (("ur", ur), ("hpi", hpi)):
        path = t.landed(f"econ_{name}")
        _once(t.spark, path, lambda df=df, path=path: df.write.mode("overwrite").partitionBy("series").option("header", "true").csv(path))
        out.append(path)
    return out[0], out[1]


@register("src_econ", Q("""
SELECT u.report_date, u.state, CASE WHEN year(u.report_date) = 1999 AND month(u.report_date) = 7 THEN NULL ELSE u.unemployment_rate END AS unemployment_rate,
  last_value(h.hpi_index IGNORE NULLS) OVER (PARTITION BY u.state ORDER BY u.report_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hpi_index, CAST(NULL AS DECIMAL(5,3)) AS mortgage_rate_30yr
FROM econ u LEFT JOIN (SELECT state, report_date, hpi_index FROM econ WHERE month(report_date) IN (3, 6, 9, 12)) h
  ON h.state = u.state AND h.report_date = u.report_date"""))
def _src_econ(t: Tables):
    ur, hpi = _landed_econ(t)
    return feeds.read_econ(t.spark, ur, hpi)


def _landed_declarations(t: Tables) -> str:
    d = t.declarations
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'00:00:00.000'Z'")
    rec = d.select(F.expr("disaster_number div 3").alias("disasterNumber"), F.col("state").alias("stateCode"),
                   iso(F.col("declaration_date")).alias("declarationDate"), F.col("incident_type").alias("incidentType"),
                   F.col("declaration_title").alias("declarationTitle"),
                   iso(F.col("declaration_date")).alias("incidentBeginDate"),
                   F.when(F.col("declaration_type") == "DR", iso(F.date_add("declaration_date", 10))).alias("incidentEndDate"),
                   F.col("declaration_type").alias("declarationType"))
    path = t.landed("declarations")
    _once(t.spark, path, lambda: rec.write.mode("overwrite").json(path))
    return path


@register("src_disasters", Q("""
SELECT disaster_number, state, declaration_date, incident_type, declaration_title, incident_begin,
  COALESCE(incident_end, '') AS incident_end, declaration_type FROM (
  SELECT disaster_number // 3 AS disaster_number, state, strftime(declaration_date, '%Y-%m-%d') AS declaration_date,
    incident_type, declaration_title, strftime(declaration_date, '%Y-%m-%d') AS incident_begin,
    CASE WHEN declaration_type = 'DR' THEN strftime(declaration_date + 10, '%Y-%m-%d') END AS incident_end, declaration_type,
    row_number() OVER (PARTITION BY disaster_number // 3, state ORDER BY declaration_date DESC, declaration_title,
      declaration_type, CASE WHEN declaration_type = 'DR' THEN strftime(declaration_date + 10, '%Y-%m-%d') END NULLS FIRST) AS rn
  FROM declarations WHERE declaration_date > DATE '1999-01-01') x WHERE rn = 1"""))
def _src_disasters(t: Tables):
    return feeds.read_disasters(t.spark, _landed_declarations(t), start_year=1999)


_EVENT_NAME = {("hurricane", "severe"): "Hurricane Warning", ("hurricane", "moderate"): "Hurricane Watch",
               ("hurricane", "mild"): "Tropical Storm Warning", ("flood", "severe"): "Flash Flood Warning",
               ("flood", "moderate"): "Flood Warning", ("flood", "mild"): "Flash Flood Watch",
               ("earthquake", "severe"): "Earthquake Warning"}
_DESC = "Heavy weather expected in the area. " * 8


def _landed_alerts(t: Tables) -> str:
    a = t.alerts.withColumn("_k", F.regexp_extract("state", r"(\d+)$", 1).cast("int"))
    code = F.element_at(F.array(*[F.lit(c) for c in US_CODES]), F.col("_k") + 1)
    ev = None
    for (s, v), name in _EVENT_NAME.items():
        c = (F.col("scenario_type") == s) & (F.col("severity") == v)
        ev = F.when(c, name) if ev is None else ev.when(c, name)
    ev = ev.otherwise("Special Weather Statement")
    props = F.struct(ev.alias("event"),
                     F.struct(F.array(F.concat(code, F.lit("Z001")), F.concat(code, F.lit("C003")),
                                      F.lit("XXZ001")).alias("UGC")).alias("geocode"),
                     code.alias("areaDesc"), F.concat(ev, F.lit(" for "), code).alias("headline"),
                     F.lit(_DESC).alias("description"), F.lit("Immediate").alias("urgency"),
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("onset"),
                     F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss").alias("expires"))
    rec = a.select(F.concat(F.lit("urn:alert:"), F.col("event_id").cast("string")).alias("id"), props.alias("properties"))
    path = t.landed("alerts")
    _once(t.spark, path, lambda: rec.write.mode("overwrite").json(path))
    return path


def _event_case_sql() -> str:
    parts = " ".join(f"WHEN scenario_type = '{s}' AND severity = '{v}' THEN '{n}'" for (s, v), n in _EVENT_NAME.items())
    return f"CASE {parts} ELSE 'Special Weather Statement' END"


@register("src_alerts", Q(f"""
SELECT event, scenario_type, severity, state, headline, description, urgency, onset, expires, id FROM (
  SELECT event, scenario_type, severity, code AS state, event || ' for ' || code AS headline,
    left('{_DESC}', 200) AS description, 'Immediate' AS urgency, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS onset,
    strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS expires, 'urn:alert:' || CAST(event_id AS VARCHAR) AS id,
    row_number() OVER (PARTITION BY scenario_type, severity, code ORDER BY strftime(ts, '%Y-%m-%dT%H:%M:%S'),
      'urn:alert:' || CAST(event_id AS VARCHAR)) AS rn
  FROM (SELECT *, {_US_LIST}[CAST(regexp_extract(state, '(\\d+)$', 1) AS INTEGER) + 1] AS code,
    {_event_case_sql()} AS event FROM alerts) a
  WHERE event <> 'Special Weather Statement') x WHERE rn = 1"""))
def _src_alerts(t: Tables):
    return feeds.read_alerts(t.spark, _landed_alerts(t), rules.alert_event_table(t.spark))


def _ratio_text(num: str, den: str):
    """Exact 8-decimal text of num/den, truncated (integer arithmetic on both engines)."""
    v = f"(({num} * 100000000) div {den})"
    return F.concat(F.expr(f"{v} div 100000000").cast("string"), F.lit("."),
                    F.lpad(F.expr(f"{v} % 100000000").cast("string"), 8, "0"))


_RATIO_SQL = """SELECT CAST(issuer_id AS VARCHAR) AS id, report_date,
  {cols} FROM (SELECT issuer_id, report_date, COUNT(*) AS n,
  SUM(CASE WHEN months_delinquent >= 2 THEN 1 ELSE 0 END) AS c2, SUM(CASE WHEN months_delinquent >= 3 THEN 1 ELSE 0 END) AS c3,
  SUM(CASE WHEN months_delinquent > 0 THEN 1 ELSE 0 END) AS cp, SUM(CASE WHEN months_delinquent = 0 THEN 1 ELSE 0 END) AS cf
  FROM loan_monthly GROUP BY 1, 2) g"""


def _ratio_sql_col(c: str, alias: str) -> str:
    v = f"(({c} * 100000000) // n)"
    return (f"CAST(CAST({v} // 100000000 AS VARCHAR) || '.' || lpad(CAST({v} % 100000000 AS VARCHAR), 8, '0') "
            f"AS DECIMAL(18,8)) AS {alias}")


@register("src_dq_ratios", Q(_RATIO_SQL.format(cols=", ".join(
    _ratio_sql_col(c, a) for c, a in [("c2", "dq2"), ("c3", "dq3"), ("cp", "dqp"), ("cf", "fic")]))))
def _src_dq_ratios(t: Tables):
    m = t.loan_monthly
    md = F.col("months_delinquent")
    g = m.groupBy("issuer_id", "report_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(md >= 2, 1).otherwise(0)).alias("c2"),
        F.sum(F.when(md >= 3, 1).otherwise(0)).alias("c3"), F.sum(F.when(md > 0, 1).otherwise(0)).alias("cp"),
        F.sum(F.when(md == 0, 1).otherwise(0)).alias("cf"))
    sheet = g.select(F.col("issuer_id").cast("string").alias("ID"),
                     F.date_format("report_date", "yyyy-MM-dd").alias("Report Date"),
                     *[_ratio_text(c, "n").alias(a) for c, a in [("c2", "DQ2"), ("c3", "DQ3"), ("cp", "DQP"), ("cf", "FIC")]])
    path = t.landed("dq_ratios")
    _once(t.spark, path, lambda: sheet.write.mode("overwrite").option("header", "true").csv(path))
    return feeds.read_dq_ratios(t.spark, path)


# ---------------------------------------------------------------------------------
# Sinks (each run writes to a fresh path in the shared folder and reads it back)
# ---------------------------------------------------------------------------------

_PL_COLS = f"cusip, as_of_date, months_delinquent, {UPB}"


@register("src_mf_loans", Q(f"""
SELECT CAST(cusip AS VARCHAR) AS cusip, 'P' || CAST(cusip % 1000 AS VARCHAR) AS pool_number, 'X' AS pool_indicator, pool_type,
  loan_interest_rate AS security_interest_rate, CAST(issuer_number AS INTEGER) AS issuer_number, 'PN' AS loan_type, loan_interest_rate,
  {UPB}, CAST(months_delinquent AS INTEGER) AS months_delinquent, 'Property ' || CAST(cusip AS VARCHAR) AS property_name,
  CAST(NULL AS VARCHAR) AS property_street, CAST(NULL AS VARCHAR) AS property_city, property_state,
  CAST(10000 + cusip % 89999 AS VARCHAR) AS property_zip, loan_maturity_date AS report_date FROM pool_loans"""))
def _src_mf_loans(t: Tables):
    p, path = t.pool_loans, t.landed("mf_loans")
    lid = F.col("cusip")
    vals = {"CUSIP": lid, "Pool_Number": F.concat(F.lit("P"), (lid % 1000).cast("string")), "Pool_Indicator": F.lit("X"),
            "Pool_Type": F.col("pool_type"), "Security_Interest_Rate": F.col("loan_interest_rate"), "Issuer_Number": F.col("issuer_number"),
            "Loan_Type": F.lit("PN"), "Loan_Interest_Rate": F.col("loan_interest_rate"), "Unpaid_Principal_Balance": F.col(UPB),
            "Months_Delinquent": F.col("months_delinquent"), "Property_Name": F.concat(F.lit("Property "), lid.cast("string")),
            "Property_State": F.col("property_state"), "Property_Zip": 10000 + lid % 89999, "Report_Date": F.col("loan_maturity_date")}
    sheet = p.select(*[vals.get(c, F.lit("")).cast("string").alias(c) for c in feeds.MF_LOAN_COLUMNS])
    _once(t.spark, path, lambda: sheet.write.mode("overwrite").option("header", "true").csv(path))
    return feeds.read_mf_loans(t.spark, path)


@register("sink_append", Q(f"""SELECT {_PL_COLS} FROM pool_loans WHERE as_of_date < '199901'
UNION ALL SELECT {_PL_COLS} FROM pool_loans WHERE as_of_date >= '199806'"""))
def _sink_append(t: Tables):
    p = t.pool_loans.select("cusip", "as_of_date", "months_delinquent", UPB)
    path = scratch_path(t.spark, "sink-append")
    sinks.sink_append(p.filter(F.col("as_of_date") < "199901"), path)
    sinks.sink_append(p.filter(F.col("as_of_date") >= "199806"), path)
    return t.spark.read.parquet(path)


@register("sink_replace_all", Q(f"SELECT {_PL_COLS} FROM pool_loans WHERE as_of_date >= '199806'"))
def _sink_replace_all(t: Tables):
    p = t.pool_loans.select("cusip", "as_of_date", "months_delinquent", UPB)
    path = scratch_path(t.spark, "sink-replace")
    sinks.sink_replace_all(p.filter(F.col("as_of_date") < "199901"), path)
    sinks.sink_replace_all(p.filter(F.col("as_of_date") >= "199806"), path)
    return t.spark.read.parquet(path)


@register("sink_replace_partitions", Q(f"""
SELECT loan_id, issuer_id, {UPB}, months_delinquent, report_date FROM loan_monthly WHERE report_date <> DATE '2000-01-01'
UNION ALL SELECT loan_id, issuer_id, {UPB}, months_delinquent + 1, report_date FROM loan_monthly
WHERE report_date = DATE '2000-01-01' AND {UPB} > 30000"""))
def _sink_replace_partitions(t: Tables):
    m = t.loan_monthly.select("loan_id", "issuer_id", UPB, "months_delinquent", "report_date")
    path = scratch_path(t.spark, "sink-partitions")
    sinks.replace_partitions(m, path)
    redelivered = m.filter((F.col("report_date") == F.lit("2000-01-01").cast("date")) & (F.col(UPB) > 30000)) \
        .withColumn("months_delinquent", F.col("months_delinquent") + 1)
    sinks.replace_partitions(redelivered, path)
    return t.spark.read.parquet(path).select("loan_id", "issuer_id", UPB, "months_delinquent", "report_date")


@register("sink_csv_result", Q(f"""
SELECT property_state, COUNT(*) AS loan_count, CAST(SUM({UPB}) AS DECIMAL(38,2)) AS total_upb,
  {pct(f"SUM({UPB})", "(SELECT SUM(unpaid_principal_balance) FROM pool_loans)")} AS pct_of_total_upb,
  CAST(SUM(CASE WHEN months_delinquent > 0 THEN 1 ELSE 0 END) AS BIGINT) AS delinquent_loans,
  {pct("SUM(CASE WHEN months_delinquent > 0 THEN 1 ELSE 0 END)", "COUNT(*)")} AS delinquency_rate
FROM pool_loans GROUP BY property_state"""))
def _sink_csv_result(t: Tables):
    res = reports.geo_concentration(t.pool_loans, top=None)
    path = scratch_path(t.spark, "sink-csv")
    sinks.sink_csv_result(res, path)
    return t.spark.read.schema(res.schema).option("header", "true").csv(path)
