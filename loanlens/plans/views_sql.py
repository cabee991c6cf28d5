"""The adapter views as SQL text, for the DuckDB oracle.

These mirror :mod:`loanlens.plans.adapter` exactly.  ``with_views(body)``
prefixes the query with the CTEs it mentions (and their dependencies), so each
oracle string runs on the raw driver tables.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "loan_static": """
SELECT o.o_orderkey AS loan_id, o.o_custkey % 10 AS issuer_id, n.n_name AS state_code,
  CASE o.o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'V' ELSE 'R' END AS agency,
  CAST(o.o_totalprice AS DECIMAL(14,2)) AS original_principal_balance,
  CAST(2 + (o.o_orderkey % 600) / CAST(100 AS DECIMAL(6,3)) AS DECIMAL(6,3)) AS loan_interest_rate,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE 600 + o.o_orderkey % 220 END AS credit_score,
  CASE WHEN o.o_custkey % 19 = 0 THEN NULL ELSE 60 + o.o_custkey % 41 END AS ltv,
  CASE WHEN c.c_mktsegment IN ('BUILDING','HOUSEHOLD') THEN 'Y' ELSE 'N' END AS first_time_home_buyer,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Y' ELSE 'N' END AS down_payment_assistance,
  CAST(o.o_orderdate AS DATE) AS loan_origination_date
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "loan_monthly": """
SELECT loan_id, report_date, issuer_id, unpaid_principal_balance, months_delinquent, current_month_liquidation, removal_reason
FROM (SELECT l_orderkey AS loan_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS report_date, l_suppkey AS issuer_id,
    CAST(l_extendedprice AS DECIMAL(14,2)) AS unpaid_principal_balance,
    greatest(l_linenumber - 4, 0) AS months_delinquent,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS current_month_liquidation,
    CASE WHEN l_returnflag = 'R' THEN 1 + l_linenumber % 6 END AS removal_reason,
    row_number() OVER (PARTITION BY l_orderkey, date_trunc('month', l_shipdate)
      ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag) AS rn
  FROM lineitem) x WHERE rn = 1""",
    "econ": """
SELECT n.n_name AS state, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS report_date,
  CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100 AS unemployment_rate,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / COUNT(*) AS hpi_index
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name, CAST(date_trunc('month', o.o_orderdate) AS DATE)""",
    "issuer_info": """
SELECT s.s_suppkey AS issuer_number, s.s_name AS issuer_name, n.n_name AS citystate,
  CASE WHEN s.s_suppkey % 4 = 0 THEN 'No Subservicer' ELSE CAST(s.s_suppkey % 4 AS VARCHAR) END AS subservicer,
  CASE WHEN s.s_suppkey % 5 = 0 THEN 'Mega' WHEN s.s_suppkey % 5 = 1 THEN 'Large' WHEN s.s_suppkey % 5 = 2 THEN 'Medium' ELSE 'Small' END AS issuer_group
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "issuers": """
SELECT issuer_number, issuer_name, citystate, issuer_group FROM issuer_info""",
    "subservicers": """
SELECT DISTINCT CAST(n_regionkey AS VARCHAR) AS subservicer_id, concat('Subservicer ', CAST(n_regionkey AS VARCHAR)) AS subservicer_name FROM nation""",
    "pool_loans": """
SELECT m.loan_id AS cusip, CAST(year(m.report_date) * 100 + month(m.report_date) AS VARCHAR) AS as_of_date,
  m.issuer_id AS issuer_number, t.state_code AS property_state, m.months_delinquent, m.unpaid_principal_balance,
  t.original_principal_balance, m.current_month_liquidation, m.removal_reason, t.loan_interest_rate,
  CASE WHEN m.loan_id % 7 = 0 THEN '' WHEN m.loan_id % 7 = 1 THEN NULL ELSE CAST(10000 + m.loan_id % 50 AS VARCHAR) END AS msa,
  CASE t.agency WHEN 'F' THEN 'PL' WHEN 'V' THEN 'PN' ELSE 'CL' END AS pool_type,
  t.loan_origination_date AS first_payment_date, m.report_date AS loan_maturity_date
FROM loan_monthly m JOIN loan_static t ON t.loan_id = m.loan_id""",
    "new_issuance": """
SELECT t.*, CAST(date_trunc('month', t.loan_origination_date) AS DATE) AS as_of_date FROM loan_static t
WHERE t.loan_origination_date >= DATE '2001-01-01'""",
    "risk": """
SELECT m.report_date AS reporting_date, t.state_code AS property_state, year(t.loan_origination_date) AS orig_year,
  CASE WHEN t.credit_score < 640 THEN '<640' WHEN t.credit_score < 680 THEN '640-679' WHEN t.credit_score < 740 THEN '680-739' WHEN t.credit_score >= 740 THEN '740+' END AS fico_bucket,
  CASE WHEN t.ltv <= 80 THEN '<=80' WHEN t.ltv <= 90 THEN '80-90' WHEN t.ltv <= 95 THEN '90-95' WHEN t.ltv > 95 THEN '95+' END AS ltv_bucket,
  COUNT(*) AS loan_count,
  CAST(SUM(CASE WHEN m.months_delinquent >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS dlq30,
  CAST(SUM(CASE WHEN m.months_delinquent >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS dlq90
FROM loan_monthly m JOIN loan_static t ON t.loan_id = m.loan_id
GROUP BY 1, 2, 3, 4, 5""",
    "alerts": """
SELECT e.event_id, e.ts, concat('NATION_', CAST(e.user_id % 25 AS VARCHAR)) AS state,
  CASE e.event_type WHEN 'error' THEN 'hurricane' WHEN 'click' THEN 'flood' WHEN 'view' THEN 'flood' ELSE 'earthquake' END AS scenario_type,
  CASE WHEN e.value >= 100 THEN 'severe' WHEN e.value >= 50 THEN 'moderate' ELSE 'mild' END AS severity
FROM events e""",
    "declarations": """
SELECT e.event_id AS disaster_number, concat('NATION_', CAST(e.user_id % 25 AS VARCHAR)) AS state,
  CAST(CAST(e.ts AS DATE) - INTERVAL 300 MONTH AS DATE) AS declaration_date,
  CASE e.event_type WHEN 'error' THEN 'Hurricane' WHEN 'click' THEN 'Flood' WHEN 'view' THEN 'Severe Storm(s)'
    WHEN 'purchase' THEN 'Fire' ELSE 'Tornado' END AS incident_type,
  CASE WHEN e.value >= 50 THEN 'DR' ELSE 'EM' END AS declaration_type,
  concat(CASE e.event_type WHEN 'error' THEN 'Hurricane' WHEN 'click' THEN 'Flood' WHEN 'view' THEN 'Severe Storm(s)'
    WHEN 'purchase' THEN 'Fire' ELSE 'Tornado' END, ' - ', concat('NATION_', CAST(e.user_id % 25 AS VARCHAR))) AS declaration_title
FROM events e""",
}

_ORDER = list(VIEWS)


def _deps(name: str) -> set[str]:
    body = VIEWS[name]
    return {v for v in VIEWS if v != name and re.search(rf"\b{v}\b", body)}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the adapter CTEs it references (transitively).

    ``extra`` adds query-local CTEs (name -> SQL) placed after the views.
    """
    text = body + " ".join((extra or {}).values())
    need: set[str] = set()
    todo = [v for v in VIEWS if re.search(rf"\b{v}\b", text)]
    while todo:
        v = todo.pop()
        if v in need:
            continue
        need.add(v)
        todo.extend(_deps(v))
    ctes = [f"{v} AS ({VIEWS[v]}\n)" for v in _ORDER if v in need]
    ctes += [f"{k} AS ({v}\n)" for k, v in (extra or {}).items()]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
