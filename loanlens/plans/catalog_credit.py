"""Registered credit (§2.8) and scenario (§2.9) queries with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanlens.functions import rules
from loanlens.operators import credit, reports, scenario
from loanlens.plans.adapter import Tables
from loanlens.plans.catalog import _REASONS_SQL, STATE, STATES, UPB, Q, register
from loanlens.plans.sqlfrag import cnt_if, money, pct
from loanlens.session import cut

SEVERITY = "moderate"
COMPARE_SCENARIO = "flood"

# ---------------------------------------------------------------------------------
# §2.8 transitions, impact, severity, calibration
# ---------------------------------------------------------------------------------

_CURE_AGGS = """COUNT(DISTINCT a.cusip) AS total_dq_loans,
  COUNT(DISTINCT CASE WHEN b.months_delinquent = 0 THEN a.cusip END) AS cured_loans,
  COUNT(DISTINCT CASE WHEN b.months_delinquent > a.months_delinquent THEN a.cusip END) AS worsened_loans,
  COUNT(DISTINCT CASE WHEN b.current_month_liquidation = 'Y' THEN a.cusip END) AS liquidated_loans"""
_CURE_JOIN = "FROM pool_loans a JOIN pool_loans b ON a.cusip = b.cusip AND b.as_of_date > a.as_of_date WHERE a.months_delinquent > 0"
_CURE_RATES = ", ".join(f"{pct(n, 'total_dq_loans')} AS {c}" for c, n in
                        [("cure_rate", "cured_loans"), ("worsen_rate", "worsened_loans"),
                         ("liquidation_rate", "liquidated_loans")])


@register("cure_rates", Q(f"SELECT *, {_CURE_RATES} FROM (SELECT {_CURE_AGGS} {_CURE_JOIN}) c"))
def _cure_rates(t: Tables):
    return credit.cure_rates(t.pool_loans)


@register("cure_rates_by_state", Q(f"""SELECT *, {_CURE_RATES} FROM (SELECT a.property_state, {_CURE_AGGS} {_CURE_JOIN}
  GROUP BY a.property_state) c"""))
def _cure_rates_by_state(t: Tables):
    return credit.cure_rates(t.pool_loans, by_state=True)


@register("cure_rates_state", Q(f"""SELECT *, {_CURE_RATES} FROM (SELECT {_CURE_AGGS} {_CURE_JOIN}
  AND a.property_state = '{STATE}') c"""))
def _cure_rates_state(t: Tables):
    return credit.cure_rates(t.pool_loans, state=STATE)


def _dr_events(t: Tables):
    return t.declarations.filter(F.col("declaration_type") == "DR").select(
        "state", F.col("disaster_number").alias("event_id"), F.col("declaration_date").alias("event_date"))


_DR_SQL = "SELECT state, disaster_number AS event_id, declaration_date AS event_date FROM declarations WHERE declaration_type = 'DR'"


@register("disaster_impact", Q(f"""
SELECT b.*, e.event_id, strftime(e.event_date, '%Y%m') AS event_month,
  CASE WHEN b.as_of_date <= strftime(e.event_date, '%Y%m') THEN 'pre' ELSE 'post' END AS period
FROM (SELECT property_state, as_of_date, COUNT(*) AS total_loans, {cnt_if('months_delinquent > 0')} AS dq_loans,
  CAST(COALESCE(SUM({UPB}), 0) AS DECIMAL(38,2)) AS total_upb,
  CAST(COALESCE(SUM(CASE WHEN months_delinquent > 0 THEN {UPB} ELSE 0 END), 0) AS DECIMAL(38,2)) AS dq_upb,
  {pct(cnt_if('months_delinquent > 0'), 'COUNT(*)', 4)} AS dq_rate
  FROM pool_loans GROUP BY 1, 2) b
JOIN ev e ON e.state = b.property_state
  AND CASE WHEN b.as_of_date <= strftime(e.event_date, '%Y%m') THEN b.as_of_date >= strftime(e.event_date - 90, '%Y%m')
    ELSE b.as_of_date <= strftime(e.event_date + 180, '%Y%m') END
JOIN (SELECT property_state AS st FROM pool_loans GROUP BY 1 HAVING COUNT(DISTINCT as_of_date) >= 2) n ON n.st = b.property_state""",
                              {"ev": _DR_SQL}))
def _disaster_impact(t: Tables):
    return credit.disaster_impact(t.pool_loans, _dr_events(t), bounded=True)


_BREAKDOWN_SQL = f"""SELECT g.removal_reason AS removal_code,
  COALESCE(r.removal_label, 'Code ' || CAST(g.removal_reason AS VARCHAR)) AS removal_reason,
  loan_count, total_original_balance, total_upb_at_removal
FROM (SELECT removal_reason, COUNT(*) AS loan_count, {money('original_principal_balance')} AS total_original_balance,
  {money(UPB)} AS total_upb_at_removal FROM pool_loans WHERE removal_reason IS NOT NULL AND removal_reason > 0
  GROUP BY removal_reason) g LEFT JOIN reasons r ON r.removal_code = g.removal_reason"""
_SEVERITY_SQL = f"""SELECT COALESCE(MAX(1 - CAST(total_upb_at_removal AS DOUBLE) / CAST(total_original_balance AS DOUBLE)),
  {rules.SEVERITY_DEFAULT}) AS loss_severity FROM bd WHERE removal_reason = 'Foreclosure' AND total_original_balance > 0"""


@register("loss_severity", Q(_SEVERITY_SQL, {"reasons": _REASONS_SQL, "bd": _BREAKDOWN_SQL}))
def _loss_severity(t: Tables):
    return credit.loss_severity(reports.removal_breakdown(t.pool_loans, rules.removal_reason_table(t.spark)))


def _templates_sql_grid() -> str:
    rows = ", ".join(f"('{s}', '{v}', {float(rules.CALIBRATION_DQ_MULTIPLIERS[v])})"
                     for s in rules.SCENARIO_TEMPLATES for v in rules.SEVERITIES)
    return f"SELECT * FROM (VALUES {rows}) AS g(scenario_type, severity, mult)"


def _rnd(x: str, d: int) -> str:
    p = float(10 ** d)
    return f"(sign(CAST({x} AS DOUBLE)) * floor(abs(CAST({x} AS DOUBLE)) * {p} + 0.5) / {p})"


_CALIB = {
    "reasons": _REASONS_SQL, "bd": _BREAKDOWN_SQL, "sev": _SEVERITY_SQL,
    "base": f"""SELECT property_state, {pct(cnt_if('months_delinquent > 0'), 'COUNT(*)', 4)} AS dq_rate FROM pool_loans
  GROUP BY property_state HAVING COUNT(*) >= 10""",
    "cure": f"SELECT *, {_CURE_RATES} FROM (SELECT {_CURE_AGGS} {_CURE_JOIN}) c",
    "k": f"""SELECT (SELECT COALESCE(AVG(dq_rate), 0.5) FROM base) AS avg_rate,
  COALESCE((SELECT CASE WHEN total_dq_loans > 0 THEN cure_rate / 100 END FROM cure), {rules.CURE_DEFAULT}) AS cure,
  (SELECT loss_severity FROM sev) AS sev, (SELECT COUNT(DISTINCT as_of_date) FROM pool_loans) AS months_of_data""",
    "grid": _templates_sql_grid(),
}


@register("calibrated_templates", Q(f"""
SELECT g.scenario_type, g.severity, {_rnd('k.avg_rate / 100 * g.mult', 4)} AS dq_increase,
  {_rnd("CASE WHEN g.severity = 'mild' THEN least(k.cure + 0.10, 0.80) WHEN g.severity = 'moderate' THEN k.cure ELSE greatest(k.cure - 0.20, 0.10) END", 2)} AS cure_rate,
  {_rnd('k.sev', 2)} AS loss_severity, k.months_of_data
FROM grid g, k WHERE k.months_of_data >= 12""", _CALIB))
def _calibrated_templates(t: Tables):
    reasons = rules.removal_reason_table(t.spark)
    return credit.calibrated_templates(t.pool_loans, reasons)


@register("calibration_report", Q(f"""
SELECT (SELECT COUNT(DISTINCT as_of_date) FROM pool_loans) AS months,
  (SELECT COUNT(DISTINCT as_of_date) FROM pool_loans) >= 7 AS ready,
  (SELECT COUNT(*) FROM pool_loans) AS total,
  (SELECT {pct("SUM(CASE WHEN months_delinquent <> 0 THEN 1 ELSE 0 END)", 'COUNT(*)')} FROM pool_loans) AS overall_dq_rate,
  (SELECT total_dq_loans FROM cure) AS dq_loans_tracked, (SELECT cure_rate FROM cure) AS cure_rate,
  (SELECT loss_severity FROM sev) AS foreclosure_severity,
  (SELECT COUNT(*) FROM declarations) AS declarations""", _CALIB))
def _calibration_report(t: Tables):
    rep = credit.calibration_report(t.pool_loans, rules.removal_reason_table(t.spark), t.declarations)
    # one-row sections read by two subqueries each: checkpoint them so the snapshot
    # scan and the per-loan cure window run once
    snap, cure = cut(rep["snapshot"]), cut(rep["cure"])
    sev = credit.loss_severity(rep["removals"])
    return rep["readiness"].select(
        "months", "ready", snap.select("total").scalar().alias("total"),
        snap.select("overall_dq_rate").scalar().alias("overall_dq_rate"),
        cure.select("total_dq_loans").scalar().alias("dq_loans_tracked"),
        cure.select("cure_rate").scalar().alias("cure_rate"),
        sev.select("loss_severity").scalar().alias("foreclosure_severity"),
        rep["disasters"].agg(F.sum("count")).scalar().alias("declarations"))


@register("disaster_frequency", Q("""SELECT incident_type, COUNT(*) AS count FROM declarations GROUP BY incident_type
ORDER BY count DESC, incident_type"""))
def _disaster_frequency(t: Tables):
    return credit.disaster_frequency(t.declarations)


@register("major_disasters", Q("""SELECT * FROM declarations WHERE declaration_type = 'DR'
ORDER BY declaration_date DESC, disaster_number, state LIMIT 5"""))
def _major_disasters(t: Tables):
    return credit.major_disasters(t.declarations)


# ---------------------------------------------------------------------------------
# §2.9 scenarios
# ---------------------------------------------------------------------------------


def _templates_sql() -> str:
    rows = []
    for name, (desc, dm, dmo, ds, cm, cmo, cs, sev, scope) in rules.SCENARIO_TEMPLATES.items():
        for severity, dq, cure in zip(rules.SEVERITIES, (dm, dmo, ds), (cm, cmo, cs)):
            rows.append(f"('{name}', '{desc}', '{severity}', CAST({dq} AS DOUBLE), CAST({cure} AS DOUBLE), "
                        f"CAST({sev} AS DOUBLE), '{scope}')")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(scenario_type, description, severity, dq_increase, "
            "cure_rate, loss_severity, affected_by)")


_EXPO = f"""COUNT(*) AS total_loans, CAST(COALESCE(SUM({UPB}), 0) AS DECIMAL(38,2)) AS total_upb,
  CAST(COALESCE(SUM(CASE WHEN months_delinquent > 0 THEN 1 ELSE 0 END), 0) AS BIGINT) AS current_dq_loans,
  CAST(COALESCE(SUM(CASE WHEN months_delinquent > 0 THEN {UPB} ELSE 0 END), 0) AS DECIMAL(38,2)) AS current_dq_upb"""
_WF = {
    "templates": _templates_sql(),
    "ex": f"""SELECT property_state AS state, 'state' AS scope, {_EXPO} FROM pool_loans GROUP BY property_state
  UNION ALL SELECT 'Nationwide', 'nationwide', {_EXPO} FROM pool_loans""",
    "wf0": f"""SELECT x.*, t.scenario_type, t.description, t.severity, t.dq_increase, t.cure_rate, t.loss_severity,
  CAST((SELECT COALESCE(SUM({UPB}), 0) FROM pool_loans) AS DOUBLE) AS book_upb,
  x.total_loans - x.current_dq_loans AS performing_loans,
  CAST(x.total_upb AS DOUBLE) - CAST(x.current_dq_upb AS DOUBLE) AS performing_upb
  FROM ex x JOIN templates t ON t.affected_by = x.scope""",
}
_WF_COLS = """SELECT *, CAST(floor(performing_loans * dq_increase) AS BIGINT) AS new_dq_loans,
  performing_upb * dq_increase AS new_dq_upb FROM {src}"""
_WF_TAIL = """SELECT *, CAST(floor(new_dq_loans * cure_rate) AS BIGINT) AS cured_loans, new_dq_upb * cure_rate AS cured_upb,
  new_dq_loans - CAST(floor(new_dq_loans * cure_rate) AS BIGINT) AS default_loans,
  new_dq_upb * (1 - cure_rate) AS default_upb, new_dq_upb * (1 - cure_rate) * loss_severity AS projected_losses,
  current_dq_loans + new_dq_loans AS total_dq_loans, CAST(current_dq_upb AS DOUBLE) + new_dq_upb AS total_dq_upb,
  CAST(total_upb AS DOUBLE) / NULLIF(book_upb, 0) * 100 AS pct_of_portfolio,
  CASE WHEN total_loans > 0 THEN CAST(current_dq_loans AS DOUBLE) / CAST(total_loans AS DOUBLE) * 100 ELSE 0.0 END AS current_dq_rate,
  CASE WHEN total_loans > 0 THEN CAST(current_dq_loans + new_dq_loans AS DOUBLE) / CAST(total_loans AS DOUBLE) * 100 ELSE 0.0 END AS projected_dq_rate,
  new_dq_upb * (1 - cure_rate) * loss_severity / NULLIF(book_upb, 0) * 100 AS portfolio_impact_pct FROM {src}"""
_WF.update({"wf1": _WF_COLS.format(src="wf0"), "grid": _WF_TAIL.format(src="wf1")})


def _grid(t: Tables):
    return scenario.loss_waterfall(t.pool_loans, scenario.scenario_templates(t.spark))


@register("loss_waterfall", Q("SELECT * FROM grid", _WF))
def _loss_waterfall(t: Tables):
    return _grid(t)


@register("scenario_all_for_state", Q(f"""SELECT * FROM grid WHERE state = '{STATE}' AND severity = '{SEVERITY}'
  AND scenario_type IN ({', '.join(repr(s) for s in rules.STATE_SCENARIOS)})""", _WF))
def _scenario_all_for_state(t: Tables):
    return scenario.scenario_all_for_state(_grid(t), state=STATE, severity=SEVERITY)


@register("scenario_compare_states", Q(f"""SELECT * FROM grid WHERE state IN ({', '.join(repr(s) for s in STATES)})
  AND scenario_type = '{COMPARE_SCENARIO}' AND severity = '{SEVERITY}'""", _WF))
def _scenario_compare_states(t: Tables):
    return scenario.scenario_compare_states(_grid(t), states=STATES, scenario=COMPARE_SCENARIO, severity=SEVERITY)


_WORST_SQL = """SELECT event_id, ts, state, scenario_type, severity FROM (SELECT *, row_number() OVER (
  PARTITION BY state, scenario_type ORDER BY CASE severity WHEN 'severe' THEN 3 WHEN 'moderate' THEN 2
  WHEN 'mild' THEN 1 END DESC, ts, event_id) AS rn FROM alerts) x WHERE rn = 1"""


@register("alert_worst", Q(_WORST_SQL))
def _alert_worst(t: Tables):
    return scenario.alert_worst(t.alerts)


@register("alert_scenarios", Q("""SELECT * FROM grid2""", {
    **_WF, "worst": _WORST_SQL,
    "ax": f"""SELECT w.state, w.scenario_type, w.severity, w.event_id, x.total_loans, x.total_upb, x.current_dq_loans,
  x.current_dq_upb, t.description, t.dq_increase, t.cure_rate, t.loss_severity, t.affected_by,
  CAST((SELECT COALESCE(SUM({UPB}), 0) FROM pool_loans) AS DOUBLE) AS book_upb,
  x.total_loans - x.current_dq_loans AS performing_loans,
  CAST(x.total_upb AS DOUBLE) - CAST(x.current_dq_upb AS DOUBLE) AS performing_upb
  FROM worst w JOIN ex x ON x.state = w.state AND x.scope = 'state' AND x.total_loans > 0
  JOIN templates t ON t.scenario_type = w.scenario_type AND t.severity = w.severity""",
    "ax1": _WF_COLS.format(src="ax"), "grid2": _WF_TAIL.format(src="ax1")}))
def _alert_scenarios(t: Tables):
    worst = scenario.alert_worst(t.alerts)
    return scenario.alert_scenarios(worst, t.pool_loans, scenario.scenario_templates(t.spark))


_STATE_MAP_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in sorted(rules.STATE_MAP.items())) + ") AS m(state_name, state_code)"


_STATE_NAMES = sorted(rules.STATE_MAP)
_STATE_CODES = [rules.STATE_MAP[n] for n in _STATE_NAMES]


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@register("resolve_state", Q(f"""
SELECT s.written, COALESCE(m.state_code, c.state_code) AS state_code FROM written s
LEFT JOIN sm m ON m.state_name = lower(trim(s.written))
LEFT JOIN (SELECT DISTINCT state_code FROM sm) c ON c.state_code = upper(trim(s.written))""",
                             {"sm": _STATE_MAP_SQL, "written": f"""SELECT DISTINCT CASE event_id % 6
  WHEN 0 THEN upper(name) WHEN 1 THEN '  ' || lower(code) || ' ' WHEN 2 THEN name WHEN 3 THEN code WHEN 4 THEN '  ' ELSE state END AS written
  FROM (SELECT *, {_sql_list(_STATE_NAMES)}[CAST(event_id % {len(_STATE_NAMES)} AS INTEGER) + 1] AS name,
    {_sql_list(_STATE_CODES)}[CAST(event_id % {len(_STATE_NAMES)} AS INTEGER) + 1] AS code FROM alerts) a"""}))
def _resolve_state(t: Tables):
    # names and codes in both cases, blanks and unknown words, by event
    e, at = F.col("event_id"), (F.col("event_id") % len(_STATE_NAMES)).cast("int") + 1
    name, code = (F.element_at(F.array(*[F.lit(v) for v in x]), at) for x in (_STATE_NAMES, _STATE_CODES))
    written = (F.when(e % 6 == 0, F.upper(name)).when(e % 6 == 1, F.concat(F.lit("  "), F.lower(code), F.lit(" ")))
               .when(e % 6 == 2, name).when(e % 6 == 3, code).when(e % 6 == 4, F.lit("  ")).otherwise(F.col("state")))
    return scenario.resolve_state(t.alerts.select(written.alias("written")).distinct(), "written", rules.state_map_table(t.spark))


@register("top_exposed", Q(f"""
SELECT * FROM (
  SELECT property_state AS state, 'issuer' AS kind, rank, issuer_name AS name, loan_count, issuer_upb AS upb FROM ti
  UNION ALL SELECT property_state, 'msa', rank, msa, loan_count, msa_upb FROM tm) u
WHERE state IN (SELECT state FROM grid WHERE state = '{STATE}')""", {
    **_WF,
    "ti": f"""SELECT * FROM (SELECT property_state, issuer_name, loan_count, issuer_upb,
  row_number() OVER (PARTITION BY property_state ORDER BY issuer_upb DESC, issuer_name) AS rank
  FROM (SELECT p.property_state, i.issuer_name, COUNT(*) AS loan_count, {money('p.' + UPB)} AS issuer_upb
        FROM pool_loans p JOIN issuers i ON p.issuer_number = i.issuer_number
        GROUP BY p.property_state, i.issuer_name) g) r WHERE rank <= 5""",
    "tm": f"""SELECT * FROM (SELECT property_state, msa, loan_count, msa_upb,
  row_number() OVER (PARTITION BY property_state ORDER BY msa_upb DESC, msa) AS rank
  FROM (SELECT property_state, msa, COUNT(*) AS loan_count, {money(UPB)} AS msa_upb
        FROM pool_loans WHERE msa IS NOT NULL AND msa != '' GROUP BY property_state, msa) g) r WHERE rank <= 5"""}))
def _top_exposed(t: Tables):
    states = t.pool_loans.filter(F.col("property_state") == STATE).select(F.col("property_state").alias("state")).distinct()
    return scenario.top_exposed(states, reports.top_issuers_in_state(t.pool_loans, t.issuers),
                                reports.top_msas_in_state(t.pool_loans))

