"""Registered panel (§2.6) and model / stress (§2.10) queries with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.operators import filters, joins, panel, regress, reports
from loanlens.plans.adapter import Tables
from loanlens.plans.catalog import (_BOOK_TIER, _PERF_SQL, _RISK_BOOK_SQL, _TIER_MIX_SQL, EXCLUDE, SHOCK_PRE, SHOCK_WINDOW,
                                    TRAIN_END, TREND_MONTHS, UPB, Q, register)
from loanlens.plans.sqlfrag import avg_d, cnt_if, money, pct, rnd
from loanlens.session import cut, scratch_path
from loanlens.sources import sinks

LEGACY = (1995, 1996)
LAG_UR, LAG_HPI = 5, 7
UNIFORM_SHOCK = 4.5
PERIODS = [("y2000", "2000-01-01", "2000-12-01"), ("from_2000_07", "2000-07-01", None)]
_EX = ", ".join(map(str, EXCLUDE))
_LEG = ", ".join(map(str, LEGACY))

# ---------------------------------------------------------------------------------
# Panels on the Spark side
# ---------------------------------------------------------------------------------


def state_panel(t: Tables):
    return regress.build_state_panel(regress.state_month(t.risk), t.econ, lag_ur=LAG_UR, lag_hpi=LAG_HPI, exclude=EXCLUDE,
                                     legacy=LEGACY)


def tier_panel(t: Tables):
    return regress.build_tier_panel(t.risk, t.econ, outcome="dlq90", lag_ur=LAG_UR, exclude=EXCLUDE)


def tier_train(t: Tables):
    return regress.train_test_split(tier_panel(t), train_end=TRAIN_END, cols=["dlq_chg", "ur_lag"])


def tier_fit(t: Tables):
    return regress.wls_tiered(tier_train(t)[0])


# ---------------------------------------------------------------------------------
# Panels in SQL
# ---------------------------------------------------------------------------------

_W = "(PARTITION BY property_state ORDER BY report_date)"
STATE_PANEL = {
    "sm": """SELECT reporting_date, property_state, orig_year, CAST(SUM(loan_count) AS BIGINT) AS loan_count,
  CAST(SUM(dlq30) AS BIGINT) AS dlq30, CAST(SUM(dlq90) AS BIGINT) AS dlq90 FROM risk GROUP BY 1, 2, 3""",
    "sp0": f"""SELECT g.*, e.unemployment_rate, e.hpi_index,
  CAST(g.dlq90 AS DOUBLE) / CAST(g.loan_count AS DOUBLE) * 100 AS dlq_rate,
  CAST(g.dlq30 AS DOUBLE) / CAST(g.loan_count AS DOUBLE) * 100 AS dlq30_rate,
  g.legacy_loans / g.loan_count * 100 AS legacy_share
FROM (SELECT property_state, reporting_date AS report_date,
  CAST(SUM(CASE WHEN orig_year NOT IN ({_EX}) OR orig_year IS NULL THEN loan_count END) AS BIGINT) AS loan_count,
  CAST(SUM(CASE WHEN orig_year NOT IN ({_EX}) OR orig_year IS NULL THEN dlq30 END) AS BIGINT) AS dlq30,
  CAST(SUM(CASE WHEN orig_year NOT IN ({_EX}) OR orig_year IS NULL THEN dlq90 END) AS BIGINT) AS dlq90,
  CAST(SUM(CASE WHEN orig_year IN ({_LEG}) THEN loan_count ELSE 0 END) AS BIGINT) AS legacy_loans
  FROM sm GROUP BY 1, 2) g
JOIN econ e ON e.state = g.property_state AND e.report_date = g.report_date WHERE g.loan_count IS NOT NULL""",
    "sp1": f"""SELECT *, dlq_rate - LAG(dlq_rate, 12) OVER {_W} AS dlq_chg,
  dlq30_rate - LAG(dlq30_rate, 12) OVER {_W} AS dlq30_chg,
  unemployment_rate - LAG(unemployment_rate, 12) OVER {_W} AS ur_chg,
  (CAST(hpi_index AS DOUBLE) / NULLIF(CAST(LAG(hpi_index, 12) OVER {_W} AS DOUBLE), 0) - 1) * 100 AS hpi_chg,
  legacy_share - LAG(legacy_share, 12) OVER {_W} AS legacy_chg FROM sp0""",
    "sp": f"""SELECT *, LAG(ur_chg, {LAG_UR}) OVER {_W} AS ur_lag, LAG(hpi_chg, {LAG_HPI}) OVER {_W} AS hpi_lag,
  LAG(hpi_chg, {LAG_HPI}) OVER {_W} * legacy_share / 100 AS hpi_x_legacy FROM sp1""",
}

_TW = "(PARTITION BY property_state, tier ORDER BY report_date)"
_TIER = """(CASE fico_bucket WHEN '<640' THEN '<680' WHEN '640-679' THEN '<680' WHEN '680-739' THEN '680-739'
  WHEN '740+' THEN '740+' END) || ' / ' || (CASE ltv_bucket WHEN '<=80' THEN '<=90' WHEN '80-90' THEN '<=90'
  WHEN '90-95' THEN '>90' WHEN '95+' THEN '>90' END)"""
TIER_PANEL = {
    "tp0": f"""SELECT g.*, e.unemployment_rate, e.hpi_index FROM (
  SELECT property_state, tier, reporting_date AS report_date, CAST(SUM(loan_count) AS BIGINT) AS loan_count,
    CAST(SUM(dlq30) AS BIGINT) AS dlq30, CAST(SUM(dlq90) AS BIGINT) AS dlq90
  FROM (SELECT *, {_TIER} AS tier FROM risk WHERE orig_year NOT IN ({_EX}) OR orig_year IS NULL) r
  WHERE tier IS NOT NULL GROUP BY 1, 2, 3) g
JOIN econ e ON e.state = g.property_state AND e.report_date = g.report_date""",
    "tgaps": f"""SELECT property_state, tier, CAST(SUM(CASE WHEN step > 31 THEN 1 ELSE 0 END) AS BIGINT) AS gaps FROM (
  SELECT property_state, tier, date_diff('day', LAG(report_date, 1) OVER {_TW}, report_date) AS step FROM tp0) x
  GROUP BY 1, 2""",
    "tp1": f"""SELECT *, CAST(dlq90 AS DOUBLE) / CAST(loan_count AS DOUBLE) * 100 AS dlq_rate FROM tp0 p
  WHERE NOT EXISTS (SELECT 1 FROM tgaps g WHERE g.gaps > 0 AND g.property_state = p.property_state AND g.tier = p.tier)""",
    "tp2": f"""SELECT *, dlq_rate - LAG(dlq_rate, 12) OVER {_TW} AS dlq_chg,
  unemployment_rate - LAG(unemployment_rate, 12) OVER {_TW} AS ur_chg FROM tp1""",
    "tp": f"SELECT *, LAG(ur_chg, {LAG_UR}) OVER {_TW} AS ur_lag FROM tp2",
    "ttr": f"SELECT * FROM tp WHERE dlq_chg IS NOT NULL AND ur_lag IS NOT NULL AND report_date <= DATE '{TRAIN_END}'",
    "tte": f"SELECT * FROM tp WHERE dlq_chg IS NOT NULL AND ur_lag IS NOT NULL AND report_date > DATE '{TRAIN_END}'",
    "tsums": """SELECT tier, SUM(loan_count) AS sw, SUM(loan_count * ur_lag) AS swx, SUM(loan_count * dlq_chg) AS swy,
  SUM(loan_count * ur_lag * ur_lag) AS swxx, SUM(loan_count * ur_lag * dlq_chg) AS swxy, COUNT(*) AS n FROM ttr GROUP BY tier""",
    "tfit0": """SELECT tier, sw, swx, n, sw * swxx - swx * swx AS d,
  (sw * swxy - swx * swy) / (sw * swxx - swx * swx) AS beta, swy AS swy FROM tsums""",
    "tfit1": "SELECT tier, sw, swx, n, d, beta, (swy - beta * swx) / sw AS intercept FROM tfit0",
    "tper": """SELECT r.tier, r.property_state, SUM(r.loan_count * r.e) AS a, SUM(r.loan_count * r.e * r.ur_lag) AS b FROM (
  SELECT x.*, x.dlq_chg - f.intercept - f.beta * x.ur_lag AS e FROM ttr x JOIN tfit1 f ON f.tier = x.tier) r GROUP BY 1, 2""",
    "tvar": """SELECT p.tier, SUM(pow((p.b * f.sw - p.a * f.swx) / f.d, 2)) AS v FROM tper p JOIN tfit1 f ON f.tier = p.tier
  GROUP BY 1""",
    "tfit": """SELECT f.tier, f.intercept, f.beta, sqrt(v.v * ((SELECT CAST(COUNT(DISTINCT property_state) AS DOUBLE) FROM ttr)
    / ((SELECT COUNT(DISTINCT property_state) FROM ttr) - 1) * (((SELECT COUNT(*) FROM ttr) - 1)
    / ((SELECT COUNT(*) FROM ttr) - 2 * (SELECT COUNT(*) FROM tsums))))) AS se, f.n
  FROM tfit1 f LEFT JOIN tvar v ON v.tier = f.tier""",
    "tbase": "SELECT tier, SUM(loan_count * dlq_chg) / SUM(loan_count) AS base FROM ttr GROUP BY tier",
    "tpred": """SELECT x.*, f.intercept + f.beta * x.ur_lag AS pred, b.base AS pred_base FROM tte x
  LEFT JOIN tfit f ON f.tier = x.tier LEFT JOIN tbase b ON b.tier = x.tier""",
    "tcmp": """SELECT report_date, SUM(dlq_chg * loan_count) / SUM(loan_count) AS actual,
  SUM(pred * loan_count) / SUM(loan_count) AS predicted, SUM(pred_base * loan_count) / SUM(loan_count) AS pred_base
  FROM tpred GROUP BY report_date""",
}


def _state(body: str, extra: dict | None = None) -> str:
    return Q(body, {**STATE_PANEL, **(extra or {})})


def _tier(body: str, extra: dict | None = None) -> str:
    return Q(body, {**TIER_PANEL, **(extra or {})})


SP_COLS = ["property_state", "report_date", "loan_count", "dlq30", "dlq90", "legacy_loans", "unemployment_rate",
           "hpi_index", "dlq_rate", "legacy_share", "dlq_chg", "ur_chg", "hpi_chg", "legacy_chg", "ur_lag", "hpi_lag",
           "hpi_x_legacy", "dlq30_rate", "dlq30_chg"]


@register("build_panel", _state(f"SELECT {', '.join(SP_COLS)} FROM sp"))
def _build_panel(t: Tables):
    return state_panel(t).select(*SP_COLS)


TP_COLS = ["property_state", "tier", "report_date", "loan_count", "dlq30", "dlq90", "unemployment_rate", "hpi_index",
           "dlq_rate", "dlq_chg", "ur_chg", "ur_lag"]


@register("build_panel_tier", _tier(f"SELECT {', '.join(TP_COLS)} FROM tp"))
def _build_panel_tier(t: Tables):
    return tier_panel(t).select(*TP_COLS)


@register("diff_12", _state("SELECT property_state, report_date, dlq_rate, dlq_chg, ur_chg FROM sp"))
def _diff_12(t: Tables):
    return state_panel(t).select("property_state", "report_date", "dlq_rate", "dlq_chg", "ur_chg")


@register("pct_change_12", _state("SELECT property_state, report_date, hpi_index, hpi_chg FROM sp"))
def _pct_change_12(t: Tables):
    return state_panel(t).select("property_state", "report_date", "hpi_index", "hpi_chg")


@register("shift_lag", _state("SELECT property_state, report_date, ur_chg, ur_lag, hpi_lag FROM sp"))
def _shift_lag(t: Tables):
    return state_panel(t).select("property_state", "report_date", "ur_chg", "ur_lag", "hpi_lag")


@register("legacy_share", _state("SELECT property_state, report_date, legacy_loans, legacy_share, legacy_chg FROM sp"))
def _legacy_share(t: Tables):
    return state_panel(t).select("property_state", "report_date", "legacy_loans", "legacy_share", "legacy_chg")


@register("interaction", _state("SELECT property_state, report_date, hpi_x_legacy FROM sp"))
def _interaction(t: Tables):
    return state_panel(t).select("property_state", "report_date", "hpi_x_legacy")


@register("period_slice", _state(f"""SELECT property_state, report_date, dlq_chg, ur_lag FROM sp
WHERE report_date >= DATE '1998-01-01' AND report_date <= DATE '{TRAIN_END}'"""))
def _period_slice(t: Tables):
    return filters.period_slice(state_panel(t), "1998-01-01", TRAIN_END).select(
        "property_state", "report_date", "dlq_chg", "ur_lag")


def _lagcorr_sql(y: str, x: str, max_lag: int, where: str) -> str:
    parts = [f"SELECT {k} AS lag, corr({y}, x{k}) AS corr FROM lc" for k in range(max_lag + 1)]
    lags = ", ".join(f"LAG({x}, {k}) OVER {_W} AS x{k}" for k in range(max_lag + 1))
    return _state(" UNION ALL ".join(parts), {"lc": f"SELECT {y}, {lags} FROM sp WHERE {where}"})


@register("lag_correlation", _lagcorr_sql("dlq_chg", "ur_chg", 12, f"report_date <= DATE '{TRAIN_END}'"))
def _lag_correlation(t: Tables):
    p = filters.period_slice(state_panel(t), None, TRAIN_END)
    return panel.lag_correlation(p, y="dlq_chg", x="ur_chg", max_lag=12, lag_by=["property_state"])


@register("lag_correlation_hpi", _lagcorr_sql("dlq30_chg", "hpi_chg", 18, f"report_date <= DATE '{TRAIN_END}'"))
def _lag_correlation_hpi(t: Tables):
    p = filters.period_slice(state_panel(t), None, TRAIN_END)
    return panel.lag_correlation(p, y="dlq30_chg", x="hpi_chg", max_lag=18, lag_by=["property_state"])


_FC = ["ur_lag", "hpi_lag", "legacy_chg"]


@register("feature_correlation", _state(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM fc" for a in _FC for b in _FC),
    {"fc": f"SELECT * FROM sp WHERE {' AND '.join(c + ' IS NOT NULL' for c in _FC)} AND report_date <= DATE '{TRAIN_END}'"}))
def _feature_correlation(t: Tables):
    return panel.feature_correlation(filters.period_slice(state_panel(t), None, TRAIN_END), _FC)


def _tier_base(t: Tables):
    r = t.risk.withColumn("tier", rules.tier_from_buckets(F.col("fico_bucket"), F.col("ltv_bucket")))
    r = filters.exclude_vintages(r, EXCLUDE).filter(F.col("tier").isNotNull())
    pt = (r.groupBy("property_state", "tier", F.col("reporting_date").alias("report_date"))
          .agg(F.sum("loan_count").cast("bigint").alias("loan_count")))
    e = t.econ.select(F.col("state").alias("property_state"), "report_date")
    return pt.join(e, ["property_state", "report_date"])


@register("gap_count", _tier("SELECT * FROM tgaps"))
def _gap_count(t: Tables):
    return panel.gap_count(_tier_base(t), by=["property_state", "tier"])


@register("drop_gap_series", _tier("SELECT property_state, tier, report_date, loan_count FROM tp1"))
def _drop_gap_series(t: Tables):
    return panel.drop_gap_series(_tier_base(t), by=["property_state", "tier"])


@register("ffill", Q("""
SELECT u.state, u.report_date, u.unemployment_rate,
  last_value(h.hpi_index IGNORE NULLS) OVER (PARTITION BY u.state ORDER BY u.report_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hpi_index
FROM econ u LEFT JOIN (SELECT state, report_date, hpi_index FROM econ WHERE month(report_date) IN (3, 6, 9, 12)) h
  ON h.state = u.state AND h.report_date = u.report_date"""))
def _ffill(t: Tables):
    e = t.econ
    h = e.filter(F.month("report_date").isin(3, 6, 9, 12)).select("state", "report_date", "hpi_index")
    u = e.select("state", "report_date", "unemployment_rate").join(h, ["state", "report_date"], "left")
    return panel.ffill(u, by="state", order_by="report_date", col="hpi_index")


@register("row_number_dedupe", Q("""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cusip ORDER BY as_of_date DESC) AS rn FROM pool_loans) x
WHERE rn = 1"""))
def _row_number_dedupe(t: Tables):
    p = t.pool_loans
    return joins.dedupe_first(p, ["cusip"], [F.desc("as_of_date")]).withColumn("rn", F.lit(1))


# ---------------------------------------------------------------------------------
# State trend (two months, LAG, label)
# ---------------------------------------------------------------------------------

M1, M2 = TREND_MONTHS
_AGE = "((year(t2.report_date) - year(t.loan_origination_date)) * 12 + month(t2.report_date) - month(t.loan_origination_date))"


_TREND = {
    "monthly": f"""SELECT t.state_code, t2.report_date AS reporting_date,
  {rnd(avg_d(_AGE), 0)} AS average_loan_seasoning, {rnd(avg_d('t2.' + UPB), 2)} AS average_upb,
  {money('t2.' + UPB)} AS total_upb, {rnd(avg_d('t.loan_interest_rate'), 2)} AS average_interest_rate,
  {rnd(avg_d('t.credit_score'), 0)} AS average_credit_score,
  {cnt_if('t2.months_delinquent = 0')} AS current_loans, {cnt_if('t2.months_delinquent <> 0')} AS delinquent_loans,
  {pct(cnt_if('t2.months_delinquent <> 0'), 'COUNT(*)')} AS delinquency_pct,
  COUNT(t4.loan_id) AS total_liquidations,
  {rnd(f"CAST({cnt_if("t2.months_delinquent <> 0 AND t3.issuer_group = 'Mega'")} AS DOUBLE) / NULLIF(CAST({cnt_if('t2.months_delinquent <> 0')} AS DOUBLE), 0)", 4)} AS mega_dq_pct
  FROM loan_static t JOIN loan_monthly t2 ON t2.loan_id = t.loan_id
  JOIN issuer_info t3 ON t3.issuer_number = t.issuer_id
  LEFT JOIN (SELECT loan_id FROM loan_monthly WHERE current_month_liquidation = 'Y' AND report_date = DATE '{M2}') t4
    ON t4.loan_id = t.loan_id
  WHERE t2.report_date IN (DATE '{M1}', DATE '{M2}') GROUP BY t.state_code, t2.report_date""",
    "trended": """SELECT *, LAG(delinquency_pct) OVER (PARTITION BY state_code ORDER BY reporting_date) AS prior_delinquency_pct
  FROM monthly""",
}


@register("state_trend", Q(f"""
SELECT *, delinquency_pct - prior_delinquency_pct AS delinquency_change_pp,
  CASE WHEN prior_delinquency_pct IS NULL THEN 'New' WHEN delinquency_pct > prior_delinquency_pct THEN 'Up'
    WHEN delinquency_pct < prior_delinquency_pct THEN 'Down' ELSE 'Flat' END AS delinquency_trend
FROM trended WHERE reporting_date = DATE '{M2}' ORDER BY state_code""", _TREND))
def _state_trend(t: Tables):
    from loanlens.operators.credit import state_trend
    return state_trend(None, t.loan_months, t.issuer_info, months=TREND_MONTHS)


# ---------------------------------------------------------------------------------
# §2.10 fits, scores, stress
# ---------------------------------------------------------------------------------


@register("train_test_split", _tier(f"SELECT {', '.join(TP_COLS)} FROM ttr"))
def _train_test_split(t: Tables):
    return tier_train(t)[0].select(*TP_COLS)


@register("wls_tiered", _tier("SELECT * FROM tfit"))
def _wls_tiered(t: Tables):
    return tier_fit(t)


@register("wls_intercept_only", _tier("SELECT * FROM tbase"))
def _wls_intercept_only(t: Tables):
    return regress.wls_intercept_only(tier_train(t)[0])


@register("wls_predict", _tier("SELECT property_state, tier, report_date, dlq_chg, pred FROM tpred"))
def _wls_predict(t: Tables):
    tr, te = tier_train(t)
    return regress.wls_predict(te, regress.wls_tiered(tr)).select("property_state", "tier", "report_date", "dlq_chg",
                                                                  "pred")


def _tier_cmp(t: Tables):
    tr, te = tier_train(t)
    p = regress.wls_predict(te, regress.wls_tiered(tr))
    base = regress.wls_intercept_only(tr).withColumnRenamed("base", "pred_base")
    p = p.join(base, "tier", "left")
    return regress.weighted_actual_vs_predicted(p, extra=["pred_base"])


@register("weighted_actual_vs_predicted", _tier("SELECT * FROM tcmp"))
def _weighted_actual_vs_predicted(t: Tables):
    return _tier_cmp(t)


_PERIODS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', DATE '{s}', {'DATE ' + repr(e) if e else 'CAST(NULL AS DATE)'})" for n, s, e in PERIODS
) + ") AS p(period, start, \"end\")"


@register("rmse_by_period", _tier("""
SELECT p.period, sqrt(AVG(pow(c.predicted - c.actual, 2))) AS model_rmse, sqrt(AVG(pow(c.actual, 2))) AS naive_rmse,
  COUNT(*) AS months, sqrt(AVG(pow(c.pred_base - c.actual, 2))) AS pred_base_rmse
FROM tcmp c JOIN periods p ON c.report_date >= p.start AND (p."end" IS NULL OR c.report_date <= p."end")
GROUP BY p.period""", {"periods": _PERIODS_SQL}))
def _rmse_by_period(t: Tables):
    return regress.rmse_by_period(_tier_cmp(t), periods_table(t), extra=["pred_base"])


def _state_train(t: Tables):
    return regress.train_test_split(state_panel(t), train_end=TRAIN_END, cols=["dlq_chg", "ur_lag", "hpi_lag"])


def wls_sql(src: str, y: str, xs: list[str], w: str, cluster: str | None = None, by: str | None = None) -> dict[str, str]:
    """CTEs of a weighted fit over the view ``src``: ``wfit`` has (by, term, beta, se, n, r2), ``wbeta`` the coefficients in a row.

    Sums, Gauss-Jordan elimination, residuals and the sandwich, step by step.
    """
    k, at = len(xs) + 1, range(len(xs) + 1)
    g = f"{by}, " if by else ""
    x = ["1.0", *[f"CAST({c} AS DOUBLE)" for c in xs]]
    cells = [f"{m}{i}_{j}" for m in "ab" for i in at for j in at]
    keep = ", ".join([*([by] if by else []), "n", "wy", *[f"xy{i}" for i in at], *[f"d{i}" for i in at]])
    out = {"wdata": f"SELECT {g}CAST({y} AS DOUBLE) AS y, CAST({w} AS DOUBLE) AS w, {', '.join(f'{x[i]} AS x{i}' for i in at)}"
                    f"{f', {cluster} AS g' if cluster else ''} FROM {src}"}
    out["ws"] = (f"SELECT {g}COUNT(*) AS n, SUM(w * y) AS wy, {', '.join(f'SUM(w * x{i} * y) AS xy{i}' for i in at)}, "
                 + ", ".join(f"SUM(w * x{i} * x{j}) AS xx{i}_{j}" for i in at for j in at if i <= j)
                 + " FROM wdata" + (f" GROUP BY {by}" if by else ""))
    out["we0"] = (f"SELECT {g}n, wy, {', '.join(f'xy{i}' for i in at)}, {', '.join(f'xx{i}_{i} AS d{i}' for i in at)}, "
                  + ", ".join(f"xx{min(i, j)}_{max(i, j)} AS a{i}_{j}" for i in at for j in at) + ", "
                  + ", ".join(f"{1.0 if i == j else 0.0} AS b{i}_{j}" for i in at for j in at) + " FROM ws")
    for p in at:
        row = {f"{m}{p}_{j}": f"{m}{p}_{j} / a{p}_{p}" for m in "ab" for j in at}
        out[f"wr{p}"] = f"SELECT {keep}, {', '.join(f'{row.get(c, c)} AS {c}' for c in cells)} FROM we{p}"
        elim = [c if c[1:].startswith(f"{p}_") else f"{c} - a{c[1:].split('_')[0]}_{p} * {c[0]}{p}_{c.split('_')[1]}" for c in cells]
        out[f"we{p + 1}"] = f"SELECT {keep}, {', '.join(f'{e} AS {c}' for e, c in zip(elim, cells))} FROM wr{p}"
    beta = [" + ".join(f"b{i}_{j} * xy{j}" for j in at) for i in at]
    out["wbeta"] = f"SELECT *, wy / d0 AS ybar, {', '.join(f'{beta[i]} AS beta{i}' for i in at)} FROM we{k}"
    on = f"d.{by} = f.{by}" if by else "TRUE"
    out["wres"] = (f"SELECT d.*, f.ybar, d.y - (f.beta0 + {' + '.join(f'f.beta{i} * d.x{i}' for i in at[1:])}) AS e "
                   f"FROM wdata d JOIN wbeta f ON {on}")
    group = f" GROUP BY {by}" if by else ""
    out["wspread"] = f"SELECT {g}SUM(w * e * e) AS ssr, SUM(w * pow(y - ybar, 2)) AS tss FROM wres{group}"
    tables = "wbeta f JOIN wspread s ON " + (f"f.{by} = s.{by}" if by else "TRUE")
    if cluster:
        out["wper"] = f"SELECT {g}g, {', '.join(f'SUM(w * e * x{i}) AS u{i}' for i in at)} FROM wres GROUP BY {g}g"
        out["wmeat"] = (f"SELECT {g}COUNT(*) AS G, {', '.join(f'SUM(u{i} * u{j}) AS m{i}_{j}' for i in at for j in at)} FROM wper{group}")
        tables += " JOIN wmeat m ON " + (f"f.{by} = m.{by}" if by else "TRUE")
        scale = f"(CAST(m.G AS DOUBLE) / (m.G - 1)) * (CAST(f.n - 1 AS DOUBLE) / (f.n - {k}))"
        var = [f"{scale} * ({' + '.join(f'f.b{i}_{p} * m.m{p}_{q} * f.b{q}_{i}' for p in at for q in at)})" for i in at]
    else:
        var = [f"s.ssr / (f.n - {k}) * f.b{i}_{i}" for i in at]
    out["wfit"] = " UNION ALL ".join(
        f"SELECT {f'f.{by}, ' if by else ''}'{t}' AS term, f.beta{i} AS beta, sqrt(greatest({var[i]}, 0.0)) AS se, "
        f"CAST(f.n AS BIGINT) AS n, 1 - s.ssr / s.tss AS r2 FROM {tables}" for i, t in enumerate(["const", *xs]))
    return out


_XS = ["ur_lag", "hpi_lag"]
_TRAIN = f"report_date <= DATE '{TRAIN_END}'"


def _train_sql(y: str, xs: list[str], where: str = _TRAIN) -> str:
    return f"SELECT * FROM sp WHERE {where} AND " + " AND ".join(f"{c} IS NOT NULL" for c in [y, *xs])


def _fit_query(key: str, y: str, xs: list[str], cluster: str | None):
    """Register the fit of ``y`` on ``xs`` over the training rows of the state panel."""
    sql = _state("SELECT term, round(beta, 9) AS beta, round(se, 9) AS se, n, round(r2, 9) AS r2 FROM wfit",
                 {"strain": _train_sql(y, xs), **wls_sql("strain", y, xs, "loan_count", cluster)})

    @register(key, sql)
    def run(t: Tables):
        tr, _ = regress.train_test_split(state_panel(t), train_end=TRAIN_END, cols=[y, *xs])
        fit = regress.wls_fit(tr, y=y, x=xs, weight="loan_count", cluster=cluster)
        return _rounded(fit, ["beta", "se", "r2"])

    return run


def _rounded(df, cols):
    return df.withColumns({c: F.round(c, 9) for c in cols})


_fit_query("wls_fit", "dlq_chg", _XS, None)
_fit_query("wls_cluster_se", "dlq_chg", _XS, "property_state")
_fit_query("wls_fit_legacy", "dlq_chg", ["ur_lag", "legacy_chg"], "property_state")
_fit_query("wls_fit_hpi", "dlq30_chg", ["hpi_lag", "legacy_chg"], "property_state")
_fit_query("wls_fit_all", "dlq30_chg", ["ur_lag", "hpi_lag", "legacy_chg"], "property_state")
_fit_query("wls_fit_interaction", "dlq30_chg", ["ur_lag", "hpi_lag", "legacy_chg", "hpi_x_legacy"], "property_state")

_STATE_FIT = {"strain": _train_sql("dlq_chg", _XS), **wls_sql("strain", "dlq_chg", _XS, "loan_count", "property_state")}
_METRICS = ", ".join(["MAX(n) AS n_train", "round(MAX(r2), 9) AS r2",
                      *[f"round(MAX(CASE WHEN term = '{c}' THEN {m} END), 9) AS {c}_{m}" for c in _XS for m in ("beta", "se")]])
_METRIC_COLS = ["r2", *[f"{c}_{m}" for c in _XS for m in ("beta", "se")]]


def state_fit(t: Tables):
    """(fit, test rows with the prediction) of the state model."""
    tr, te = _state_train(t)
    fit = cut(regress.wls_fit(tr, y="dlq_chg", x=_XS, weight="loan_count", cluster="property_state"))
    return fit, regress.predict_linear(te, fit, _XS)


@register("fit_metrics", _state(f"SELECT {_METRICS} FROM wfit", _STATE_FIT))
def _fit_metrics(t: Tables):
    return _rounded(regress.fit_metrics(state_fit(t)[0], _XS), _METRIC_COLS)


_STATE_CMP = {**_STATE_FIT, "stest": _train_sql("dlq_chg", _XS, f"report_date > DATE '{TRAIN_END}'"),
              "scmp": """SELECT report_date, SUM(dlq_chg * loan_count) / SUM(loan_count) AS actual,
  SUM((f.beta0 + f.beta1 * ur_lag + f.beta2 * hpi_lag) * loan_count) / SUM(loan_count) AS predicted
  FROM stest JOIN wbeta f ON TRUE GROUP BY report_date""",
              "speriods": _PERIODS_SQL,
              "srmse": """SELECT p.period, sqrt(AVG(pow(c.predicted - c.actual, 2))) AS model_rmse, sqrt(AVG(pow(c.actual, 2))) AS naive_rmse,
  COUNT(*) AS months FROM scmp c JOIN speriods p ON c.report_date >= p.start AND (p."end" IS NULL OR c.report_date <= p."end")
  GROUP BY p.period"""}


@register("state_model_actual_vs_predicted", _state(
    "SELECT report_date, round(actual, 9) AS actual, round(predicted, 9) AS predicted FROM scmp", _STATE_CMP))
def _state_model_cmp(t: Tables):
    return _rounded(regress.weighted_actual_vs_predicted(state_fit(t)[1]), ["actual", "predicted"])


def periods_table(t: Tables):
    return t.spark.createDataFrame([(n, s, e) for n, s, e in PERIODS], "period string, start string, end string") \
        .select("period", F.col("start").cast("date").alias("start"), F.col("end").cast("date").alias("end"))


def state_scores(t: Tables, tested):
    return regress.rmse_by_period(regress.weighted_actual_vs_predicted(tested), periods_table(t))


@register("state_model_rmse", _state(
    "SELECT period, round(model_rmse, 9) AS model_rmse, round(naive_rmse, 9) AS naive_rmse, months FROM srmse", _STATE_CMP))
def _state_model_rmse(t: Tables):
    return _rounded(state_scores(t, state_fit(t)[1]), ["model_rmse", "naive_rmse"])


_LAGS = (3, 5, 7, 8)
_LAG_ROWS = " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS lag, property_state, dlq_chg, loan_count, hpi_lag, lag{k} AS ur_lag FROM slags "
    f"WHERE {_TRAIN} AND dlq_chg IS NOT NULL AND hpi_lag IS NOT NULL AND lag{k} IS NOT NULL" for k in _LAGS)


@register("lag_sensitivity", _state(
    "SELECT lag, round(beta, 9) AS beta, round(se, 9) AS se, round(r2, 9) AS r2, n FROM wfit WHERE term = 'ur_lag'",
    {"slags": f"SELECT *, {', '.join(f'LAG(ur_chg, {k}) OVER {_W} AS lag{k}' for k in _LAGS)} FROM sp", "lagged": _LAG_ROWS,
     **wls_sql("lagged", "dlq_chg", _XS, "loan_count", "property_state", by="lag")}))
def _lag_sensitivity(t: Tables):
    return _rounded(regress.lag_sensitivity(state_panel(t), lags=_LAGS, train_end=TRAIN_END), ["beta", "se", "r2"])


# the log holds two runs of the same model: one row each
MODEL_LOG_DATE = "2026-06-01"
_SCORE_COLS = [c for n, _, _ in PERIODS for c in (f"rmse_{n}", f"naive_{n}")]
_LOG_SQL = (f"SELECT DATE '{MODEL_LOG_DATE}' AS run_date, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT "
            f"CAST(orig_year AS VARCHAR) AS v FROM sm WHERE orig_year NOT IN ({_EX})) x) AS vintages, m.*, "
            + ", ".join(f"(SELECT round({c}_rmse, 9) FROM srmse WHERE period = '{n}') AS {a}_{n}"
                        for n, _, _ in PERIODS for c, a in (("model", "rmse"), ("naive", "naive")))
            + f" FROM (SELECT {_METRICS} FROM wfit) m")


@register("sink_model_log", _state(f"SELECT * FROM ml UNION ALL SELECT * FROM ml", {**_STATE_CMP, "ml": _LOG_SQL}))
def _sink_model_log(t: Tables):
    fit, tested = state_fit(t)
    years = filters.exclude_vintages(regress.state_month(t.risk), EXCLUDE).filter(F.col("orig_year").isNotNull())
    vintages = years.agg(F.array_join(F.sort_array(F.collect_set(F.col("orig_year").cast("string"))), ",")).scalar()
    row = sinks.model_log_row(regress.fit_metrics(fit, _XS), run_date=MODEL_LOG_DATE, vintages=vintages,
                              scores=state_scores(t, tested), periods=[n for n, _, _ in PERIODS])
    row = cut(_rounded(row, [*_METRIC_COLS, *_SCORE_COLS]))
    path = scratch_path(t.spark, "model-log")
    sinks.sink_model_log(row, path)
    sinks.sink_model_log(row, path)
    return t.spark.read.schema(row.schema).option("header", "true").csv(path)


def _book_b(t: Tables):
    book = reports.risk_book(None, t.loan_months)
    betas = tier_fit(t).select("tier", F.col("beta").alias("beta_tier"))
    return regress.book_beta(book, betas)


_BOOK_B = {
    "book": _RISK_BOOK_SQL,
    "bookj": "SELECT b.*, f.beta AS fbeta FROM book b LEFT JOIN tfit f ON f.tier = trim(b.tier)",
    "bookb": f"""SELECT state_code, trim(tier) AS tier, loans, {UPB}, fbeta IS NOT NULL AS beta_known,
  COALESCE(fbeta, (SELECT SUM(fbeta * CAST({UPB} AS DOUBLE)) / SUM(CAST({UPB} AS DOUBLE)) FROM bookj
    WHERE fbeta IS NOT NULL)) AS beta FROM bookj""",
}


@register("book_beta", _tier("SELECT * FROM bookb", _BOOK_B))
def _book_beta(t: Tables):
    return _book_b(t)


@register("shock_uniform", Q(f"SELECT DISTINCT state, CAST({UNIFORM_SHOCK} AS DOUBLE) AS ur_shock FROM econ"))
def _shock_uniform(t: Tables):
    return regress.shock_uniform(t.econ, shock=UNIFORM_SHOCK)


_SHOCK_SQL = f"""SELECT state, MAX(CASE WHEN report_date BETWEEN DATE '{SHOCK_WINDOW[0]}' AND DATE '{SHOCK_WINDOW[1]}'
  THEN unemployment_rate END) - MAX(CASE WHEN report_date = DATE '{SHOCK_PRE}' THEN unemployment_rate END) AS ur_shock
FROM econ GROUP BY state"""


@register("shock_historical", Q(_SHOCK_SQL))
def _shock_historical(t: Tables):
    return regress.shock_historical(t.econ, pre=SHOCK_PRE, window=SHOCK_WINDOW)


_STRESS = {**_BOOK_B, "shock": _SHOCK_SQL,
           "stressed": f"""SELECT b.*, s.ur_shock, b.beta * s.ur_shock / 100 * CAST(b.{UPB} AS DOUBLE) AS stressed_upb
  FROM bookb b JOIN shock s ON s.state = b.state_code"""}


def _stressed(t: Tables):
    return regress.stress_book(_book_b(t), regress.shock_historical(t.econ, pre=SHOCK_PRE, window=SHOCK_WINDOW))


@register("stress_book", _tier("SELECT * FROM stressed", _STRESS))
def _stress_book(t: Tables):
    return _stressed(t)


@register("stress_total", _tier(f"""SELECT SUM(stressed_upb) / SUM(CAST({UPB} AS DOUBLE)) * 100 AS book_dlq_chg_pts,
  SUM(stressed_upb) / 1e9 AS stressed_upb_bn, SUM(CAST({UPB} AS DOUBLE)) / 1e9 AS book_upb_bn FROM stressed""", _STRESS))
def _stress_total(t: Tables):
    return regress.stress_total(_stressed(t))


@register("unknown_share", _tier(f"""SELECT SUM(CASE WHEN NOT beta_known THEN CAST({UPB} AS DOUBLE) ELSE 0.0 END)
  / SUM(CAST({UPB} AS DOUBLE)) AS unknown_share FROM bookb""", _BOOK_B))
def _unknown_share(t: Tables):
    return regress.unknown_share(_book_b(t))


@register("state_scorecard", _tier(f"""
SELECT state_code, _u / (SELECT SUM(_u) FROM g) * 100 AS upb_share, _s / _u * 100 AS proj_dlq_chg,
  _s / 1e9 AS stressed_upb_bn, _s / (SELECT SUM(_s) FROM g) * 100 AS stress_share,
  (_s / (SELECT SUM(_s) FROM g) * 100) / (_u / (SELECT SUM(_u) FROM g) * 100) AS conc_ratio FROM g""",
                                   {**_STRESS, "g": f"""SELECT state_code, SUM(CAST({UPB} AS DOUBLE)) AS _u,
  SUM(stressed_upb) AS _s FROM stressed GROUP BY state_code"""}))
def _state_scorecard(t: Tables):
    return regress.state_scorecard(_stressed(t))


# ---------------------------------------------------------------------------------
# State-month delinquency, national series, weighted unemployment, issuer stress
# ---------------------------------------------------------------------------------

_SMD_SQL = f"""SELECT reporting_date, property_state,
  CAST(SUM(CASE WHEN orig_year NOT IN ({_EX}) OR orig_year IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS loan_count,
  CAST(SUM(CASE WHEN (orig_year NOT IN ({_EX}) OR orig_year IS NULL) AND dq_status >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS dlq30,
  CAST(SUM(CASE WHEN (orig_year NOT IN ({_EX}) OR orig_year IS NULL) AND dq_status >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS dlq90,
  CAST(SUM(CASE WHEN orig_year IN ({_LEG}) THEN 1 ELSE 0 END) AS BIGINT) AS legacy_loans
FROM perf WHERE upb > 0 AND dq_status IS NOT NULL AND loan_age >= 24 GROUP BY 1, 2"""
_SMD = {"perf": _PERF_SQL, "smd0": _SMD_SQL,
        "smd": """SELECT *, CAST(dlq30 AS DOUBLE) / CAST(loan_count AS DOUBLE) * 100 AS dlq30_rate,
  CAST(dlq90 AS DOUBLE) / CAST(loan_count AS DOUBLE) * 100 AS dlq90_rate FROM smd0 WHERE loan_count > 0"""}


def _smd(t: Tables):
    from loanlens.plans.catalog import perf

    return reports.state_month_dq(perf(t), exclude=EXCLUDE, legacy=LEGACY)


@register("state_month_dq", Q("SELECT * FROM smd", _SMD))
def _state_month_dq(t: Tables):
    return _smd(t)


@register("national_dq", Q("""
SELECT reporting_date, CAST(SUM(loan_count) AS BIGINT) AS loan_count, CAST(SUM(dlq30) AS BIGINT) AS dlq30,
  CAST(SUM(dlq90) AS BIGINT) AS dlq90, CAST(SUM(dlq30) AS DOUBLE) / CAST(SUM(loan_count) AS DOUBLE) * 100 AS dlq30_rate,
  CAST(SUM(dlq90) AS DOUBLE) / CAST(SUM(loan_count) AS DOUBLE) * 100 AS dlq90_rate FROM smd GROUP BY reporting_date""", _SMD))
def _national_dq(t: Tables):
    return reports.national_dq(_smd(t))


def _wu_sql(drop: bool) -> str:
    where = "WHERE e.unemployment_rate IS NOT NULL" if drop else ""
    return Q(f"""SELECT reporting_date, ur_x_loans, loan_count, ur_x_loans / loan_count AS unemployment_rate FROM (
  SELECT s.reporting_date, COALESCE(SUM(e.unemployment_rate * s.loan_count), 0.0) AS ur_x_loans,
    CAST(SUM(s.loan_count) AS BIGINT) AS loan_count
  FROM smd s LEFT JOIN econ e ON e.state = s.property_state AND e.report_date = s.reporting_date {where}
  GROUP BY s.reporting_date) g""", _SMD)


@register("weighted_unemployment", _wu_sql(False))
def _weighted_unemployment(t: Tables):
    return reports.weighted_unemployment(_smd(t), t.econ)


@register("weighted_unemployment_dropna", _wu_sql(True))
def _weighted_unemployment_dropna(t: Tables):
    return reports.weighted_unemployment(_smd(t), t.econ, drop_missing=True)


def _nation(t: Tables):
    """The national series: one row a month, so its lags need one small window."""
    smd = cut(_smd(t))
    n = reports.national_dq(smd).join(reports.weighted_unemployment(smd, t.econ).select("reporting_date", "unemployment_rate"),
                                      "reporting_date")
    n = n.select(F.col("reporting_date").alias("report_date"), "dlq90_rate", "unemployment_rate")
    n = panel.diff_n(n, by=(), order_by="report_date", col="dlq90_rate", name="dlq90_chg")
    return panel.diff_n(n, by=(), order_by="report_date", col="unemployment_rate", name="ur_chg")


def _nation_sql(where: str) -> str:
    over = "OVER (ORDER BY report_date)"
    lags = ", ".join(f"LAG(ur_chg, {k}) {over} AS x{k}" for k in range(13))
    return Q(" UNION ALL ".join(f"SELECT {k} AS lag, corr(dlq90_chg, x{k}) AS corr FROM lc" for k in range(13)), {
        **_SMD,
        "nat0": """SELECT s.reporting_date AS report_date, CAST(SUM(s.dlq90) AS DOUBLE) / CAST(SUM(s.loan_count) AS DOUBLE) * 100 AS dlq90_rate,
  COALESCE(SUM(e.unemployment_rate * s.loan_count), 0.0) / CAST(SUM(s.loan_count) AS DOUBLE) AS unemployment_rate
  FROM smd s LEFT JOIN econ e ON e.state = s.property_state AND e.report_date = s.reporting_date GROUP BY 1""",
        "nat": f"""SELECT report_date, dlq90_rate - LAG(dlq90_rate, 12) {over} AS dlq90_chg,
  unemployment_rate - LAG(unemployment_rate, 12) {over} AS ur_chg FROM nat0""",
        "lc": f"SELECT dlq90_chg, {lags} FROM nat WHERE {where}"})


@register("lag_correlation_national", _nation_sql("TRUE"))
def _lag_correlation_national(t: Tables):
    return panel.lag_correlation(_nation(t), y="dlq90_chg", x="ur_chg", max_lag=12)


@register("lag_correlation_national_train", _nation_sql(f"report_date <= DATE '{TRAIN_END}'"))
def _lag_correlation_national_train(t: Tables):
    return panel.lag_correlation(filters.period_slice(_nation(t), None, TRAIN_END), y="dlq90_chg", x="ur_chg", max_lag=12)


_CAL = "(PARTITION BY property_state ORDER BY year(report_date) * 12 + month(report_date) RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"


@register("diff_12_calendar", _state(f"""SELECT property_state, report_date, ur_chg, first(ur_chg) OVER {_CAL.format(n=5)} AS ur_lag FROM (
  SELECT property_state, report_date, unemployment_rate - first(unemployment_rate) OVER {_CAL.format(n=12)} AS ur_chg
  FROM sp0 WHERE month(report_date) <> 7) g"""))
def _diff_12_calendar(t: Tables):
    """Lags by the calendar on series whose Julys are missing."""
    p = state_panel(t).select("property_state", "report_date", "unemployment_rate").filter(F.month("report_date") != 7)
    kw = dict(by="property_state", order_by="report_date", calendar=True)
    p = panel.shift_lag(panel.diff_n(p, col="unemployment_rate", name="ur_chg", **kw), col="ur_chg", k=5, name="ur_lag", **kw)
    return p.select("property_state", "report_date", "ur_chg", "ur_lag")


@register("tier_mix_beta", _tier("""SELECT m.issuer_title, m.tier, m.loans, f.beta FROM mix m LEFT JOIN tfit f ON f.tier = m.tier""",
                                 {"mix": _TIER_MIX_SQL}))
def _tier_mix_beta(t: Tables):
    return reports.tier_mix_beta(reports.tier_mix(t.loan_static, t.issuer_info), tier_fit(t))


@register("join_scenario", _tier(f"""SELECT b.state_code, b.tier, b.loans, b.{UPB}, s.ur_shock FROM book b
JOIN shock s ON s.state = b.state_code""", {"book": _RISK_BOOK_SQL, "shock": _SHOCK_SQL}))
def _join_scenario(t: Tables):
    book = reports.risk_book(None, t.loan_months)
    shock = regress.shock_historical(t.econ, pre=SHOCK_PRE, window=SHOCK_WINDOW)
    return joins.join_scenario(book, shock)


_RISK_BOOK_ISSUER_SQL = f"""SELECT b.*, i.issuer_name, i.issuer_group FROM (
SELECT upper(trim(t.state_code)) AS state_code, {_BOOK_TIER} AS tier,
  t2.issuer_id, COUNT(*) AS loans, {money('t2.' + UPB)} AS {UPB}
FROM loan_monthly t2 JOIN loan_static t ON t.loan_id = t2.loan_id
WHERE t2.report_date = (SELECT MAX(report_date) FROM loan_monthly) GROUP BY 1, 2, 3) b
LEFT JOIN issuer_info i ON i.issuer_number = b.issuer_id"""
_ISSUER_STRESS = {
    "ibook": _RISK_BOOK_ISSUER_SQL,
    "ibookj": "SELECT b.*, f.beta AS fbeta FROM ibook b LEFT JOIN tfit f ON f.tier = trim(b.tier)",
    "ibookb": f"""SELECT state_code, trim(tier) AS tier, issuer_id, issuer_name, loans, {UPB}, fbeta IS NOT NULL AS beta_known,
  COALESCE(fbeta, (SELECT SUM(fbeta * CAST({UPB} AS DOUBLE)) / SUM(CAST({UPB} AS DOUBLE)) FROM ibookj
    WHERE fbeta IS NOT NULL)) AS beta FROM ibookj""",
    "shock": _SHOCK_SQL,
    "istress": f"""SELECT b.*, b.beta * s.ur_shock / 100 * CAST(b.{UPB} AS DOUBLE) AS stressed_upb
  FROM ibookb b JOIN shock s ON s.state = b.state_code""",
    "ig": f"""SELECT issuer_id, issuer_name, SUM(CAST({UPB} AS DOUBLE)) AS _u, SUM(stressed_upb) AS _s,
  SUM(beta * CAST({UPB} AS DOUBLE)) AS _bu,
  SUM(CASE WHEN NOT beta_known THEN CAST({UPB} AS DOUBLE) ELSE 0.0 END) AS _unk FROM istress GROUP BY 1, 2""",
}


@register("issuer_scorecard", _tier("""
SELECT issuer_id, issuer_name, _u / 1e9 AS upb_bn, _bu / _u AS mix_beta, _s / _u * 100 AS proj_dlq_chg,
  _s / 1e9 AS stressed_upb_bn, _unk / _u * 100 AS unknown_pct, _u / (SELECT SUM(_u) FROM ig) * 100 AS upb_share,
  _s / (SELECT SUM(_s) FROM ig) * 100 AS stress_share,
  (_s / (SELECT SUM(_s) FROM ig) * 100) / (_u / (SELECT SUM(_u) FROM ig) * 100) AS conc_ratio,
  (_bu / _u) / (SELECT SUM(_bu) / SUM(_u) FROM ig) AS mix_vs_peer,
  ((_s / (SELECT SUM(_s) FROM ig) * 100) / (_u / (SELECT SUM(_u) FROM ig) * 100)) / ((_bu / _u) / (SELECT SUM(_bu) / SUM(_u) FROM ig)) AS geo_factor
FROM ig""", _ISSUER_STRESS))
def _issuer_scorecard(t: Tables):
    book = reports.risk_book(None, t.loan_months, by_issuer=True, issuer_info=t.issuer_info)
    betas = tier_fit(t).select("tier", F.col("beta").alias("beta_tier"))
    bb = regress.book_beta(book.drop("issuer_group"), betas)
    stressed = regress.stress_book(bb, regress.shock_historical(t.econ, pre=SHOCK_PRE, window=SHOCK_WINDOW))
    return regress.issuer_scorecard(stressed)
