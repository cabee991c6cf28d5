"""Credit-transition, trend, severity and calibration operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.functions.exprs import MONEY_SUM, avg_d, cnt_if, money, pct, ratio, rnd, with_pct, with_rounded
from loanlens.operators.reports import loan_age_months
from loanlens.session import cut

UPB = "unpaid_principal_balance"


def state_trend(static: DataFrame | None, monthly: DataFrame, issuer_info: DataFrame, *, months: tuple[str, str],
                liquidations: DataFrame | None = None, age: Column | None = None) -> DataFrame:
    """Two months per state: age, UPB, rate, score, current, delinquent, DQ %, liquidations, Mega share of
    delinquencies; prior DQ by LAG, change in points, label New / Up / Down / Flat; latest month only.

    Without ``static``, ``monthly`` holds loans and months joined (structs ``t`` and ``t2``, see
    ``reports.joined_loan_months``) and is read once, with no join on the loan id.  Only the second
    month's row is reported, so a loan's liquidation in that month is a flag of the row itself;
    ``liquidations`` from a table of their own are joined on the loan id (the reference's condition inside ON).
    """
    m1, m2 = (F.lit(m).cast("date") for m in months)
    ii = issuer_info.select("issuer_number", "issuer_group")
    if static is None:
        j = monthly.filter(F.col("report_date").isin(m1, m2) & F.col("t2").isNotNull())
    else:
        mon = monthly.filter(F.col("report_date").isin(m1, m2))
        j = static.alias("t").join(mon.alias("t2"), F.col("t.loan_id") == F.col("t2.loan_id"))
    if liquidations is None:
        gone = (F.col("t2.current_month_liquidation") == "Y") & (F.col("t2.report_date") == m2)
    else:
        liq = liquidations.filter(F.col("report_date") == m2).select(F.col("loan_id").alias("liq_id")).distinct()
        j = j.join(liq, F.col("t.loan_id") == F.col("liq_id"), "left")
        gone = F.col("liq_id").isNotNull()
    age = age if age is not None else loan_age_months(F.col("t2.report_date"), F.col("t.loan_origination_date"))
    dq = F.col("t2.months_delinquent") != 0
    # sums per issuer first: the issuer dimension then joins a few rows, not every loan of a hot issuer
    means = {"age": age, "upb": F.col(f"t2.{UPB}"), "rate": F.col("t.loan_interest_rate"), "score": F.col("t.credit_score")}
    per = (j.groupBy(F.col("t.state_code").alias("state_code"), F.col("t2.report_date").alias("reporting_date"),
                     F.col("t.issuer_id").alias("issuer_id"))
           .agg(F.count(F.lit(1)).alias("n"), cnt_if(dq).alias("dq"), cnt_if(~dq).alias("ok"), cnt_if(gone).alias("liq"),
                *[x for k, c in means.items() for x in (F.sum(c).alias(f"s_{k}"), F.count(c).alias(f"c_{k}"))]))
    per = per.join(ii, per.issuer_id == ii.issuer_number)

    def mean(k: str, digits: int) -> Column:
        return rnd(ratio(F.sum(f"s_{k}"), F.sum(f"c_{k}")), digits)

    mega = F.sum(F.when(F.col("issuer_group") == "Mega", F.col("dq")).otherwise(0))
    monthly_g = (per.groupBy("state_code", "reporting_date")
                 .agg(mean("age", 0).alias("average_loan_seasoning"), mean("upb", 2).alias("average_upb"),
                      F.sum("s_upb").cast(MONEY_SUM).alias("total_upb"), mean("rate", 2).alias("average_interest_rate"),
                      mean("score", 0).alias("average_credit_score"),
                      F.sum("ok").cast("bigint").alias("current_loans"), F.sum("dq").cast("bigint").alias("delinquent_loans"),
                      pct(F.sum("dq"), F.sum("n")).alias("delinquency_pct"),
                      F.sum("liq").cast("bigint").alias("total_liquidations"),
                      rnd(ratio(mega, F.sum("dq")), 4).alias("mega_dq_pct")))
    w = Window.partitionBy("state_code").orderBy("reporting_date")
    tr = monthly_g.withColumn("prior_delinquency_pct", F.lag("delinquency_pct").over(w))
    cur, prev = F.col("delinquency_pct"), F.col("prior_delinquency_pct")
    return (tr.withColumn("delinquency_change_pp", cur - prev)
            .withColumn("delinquency_trend", F.when(prev.isNull(), "New").when(cur > prev, "Up")
                        .when(cur < prev, "Down").otherwise("Flat"))
            .filter(F.col("reporting_date") == m2).orderBy("state_code"))


def cure_rates(snapshots: DataFrame, *, state: str | None = None, by_state: bool = False,
               key: str = "cusip", order: str = "as_of_date") -> DataFrame:
    """Loans delinquent at some snapshot and seen later: distinct loans, cured, worsened, liquidated, rates.

    The reference self-joins every snapshot with every later one.  Here one
    window per loan over the following rows gives the later minimum / maximum
    months delinquent and whether any later snapshot is a liquidation; a
    delinquent snapshot is counted when it has a later snapshot.  One shuffle on
    the loan id, linear in the rows.  ``state`` filters on the state at the
    delinquent snapshot.  Rates are percentages (2 dp).
    """
    later = Window.partitionBy(key).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    liq = F.when(F.col("current_month_liquidation") == "Y", 1).otherwise(0)
    m = F.col("months_delinquent")
    s = snapshots.select(key, "property_state", m.alias("m"),
                         F.count(F.lit(1)).over(later).alias("n_later"),
                         F.min("months_delinquent").over(later).alias("min_later"),
                         F.max("months_delinquent").over(later).alias("max_later"),
                         F.max(liq).over(later).alias("liq_later"))
    s = s.filter((F.col("m") > 0) & (F.col("n_later") > 0))
    if state is not None:
        s = s.filter(F.col("property_state") == state)
    # one row per loan first, where its rows already lie, then plain sums
    flags = {"cured_loans": F.col("min_later") == 0, "worsened_loans": F.col("max_later") > F.col("m"),
             "liquidated_loans": F.col("liq_later") == 1}
    loans = (s.filter(F.col(key).isNotNull()).groupBy(key, *(["property_state"] if by_state else []))
             .agg(*[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()]))
    aggs = [F.count(F.lit(1)).alias("total_dq_loans"),
            *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in flags]]
    g = loans.groupBy("property_state").agg(*aggs) if by_state else loans.agg(*aggs)
    for c, n in [("cure_rate", "cured_loans"), ("worsen_rate", "worsened_loans"),
                 ("liquidation_rate", "liquidated_loans")]:
        g = g.withColumn(c, pct(F.col(n), F.col("total_dq_loans")))
    return g


def disaster_impact(snapshots: DataFrame, events: DataFrame, *, min_months: int = 2, bounded: bool = False,
                    months_before: int = 3, months_after: int = 6) -> DataFrame:
    """Per (state, event) and month: DQ metrics labelled pre (month <= event month) or post.

    ``events`` is (state, event_id, event_date).  Every event is evaluated at once:
    the per-state monthly metrics are computed once (small: states x months).
    With ``bounded`` an event becomes its months, which meet the metrics on (state, month): rows
    compared are rows out.  Without, every month of the event's state belongs to the result.  States with fewer than ``min_months`` months
    are dropped (the reference returns an error for them).

    The reference computes a window of ``months_before`` / ``months_after`` 30-day
    steps around the event but never applies it; ``bounded=True`` applies it (pre
    months from the window start, post months up to the window end).
    """
    by_month = (snapshots.groupBy("property_state", "as_of_date")
                .agg(F.count(F.lit(1)).alias("total_loans"), cnt_if(F.col("months_delinquent") > 0).alias("dq_loans"),
                     F.coalesce(F.sum(UPB), F.lit(0)).cast(MONEY_SUM).alias("total_upb"),
                     F.coalesce(F.sum(F.when(F.col("months_delinquent") > 0, F.col(UPB)).otherwise(0)), F.lit(0))
                      .cast(MONEY_SUM).alias("dq_upb"))
                .withColumn("dq_rate", pct(F.col("dq_loans"), F.col("total_loans"), 4))
                .withColumn("n_months", F.count(F.lit(1)).over(Window.partitionBy("property_state")))
                .filter(F.col("n_months") >= min_months).drop("n_months"))
    d = F.col("event_date").cast("date")
    ev = events.select(F.col("state").alias("property_state"), "event_id", F.date_format(d, "yyyyMM").alias("event_month"),
                       F.date_sub(d, 30 * months_before).alias("_from"), F.date_add(d, 30 * months_after).alias("_to"))
    keys = ["property_state"]
    if bounded:
        span = F.sequence(F.trunc("_from", "MM"), F.trunc("_to", "MM"), F.expr("INTERVAL 1 MONTH"))
        ev = ev.withColumn("_m", F.explode(span)).withColumn("as_of_date", F.date_format("_m", "yyyyMM")).drop("_m")
        keys.append("as_of_date")
    j = by_month.join(ev.drop("_from", "_to"), keys)
    return j.withColumn("period", F.when(F.col("as_of_date") <= F.col("event_month"), "pre").otherwise("post"))


def loss_severity(breakdown: DataFrame, *, reason: str = "Foreclosure", default: float = rules.SEVERITY_DEFAULT) -> DataFrame:
    """Severity = 1 − ΣUPB / Σoriginal for the reason; the default when absent or zero original balance."""
    r = breakdown.filter((F.col("removal_reason") == reason) & (F.col("total_original_balance") > 0))
    v = r.agg(F.max(1 - F.col("total_upb_at_removal").cast("double") / F.col("total_original_balance").cast("double")))
    return v.select(F.coalesce(F.col(v.columns[0]), F.lit(default)).alias("loss_severity"))


def calibrated_templates(snapshots: DataFrame, reasons: DataFrame, *, min_months: int = 12,
                         min_count: int = 10) -> DataFrame:
    """Data-driven templates: one row per (scenario, severity) from history.

    avg state DQ rate -> DQ increase = avg/100 x 3 / 8 / 16 (4 dp); overall cure
    rate (2 dp percent / 100, default .50) -> mild min(cure+.10,.80), moderate
    cure, severe max(cure-.20,.10) (2 dp); severity from ``loss_severity`` (2 dp).
    Empty when fewer than ``min_months`` months are loaded.  One pass over the
    snapshots sums them by state, month and removal reason (kept as a small
    table), a second one follows each loan for the cure rate.
    """
    late = F.col("months_delinquent") > 0
    sums = cut(snapshots.groupBy("property_state", "as_of_date", "removal_reason")
               .agg(F.count(F.lit(1)).alias("n"), cnt_if(late).alias("dq"),
                    F.sum("original_principal_balance").alias("opb"), F.sum(UPB).alias("upb")))
    n_months = sums.agg(F.count_distinct("as_of_date")).scalar()
    base = (sums.groupBy("property_state").agg(F.sum("n").alias("n"), F.sum("dq").alias("dq"))
            .filter(F.col("n") >= min_count).select(pct(F.col("dq"), F.col("n"), 4).alias("dq_rate")))
    avg_rate = base.agg(F.coalesce(F.avg("dq_rate"), F.lit(0.5))).scalar()
    removed = (sums.filter(F.col("removal_reason") > 0).groupBy("removal_reason")
               .agg(F.sum("opb").alias("total_original_balance"), F.sum("upb").alias("total_upb_at_removal")))
    breakdown = removed.join(reasons, removed.removal_reason == reasons.removal_code).select(
        F.col("removal_label").alias("removal_reason"), "total_original_balance", "total_upb_at_removal")
    cure = cure_rates(snapshots)
    cure_v = cure.select(F.when(F.col("total_dq_loans") > 0, F.col("cure_rate") / 100)).scalar()
    cure_c = F.coalesce(cure_v, F.lit(rules.CURE_DEFAULT))
    sev = loss_severity(breakdown).scalar()
    spark = snapshots.sparkSession
    grid = spark.createDataFrame(
        [(s, v, float(rules.CALIBRATION_DQ_MULTIPLIERS[v])) for s in rules.SCENARIO_TEMPLATES for v in rules.SEVERITIES],
        "scenario_type string, severity string, mult double")
    # each scalar subquery goes in a column of its own first, so it is evaluated once
    cure = F.col("_cure")
    cure_by = (F.when(F.col("severity") == "mild", F.least(cure + 0.10, F.lit(0.80)))
               .when(F.col("severity") == "moderate", cure)
               .otherwise(F.greatest(cure - 0.20, F.lit(0.10))))
    g = with_rounded(grid, "dq_increase", avg_rate / 100 * F.col("mult"), 4).withColumn("_cure", cure_c)
    g = with_rounded(with_rounded(g, "cure_rate", cure_by, 2), "loss_severity", sev, 2).drop("_cure")
    return (g.withColumn("months_of_data", n_months)
            .filter(F.col("months_of_data") >= min_months)
            .drop("mult"))


def calibration_report(snapshots: DataFrame, reasons: DataFrame, declarations: DataFrame | None = None,
                       *, state: str | None = None, ready_months: int = 7) -> dict[str, DataFrame]:
    """The five calibration sections as DataFrames (no printing)."""
    from loanlens.operators import reports

    s = snapshots if state is None else snapshots.filter(F.col("property_state") == state)
    out = {
        "snapshot": reports.dq_snapshot(s),
        "removals": reports.removal_breakdown(s, reasons),
        "cure": cure_rates(s),
        "readiness": s.agg(F.count_distinct("as_of_date").alias("months"))
                      .withColumn("ready", F.col("months") >= ready_months),
    }
    if declarations is not None:
        out["disasters"] = disaster_frequency(declarations)
    return out


def disaster_frequency(declarations: DataFrame) -> DataFrame:
    """incident type -> count, most frequent first."""
    return (declarations.groupBy("incident_type").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "incident_type"))


def major_disasters(declarations: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` declarations of type DR in date-descending order."""
    return (declarations.filter(F.col("declaration_type") == "DR")
            .orderBy(F.desc("declaration_date"), "disaster_number", "state").limit(n))
