"""Aggregate reports (concentration, delinquency, issuance, issuer profiles).

Plan shape used throughout: aggregate the large fact table on its group key
first (partial aggregation before the shuffle absorbs a hot state or a Mega
issuer), then join the small aggregated result to the dimension, then regroup
by the dimension attribute when the report groups by a name.  Ratios to a
grand total use a scalar subquery (one row, computed once) rather than a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.functions.exprs import MONEY_SUM, avg_d, cnt_if, money, pct, ratio, rnd, with_pct, with_rounded, with_total
from loanlens.session import cut

UPB = "unpaid_principal_balance"


def _dq(months: str = "months_delinquent") -> Column:
    return F.col(months) > 0


def _top(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    return df.orderBy(*order).limit(n) if n else df


def _filter_month(df: DataFrame, report_date, col: str = "report_date") -> DataFrame:
    return df if report_date is None else df.filter(F.col(col) == F.lit(report_date).cast("date"))


# ---------------------------------------------------------------------------------
# Portfolio concentration (pool_loans)
# ---------------------------------------------------------------------------------


def issuer_concentration(pool_loans: DataFrame, issuers: DataFrame, *, top: int | None = 15) -> DataFrame:
    """issuer -> pools, UPB, % of total UPB; the largest ``top`` by UPB."""
    # loans without an issuer count in the total only; with a key that is never null, and the same columns
    # asked for, the total and the report read one shuffle of ``per``, and the loans once
    issuer = F.coalesce(F.col("issuer_number").cast("long"), F.lit(-(1 << 63))).alias("issuer_number")
    per = pool_loans.groupBy(issuer).agg(F.count(F.lit(1)).alias("n"), F.sum(UPB).alias("upb"))
    total = per.agg(F.struct(F.sum("upb").alias("upb"), F.sum("n")).alias("s")).scalar().getField("upb")
    named = (per.join(issuers.select("issuer_number", "issuer_name"), "issuer_number")
             .groupBy("issuer_name")
             .agg(F.sum("n").cast("bigint").alias("pool_count"), F.sum("upb").cast(MONEY_SUM).alias("total_upb")))
    out = with_pct(named, "pct_of_total_upb", F.col("total_upb"), total)
    return _top(out, [F.desc("total_upb"), F.asc("issuer_name")], top)


def geo_concentration(pool_loans: DataFrame, *, top: int | None = 15) -> DataFrame:
    """state -> loans, UPB, % of UPB, delinquent loans, DQ rate; largest ``top`` by UPB."""
    out = (pool_loans.groupBy("property_state")
           .agg(F.count(F.lit(1)).alias("loan_count"), money(UPB).alias("total_upb"),
                cnt_if(_dq()).alias("delinquent_loans")))
    out = (with_pct(with_total(out, "_total", "total_upb"), "pct_of_total_upb", F.col("total_upb"), F.col("_total"))
           .withColumn("delinquency_rate", pct(F.col("delinquent_loans"), F.col("loan_count"))))
    out = out.select("property_state", "loan_count", "total_upb", "pct_of_total_upb", "delinquent_loans",
                     "delinquency_rate")
    return _top(out, [F.desc("total_upb"), F.asc("property_state")], top)


def dq_buckets(pool_loans: DataFrame) -> DataFrame:
    """delinquency bucket -> loans, UPB, % of UPB, ordered by the smallest months in the bucket."""
    g = (pool_loans.groupBy(rules.dq_bucket(F.col("months_delinquent")).alias("delinquency_bucket"))
         .agg(F.count(F.lit(1)).alias("loan_count"), money(UPB).alias("total_upb"),
              F.min("months_delinquent").alias("_min")))
    return (with_pct(with_total(g, "_total", "total_upb"), "pct_of_upb", F.col("total_upb"), F.col("_total"))
            .orderBy(F.asc_nulls_last("_min"), "delinquency_bucket")
            .drop("_min", "_total"))


def issuer_dq(pool_loans: DataFrame, issuers: DataFrame, *, min_count: int = 10, top: int | None = 15) -> DataFrame:
    """issuer -> pools, UPB, delinquent loans, DQ rate, UPB 3+ months late; HAVING count >= min_count."""
    m = F.col("months_delinquent")
    per = (pool_loans.groupBy("issuer_number")
           .agg(F.count(F.lit(1)).alias("n"), F.sum(UPB).alias("upb"), cnt_if(m > 0).alias("dq"),
                F.sum(F.when(m >= 3, F.col(UPB)).otherwise(0)).alias("sdq")))
    out = (per.join(issuers.select("issuer_number", "issuer_name"), "issuer_number")
           .groupBy("issuer_name")
           .agg(F.sum("n").cast("bigint").alias("pool_count"), F.sum("upb").cast(MONEY_SUM).alias("total_upb"),
                F.sum("dq").cast("bigint").alias("delinquent_loans"),
                F.sum("sdq").cast(MONEY_SUM).alias("serious_dq_upb"))
           .filter(F.col("pool_count") >= min_count)
           .withColumn("delinquency_rate", pct(F.col("delinquent_loans"), F.col("pool_count"))))
    out = out.select("issuer_name", "pool_count", "total_upb", "delinquent_loans", "delinquency_rate",
                     "serious_dq_upb")
    return _top(out, [F.desc("delinquency_rate"), F.asc("issuer_name")], top)


def issuer_state_share(pool_loans: DataFrame, issuers: DataFrame, *, min_count: int = 5,
                       top: int | None = 20) -> DataFrame:
    """issuer x state -> loans, UPB, % of the issuer's loans; HAVING count >= min_count.

    The issuer's total (a correlated count in the reference) is a window sum over
    the already aggregated (issuer, state) rows, taken before the HAVING filter.
    A window partition holds one issuer's states: bounded by the number of states.
    """
    per = (pool_loans.groupBy("issuer_number", F.col("property_state").alias("top_state"))
           .agg(F.count(F.lit(1)).alias("loans_in_state"), money(UPB).alias("state_upb")))
    per = per.withColumn("_issuer_total", F.sum("loans_in_state").over(Window.partitionBy("issuer_number")))
    out = (per.join(issuers.select("issuer_number", "issuer_name"), "issuer_number")
           .filter(F.col("loans_in_state") >= min_count)
           .withColumn("pct_of_issuer_portfolio", pct(F.col("loans_in_state"), F.col("_issuer_total")))
           .select("issuer_name", "top_state", "loans_in_state", "state_upb", "pct_of_issuer_portfolio"))
    return _top(out, [F.desc("pct_of_issuer_portfolio"), F.asc("issuer_name"), F.asc("top_state"),
                      F.desc("loans_in_state")], top)


def pool_type_mix(pool_loans: DataFrame) -> DataFrame:
    """pool type -> count, UPB, avg rate (3 dp), avg term in whole years (1 dp), delinquent count."""
    years = F.expr("timestampdiff(YEAR, first_payment_date, loan_maturity_date)")
    return (pool_loans.groupBy("pool_type")
            .agg(F.count(F.lit(1)).alias("pool_count"), money(UPB).alias("total_upb"),
                 rnd(avg_d("loan_interest_rate"), 3).alias("avg_interest_rate"),
                 rnd(avg_d(years), 1).alias("avg_term_years"),
                 cnt_if(_dq()).alias("delinquent_count"))
            .orderBy(F.desc("total_upb"), "pool_type"))


def state_exposure_what_if(pool_loans: DataFrame, *, state: str, label: str | None = None,
                           severities=(0.15, 0.25)) -> DataFrame:
    """One state: loans, UPB, % of portfolio, delinquents, projected loss at two severities."""
    g = (pool_loans.groupBy("property_state")
         .agg(F.count(F.lit(1)).alias("_n"), F.sum(UPB).alias("_u"), cnt_if(_dq()).alias("_d")))
    here = F.col("property_state") == state
    upb = F.sum(F.when(here, F.col("_u"))).cast(MONEY_SUM)
    cols = [F.lit(label or f"{state} Exposure").alias("scenario"),
            F.coalesce(F.sum(F.when(here, F.col("_n"))), F.lit(0)).cast("bigint").alias("total_loans"),
            upb.alias("total_upb"), F.sum(F.when(here, F.col("_d"))).cast("bigint").alias("currently_delinquent"),
            F.sum("_u").alias("_total")]
    losses = []
    for sev in severities:
        losses.append(f"projected_loss_{int(round(sev * 100))}pct_severity")
        cols.append(F.round(upb * F.lit(sev).cast("decimal(4,2)"), 2).cast(MONEY_SUM).alias(losses[-1]))
    out = with_pct(g.agg(*cols), "pct_of_portfolio", F.col("total_upb"), F.col("_total"))
    return out.select("scenario", "total_loans", "total_upb", "pct_of_portfolio", "currently_delinquent", *losses)


def portfolio_exposure(pool_loans: DataFrame, *, state: str | None = None, by_state: bool = False) -> DataFrame:
    """loans, UPB, delinquent loans and UPB; 0 for an empty set. ``by_state`` returns every state at once."""
    d = _dq()
    aggs = [F.count(F.lit(1)).alias("total_loans"),
            F.coalesce(F.sum(UPB), F.lit(0)).cast(MONEY_SUM).alias("total_upb"),
            F.coalesce(cnt_if(d), F.lit(0)).cast("bigint").alias("current_dq_loans"),
            F.coalesce(F.sum(F.when(d, F.col(UPB)).otherwise(0)), F.lit(0)).cast(MONEY_SUM).alias("current_dq_upb")]
    if by_state:
        return pool_loans.groupBy(F.col("property_state").alias("state")).agg(*aggs)
    df = pool_loans if state is None else pool_loans.filter(F.col("property_state") == state)
    return df.agg(*aggs)


def top_issuers_in_state(pool_loans: DataFrame, issuers: DataFrame, *, state: str | None = None,
                         n: int = 5) -> DataFrame:
    """state -> the ``n`` largest issuers by UPB (all states at once when ``state`` is None)."""
    p = pool_loans if state is None else pool_loans.filter(F.col("property_state") == state)
    per = p.groupBy("property_state", "issuer_number").agg(F.count(F.lit(1)).alias("c"), F.sum(UPB).alias("u"))
    named = (per.join(issuers.select("issuer_number", "issuer_name"), "issuer_number")
             .groupBy("property_state", "issuer_name")
             .agg(F.sum("c").cast("bigint").alias("loan_count"), F.sum("u").cast(MONEY_SUM).alias("issuer_upb")))
    w = Window.partitionBy("property_state").orderBy(F.desc("issuer_upb"), F.asc("issuer_name"))
    return named.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_msas_in_state(pool_loans: DataFrame, *, state: str | None = None, n: int = 5) -> DataFrame:
    """state -> the ``n`` largest MSAs by UPB; blank and null MSAs are skipped."""
    from loanlens.operators.filters import not_blank_filter

    p = not_blank_filter(pool_loans, "msa")
    if state is not None:
        p = p.filter(F.col("property_state") == state)
    per = p.groupBy("property_state", "msa").agg(F.count(F.lit(1)).alias("loan_count"), money(UPB).alias("msa_upb"))
    w = Window.partitionBy("property_state").orderBy(F.desc("msa_upb"), F.asc("msa"))
    return per.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def dq_snapshot(pool_loans: DataFrame, *, state: str | None = None, by_state: bool = False) -> DataFrame:
    """total, current, 30/60/90/120+ counts and shares, UPB, overall DQ rate."""
    m = F.col("months_delinquent")
    aggs = [F.count(F.lit(1)).alias("total"), cnt_if(m == 0).alias("current"), cnt_if(m == 1).alias("dq_30"),
            cnt_if(m == 2).alias("dq_60"), cnt_if(m == 3).alias("dq_90"), cnt_if(m >= 4).alias("dq_120plus"),
            money(UPB).alias("total_upb")]
    if by_state:
        df = pool_loans.groupBy(F.col("property_state").alias("state")).agg(*aggs)
    else:
        p = pool_loans if state is None else pool_loans.filter(F.col("property_state") == state)
        df = p.agg(*aggs)
    for c in ["current", "dq_30", "dq_60", "dq_90", "dq_120plus"]:
        df = df.withColumn(f"{c}_pct", pct(F.col(c), F.col("total")))
    return df.withColumn("overall_dq_rate", pct(F.col("total") - F.col("current"), F.col("total")))


def dq_by_month(pool_loans: DataFrame, *, state: str | None = None) -> DataFrame:
    """(state,) month -> loans, delinquents, DQ rate (4 dp), UPB, delinquent UPB."""
    p = pool_loans if state is None else pool_loans.filter(F.col("property_state") == state)
    d = _dq()
    return (p.groupBy("property_state", "as_of_date")
            .agg(F.count(F.lit(1)).alias("total_loans"), cnt_if(d).alias("dq_loans"),
                 F.coalesce(F.sum(UPB), F.lit(0)).cast(MONEY_SUM).alias("total_upb"),
                 F.coalesce(F.sum(F.when(d, F.col(UPB)).otherwise(0)), F.lit(0)).cast(MONEY_SUM).alias("dq_upb"))
            .withColumn("dq_rate", pct(F.col("dq_loans"), F.col("total_loans"), 4)))


def state_dq_baseline(pool_loans: DataFrame, *, min_count: int = 10) -> DataFrame:
    """state -> total, delinquents, DQ rate (4 dp); HAVING count >= min_count; ordered by rate."""
    return (pool_loans.groupBy("property_state")
            .agg(F.count(F.lit(1)).alias("total"), cnt_if(_dq()).alias("dq"))
            .filter(F.col("total") >= min_count)
            .withColumn("dq_rate", pct(F.col("dq"), F.col("total"), 4))
            .orderBy(F.desc("dq_rate"), "property_state"))


def removal_breakdown(pool_loans: DataFrame, reasons: DataFrame, *, state: str | None = None) -> DataFrame:
    """removal reason -> count, sum and mean of original balance and of UPB at removal.

    ``reasons`` is the fixed code -> label table (broadcast); unknown codes read ``Code n``.
    """
    p = pool_loans.filter(F.col("removal_reason").isNotNull() & (F.col("removal_reason") > 0))
    if state is not None:
        p = p.filter(F.col("property_state") == state)
    agg = (p.groupBy("removal_reason")
           .agg(F.count(F.lit(1)).alias("loan_count"),
                money("original_principal_balance").alias("total_original_balance"),
                money(UPB).alias("total_upb_at_removal"),
                avg_d("original_principal_balance").alias("avg_original_balance"),
                avg_d(UPB).alias("avg_upb_at_removal")))
    lab = agg.join(F.broadcast(reasons), agg.removal_reason == reasons.removal_code, "left")
    return (lab.select(F.col("removal_reason").alias("removal_code"),
                       F.coalesce(F.col("removal_label"),
                                  F.concat(F.lit("Code "), F.col("removal_reason").cast("string"))).alias("removal_reason"),
                       "loan_count", "total_original_balance", "total_upb_at_removal", "avg_original_balance",
                       "avg_upb_at_removal")
            .orderBy("removal_code"))


def available_months(pool_loans: DataFrame, *, state: str | None = None) -> DataFrame:
    """Distinct snapshot months in order, each row carrying the number of months."""
    p = pool_loans if state is None else pool_loans.filter(F.col("property_state") == state)
    months = p.select("as_of_date").distinct()
    n = F.count("as_of_date").over(Window.partitionBy())  # over the few distinct months
    return months.withColumn("month_count", n).orderBy("as_of_date")


# ---------------------------------------------------------------------------------
# Loan-level reports over static x monthly
# ---------------------------------------------------------------------------------


def joined_loan_months(static: DataFrame, monthly: DataFrame, deal=None) -> DataFrame:
    """Every loan with each of its months: ``t`` (static attributes), ``t2`` (the month's; null for a loan without any), report_date.

    Stored once, it spares every report the shuffle of both tables on the loan id: the
    reports take it as ``monthly`` with None as ``static``.  ``deal`` shuffles the joined rows
    while they are flat, each key in one column; they are nested after it.
    """
    own = [c for c in monthly.columns if c not in ("loan_id", "report_date")]
    j = static.alias("a").join(monthly.alias("b"), F.col("a.loan_id") == F.col("b.loan_id"), "left")
    j = j.select(F.col("a.loan_id").alias("loan_id"), F.col("b.report_date").alias("report_date"), F.col("b.loan_id").isNotNull().alias("_month"),
                 *[F.col(f"a.{c}").alias(f"a_{c}") for c in static.columns if c != "loan_id"], *[F.col(f"b.{c}").alias(f"b_{c}") for c in own])
    j = deal(j) if deal else j
    of_loan = [F.col(c if c == "loan_id" else f"a_{c}").alias(c) for c in static.columns]
    of_month = [F.col(f"b_{c}" if c in own else c).alias(c) for c in monthly.columns]
    return j.select("loan_id", F.struct(*of_loan).alias("t"), F.when(F.col("_month"), F.struct(*of_month)).alias("t2"), "report_date")


def _static_monthly(static: DataFrame | None, monthly: DataFrame, how: str = "inner") -> DataFrame:
    """static (t) joined to monthly (t2) on the loan id; ``joined_loan_months`` rows (static None) as they are."""
    if static is None:
        return monthly if how == "left" else monthly.filter(F.col("t2").isNotNull())
    return static.alias("t").join(monthly.alias("t2"), F.col("t.loan_id") == F.col("t2.loan_id"), how)


def loan_age_months(report: Column, origination: Column) -> Column:
    """Whole months from origination to the report month."""
    return (F.year(report) - F.year(origination)) * 12 + F.month(report) - F.month(origination)


def issuer_level(static: DataFrame | None, monthly: DataFrame, *, age: Column | None = None) -> DataFrame:
    """issuer x month -> avg age, avg/sum UPB, avg rate, avg score, current/delinquent counts, DQ % (unrounded)."""
    j = _static_monthly(static, monthly)
    age = age if age is not None else loan_age_months(F.col("t2.report_date"), F.col("t.loan_origination_date"))
    m = F.col("t2.months_delinquent")
    return (j.groupBy(F.col("t2.issuer_id").alias("issuer_id"), F.col("t2.report_date").alias("reporting_date"))
            .agg(rnd(avg_d(age), 0).alias("average_loan_seasoning"),
                 rnd(avg_d(F.col(f"t2.{UPB}")), 2).alias("average_upb"),
                 money(F.col(f"t2.{UPB}")).alias("total_upb"),
                 rnd(avg_d(F.col("t.loan_interest_rate")), 2).alias("average_interest_rate"),
                 rnd(avg_d(F.col("t.credit_score")), 0).alias("average_credit_score"),
                 cnt_if(m == 0).alias("current_loans"), cnt_if(m != 0).alias("delinquent_loans"),
                 (ratio(cnt_if(m != 0), F.count(F.lit(1))) * 100).alias("delinquency_pct")))


def state_level(static: DataFrame | None, monthly: DataFrame, *, age: Column | None = None) -> DataFrame:
    """state x month (static LEFT JOIN monthly) -> same measures; DQ % over matched loan-months only."""
    j = _static_monthly(static, monthly, "left")
    age = age if age is not None else loan_age_months(F.col("t2.report_date"), F.col("t.loan_origination_date"))
    m = F.col("t2.months_delinquent")
    return (j.groupBy(F.col("t.state_code").alias("state_code"), F.col("t2.report_date").alias("reporting_date"))
            .agg(rnd(avg_d(age), 0).alias("average_loan_seasoning"),
                 rnd(avg_d(F.col(f"t2.{UPB}")), 2).alias("average_upb"),
                 money(F.col(f"t2.{UPB}")).alias("total_upb"),
                 rnd(avg_d(F.col("t.loan_interest_rate")), 2).alias("average_interest_rate"),
                 rnd(avg_d(F.col("t.credit_score")), 0).alias("average_credit_score"),
                 cnt_if(m == 0).alias("current_loans"), cnt_if(m != 0).alias("delinquent_loans"),
                 pct(cnt_if(m != 0), F.count(F.col("t2.loan_id"))).alias("delinquency_pct")))


_AGENCY_PREFIX = {"F": "fha", "V": "va", "R": "rd", "N": "pih"}


def agency_share(static: DataFrame | None, monthly: DataFrame, *, agency: str = "F",
                 report_date=None) -> DataFrame:
    """state -> loans, agency loans, agency UPB, % loans, % UPB, agency delinquencies (static LEFT JOIN monthly)."""
    p = _AGENCY_PREFIX[agency]
    if static is None and report_date is not None:
        raise ValueError("one month of the left join needs both tables: loans without that month count too")
    mon = _filter_month(monthly, report_date)
    j = _static_monthly(static, mon, "left")
    a = F.col("t.agency") == agency
    upb = F.col(f"t2.{UPB}")
    out = (j.groupBy(F.col("t.state_code").alias("state"))
           .agg(F.count(F.lit(1)).alias("state_loans"), cnt_if(a).alias(f"{p}_loans"),
                F.sum(F.when(a, upb).otherwise(0)).cast(MONEY_SUM).alias(f"total_{p}_upb"),
                F.sum(upb).alias("_upb"),
                cnt_if(a & (F.col("t2.months_delinquent") != 0)).alias(f"total_{p}_delinquencies")))
    return (out.withColumn(f"percent_state_{p}", pct(F.col(f"{p}_loans"), F.col("state_loans")))
            .withColumn(f"percent_state_upb_{p}", pct(F.col(f"total_{p}_upb"), F.col("_upb")))
            .drop("_upb"))


def agency_dq_rate(share: DataFrame, *, agency: str = "F", n: int = 10) -> DataFrame:
    """Agency DQ / agency loans per state; the ``n`` largest with the mean of the top set and of all states."""
    p = _AGENCY_PREFIX[agency]
    rate = f"{p}_delinquency_rate"
    # one row per state, read three times (rows, two means): checkpoint it once
    # rather than re-deriving the share from the loan tables for each read
    d = cut(share.withColumn(rate, ratio(F.col(f"total_{p}_delinquencies"), F.col(f"{p}_loans")) * 100))
    all_mean = d.agg(F.avg(rate)).scalar()
    top = d.orderBy(F.desc_nulls_last(rate), F.asc("state")).limit(n)
    top_mean = top.agg(F.avg(rate)).scalar()
    return top.select("state", rate, top_mean.alias("top_mean"), all_mean.alias("all_mean"))


def buyer_characteristics(static: DataFrame, *, dialect: str = "tsql") -> DataFrame:
    """buyer type x assistance x insurer -> loans, avg rate (pg form adds avg score)."""
    if dialect == "tsql":
        nb = rules.buyer_label(F.col("first_time_home_buyer"))
        asst = rules.assistance_label(F.col("down_payment_assistance"))
    else:
        ft, dp = F.col("first_time_home_buyer"), F.col("down_payment_assistance")
        nb = F.when(ft.isin("NaN", "N"), "Repeat Buyer").when(ft == "Y", "First Time Buyer")
        asst = F.when(dp.isin("NaN", "N"), "No Assistance").when(dp == "Y", "Received Assistance")
    aggs = [F.count(F.lit(1)).alias("total_loans"), rnd(avg_d("loan_interest_rate"), 2).alias("average_interest_rate")]
    if dialect != "tsql":
        aggs.append(rnd(avg_d("credit_score"), 0).alias("average_credit_score"))
    return static.groupBy(nb.alias("new_buyer"), asst.alias("assistance"),
                          rules.insurer_label(F.col("agency"), dialect).alias("insurer")).agg(*aggs)


INSURERS = ["FHA", "VA", "RD", "PIH"]


def buyer_rate_pivot(buyers: DataFrame, *, insurers=INSURERS) -> DataFrame:
    """rows buyer type, one column per insurer: mean of the group average rates."""
    p = buyers.groupBy("new_buyer").pivot("insurer", list(insurers)).agg(F.avg("average_interest_rate"))
    return p.select("new_buyer", *[F.col(i).alias(i.lower()) for i in insurers])


def existence_flag(static: DataFrame, other: DataFrame, *, key: str = "loan_id", yes: str = "New Issuances",
                   no: str = "Existing Loans", name: str = "loan_type") -> DataFrame:
    """Label each row by whether its key exists in ``other`` (CASE WHEN EXISTS ...)."""
    keys = other.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    j = static.join(keys, static[key] == keys["_k"], "left")
    return j.withColumn(name, F.when(F.col("_hit"), yes).otherwise(no)).drop("_k", "_hit")


def existing_vs_new(static: DataFrame, new_issuance: DataFrame) -> DataFrame:
    """New / Existing x state -> loans, avg rate, share first-time, share assisted (fractions, 2 dp)."""
    f = existence_flag(static, new_issuance)
    n = F.count(F.lit(1))
    return (f.groupBy("loan_type", "state_code")
            .agg(n.alias("total_loans"), rnd(avg_d("loan_interest_rate"), 2).alias("average_interest_rate"),
                 rnd(ratio(cnt_if(F.col("first_time_home_buyer") == "Y"), n), 2).alias("percent_fthb"),
                 rnd(ratio(cnt_if(F.col("down_payment_assistance") == "Y"), n), 2).alias("percent_dpa"))
            .orderBy("state_code", "loan_type"))


def mega_vs_other(static: DataFrame | None, monthly: DataFrame, issuer_info: DataFrame, *, report_date=None) -> DataFrame:
    """Mega / Non Mega -> delinquencies, loans by agency, total, first-time and assisted shares.

    Loan-months are first summed per static issuer id (the join key of the
    dimension), then the few issuer rows are labelled and regrouped.
    """
    j = _static_monthly(static, _filter_month(monthly, report_date))
    a = F.col("t.agency")
    per = (j.groupBy(F.col("t.issuer_id").alias("issuer_id"))
           .agg(cnt_if(F.col("t2.months_delinquent") != 0).alias("dq"), cnt_if(a == "F").alias("f"),
                cnt_if(a == "V").alias("v"), cnt_if(a == "R").alias("r"), cnt_if(a == "N").alias("n"),
                F.count(F.col("t.loan_id")).alias("loans"),
                cnt_if(F.col("t.first_time_home_buyer") == "Y").alias("ft"),
                cnt_if(F.col("t.down_payment_assistance") == "Y").alias("dp")))
    ii = issuer_info.select("issuer_number", "issuer_group")
    lab = per.join(ii, per.issuer_id == ii.issuer_number, "left").withColumn(
        "issuer_group", F.when(F.col("issuer_group") == "Mega", "Mega").otherwise("Non Mega"))
    s = lambda c: F.sum(c).cast("bigint")
    return (lab.groupBy("issuer_group")
            .agg(s("dq").alias("total_delinquencies"), s("f").alias("fha_loans"), s("v").alias("va_loans"),
                 s("r").alias("rd_loans"), s("n").alias("pih_loans"), s("loans").alias("total_loans"),
                 rnd(ratio(F.sum("ft"), F.sum("loans")), 2).alias("percent_fthb"),
                 rnd(ratio(F.sum("dp"), F.sum("loans")), 2).alias("percent_dpa")))


def _issuer_title(issuer_id: Column, name: Column) -> Column:
    return F.concat_ws("", issuer_id.cast("string"), F.lit(" - "), name)


def mega_issuer_profile(static: DataFrame | None, monthly: DataFrame, issuer_info: DataFrame, subservicers: DataFrame,
                        *, report_date=None) -> DataFrame:
    """Mega issuer x location x subservicer -> delinquencies, first-time and assisted shares."""
    j = _static_monthly(static, _filter_month(monthly, report_date))
    per = (j.groupBy(F.col("t.issuer_id").alias("sid"), F.col("t2.issuer_id").alias("mid"))
           .agg(cnt_if(F.col("t2.months_delinquent") != 0).alias("dq"), F.count(F.lit(1)).alias("n"),
                cnt_if(F.col("t.first_time_home_buyer") == "Y").alias("ft"),
                cnt_if(F.col("t.down_payment_assistance") == "Y").alias("dp")))
    ii = issuer_info.filter(F.col("issuer_group") == "Mega")
    x = (per.join(ii, per.mid == ii.issuer_number)
         .join(subservicers, F.col("subservicer") == F.col("subservicer_id"), "left"))
    sub = F.when(F.col("subservicer") != "No Subservicer", F.col("subservicer_name")).otherwise("No Subservicer")
    return (x.groupBy(_issuer_title(F.col("sid"), F.col("issuer_name")).alias("issuer_title"),
                      F.col("citystate").alias("location"), sub.alias("subservicer"))
            .agg(F.sum("dq").cast("bigint").alias("total_delinquencies"),
                 rnd(ratio(F.sum("ft"), F.sum("n")), 2).alias("percent_fthb"),
                 rnd(ratio(F.sum("dp"), F.sum("n")), 2).alias("percent_dpa")))


_ISSUANCE_MEANS = [("original_principal_balance", "average_opb", 2), ("loan_interest_rate", "average_interest_rate", 2),
                   ("credit_score", "average_credit_score", 0)]
_ISSUANCE_AGENCIES = [("F", "new_fha_issuances"), ("V", "new_va_issuances"), ("R", "new_rd_issuances"), ("N", "new_pih_issuances")]


def _issuance_sums() -> list[Column]:
    """Sums and counts that add up over issuers."""
    out = [F.count(F.lit(1)).alias("_n")]
    for c, _, _ in _ISSUANCE_MEANS:
        out += [F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_c_{c}")]
    return out + [cnt_if(F.col("agency") == code).alias(name) for code, name in _ISSUANCE_AGENCIES]


def _issuance_totals() -> list[Column]:
    """The issuance measures from ``_issuance_sums`` rows."""
    means = [rnd(ratio(F.sum(f"_s_{c}"), F.sum(f"_c_{c}")), d).alias(name) for c, name, d in _ISSUANCE_MEANS]
    return [F.sum("_n").cast("bigint").alias("total_new_issuances"), means[0],
            F.sum("_s_original_principal_balance").cast(MONEY_SUM).alias("total_opb"), *means[1:],
            *[F.sum(name).cast("bigint").alias(name) for _, name in _ISSUANCE_AGENCIES]]


def new_issuance_by_issuer(new_issuance: DataFrame, issuer_info: DataFrame, *, as_of=None) -> DataFrame:
    """issuer x as-of month -> issuances, avg/sum balance, avg rate, avg score, counts by agency."""
    n = _filter_month(new_issuance, as_of, "as_of_date")
    # loans meet the dimension after they are summed per issuer, so a hot issuer is one row
    per = n.groupBy("issuer_id", "as_of_date").agg(*_issuance_sums())
    j = per.join(issuer_info.select("issuer_number", "issuer_name"), per.issuer_id == F.col("issuer_number"))
    return j.groupBy(_issuer_title(F.col("issuer_id"), F.col("issuer_name")).alias("issuer_title"),
                     "as_of_date").agg(*_issuance_totals())


def new_issuance_agency_totals(by_issuer: DataFrame) -> DataFrame:
    """Column sums of the agency counts over all issuers, one row per agency."""
    t = by_issuer.agg(*[F.sum(f"new_{p}_issuances").cast("bigint").alias(p.upper())
                        for p in ("fha", "va", "rd", "pih")])
    return t.unpivot([], ["FHA", "VA", "RD", "PIH"], "agency", "total_new_issuances")


def new_issuance_by_state(new_issuance: DataFrame, issuer_info: DataFrame, *, as_of=None) -> DataFrame:
    """state -> the issuance measures for one as-of month (all months when ``as_of`` is None)."""
    n = _filter_month(new_issuance, as_of, "as_of_date")
    per = n.groupBy("issuer_id", "state_code").agg(*_issuance_sums())
    j = per.join(issuer_info.select("issuer_number"), per.issuer_id == F.col("issuer_number"), "left_semi")
    return j.groupBy("state_code").agg(*_issuance_totals())


def mf_state_concentration(loans: DataFrame) -> DataFrame:
    """state -> UPB (and in billions), loans, avg rate, delinquent loans and UPB."""
    m = F.col("months_delinquent")
    return (loans.groupBy("property_state")
            .agg(money(UPB).alias("total_upb"), F.count(F.lit(1)).alias("total_loans"),
                 rnd(avg_d("loan_interest_rate"), 2).alias("average_interest_rate"),
                 cnt_if(m != 0).alias("total_delinquent_loans"),
                 F.sum(F.when(m != 0, F.col(UPB)).otherwise(0)).cast(MONEY_SUM).alias("total_delinquent_upb"))
            .withColumn("total_upb_bn", rnd(F.col("total_upb").cast("double") / 1e9, 2))
            .orderBy(F.desc("total_upb"), "property_state"))


def fnma_state_level(perf: DataFrame, *, period=None) -> DataFrame:
    """state x period -> avg rate, age, score, current, delinquent, DQ / current (the reference's denominator)."""
    p = perf if period is None else perf.filter(F.col("reporting_date") == F.lit(period).cast("date"))
    s = F.col("dq_status")
    return (p.groupBy("property_state", "reporting_date")
            .agg(rnd(avg_d("interest_rate"), 2).alias("average_interest_rate"),
                 rnd(avg_d("loan_age"), 0).alias("average_loan_seasoning"),
                 rnd(avg_d("credit_score"), 0).alias("average_credit_score"),
                 cnt_if(s == 0).alias("current_loans"), cnt_if(s != 0).alias("delinquent_loans"))
            .withColumn("dq_to_current_pct", ratio(F.col("delinquent_loans"), F.col("current_loans")) * 100))


def tier_mix(static: DataFrame, issuer_info: DataFrame, *, group: str = "Mega") -> DataFrame:
    """issuer (of the group) x credit tier -> loans; loans without score or LTV are left out."""
    s = static.filter(F.col("credit_score").cast("double").isNotNull() & F.col("ltv").cast("double").isNotNull())
    per = s.groupBy("issuer_id", rules.credit_tier(F.col("credit_score"), F.col("ltv"), None).alias("tier")) \
           .agg(F.count(F.lit(1)).alias("c"))
    ii = issuer_info.filter(F.col("issuer_group") == group).select("issuer_number", "issuer_name")
    j = per.join(ii, per.issuer_id == ii.issuer_number)
    return (j.groupBy(_issuer_title(F.col("issuer_id"), F.col("issuer_name")).alias("issuer_title"), "tier")
            .agg(F.sum("c").cast("bigint").alias("loans")))


TIERS = ["<680 / <=90", "<680 / >90", "680-739 / <=90", "680-739 / >90", "740+ / <=90", "740+ / >90"]


def tier_mix_new_issuance(new_issuance: DataFrame, issuer_info: DataFrame, *, group: str = "Mega", as_of=None) -> DataFrame:
    """``tier_mix`` of the loans issued at the latest as-of date (or ``as_of``)."""
    from loanlens.operators.filters import latest_snapshot

    n = latest_snapshot(new_issuance, "as_of_date") if as_of is None else _filter_month(new_issuance, as_of, "as_of_date")
    return tier_mix(n, issuer_info, group=group)


def tier_mix_beta(mix: DataFrame, betas: DataFrame) -> DataFrame:
    """``tier_mix`` rows with the beta of their tier attached (null where the fit has no such tier)."""
    return mix.join(betas.select("tier", "beta"), "tier", "left").select("issuer_title", "tier", "loans", "beta")


def tier_mix_crosstab(mix: DataFrame, *, tiers=TIERS) -> DataFrame:
    """issuer rows x tier columns: row percent of loans, missing tiers 0."""
    p = mix.groupBy("issuer_title").pivot("tier", list(tiers)).agg(F.sum("loans")).na.fill(0)
    total = sum((F.col(t) for t in tiers), F.lit(0))
    return p.select("issuer_title", *[(F.col(t) / total * 100).alias(f"pct {t}") for t in tiers])


def tier_check(panel_rows: DataFrame, *, outcome: str = "dlq90") -> DataFrame:
    """tier -> loans, delinquents, rate, share of all loans."""
    t = panel_rows.groupBy("tier").agg(F.sum("loan_count").cast("bigint").alias("loan_count"),
                                       F.sum(outcome).cast("bigint").alias(outcome))
    return (with_total(t, "_total", "loan_count")
            .withColumn("dlq_rate", ratio(F.col(outcome), F.col("loan_count")) * 100)
            .withColumn("mix", ratio(F.col("loan_count"), F.col("_total"))).drop("_total"))


def risk_book(static: DataFrame | None, monthly: DataFrame, *, as_of=None, by_issuer: bool = False,
              issuer_info: DataFrame | None = None) -> DataFrame:
    """state x tier (x issuer x group) -> loans, UPB at the latest month (or ``as_of``)."""
    from loanlens.operators.filters import latest_snapshot

    mon = latest_snapshot(monthly, "report_date") if as_of is None else _filter_month(monthly, as_of)
    j = _static_monthly(static, mon)
    tier = rules.credit_tier(F.col("t.credit_score"), F.col("t.ltv"), "unknown")
    keys = [F.upper(F.trim(F.col("t.state_code"))).alias("state_code"), tier.alias("tier")]
    if by_issuer:
        keys.append(F.col("t2.issuer_id").alias("issuer_id"))
    out = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("loans"), money(F.col(f"t2.{UPB}")).alias(UPB))
    if by_issuer and issuer_info is not None:
        ii = issuer_info.select("issuer_number", "issuer_name", "issuer_group")
        out = out.join(ii, out.issuer_id == ii.issuer_number, "left").drop("issuer_number")
    return out


def state_month_dq(perf: DataFrame, *, exclude=(2005, 2006, 2007), legacy=(2005, 2006, 2007),
                   min_age: int = 24) -> DataFrame:
    """month x state over active, known-status, seasoned loans: loans, 30+, 90+, legacy loans and rates.

    Vintages in ``exclude`` are left out of the counts; legacy loans are counted
    before that exclusion (with the reference's identical lists legacy was always 0).
    """
    yr, st = F.col("orig_year"), F.col("dq_status")
    p = perf.filter((F.col("upb") > 0) & st.isNotNull() & (F.col("loan_age") >= min_age))
    # as in filters.exclude_vintages: the listed years go, an unknown year stays
    keep = ~yr.isin(list(exclude)) | yr.isNull() if exclude else F.lit(True)
    g = (p.groupBy("reporting_date", "property_state")
         .agg(cnt_if(keep).alias("loan_count"), cnt_if(keep & (st >= 1)).alias("dlq30"),
              cnt_if(keep & (st >= 3)).alias("dlq90"), cnt_if(yr.isin(list(legacy))).alias("legacy_loans"))
         .filter(F.col("loan_count") > 0))
    return (g.withColumn("dlq30_rate", ratio(F.col("dlq30"), F.col("loan_count")) * 100)
            .withColumn("dlq90_rate", ratio(F.col("dlq90"), F.col("loan_count")) * 100))


def national_dq(smd: DataFrame) -> DataFrame:
    """month -> summed counts and 30+ / 90+ rates."""
    g = smd.groupBy("reporting_date").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("loan_count", "dlq30", "dlq90")])
    return (g.withColumn("dlq30_rate", ratio(F.col("dlq30"), F.col("loan_count")) * 100)
            .withColumn("dlq90_rate", ratio(F.col("dlq90"), F.col("loan_count")) * 100))


def weighted_unemployment(smd: DataFrame, econ: DataFrame, *, drop_missing: bool = False) -> DataFrame:
    """month -> Σ(UR x loans) / Σ loans over states.

    ``drop_missing=False`` (first version) keeps states without a UR value in the
    denominator; ``True`` (second version) drops them first.
    """
    e = econ.select(F.col("state").alias("property_state"), F.col("report_date").alias("reporting_date"),
                    "unemployment_rate")
    m = smd.join(e, ["property_state", "reporting_date"], "left")
    if drop_missing:
        m = m.filter(F.col("unemployment_rate").isNotNull() & ~F.isnan("unemployment_rate"))
    g = m.groupBy("reporting_date").agg(
        F.coalesce(F.sum(F.col("unemployment_rate") * F.col("loan_count")), F.lit(0.0)).alias("ur_x_loans"),
        F.sum("loan_count").cast("bigint").alias("loan_count"))
    return g.withColumn("unemployment_rate", F.col("ur_x_loans") / F.col("loan_count"))
