"""Panels, weighted least squares with clustered errors, scoring and stress.

Fits are sufficient-statistics fits: one aggregation produces the sums
``Σw·xᵢxⱼ, Σw·xᵢy`` per fit group, a Gauss-Jordan elimination in column
expressions solves the k×k system of each group (k ≤ ~6 regressors), and a
second pass over the data computes residual scores per cluster for the sandwich
covariance.  Nothing reaches the driver, however many groups there are.
Divisions by zero give null: a group that cannot be fitted has null results.

The tiered model (own intercept and slope per tier) is block-diagonal, so its
coefficients and clustered errors are closed-form column expressions per tier and
never leave Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.functions.exprs import with_total
from loanlens.operators import filters, panel
from loanlens.session import cut

# ---------------------------------------------------------------------------------
# Panels
# ---------------------------------------------------------------------------------


def state_month(risk: DataFrame) -> DataFrame:
    """The additive state x month x vintage pre-aggregate (``sf_state_month`` shape) from the risk bands."""
    return (risk.groupBy("reporting_date", "property_state", "orig_year")
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("loan_count", "dlq30", "dlq90")]))


def build_state_panel(sm: DataFrame, econ: DataFrame, *, outcome: str = "dlq90", lag_ur: int = 5, lag_hpi: int = 7,
                      exclude=(2005, 2006, 2007), legacy=(), calendar: bool = False) -> DataFrame:
    """State x month panel: vintages dropped, summed, joined to economy (inner), rates, yearly changes, lags.

    Loans of the ``legacy`` vintages are counted before the ``exclude`` vintages are dropped.
    ``dlq30_rate`` and its change are always there, ``dlq_rate`` is that of ``outcome``.
    ``calendar`` takes lags by month instead of by row, for series with gaps.
    """
    yr = F.col("orig_year")
    keep = ~yr.isin(list(exclude)) | yr.isNull() if exclude else F.lit(True)
    old = F.sum(F.when(yr.isin(list(legacy)), F.col("loan_count")).otherwise(0)) if legacy else F.sum(F.lit(0))
    st = (sm.groupBy("property_state", F.col("reporting_date").alias("report_date"))
          .agg(*[F.sum(F.when(keep, F.col(c))).cast("bigint").alias(c) for c in ("loan_count", "dlq30", "dlq90")],
               old.cast("bigint").alias("legacy_loans"))
          .filter(F.col("loan_count").isNotNull()))
    e = econ.select(F.col("state").alias("property_state"), "report_date", "unemployment_rate", "hpi_index")
    st = st.join(e, ["property_state", "report_date"])
    st = st.withColumn("dlq_rate", panel.rate(F.col(outcome), F.col("loan_count")))
    st = st.withColumn("dlq30_rate", panel.rate(F.col("dlq30"), F.col("loan_count")))
    kw = dict(by="property_state", order_by="report_date", calendar=calendar)
    st = panel.diff_n(st, col="dlq_rate", name="dlq_chg", **kw)
    st = panel.diff_n(st, col="dlq30_rate", name="dlq30_chg", **kw)
    st = panel.diff_n(st, col="unemployment_rate", name="ur_chg", **kw)
    st = panel.pct_change_n(st, col="hpi_index", name="hpi_chg", **kw)
    st = panel.legacy_share(st, calendar=calendar)
    st = panel.shift_lag(st, col="ur_chg", k=lag_ur, name="ur_lag", **kw)
    st = panel.shift_lag(st, col="hpi_chg", k=lag_hpi, name="hpi_lag", **kw)
    return panel.interaction(st, "hpi_lag", "legacy_share", "hpi_x_legacy")


def build_tier_panel(risk: DataFrame, econ: DataFrame, *, outcome: str = "dlq90", lag_ur: int = 5,
                     exclude=(2005, 2006, 2007), drop_gaps: bool = True) -> DataFrame:
    """State x tier x month panel: tier from bands, vintages dropped, economy joined, gapped series dropped."""
    r = risk.withColumn("tier", rules.tier_from_buckets(F.col("fico_bucket"), F.col("ltv_bucket")))
    r = filters.exclude_vintages(r, exclude).filter(F.col("tier").isNotNull())
    pt = (r.groupBy("property_state", "tier", F.col("reporting_date").alias("report_date"))
          .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("loan_count", "dlq30", "dlq90")]))
    e = econ.select(F.col("state").alias("property_state"), "report_date", "unemployment_rate", "hpi_index")
    pt = pt.join(e, ["property_state", "report_date"])
    if drop_gaps:
        pt = panel.drop_gap_series(pt, by=["property_state", "tier"])
    kw = dict(by=["property_state", "tier"], order_by="report_date")
    pt = pt.withColumn("dlq_rate", panel.rate(F.col(outcome), F.col("loan_count")))
    pt = panel.diff_n(pt, col="dlq_rate", name="dlq_chg", **kw)
    pt = panel.diff_n(pt, col="unemployment_rate", name="ur_chg", **kw)
    return panel.shift_lag(pt, col="ur_chg", k=lag_ur, name="ur_lag", **kw)


def train_test_split(df: DataFrame, *, train_end: str, cols, date_col: str = "report_date"):
    """(train, test): train is ``date <= train_end``, test is after; complete cases over ``cols``."""
    d = filters.dropna_subset(df, cols)
    end = F.lit(train_end).cast("date")
    return d.filter(F.col(date_col) <= end), d.filter(F.col(date_col) > end)


# ---------------------------------------------------------------------------------
# Weighted least squares
# ---------------------------------------------------------------------------------


SINGULAR = 1e-12  # a pivot this small beside its diagonal element counts as zero


def _solved(sums: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """``sums`` (xx{i}_{j} for i <= j, xy{i}) with the inverse b{i}_{j} and the coefficients beta{i}.

    Gauss-Jordan elimination, one projection per step; a singular system has nulls.
    """
    at = range(k)
    df = sums.select(*keep, *[F.col(f"xy{i}") for i in at], *[F.col(f"xx{i}_{i}").alias(f"d{i}") for i in at],
                     *[F.col(f"xx{min(i, j)}_{max(i, j)}").alias(f"a{i}_{j}") for i in at for j in at],
                     *[F.lit(1.0 if i == j else 0.0).alias(f"b{i}_{j}") for i in at for j in at])
    cells = [f"{m}{i}_{j}" for m in "ab" for i in at for j in at]
    rest = [c for c in df.columns if c not in cells]
    for p in at:
        pivot = F.when(F.abs(F.col(f"a{p}_{p}")) > SINGULAR * F.col(f"d{p}"), F.col(f"a{p}_{p}"))
        row = {f"{m}{p}_{j}": F.try_divide(F.col(f"{m}{p}_{j}"), pivot) for m in "ab" for j in at}
        df = df.select(*rest, *[row.get(c, F.col(c)).alias(c) for c in cells])
        df = df.select(*rest, *[(F.col(c) if c[1:].startswith(f"{p}_") else
                                 F.col(c) - F.col(f"a{c[1:].split('_')[0]}_{p}") * F.col(f"{c[0]}{p}_{c.split('_')[1]}")).alias(c)
                                for c in cells])
    betas = [sum((F.col(f"b{i}_{j}") * F.col(f"xy{j}") for j in at[1:]), F.col(f"b{i}_0") * F.col("xy0")).alias(f"beta{i}") for i in at]
    return df.select(*rest, *[f"b{i}_{j}" for i in at for j in at], *betas)


def wls_fit(df: DataFrame, *, y: str, x, weight: str, cluster: str | None = None, by=()) -> DataFrame:
    """WLS with intercept; one fit per ``by`` group.  Returns (by..., term, beta, se, n, r2).

    With ``cluster`` the standard errors are cluster-robust with the small-sample
    correction G/(G-1)·(N-1)/(N-k); without it they are the classical WLS errors.
    Rows are complete cases; the frame is cut once and read by the passes below.
    """
    xs = [x] if isinstance(x, str) else list(x)
    groups = list(by)
    k, at = len(xs) + 1, range(len(xs) + 1)
    data = df.select(*groups, F.col(y).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_x{i + 1}") for i, c in enumerate(xs)],
                     F.col(weight).cast("double").alias("_w"), *([F.col(cluster).alias("_g")] if cluster else []))
    data = cut(data.withColumn("_x0", F.lit(1.0)).withColumn("_fit", F.lit(0)))
    keys = ["_fit", *groups]
    w, yc = F.col("_w"), F.col("_y")
    sums = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(w * yc).alias("wy"), *[F.sum(w * F.col(f"_x{i}") * yc).alias(f"xy{i}") for i in at],
        *[F.sum(w * F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"xx{i}_{j}") for i in at for j in at if i <= j])
    fit = _solved(sums, k, [*keys, "n", "wy"])
    small = fit.select(*keys, *[f"beta{i}" for i in at], F.try_divide(F.col("wy"), F.col("d0")).alias("_mean"))
    e = yc - sum((F.col(f"beta{i}") * F.col(f"_x{i}") for i in at[1:]), F.col("beta0"))
    r = data.join(small, keys).withColumn("_e", e)
    spread = r.groupBy(*keys).agg(F.sum(w * F.col("_e") * F.col("_e")).alias("ssr"), F.sum(w * F.pow(yc - F.col("_mean"), 2)).alias("tss"))
    out = fit.join(spread, keys)
    n, b = F.col("n"), lambda i, j: F.col(f"b{i}_{j}")
    free = F.when(n > k, n - k)
    if cluster:
        per = r.groupBy(*keys, "_g").agg(*[F.sum(w * F.col("_e") * F.col(f"_x{i}")).alias(f"u{i}") for i in at])
        meat = per.groupBy(*keys).agg(F.count(F.lit(1)).alias("G"), *[F.sum(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"m{i}_{j}")
                                                                      for i in at for j in at])
        out = out.join(meat, keys)
        scale = F.try_divide(F.col("G"), F.col("G") - 1) * F.try_divide(n - 1, free)
        variance = [scale * sum((b(i, p) * F.col(f"m{p}_{q}") * b(q, i) for p in at for q in at), F.lit(0.0)) for i in at]
    else:
        variance = [F.try_divide(F.col("ssr"), free) * b(i, i) for i in at]
    r2 = 1 - F.try_divide(F.col("ssr"), F.col("tss"))
    rows = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"beta{i}").alias("beta"), F.sqrt(F.greatest(variance[i], F.lit(0.0))).alias("se"))
                     for i, t in enumerate(["const", *xs])])
    return (out.select(*groups, F.explode(rows).alias("t"), n.cast("bigint").alias("n"), r2.alias("r2"))
            .select(*groups, "t.term", "t.beta", "t.se", "n", "r2"))


def fit_metrics(fit: DataFrame, terms=None) -> DataFrame:
    """One row: n, R², and beta / se per term (the model-log row without scores)."""
    terms = list(terms) if terms else ["const"]
    aggs = [F.max("n").alias("n_train"), F.max("r2").alias("r2")]
    for t in terms:
        aggs += [F.max(F.when(F.col("term") == t, F.col("beta"))).alias(f"{t}_beta"),
                 F.max(F.when(F.col("term") == t, F.col("se"))).alias(f"{t}_se")]
    return fit.agg(*aggs)


def wls_tiered(train: DataFrame, *, y: str = "dlq_chg", x: str = "ur_lag", weight: str = "loan_count",
               by: str = "tier", cluster: str = "property_state") -> DataFrame:
    """``y ~ C(tier) + x:C(tier)`` weighted: intercept and slope per tier, clustered SE of the slope.

    A tier whose x does not vary (one row, say) has null results; ``book_beta`` fills them.

    Closed form per tier; the clustered variance uses the joint fit's
    correction G/(G-1)·(N-1)/(N-2T) with N, T and G over the whole training set.
    """
    # The training panel is small (series x months) and is read by several
    # aggregates below: cut its lineage once so the panel is not rebuilt each time.
    train = cut(train.select(by, cluster, y, x, weight))
    w, xc, yc = F.col(weight), F.col(x), F.col(y)
    s = (train.groupBy(by).agg(F.sum(w).alias("sw"), F.sum(w * xc).alias("swx"), F.sum(w * yc).alias("swy"),
                               F.sum(w * xc * xc).alias("swxx"), F.sum(w * xc * yc).alias("swxy"),
                               F.count(F.lit(1)).alias("n"))
         .withColumn("_d", F.col("sw") * F.col("swxx") - F.col("swx") * F.col("swx"))
         .withColumn("_d", F.when(F.col("_d") > SINGULAR * F.col("sw") * F.col("swxx"), F.col("_d")))
         .withColumn("beta", F.try_divide(F.col("sw") * F.col("swxy") - F.col("swx") * F.col("swy"), F.col("_d")))
         .withColumn("intercept", F.try_divide(F.col("swy") - F.col("beta") * F.col("swx"), F.col("sw"))))
    tot = train.agg(F.count(F.lit(1)).alias("N"), F.count_distinct(cluster).alias("G"))
    T = s.agg(F.count(F.lit(1))).scalar()
    N, G = tot.select("N").scalar(), tot.select("G").scalar()
    corr = F.try_divide(G, G - 1) * F.try_divide(N - 1, F.when(N - 2 * T > 0, N - 2 * T))
    r = train.join(s.select(by, "beta", "intercept"), by).withColumn(
        "_e", yc - F.col("intercept") - F.col("beta") * xc)
    per = r.groupBy(by, cluster).agg(F.sum(w * F.col("_e")).alias("a"), F.sum(w * F.col("_e") * xc).alias("b"))
    v = (per.join(s.select(by, "sw", "swx", "_d"), by)
         .groupBy(by).agg(F.sum(F.pow(F.try_divide(F.col("b") * F.col("sw") - F.col("a") * F.col("swx"), F.col("_d")), 2))
                          .alias("_v")))
    return s.join(v, by, "left").select(by, "intercept", "beta", F.sqrt(F.col("_v") * corr).alias("se"), "n")


def wls_intercept_only(train: DataFrame, *, y: str = "dlq_chg", weight: str = "loan_count", by: str = "tier") -> DataFrame:
    """``y ~ C(tier)`` weighted: the weighted mean of y per tier."""
    return train.groupBy(by).agg(F.try_divide(F.sum(F.col(weight) * F.col(y)), F.sum(weight).cast("double")).alias("base"))


def wls_predict(test: DataFrame, betas: DataFrame, *, x: str = "ur_lag", by: str = "tier",
                name: str = "pred") -> DataFrame:
    """Apply a tiered fit (by, intercept, beta) to rows; tiers missing from the fit predict null."""
    b = betas.select(by, "intercept", "beta")
    j = test.join(b, by, "left")
    return j.withColumn(name, F.col("intercept") + F.col("beta") * F.col(x)).drop("intercept", "beta")


def predict_linear(df: DataFrame, fit: DataFrame, x, name: str = "pred") -> DataFrame:
    """Apply a ``wls_fit`` result (term, beta) with const + Σ beta·x: the betas are one scalar subquery."""
    terms = ["const", *([x] if isinstance(x, str) else x)]
    betas = fit.agg(F.struct(*[F.max(F.when(F.col("term") == t, F.col("beta"))).alias(f"b{i}") for i, t in enumerate(terms)]).alias("b")).scalar()
    e: Column = betas.getField("b0")
    for i, t in enumerate(terms[1:], 1):
        e = e + betas.getField(f"b{i}") * F.col(t)
    return df.withColumn(name, e)


def weighted_actual_vs_predicted(df: DataFrame, *, y: str = "dlq_chg", pred: str = "pred",
                                 weight: str = "loan_count", date_col: str = "report_date",
                                 extra=()) -> DataFrame:
    """month -> loan-weighted actual and predicted (and any ``extra`` prediction columns)."""
    w = F.col(weight)
    aggs = [F.sum(w).alias("_w"), F.sum(F.col(y) * w).alias("_a"), F.sum(F.col(pred) * w).alias("_p")]
    aggs += [F.sum(F.col(c) * w).alias(f"_x_{c}") for c in extra]
    g = df.groupBy(date_col).agg(*aggs)
    mean = lambda c: F.try_divide(F.col(c), F.col("_w").cast("double"))
    return g.select(date_col, mean("_a").alias("actual"), mean("_p").alias("predicted"), *[mean(f"_x_{c}").alias(c) for c in extra])


def rmse_by_period(cmp: DataFrame, periods: DataFrame, *, date_col: str = "report_date", extra=()) -> DataFrame:
    """Named periods (may overlap, open end) -> model RMSE, naive RMSE (predict 0), and RMSE of ``extra`` columns.

    ``periods`` is (period, start, end) with ``end`` null for open-ended; the join
    is a range join against a handful of period rows (broadcast).
    """
    d = F.col(date_col)
    cond = (d >= F.col("start")) & (F.col("end").isNull() | (d <= F.col("end")))
    j = cmp.join(F.broadcast(periods), cond)
    aggs = [F.sqrt(F.avg(F.pow(F.col("predicted") - F.col("actual"), 2))).alias("model_rmse"),
            F.sqrt(F.avg(F.pow(F.col("actual"), 2))).alias("naive_rmse"), F.count(F.lit(1)).alias("months")]
    aggs += [F.sqrt(F.avg(F.pow(F.col(c) - F.col("actual"), 2))).alias(f"{c}_rmse") for c in extra]
    return j.groupBy("period").agg(*aggs)


def lag_sensitivity(pnl: DataFrame, *, lags=(3, 5, 7, 8), train_end: str, y: str = "dlq_chg",
                    xs=("ur_lag", "hpi_lag"), weight: str = "loan_count", cluster: str = "property_state",
                    by="property_state", order_by: str = "report_date", source: str = "ur_chg") -> DataFrame:
    """Refit with the unemployment change lagged by each of ``lags``: beta, SE, R² per lag, one job.

    Every lag's column is produced in one window pass, the panel is stacked to
    (lag, value) rows, and all fits run as one grouped ``wls_fit`` by lag.
    """
    w = Window.partitionBy(by).orderBy(order_by)
    xs = list(xs)
    lagged = xs[0]
    keep = [c for c in pnl.columns if c != lagged]
    d = pnl.select(*keep, *[F.lag(source, k).over(w).alias(f"_l{k}") for k in lags])
    stack = ", ".join(f"{k}, _l{k}" for k in lags)
    d = d.selectExpr(*[f"`{c}`" for c in keep], f"stack({len(lags)}, {stack}) AS (lag, {lagged})")
    tr = filters.dropna_subset(d.filter(F.col(order_by) <= F.lit(train_end).cast("date")), [y, *xs])
    fit = wls_fit(tr, y=y, x=xs, weight=weight, cluster=cluster, by=["lag"])
    return fit.filter(F.col("term") == lagged).select("lag", "beta", "se", "r2", "n")


# ---------------------------------------------------------------------------------
# Book, shock and stress
# ---------------------------------------------------------------------------------


def book_beta(book: DataFrame, betas: DataFrame, *, tier_col: str = "tier", beta_col: str = "beta_tier",
              upb: str = "unpaid_principal_balance") -> DataFrame:
    """Attach the tier beta; unknown tiers get the UPB-weighted mean beta of the known ones.

    The fill value is a scalar subquery over the joined book.  The joined book (states x tiers rows)
    is checkpointed once, so the subquery and the result read it instead of both
    re-scanning the loan tables.
    """
    b = betas.select(F.trim(F.col(tier_col)).alias(tier_col), F.col(beta_col).alias("_beta"))
    j = cut(book.withColumn(tier_col, F.trim(F.col(tier_col))).join(b, tier_col, "left"))
    u = F.col(upb).cast("double")
    known = j.filter(F.col("_beta").isNotNull())
    fill = known.agg(F.try_divide(F.sum(F.col("_beta") * u), F.sum(u))).scalar()
    return (j.withColumn("beta_known", F.col("_beta").isNotNull())
            .withColumn("beta", F.coalesce(F.col("_beta"), fill)).drop("_beta"))


def unknown_share(book_b: DataFrame, upb: str = "unpaid_principal_balance") -> DataFrame:
    """Share of UPB whose tier had no beta."""
    u = F.col(upb).cast("double")
    return book_b.agg(F.try_divide(F.sum(F.when(~F.col("beta_known"), u).otherwise(0.0)), F.sum(u)).alias("unknown_share"))


def shock_uniform(states: DataFrame, *, shock: float = 4.5, state_col: str = "state") -> DataFrame:
    """Every state of the economy table gets the same shock."""
    return states.select(state_col).distinct().withColumn("ur_shock", F.lit(float(shock)))


def shock_historical(econ: DataFrame, *, pre: str, window: tuple[str, str]) -> DataFrame:
    """Per state: max unemployment in the window minus unemployment at ``pre``; missing either -> null.

    One pass: two conditional aggregates per state.
    """
    d, ur = F.col("report_date"), F.col("unemployment_rate")
    lo, hi = F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date")
    g = econ.groupBy("state").agg(F.max(F.when(d.between(lo, hi), ur)).alias("_peak"),
                                  F.max(F.when(d == F.lit(pre).cast("date"), ur)).alias("_pre"))
    return g.select("state", (F.col("_peak") - F.col("_pre")).alias("ur_shock"))


def stress_book(book_b: DataFrame, shock: DataFrame, *, upb: str = "unpaid_principal_balance") -> DataFrame:
    """Inner join on state; stressed UPB = beta · shock / 100 · UPB (a null shock keeps the row, null stress)."""
    s = shock.withColumnRenamed("state", "state_code")
    j = book_b.join(s, "state_code")
    return j.withColumn("stressed_upb", F.col("beta") * F.col("ur_shock") / 100 * F.col(upb).cast("double"))


def stress_total(stressed: DataFrame, *, upb: str = "unpaid_principal_balance") -> DataFrame:
    """Book-wide change in points and stressed UPB in billions."""
    return stressed.agg(
        (F.try_divide(F.sum("stressed_upb"), F.sum(F.col(upb).cast("double"))) * 100).alias("book_dlq_chg_pts"),
        (F.sum("stressed_upb") / 1e9).alias("stressed_upb_bn"),
        (F.sum(F.col(upb).cast("double")) / 1e9).alias("book_upb_bn"))


def _share(num, den) -> Column:
    return F.try_divide(F.col(num) if isinstance(num, str) else num, F.col(den) if isinstance(den, str) else den)


def state_scorecard(stressed: DataFrame, *, upb: str = "unpaid_principal_balance") -> DataFrame:
    """state -> UPB share, projected change, stressed $B, stress share, concentration ratio."""
    g = stressed.groupBy("state_code").agg(F.sum(F.col(upb).cast("double")).alias("_u"), F.sum("stressed_upb").alias("_s"))
    tu, ts = F.col("_tu"), F.col("_ts")  # over the grouped rows, one per state
    return (with_total(with_total(g, "_tu", "_u"), "_ts", "_s").withColumn("proj_dlq_chg", _share("_s", "_u") * 100)
            .withColumn("upb_share", _share("_u", tu) * 100)
            .withColumn("stress_share", _share("_s", ts) * 100)
            .withColumn("conc_ratio", _share("stress_share", "upb_share"))
            .withColumn("stressed_upb_bn", F.col("_s") / 1e9)
            .select("state_code", "upb_share", "proj_dlq_chg", "stressed_upb_bn", "stress_share", "conc_ratio"))


def issuer_scorecard(stressed: DataFrame, *, upb: str = "unpaid_principal_balance") -> DataFrame:
    """issuer -> UPB $B, mix beta, projected change, stressed $B, unknown %, shares, concentration ratio,
    mix vs peer, geography factor (concentration ÷ mix)."""
    u = F.col(upb).cast("double")
    g = stressed.groupBy("issuer_id", "issuer_name").agg(
        F.sum(u).alias("_u"), F.sum("stressed_upb").alias("_s"),
        F.sum(F.col("beta") * u).alias("_bu"),
        F.sum(F.when(~F.col("beta_known"), u).otherwise(0.0)).alias("_unk"))
    for name, value in (("_tu", "_u"), ("_ts", "_s"), ("_tb", "_bu")):  # over the grouped rows, one per issuer
        g = with_total(g, name, value)
    tu, ts, peer = F.col("_tu"), F.col("_ts"), F.try_divide(F.col("_tb"), F.col("_tu"))
    return (g.withColumn("upb_bn", F.col("_u") / 1e9)
            .withColumn("mix_beta", _share("_bu", "_u"))
            .withColumn("proj_dlq_chg", _share("_s", "_u") * 100)
            .withColumn("stressed_upb_bn", F.col("_s") / 1e9)
            .withColumn("unknown_pct", _share("_unk", "_u") * 100)
            .withColumn("upb_share", _share("_u", tu) * 100)
            .withColumn("stress_share", _share("_s", ts) * 100)
            .withColumn("conc_ratio", _share("stress_share", "upb_share"))
            .withColumn("mix_vs_peer", _share("mix_beta", peer))
            .withColumn("geo_factor", _share("conc_ratio", "mix_vs_peer"))
            .drop("_u", "_s", "_bu", "_unk", "_tu", "_ts", "_tb"))
