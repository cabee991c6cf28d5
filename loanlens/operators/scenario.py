"""Scenario (loss-waterfall) operators.

One grid answers every menu choice of the reference: exposure per area (each
state, plus the nationwide book) equi-joined on scope to the fixed template
table (18 rows, broadcast), then the waterfall as column arithmetic.  Filters of
the grid give the single-state, all-scenarios and compare-states views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.operators import reports


def scenario_templates(spark) -> DataFrame:
    """The fixed template table: 6 scenarios x 3 severities."""
    return rules.scenario_template_table(spark)


def area_exposure(pool_loans: DataFrame) -> DataFrame:
    """Exposure per state (scope 'state') plus the whole book (scope 'nationwide'), with the book total."""
    by_state = reports.portfolio_exposure(pool_loans, by_state=True)
    measures = {f.name: f.dataType for f in by_state.schema.fields if f.name != "state"}
    # each state counts for itself and for the nation; an empty book still has its nationwide row of zeros
    place = F.explode(F.array(F.struct(F.col("state").alias("state"), F.lit("state").alias("scope")),
                              F.struct(F.lit("Nationwide").alias("state"), F.lit("nationwide").alias("scope"))))
    twice = by_state.select(place.alias("p"), *measures).select("p.state", "p.scope", *measures)
    zero = pool_loans.sparkSession.range(1).select(F.lit("Nationwide").alias("state"), F.lit("nationwide").alias("scope"),
                                                   *[F.lit(0).cast(t).alias(c) for c, t in measures.items()])
    g = twice.unionByName(zero).groupBy("state", "scope").agg(*[F.sum(c).cast(t).alias(c) for c, t in measures.items()])
    book = F.sum(F.when(F.col("scope") == "nationwide", F.col("total_upb"))).over(Window.partitionBy())
    return g.withColumn("book_upb", book.cast("double"))


def waterfall_columns(df: DataFrame) -> DataFrame:
    """The loss waterfall on rows carrying exposure and template columns.

    performing = total - delinquent; new DQ loans = trunc(performing x increase);
    cured = trunc(new x cure); defaults = new - cured; default UPB = new UPB x
    (1 - cure); loss = default UPB x severity.  Loan counts are >= 0 so floor
    equals the reference's int() truncation.
    """
    tl, tu = F.col("total_loans"), F.col("total_upb").cast("double")
    dl, du = F.col("current_dq_loans"), F.col("current_dq_upb").cast("double")
    inc, cure, sev = F.col("dq_increase"), F.col("cure_rate"), F.col("loss_severity")
    perf_l, perf_u = tl - dl, tu - du
    new_l = F.floor(perf_l * inc).cast("bigint")
    new_u = perf_u * inc
    cured_l = F.floor(new_l * cure).cast("bigint")
    d = (df.withColumn("performing_loans", perf_l).withColumn("performing_upb", perf_u)
         .withColumn("new_dq_loans", new_l).withColumn("new_dq_upb", new_u)
         .withColumn("cured_loans", cured_l).withColumn("cured_upb", new_u * cure)
         .withColumn("default_loans", F.col("new_dq_loans") - F.col("cured_loans"))
         .withColumn("default_upb", new_u * (1 - cure))
         .withColumn("projected_losses", F.col("default_upb") * sev)
         .withColumn("total_dq_loans", dl + F.col("new_dq_loans"))
         .withColumn("total_dq_upb", du + new_u))
    rate = lambda n: F.when(tl > 0, n.cast("double") / tl.cast("double") * 100).otherwise(0.0)
    return (d.withColumn("pct_of_portfolio", F.try_divide(tu, F.col("book_upb")) * 100)
            .withColumn("current_dq_rate", rate(dl))
            .withColumn("projected_dq_rate", rate(F.col("total_dq_loans")))
            .withColumn("portfolio_impact_pct", F.try_divide(F.col("projected_losses"), F.col("book_upb")) * 100))


def loss_waterfall(pool_loans: DataFrame, templates: DataFrame) -> DataFrame:
    """Every (area, scenario, severity) waterfall: state scenarios per state, nationwide ones on the book."""
    ex = area_exposure(pool_loans)
    t = templates.withColumnRenamed("affected_by", "scope")
    return waterfall_columns(ex.join(F.broadcast(t), "scope"))


def scenario_all_for_state(grid: DataFrame, *, state: str, severity: str) -> DataFrame:
    """The five state scenarios for one state at one severity."""
    return grid.filter((F.col("state") == state) & (F.col("severity") == severity)
                       & F.col("scenario_type").isin(rules.STATE_SCENARIOS))


def scenario_compare_states(grid: DataFrame, *, states, scenario: str, severity: str) -> DataFrame:
    """One scenario and severity across chosen states."""
    return grid.filter(F.col("state").isin(list(states)) & (F.col("scenario_type") == scenario)
                       & (F.col("severity") == severity))


def alert_worst(alerts: DataFrame, *, order: list[str] = ("ts", "event_id")) -> DataFrame:
    """Per state x scenario keep the worst severity (severe > moderate > mild), the earliest alert on ties.

    A window per (state, scenario): a hot state is one partition holding its own
    alerts only; at stream scale the same rule runs as a watermarked aggregate.
    """
    rank = rules.severity_rank(F.col("severity"))
    w = Window.partitionBy("state", "scenario_type").orderBy(F.desc("_rank"), *[F.asc(c) for c in order])
    return (alerts.withColumn("_rank", rank).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn", "_rank"))


def alert_scenarios(worst: DataFrame, pool_loans: DataFrame, templates: DataFrame) -> DataFrame:
    """Worst alerts x state exposure (states with loans) x template -> loss table."""
    ex = area_exposure(pool_loans).filter((F.col("scope") == "state") & (F.col("total_loans") > 0)).drop("scope")
    j = (worst.select("state", "scenario_type", "severity", "event_id")
         .join(ex, "state")
         .join(F.broadcast(templates), ["scenario_type", "severity"]))
    return waterfall_columns(j)


def resolve_state(df: DataFrame, col: str, state_map: DataFrame, *, name: str = "state_code") -> DataFrame:
    """Name or code -> two-letter code, case-insensitive and trimmed; anything else null."""
    key = F.lower(F.trim(F.col(col)))
    codes = state_map.select(F.col("state_code").alias("_code")).distinct()
    by_name = state_map.select(F.col("state_name").alias("_k"), F.col("state_code").alias("_by_name"))
    j = (df.withColumn("_k", key).join(F.broadcast(by_name), "_k", "left")
         .join(F.broadcast(codes), F.upper(F.col("_k")) == F.col("_code"), "left"))
    return j.withColumn(name, F.coalesce(F.col("_by_name"), F.col("_code"))).drop("_k", "_by_name", "_code")


def top_exposed(results: DataFrame, top_issuers: DataFrame, top_msas: DataFrame) -> DataFrame:
    """The top issuers and MSAs attached to each state result, in long form (state, kind, rank, name, loans, upb)."""
    iss = top_issuers.select(F.col("property_state").alias("state"), F.lit("issuer").alias("kind"), "rank",
                             F.col("issuer_name").alias("name"), "loan_count", F.col("issuer_upb").alias("upb"))
    msa = top_msas.select(F.col("property_state").alias("state"), F.lit("msa").alias("kind"), "rank",
                          F.col("msa").alias("name"), "loan_count", F.col("msa_upb").alias("upb"))
    states = results.select("state").distinct()  # any frame with the states wanted
    return iss.unionByName(msa).join(states, "state", "left_semi")
