"""Business rules: bands, tiers, labels and the fixed lookup tables.

Every ladder is a JVM-side ``CASE WHEN`` column expression; lookup tables are
small literal DataFrames meant for broadcast joins (their size is fixed and
does not grow with the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------
# Fixed values that must equal the reference's for results to match.
# ---------------------------------------------------------------------------------

# Issuer size bands by loan count in a month: below each edge gets that label.
ISSUER_GROUP_EDGES = [(2500, "Very Small"), (10000, "Small"), (75000, "Medium"), (400000, "Large")]
ISSUER_GROUP_TOP = "Mega"

# Removal reason codes.
REMOVAL_REASONS = {
    1: "Mortgagor Payoff",
    2: "Repurchase of DQ Loan",
    3: "Foreclosure",
    4: "Loss Mitigation",
    5: "Substitution",
    6: "Other",
}

# Risk pre-aggregate bands and their collapse into model tiers.
FICO_BUCKET_TO_BAND = {"<640": "<680", "640-679": "<680", "680-739": "680-739", "740+": "740+"}
LTV_BUCKET_TO_BAND = {"<=80": "<=90", "80-90": "<=90", "90-95": ">90", "95+": ">90"}

# Scenario templates: description, dq increase mild/moderate/severe,
# cure rate mild/moderate/severe, loss severity, scope.
SCENARIO_TEMPLATES = {
    "hurricane": ("Major hurricane impact", 0.05, 0.12, 0.25, 0.60, 0.45, 0.25, 0.15, "state"),
    "earthquake": ("Major earthquake impact", 0.04, 0.10, 0.20, 0.55, 0.40, 0.20, 0.20, "state"),
    "flood": ("Severe flooding impact", 0.06, 0.15, 0.30, 0.55, 0.40, 0.22, 0.18, "state"),
    "unemployment": ("Unemployment spike", 0.03, 0.08, 0.15, 0.65, 0.50, 0.35, 0.10, "state"),
    "interest_rate_shock": ("Rapid interest rate increase", 0.02, 0.05, 0.10, 0.70, 0.55, 0.40, 0.08, "nationwide"),
    "housing_market_crash": ("Housing market downturn", 0.04, 0.10, 0.22, 0.50, 0.35, 0.15, 0.25, "state"),
}
SEVERITIES = ["mild", "moderate", "severe"]
SEVERITY_RANK = {"severe": 3, "moderate": 2, "mild": 1}
STATE_SCENARIOS = ["hurricane", "earthquake", "flood", "unemployment", "housing_market_crash"]

# State names to two-letter codes (lower-case names).
STATE_MAP = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR",
    "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID",
    "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS",
    "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE",
    "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ",
    "new mexico": "NM", "new york": "NY", "north carolina": "NC",
    "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR",
    "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT",
    "vermont": "VT", "virginia": "VA", "washington": "WA",
    "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
    "district of columbia": "DC",
}

# Weather alert event to (scenario, severity).
ALERT_EVENT_MAP = {
    "Hurricane Warning": ("hurricane", "severe"),
    "Hurricane Watch": ("hurricane", "moderate"),
    "Tropical Storm Warning": ("hurricane", "mild"),
    "Tropical Storm Watch": ("hurricane", "mild"),
    "Flash Flood Warning": ("flood", "severe"),
    "Flood Warning": ("flood", "moderate"),
    "Flash Flood Watch": ("flood", "mild"),
    "Flood Watch": ("flood", "mild"),
    "Earthquake Warning": ("earthquake", "severe"),
    "Tsunami Warning": ("earthquake", "severe"),
    "Severe Thunderstorm Warning": ("flood", "mild"),
    "Storm Surge Warning": ("hurricane", "severe"),
    "Storm Surge Watch": ("hurricane", "moderate"),
}

# Disaster declaration incident types that affect housing.
DISASTER_INCIDENT_TYPES = ["Hurricane", "Flood", "Earthquake", "Severe Storm(s)", "Tornado", "Fire",
                           "Typhoon", "Coastal Storm"]

# Calibration multipliers and cure adjustments.
CALIBRATION_DQ_MULTIPLIERS = {"mild": 3, "moderate": 8, "severe": 16}
CURE_DEFAULT = 0.50
SEVERITY_DEFAULT = 0.15

# ---------------------------------------------------------------------------------
# Column rules
# ---------------------------------------------------------------------------------


def fico_bucket(score: Column) -> Column:
    """Four credit-score bands of the risk pre-aggregate; null stays null."""
    return (F.when(score < 640, "<640").when(score < 680, "640-679")
            .when(score < 740, "680-739").when(score >= 740, "740+"))


def ltv_bucket(ltv: Column) -> Column:
    """Four LTV bands of the risk pre-aggregate; null stays null."""
    return (F.when(ltv <= 80, "<=80").when(ltv <= 90, "80-90")
            .when(ltv <= 95, "90-95").when(ltv > 95, "95+"))


def _map_expr(mapping: dict, c: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr


def tier_from_buckets(fico_b: Column, ltv_b: Column) -> Column:
    """Model tier ``'<fico band> / <ltv band>'`` from the pre-aggregate buckets; null if either is unmapped."""
    return F.concat(_map_expr(FICO_BUCKET_TO_BAND, fico_b), F.lit(" / "), _map_expr(LTV_BUCKET_TO_BAND, ltv_b))


def credit_tier(score: Column, ltv: Column, unknown: str | None = "unknown") -> Column:
    """Tier of a loan from raw score and LTV.

    ``unknown='unknown'`` labels missing parts (the book form); ``unknown=None``
    makes the whole tier null when a part is missing (the mix form, filtered later).
    """
    s, l_ = score.cast("double"), ltv.cast("double")
    fico = F.when(s < 680, "<680").when(s < 740, "680-739").when(s.isNotNull(), "740+")
    ltvb = F.when(l_ <= 90, "<=90").when(l_.isNotNull(), ">90")
    if unknown is None:
        return F.concat(fico, F.lit(" / "), ltvb)
    return F.concat(F.coalesce(fico, F.lit(unknown)), F.lit(" / "), F.coalesce(ltvb, F.lit(unknown)))


def dq_bucket(months: Column) -> Column:
    return (F.when(months == 0, "Current").when(months == 1, "30 Days").when(months == 2, "60 Days")
            .when(months == 3, "90 Days").when(months >= 4, "120+ Days").otherwise("Unknown"))


def dq_label(months: Column) -> Column:
    """Status label of the loan-month: null months count as Delinquent."""
    return F.when(months == 0, "Current").otherwise("Delinquent")


def issuer_group(loans: Column, edges=ISSUER_GROUP_EDGES, top: str = ISSUER_GROUP_TOP) -> Column:
    expr = None
    for edge, label in edges:
        expr = F.when(loans < edge, label) if expr is None else expr.when(loans < edge, label)
    return expr.otherwise(top)


def buyer_label(flag: Column) -> Column:
    return (F.when(flag.isNull() | flag.isin("NaN", "N"), "Repeat Buyer")
            .when(flag == "Y", "First Time Buyer"))


def assistance_label(flag: Column) -> Column:
    return (F.when(flag.isNull() | flag.isin("NaN", "N"), "No Assistance")
            .when(flag == "Y", "Received Assistance"))


def insurer_label(agency: Column, dialect: str = "tsql") -> Column:
    """Agency letter to insurer name; unmatched is 'PIH' (tsql) or the letter itself (pg)."""
    base = F.when(agency == "F", "FHA").when(agency == "V", "VA").when(agency == "R", "RD")
    return base.otherwise("PIH" if dialect == "tsql" else agency)


# ---------------------------------------------------------------------------------
# Literal lookup tables (fixed size: safe to broadcast)
# ---------------------------------------------------------------------------------


def removal_reason_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REMOVAL_REASONS.items()), "removal_code int, removal_label string")


def scenario_template_table(spark: SparkSession) -> DataFrame:
    """Six scenarios x three severities: one row per (scenario, severity)."""
    rows = []
    for name, (desc, dm, dmo, ds, cm, cmo, cs, sev, scope) in SCENARIO_TEMPLATES.items():
        for severity, dq, cure in zip(SEVERITIES, (dm, dmo, ds), (cm, cmo, cs)):
            rows.append((name, desc, severity, dq, cure, sev, scope))
    return spark.createDataFrame(
        rows, "scenario_type string, description string, severity string, dq_increase double, "
              "cure_rate double, loss_severity double, affected_by string")


def state_map_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(STATE_MAP.items()), "state_name string, state_code string")


def alert_event_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, s, v) for k, (s, v) in ALERT_EVENT_MAP.items()],
                                 "event string, scenario_type string, severity string")


def severity_rank(sev: Column) -> Column:
    return F.when(sev == "severe", 3).when(sev == "moderate", 2).when(sev == "mild", 1)
