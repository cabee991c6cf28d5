"""Readers for landed feeds: second-agency performance CSV, economic series, disaster
declarations, weather alerts, issuer ratio sheets and new-issuance files.

The reference calls web services; here the responses are files landed in
storage, read with explicit schemas (no inference) and shaped with column
expressions.  Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loanlens.functions import rules
from loanlens.functions.clean import blank_null
from loanlens.operators.panel import ffill
from loanlens.sources.layouts import FNMA_FIELDS, LL_FIELDS
from loanlens.sources.records import read_records, report_month

# ---------------------------------------------------------------------------------
# Second agency performance file
# ---------------------------------------------------------------------------------


def read_fnma_perf(spark: SparkSession, paths, *, fields=FNMA_FIELDS) -> DataFrame:
    """Pipe-delimited, no header, all strings; only the first ``len(fields)`` columns are kept."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return (spark.read.schema(schema).option("sep", "|").option("header", "false").option("mode", "PERMISSIVE")
            .csv(paths))


# ---------------------------------------------------------------------------------
# Economic series
# ---------------------------------------------------------------------------------


def read_series(spark: SparkSession, path: str, value: str) -> DataFrame:
    """Landed two-column series CSVs (date, value) in folders ``series=<STATE><SUFFIX>``; bad values -> null."""
    schema = T.StructType([T.StructField("observation_date", T.StringType()), T.StructField("value", T.StringType()),
                           T.StructField("series", T.StringType())])
    df = spark.read.schema(schema).option("header", "true").csv(path)
    v = F.col("value").try_cast("double")
    return df.select(F.col("series"), F.col("observation_date").try_cast("date").alias("report_date"),
                     F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v).alias(value))


def read_econ(spark: SparkSession, ur_path: str, hpi_path: str, *, ur_suffix: str = "UR",
              hpi_suffix: str = "STHPI") -> DataFrame:
    """Per-state unemployment LEFT JOIN house prices on date, HPI forward-filled within the state, all states.

    One left join on (state, date) and one window per state (a state's months).
    """
    ur = read_series(spark, ur_path, "unemployment_rate")
    ur = ur.withColumn("state", F.regexp_replace("series", f"{ur_suffix}$", "")).drop("series")
    hpi = read_series(spark, hpi_path, "hpi_index")
    hpi = hpi.withColumn("state", F.regexp_replace("series", f"{hpi_suffix}$", "")).drop("series")
    j = ur.join(hpi, ["state", "report_date"], "left")
    j = ffill(j, by="state", order_by="report_date", col="hpi_index")
    return j.select("report_date", "state", "unemployment_rate", "hpi_index",
                    F.lit(None).cast("decimal(5,3)").alias("mortgage_rate_30yr"))


# ---------------------------------------------------------------------------------
# Disaster declarations and weather alerts (landed JSON)
# ---------------------------------------------------------------------------------

DECLARATION_SCHEMA = T.StructType([
    T.StructField("disasterNumber", T.LongType()), T.StructField("stateCode", T.StringType()),
    T.StructField("declarationDate", T.StringType()), T.StructField("incidentType", T.StringType()),
    T.StructField("declarationTitle", T.StringType()), T.StructField("incidentBeginDate", T.StringType()),
    T.StructField("incidentEndDate", T.StringType()), T.StructField("declarationType", T.StringType()),
])


def read_disasters(spark: SparkSession, path: str, *, start_year: int, state: str | None = None,
                   incident_types=tuple(rules.DISASTER_INCIDENT_TYPES), top: int | None = None,
                   wrapped: bool = False) -> DataFrame:
    """Declarations after ``start_year``-01-01 of the housing incident types (optionally one state).

    One row per (disaster number, state): the first in date-descending order.
    Dates are cut to 10 characters.  ``wrapped`` reads API pages
    (``{"DisasterDeclarationsSummaries": [...]}``) instead of one record per line.
    ``top`` keeps the latest n raw records, as a page request does.
    """
    if wrapped:
        page = T.StructType([T.StructField("DisasterDeclarationsSummaries", T.ArrayType(DECLARATION_SCHEMA))])
        raw = spark.read.schema(page).option("multiLine", "true").json(path).select(
            F.explode("DisasterDeclarationsSummaries").alias("r")).select("r.*")
    else:
        raw = spark.read.schema(DECLARATION_SCHEMA).json(path)
    d = raw.filter((F.col("declarationDate") > f"{start_year}-01-01T00:00:00.000Z")
                   & F.col("incidentType").isin(list(incident_types)))
    if state is not None:
        d = d.filter(F.col("stateCode") == state)
    order = [F.desc("declarationDate"), F.asc("disasterNumber"), F.asc("stateCode"), F.asc("declarationTitle"),
             F.asc("declarationType"), F.asc("incidentEndDate")]
    if top:
        d = d.orderBy(*order).limit(top)
    w = Window.partitionBy("disasterNumber", "stateCode").orderBy(*order)
    d = d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    cut = lambda c: F.left(F.coalesce(F.col(c), F.lit("")), F.lit(10))
    return d.select(F.col("disasterNumber").alias("disaster_number"), F.col("stateCode").alias("state"),
                    cut("declarationDate").alias("declaration_date"), F.coalesce("incidentType", F.lit("")).alias("incident_type"),
                    F.coalesce("declarationTitle", F.lit("")).alias("declaration_title"),
                    cut("incidentBeginDate").alias("incident_begin"), cut("incidentEndDate").alias("incident_end"),
                    F.coalesce("declarationType", F.lit("")).alias("declaration_type"))


ALERT_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("properties", T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("geocode", T.StructType([T.StructField("UGC", T.ArrayType(T.StringType()))])),
    T.StructField("areaDesc", T.StringType()), T.StructField("headline", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("urgency", T.StringType()),
    T.StructField("onset", T.StringType()), T.StructField("expires", T.StringType()),
]))])


def read_alerts(spark: SparkSession, path: str, event_map: DataFrame) -> DataFrame:
    """Mapped weather alerts, one row per (scenario, severity, state), the first in feed order.

    The state is the 2-letter prefix of each UGC zone code, kept when it is a
    valid state code; the event maps to (scenario, severity) through the fixed
    event table (broadcast); the description is cut to 200 characters.
    """
    valid = sorted(set(rules.STATE_MAP.values()))
    a = spark.read.schema(ALERT_SCHEMA).json(path).select("id", "properties.*")
    a = a.join(F.broadcast(event_map), "event")
    states = F.array_distinct(F.filter(F.transform(F.coalesce(F.col("geocode.UGC"), F.array()),
                                                   lambda z: F.left(z, F.lit(2))),
                                       lambda s: s.isin(valid)))
    x = a.select("*", F.explode(states).alias("state"))
    w = Window.partitionBy("scenario_type", "severity", "state").orderBy(F.asc("onset"), F.asc("id"))
    x = x.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    s = lambda c: F.coalesce(F.col(c), F.lit(""))
    return x.select("event", "scenario_type", "severity", "state", s("headline").alias("headline"),
                    F.left(s("description"), F.lit(200)).alias("description"), s("urgency").alias("urgency"),
                    s("onset").alias("onset"), s("expires").alias("expires"), "id")


# ---------------------------------------------------------------------------------
# Issuer ratio sheets and new issuance
# ---------------------------------------------------------------------------------


def read_dq_ratios(spark: SparkSession, path: str) -> DataFrame:
    """Issuer ratio sheet exported as CSV; ratios parsed exactly as decimals from their text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["ID", "Report Date", "DQ2", "DQ3", "DQP", "FIC"]])
    df = spark.read.schema(schema).option("header", "true").csv(path)
    dec = lambda c: blank_null(F.col(f"`{c}`")).try_cast("decimal(18,8)")
    return df.select(F.col("ID").alias("id"), F.col("`Report Date`").try_cast("date").alias("report_date"),
                     dec("DQ2").alias("dq2"), dec("DQ3").alias("dq3"), dec("DQP").alias("dqp"), dec("FIC").alias("fic"))


def read_new_issuance(spark: SparkSession, paths, *, as_of, since=None) -> DataFrame:
    """New-issuance LL files, with the operator-supplied as-of date replacing the file's.

    ``since`` keeps the files whose name (or folder) says that month or a later one; the
    other files' names are all that is looked at, their lines are filtered out in the scan.
    """
    r = read_records(spark, paths, "LL", LL_FIELDS)
    if since is not None:
        r = r.filter(report_month(F.col("source")) >= F.lit(since).cast("date"))
    return r.drop("as_of_date").withColumn("as_of_date", F.lit(as_of).cast("date"))


MF_LOAN_COLUMNS = ["CUSIP", "Pool_Number", "Pool_Indicator", "Pool_Type", "Security_Interest_Rate", "Issuer_Number", "Loan_Type",
                   "Loan_Interest_Rate", "Unpaid_Principal_Balance", "Months_Delinquent", "Property_Name", "Property_Street",
                   "Property_City", "Property_State", "Property_Zip", "Report_Date"]  # fixed values: columns of the sheet


def read_mf_loans(spark: SparkSession, path: str) -> DataFrame:
    """Multifamily loan sheet exported as CSV (16 columns, lower-case names out), numbers and the date typed; bad values -> null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in MF_LOAN_COLUMNS])
    df = spark.read.schema(schema).option("header", "true").csv(path)
    kinds = {"Security_Interest_Rate": "decimal(6,3)", "Loan_Interest_Rate": "decimal(6,3)", "Issuer_Number": "int",
             "Unpaid_Principal_Balance": "decimal(14,2)", "Months_Delinquent": "int", "Report_Date": "date"}
    return df.select(*[(blank_null(F.col(c)).try_cast(kinds[c]) if c in kinds else blank_null(F.col(c))).alias(c.lower())
                       for c in MF_LOAN_COLUMNS])
