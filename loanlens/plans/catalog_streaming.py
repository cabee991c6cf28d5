"""Registered streaming queries (§2.11).

Each runs a Structured Streaming query to completion (``availableNow``) over
files landed from the driver tables, writes into fresh tables in the shared
checkpoint folder (with its own streaming checkpoint there) and returns the
resulting table; the oracle is the equivalent batch SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.plans import fixtures
from loanlens.plans.adapter import Tables
from loanlens.plans.catalog import Q, register
from loanlens.plans.catalog_maintain import LL_SQL, LR_SQL
from loanlens.plans.catalog_sources import _once
from loanlens.session import scratch_path
from loanlens.streaming import book as books
from loanlens.streaming import streams

NOW = "2026-06-01 00:00:00"
BATCHES = 4  # micro-batches that the landed events make


def _ingest(t: Tables, force=(False,)) -> str:
    """The book that streams made from the inbox (flat, nested, zipped; loans and liquidations; stray files), one for each of ``force``."""
    inbox = fixtures.inbox(t)
    base = scratch_path(t.spark, "stream-ingest")
    books.put(t.spark, f"{base}/book", "issuers", t.issuer_info.withColumn("issuer_number", F.col("issuer_number").cast("int")))
    for i, again in enumerate(force):
        streams.stream_ingest(t.spark, inbox, book=f"{base}/book", checkpoint=f"{base}/_checkpoint{i}", max_files=200, force=again,
                              now=NOW, keep=2).awaitTermination()
    return f"{base}/book"


_MONTHLY_SQL = Q("""
SELECT disclosure_sequence_number, CAST(issuer_id AS INTEGER) AS issuer_id,
  CAST(unpaid_principal_balance AS DECIMAL(14,2)) AS unpaid_principal_balance, CAST(loan_age AS INTEGER) AS loan_age_months,
  CAST(months_delinquent AS INTEGER) AS months_delinquent,
  CASE WHEN CAST(months_delinquent AS INTEGER) = 0 THEN 'Current' ELSE 'Delinquent' END AS delinquency_status, report_date
FROM ll""", {"ll": LL_SQL})

_LOADED_SQL = f"""
SELECT 'monthly' AS tbl, disclosure_sequence_number AS id, report_date, CAST(issuer_id AS BIGINT) AS n,
  CAST(unpaid_principal_balance AS DECIMAL(14,2)) AS amount,
  CASE WHEN CAST(months_delinquent AS INTEGER) = 0 THEN 'Current' ELSE 'Delinquent' END AS label FROM ll
UNION ALL SELECT 'static', disclosure_sequence_number, CAST(TIMESTAMP '{NOW}' AS DATE), CAST(credit_score AS BIGINT),
  CAST(original_principal_balance AS DECIMAL(14,2)), state_code FROM (
  SELECT *, row_number() OVER (PARTITION BY disclosure_sequence_number ORDER BY as_of_date DESC) AS rn FROM ll) x WHERE rn = 1
UNION ALL SELECT 'liquidations', disclosure_sequence_number, report_date, CAST(issuer_id AS BIGINT),
  CAST(liquidation_balance AS DECIMAL(14,2)), removal_reason FROM lr
UNION ALL SELECT 'log', 'loans', report_date, COUNT(*), CAST(0 AS DECIMAL(14,2)), 'files' FROM ll GROUP BY report_date
UNION ALL SELECT 'log', 'liquidations', report_date, COUNT(*), CAST(0 AS DECIMAL(14,2)), 'files' FROM lr GROUP BY report_date
UNION ALL SELECT 'issuers', CAST(i.issuer_number AS VARCHAR), CAST(TIMESTAMP '{NOW}' AS DATE), CAST(c.n AS BIGINT),
  CAST(0 AS DECIMAL(14,2)), CASE WHEN c.n IS NULL THEN i.issuer_group ELSE 'Very Small' END FROM issuer_info i LEFT JOIN (
  SELECT issuer_id, COUNT(*) AS n FROM (SELECT *, dense_rank() OVER (PARTITION BY issuer_id ORDER BY report_date DESC) AS r
  FROM loan_monthly) y WHERE r = 1 GROUP BY issuer_id) c ON c.issuer_id = i.issuer_number"""


@register("stream_ingest", Q(_LOADED_SQL, {"ll": LL_SQL, "lr": LR_SQL}))
def _stream_ingest(t: Tables):
    """Everything the loader made: loan-months, static loans, liquidations, log and issuer bands.

    The inbox comes twice; the second stream finds every file in the log and changes nothing.
    """
    book = _ingest(t, (False, False))
    amount = lambda c: F.col(c).cast("decimal(14,2)").alias("amount")
    none = F.lit(0).cast("decimal(14,2)").alias("amount")
    monthly, liq, issuers, static = (books.read(t.spark, book, x) for x in ("monthly", "liquidations", "issuers", "static"))
    month = F.max("report_date").over(Window.partitionBy("issuer_id"))
    latest = (monthly.groupBy("issuer_id", "report_date").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("m", month).filter("report_date = m").select("issuer_id", "n"))
    log = streams.load_log(t.spark, book)
    parts = [
        monthly.select(F.lit("monthly").alias("tbl"), F.col("disclosure_sequence_number").alias("id"), "report_date",
                       F.col("issuer_id").cast("bigint").alias("n"), amount("unpaid_principal_balance"),
                       F.col("delinquency_status").alias("label")),
        static.select(F.lit("static").alias("tbl"), F.col("disclosure_sequence_number").alias("id"),
                                      F.to_date("created_at").alias("report_date"), F.col("credit_score").cast("bigint").alias("n"),
                                      amount("original_principal_balance"), F.col("state_code").alias("label")),
        liq.select(F.lit("liquidations").alias("tbl"), F.col("disclosure_sequence_number").alias("id"), "report_date",
                   F.col("issuer_id").cast("bigint").alias("n"), amount("liquidation_balance"), F.col("removal_reason").alias("label")),
        log.groupBy("file_type", "report_date").agg(F.sum("rows_loaded").alias("n")).select(
            F.lit("log").alias("tbl"), F.col("file_type").alias("id"), "report_date", "n", none, F.lit("files").alias("label")),
        issuers.join(latest, issuers.issuer_number == latest.issuer_id, "left").select(
            F.lit("issuers").alias("tbl"), F.col("issuer_number").cast("string").alias("id"), F.to_date(F.lit(NOW)).alias("report_date"),
            "n", none, F.col("issuer_group").alias("label"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("stream_replace_period", _MONTHLY_SQL)
def _stream_replace_period(t: Tables):
    """The inbox delivered to two streams in turn: the second, told to load all again, replaces the months of the first."""
    return books.read(t.spark, _ingest(t, (False, True)), "monthly")


def _landed_events(t: Tables, name: str = "events_stream", copies: int = 1) -> str:
    """The events in files ordered by time, as many as the data asks for."""
    path = t.landed(name)

    def write():
        e = t.raw("events").select("event_id", "ts", "user_id", "event_type", "value")
        for _ in range(1, copies):
            e = e.unionByName(t.raw("events").select("event_id", "ts", "user_id", "event_type", "value"))
        e.repartitionByRange(t.write_tasks(), "ts").write.mode("overwrite").parquet(path)

    return _once(t.spark, path, write)


def _in_order(t: Tables, path: str) -> str:
    """Give the landed files times in the order of their names, which is that of their events: a stream takes them so."""
    sc = t.spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().getName() for f in fs.listStatus(root) if f.getPath().getName().startswith("part-"))
    for i, name in enumerate(parts):
        fs.setTimes(sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), 1_700_000_000_000 + 1000 * i, -1)
    return path


def _alerts_stream(t: Tables, copies: int = 1, ordered: bool = False):
    path = _landed_events(t, f"events_stream_x{copies}" + "_ordered" * ordered, copies)
    path = _in_order(t, path) if ordered else path
    schema = t.spark.read.parquet(path).schema
    e = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", -(-t.write_tasks() // BATCHES)).parquet(path)
    et, v = F.col("event_type"), F.col("value")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("state"),
        F.when(et == "error", "hurricane").when(et.isin("click", "view"), "flood").otherwise("earthquake").alias("scenario_type"),
        F.when(v >= 100, "severe").when(v >= 50, "moderate").otherwise("mild").alias("severity"), "user_id", "event_type", "value")


@register("stream_state_counts", Q("""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, state,
  COUNT(*) AS events, CAST(SUM(CASE WHEN severity = 'severe' THEN 1 ELSE 0 END) AS BIGINT) AS severe
FROM alerts GROUP BY 1, 2, 3"""))
def _stream_state_counts(t: Tables):
    agg = streams.stream_state_counts(_alerts_stream(t), watermark="31 days", window="1 day")
    path = scratch_path(t.spark, "stream-counts")
    streams.run_to_table(agg, path, f"{path}_checkpoint", mode="update")
    out = streams.latest_per_key(t.spark.read.parquet(path), ["window_start", "state"])
    return (out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
            .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


@register("stream_alert_worst", Q("""
SELECT state, scenario_type, event_id, ts, severity FROM (SELECT *, row_number() OVER (PARTITION BY state, scenario_type
  ORDER BY CASE severity WHEN 'severe' THEN 3 WHEN 'moderate' THEN 2 WHEN 'mild' THEN 1 END DESC, ts, event_id) AS rn
  FROM alerts) x WHERE rn = 1"""))
def _stream_alert_worst(t: Tables):
    worst = streams.stream_alert_worst(_alerts_stream(t, copies=2), watermark="31 days")
    path = scratch_path(t.spark, "stream-worst")
    streams.run_to_table(worst, path, f"{path}_checkpoint", mode="update")
    out = streams.latest_per_key(t.spark.read.parquet(path), ["state", "scenario_type"])
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


TTL_DAYS, DELAY_DAYS = 3, 1


@register("stream_alert_expiry", Q(f"""
SELECT state, scenario_type, event_id, ts, severity FROM (SELECT *, row_number() OVER (PARTITION BY state, scenario_type
  ORDER BY CASE severity WHEN 'severe' THEN 3 WHEN 'moderate' THEN 2 WHEN 'mild' THEN 1 END DESC, ts, event_id) AS rn
  FROM alerts WHERE -((-(epoch_us(ts) + {TTL_DAYS} * 86400000000)) // 1000) > (SELECT epoch_us(MAX(ts)) // 1000 FROM alerts) - {DELAY_DAYS} * 86400000) x
WHERE rn = 1"""))
def _stream_alert_expiry(t: Tables):
    """The worst alert of each state and scenario that has not expired when the stream ends."""
    streams.use_rocksdb(t.spark)
    worst = streams.stream_alert_expiry(_alerts_stream(t, copies=2, ordered=True), ttl_seconds=TTL_DAYS * 86400, watermark=f"{DELAY_DAYS} day")
    path = scratch_path(t.spark, "stream-expiry")
    streams.run_to_table(worst, path, f"{path}_checkpoint", mode="update")
    out = streams.latest_per_key(t.spark.read.parquet(path), ["state", "scenario_type"]).filter("event_id is not null")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_dedupe", Q("SELECT event_id, ts, user_id, event_type, value FROM events"))
def _stream_dedupe(t: Tables):
    a = _alerts_stream(t, copies=2).select("event_id", "ts", "user_id", "event_type", "value")
    d = streams.stream_dedupe(a, ["event_id"], watermark="31 days")
    path = scratch_path(t.spark, "stream-dedupe")
    streams.run_to_table(d, path, f"{path}_checkpoint", mode="append")
    return t.spark.read.parquet(path).drop("batch_id").withColumn("ts", F.col("ts").cast("timestamp_ntz"))

