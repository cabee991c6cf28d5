"""Structured Streaming forms of the loaders and of the stateful alert / count rules.

The reference polls an inbox, asks its load log before each file and loads a file in one
transaction.  Here a file-source stream picks up the names of new files, and ``load_files``
loads a batch of them into a book (``streaming.book``): months of loans and liquidations replaced, static loans
merged into buckets that split, issuer bands, load log and rejected lines, all of it by one manifest.

A file that is in the log with the same content is passed over, wherever it lies now; one of
the same name with other content replaces the rows of its loans and months; ``force`` loads all.
"""

from __future__ import annotations

import datetime
from collections import defaultdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanlens.functions import rules
from loanlens.operators import maintain
from loanlens.operators.joins import dedupe_first
from loanlens.session import cut, dropped, scratch_path, shuffles_dropped
from loanlens.sources.layouts import LL_FIELDS, LL_KEPT, LR_FIELDS, LR_KEPT
from loanlens.sources.records import (checked_records, content_digest, file_type, list_files, load_name, read_lines, read_zip_members,
                                      report_month)
from loanlens.streaming import book as books

ROWS_PER_BUCKET = 2_000_000  # mean of static loans per bucket beyond which the next bucket splits
LOG_FOLDERS = 64  # loads after which the log is written as one folder again
LOG_COLUMNS = ["file_name", "file_type", "report_date", "rows_loaded", "rows_rejected", "loaded_at", "length", "digest", "load_id"]
KEY = "disclosure_sequence_number"
KINDS = {"loans": ("LL", LL_FIELDS), "liquidations": ("LR", LR_FIELDS)}
# The column that takes the file's month, the first term of the order of a loan's records in a month, and the fields that the tables take.
PICKS = {"loans": dict(month="as_of_date", balance="unpaid_principal_balance", keep=LL_KEPT),
         "liquidations": dict(month="report_period", balance="liquidation_balance", keep=LR_KEPT)}
ROWS_PER_TASK = 250_000  # lines that a task sorts: some 150 MB with both sorts
MONTHS_PER_TASK = 1_000_000  # loan-months that a task sorts and writes


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    zips = [p for p in paths if p.lower().endswith(".zip")]
    texts = [p for p in paths if not p.lower().endswith(".zip")]
    parts = ([read_lines(spark, texts)] if texts else []) + ([read_zip_members(spark, zips)] if zips else [])
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _digests(spark: SparkSession, files: list[dict]) -> dict[str, str]:
    """Content digest of files that the log may know already: their records are read, nothing is staged."""
    out = {}
    for kind, (prefix, fields) in KINDS.items():
        own = [f["source"] for f in files if f["file_type"] == kind]
        if own:
            recs = checked_records(_lines(spark, own), prefix, fields)
            out |= {r["source"]: r["digest"] for r in recs.groupBy("source").agg(content_digest(F.col("line_hash")).alias("digest")).collect()}
    return out


def _wanted(spark: SparkSession, files: list[dict], log: DataFrame | None, force: bool) -> list[list[dict]]:
    """The files to load, in rounds: a round has each name once.

    The log is asked by name and length first; only a file that it has with the same length is read to be compared.
    """
    by_name: dict[str, list[dict]] = defaultdict(list)
    for f in sorted(files, key=lambda f: f["source"]):
        by_name[f["file_name"]].append(f)
    suspects = [f for own in by_name.values() if len(own) > 1 for f in own]
    known: set[tuple[str, str]] = set()
    if log is not None and not force:
        names = spark.createDataFrame([(f["file_name"], f["length"]) for f in files], "file_name string, length long").distinct()
        hits = log.join(names, ["file_name", "length"], "left_semi").select("file_name", "length", "digest").collect()  # files of this batch
        known = {(r["file_name"], r["digest"]) for r in hits}
        lengths = {(r["file_name"], r["length"]) for r in hits}
        suspects += [f for f in files if (f["file_name"], f["length"]) in lengths and f not in suspects]
    digest = _digests(spark, suspects) if suspects else {}
    rounds: list[list[dict]] = []
    for name, own in by_name.items():
        seen = set() if force else set(known)
        at = 0
        for f in own:
            d = (name, digest.get(f["source"]))
            if d[1] is not None and d in seen:
                continue
            seen.add(d)
            if at == len(rounds):
                rounds.append([])
            rounds[at].append(f)
            at += 1
    return rounds


def load_files(spark: SparkSession, paths: list[str], *, book: str, force: bool = False, max_reject_share: float = 0.01, last_load_wins: bool = False,
               now: str | None = None, stream_id: str = "batch", batch_id: int | None = None) -> dict:
    """Load disclosure files (text or zip, loans or liquidations) into the book; the manifest after it.

    ``paths`` are the files of one batch (the stream bounds their number).  A name that is not recognised fails, and
    so does a file without records.  Lines that are no records go to ``rejects`` with a reason; a
    batch of which they are more than ``max_reject_share`` fails.  A static loan takes the attributes of its latest
    month whatever the order of the files, or with ``last_load_wins`` those of the last file loaded.
    ``now`` stamps rows and log, the current time by default.  A (``stream_id``, ``batch_id``) that the book has
    committed is not loaded again.
    """
    with shuffles_dropped(spark):
        return _load_batch(spark, paths, book, force, max_reject_share, last_load_wins, now, stream_id, batch_id)


def _load_batch(spark: SparkSession, paths: list[str], book: str, force: bool, max_reject_share: float, last_load_wins: bool, now: str | None,
                stream_id: str, batch_id: int | None) -> dict:
    at = books.manifest(spark, book)
    if not paths or (batch_id is not None and at["streams"].get(stream_id, -1) >= batch_id):
        return at
    stamp = now or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    sizes = list_files(spark, paths)
    files = [r.asDict() for r in sizes.select(F.col("path").alias("source"), load_name(F.col("path")).alias("file_name"), file_type(F.col("path")).alias("file_type"),
                                              report_month(F.col("path")).alias("report_date"), "length").collect()]
    unknown = sorted(f["source"] for f in files if f["file_type"] is None or f["report_date"] is None)
    if unknown:
        raise ValueError(f"not a recognised disclosure file: {unknown[0]}")
    rounds = _wanted(spark, files, load_log(spark, book, at=at), force)
    for i, some in enumerate(rounds):
        done = {stream_id: batch_id} if batch_id is not None and i == len(rounds) - 1 else {}
        at = _load(spark, some, book, at, stamp, max_reject_share, last_load_wins, done)
    if not rounds and batch_id is not None:
        at = books.commit(spark, book, at, {}, {stream_id: batch_id})
    return at


def _load(spark: SparkSession, files: list[dict], book: str, at: dict, stamp: str, max_reject_share: float, last_load_wins: bool, done: dict) -> dict:
    """One commit: the staged lines are written once, then the one record of each loan and month; the tables are made from these, the manifest comes last."""
    load, tables, staged, logs, rejects = books.new_load(at), {}, [], [], []
    try:
        for kind, (prefix, fields) in KINDS.items():
            own = [f for f in files if f["file_type"] == kind]
            if not own:
                continue
            staging = scratch_path(spark, f"staging-{kind}")
            staged.append(staging)
            seen = Observation()
            checked_records(_lines(spark, [f["source"] for f in own]), prefix, fields, key=KEY) \
                .observe(seen, F.count(F.lit(1)).alias("rows"), F.count("bad_reason").alias("bad")).write.option("compression", "zstd").parquet(staging)
            if seen.get["bad"] > max_reject_share * seen.get["rows"]:
                raise ValueError(f"{seen.get['bad']} of {seen.get['rows']} {kind} records are not well formed; the file layout may have changed")
            rows = spark.read.parquet(staging)
            names = spark.createDataFrame([(f["source"], f["file_name"], f["file_type"], f["report_date"], f["length"]) for f in own],
                                          "source string, file_name string, file_type string, report_date date, length long")
            counts = rows.groupBy("source").agg((F.count(F.lit(1)) - F.count("bad_reason")).alias("rows_loaded"), F.count("bad_reason").alias("rows_rejected"),
                                                content_digest(F.col("line_hash")).alias("digest"))
            loaded = names.join(counts, "source", "left").withColumn("rows_loaded", F.coalesce("rows_loaded", F.lit(0))) \
                .withColumn("rows_rejected", F.coalesce("rows_rejected", F.lit(0))).withColumn("loaded_at", F.lit(stamp).cast("timestamp")) \
                .withColumn("load_id", F.lit(load)).select(*LOG_COLUMNS)
            logs.append(cut(maintain.load_log_update(loaded.filter(F.lit(False)), loaded)))  # fails on a file without records
            if seen.get["bad"]:
                rejects.append(rows.filter(F.col("bad_reason").isNotNull()).join(names.select("source", "file_name"), "source")
                               .select("file_name", F.lit(kind).alias("file_type"), "bad_reason", F.col("value").alias("bad_line"),
                                       F.lit(stamp).cast("timestamp").alias("loaded_at")))
            picks, records = PICKS[kind], scratch_path(spark, f"records-{kind}")
            staged.append(records)
            months = names.select("source", F.date_format("report_date", "yyyyMM").alias(picks["month"]))
            good = rows.filter(F.col("bad_reason").isNull()).join(F.broadcast(months), "source")  # a row per file of the batch
            maintain.first_records(good, fields, key=KEY, tasks=_tasks(spark, seen.get["rows"], ROWS_PER_TASK), **picks) \
                .write.option("compression", "zstd").parquet(records)
            recs = spark.read.parquet(records)
            if not seen.get["bad"]:
                dropped(spark, staging)
            if kind == "loans":
                tables["monthly"] = _months(spark, book, at, load, "monthly", maintain.monthly_projection(recs, unique=True))
                latest = maintain.static_projection(recs.filter("last"), keep=["as_of_date"], unique=True)
                tables["static"] = _static(spark, book, at, load, latest, stamp, last_load_wins)
                issuers = _issuers(spark, book, at, load, tables["monthly"], sorted({str(f["report_date"]) for f in own}))
                tables |= {"issuers": issuers} if issuers else {}
            else:
                tables["liquidations"] = _months(spark, book, at, load, "liquidations", maintain.liquidation_projection(recs, unique=True))
        for name, parts in (("log", logs), ("rejects", rejects)):
            if parts:
                tables[name] = _added(spark, book, at, load, name, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]))
        return books.commit(spark, book, at, tables, done)
    finally:
        for path in staged:
            dropped(spark, path)


def _tasks(spark: SparkSession, rows: int, per: int) -> int:
    """Tasks for a shuffle of so many rows: one for each ``per`` of them, at least the session's partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per))


def _months(spark: SparkSession, book: str, at: dict, load: str, name: str, rows: DataFrame) -> dict:
    """Replace the rows of the same loans and months: the months of ``rows`` are written anew, with their other loans, each by few tasks."""
    months = sorted(str(r["report_date"]) for r in rows.select("report_date").distinct().collect())  # those of the batch's files
    old = books.read(spark, book, name, only=set(months), at=at)
    tasks = _tasks(spark, rows.count() + (old.count() if old is not None else 0), MONTHS_PER_TASK)
    new = rows if old is None else maintain.replace_period(old.select(*rows.columns), rows, [KEY], tasks=tasks)
    new = new.repartitionByRange(tasks, "report_date", KEY)
    folders = {v: f for v, f in (at["tables"].get(name) or {"folders": {}})["folders"].items() if v not in months}
    return books.entry(rows, "report_date", folders | books.write(new, book, name, load, "report_date"))


def _static(spark: SparkSession, book: str, at: dict, load: str, rows: DataFrame, stamp: str, last_load_wins: bool) -> dict:
    """Merge static loans (one row each): only the buckets of the batch's loans, and those that split, are written anew.

    The number of buckets follows the rows of the table (linear hashing), so it need not be known when the table begins.
    """
    have = at["tables"].get("static")
    n, total, folders = (have["buckets"], have["n_rows"], have["folders"]) if have else (1, 0, {})
    n_new = rows.count()
    tasks = _tasks(spark, n_new + total, ROWS_PER_TASK)
    touched = {r["b"] for r in rows.select(books.bucket_of(KEY, n).alias("b")).distinct().collect()}  # bucket numbers
    if have:
        old = books.read(spark, book, "static", only={str(b) for b in touched}, at=at)
        fresh = rows.select(KEY).repartition(tasks, KEY).join(old.select(KEY), KEY, "left_anti").count()
    else:
        fresh = n_new
    total += fresh
    wanted = max(n, -(-total // ROWS_PER_BUCKET))
    touched |= books.split_sources(n, wanted)
    if have:
        old = books.read(spark, book, "static", only={str(b) for b in touched}, at=at).drop("bucket")
    else:
        none = F.lit(None).cast("timestamp")
        old = rows.filter(F.lit(False)).withColumn("created_at", none).withColumn("last_updated", none)
    merged = maintain.merge_scd1(old, rows.repartition(tasks, KEY), [KEY], order_by=[F.col("issuer_id")], now=stamp,
                                 version=None if last_load_wins else "as_of_date", unique=True)
    part = F.pmod(F.xxhash64(F.lit(1), KEY), F.lit(max(1, ROWS_PER_BUCKET // ROWS_PER_TASK)))  # a bucket is written by some tasks
    merged = merged.withColumn("bucket", books.bucket_of(KEY, wanted)).repartition(tasks, "bucket", part)
    kept = {v: f for v, f in folders.items() if int(v) not in touched}
    return books.entry(merged, "bucket", kept | books.write(merged, book, "static", load, "bucket"), buckets=wanted, n_rows=total)


def _issuers(spark: SparkSession, book: str, at: dict, load: str, monthly: dict, months: list[str]) -> dict | None:
    """Size bands of the issuers from the months just loaded, if the book has issuers."""
    issuers = books.read(spark, book, "issuers", at=at)
    if issuers is None:
        return None
    loans = books.read(spark, book, "monthly", only=set(months), at={"tables": {"monthly": monthly}})
    new = maintain.issuer_group_update(issuers, loans, latest=True)
    return books.entry(issuers, None, books.write(new.select(*issuers.columns), book, "issuers", load, None))


def _added(spark: SparkSession, book: str, at: dict, load: str, name: str, rows: DataFrame) -> dict:
    """Rows added as a folder of their own; many folders become one again."""
    folders = dict((at["tables"].get(name) or {"folders": {}})["folders"])
    if len(folders) >= LOG_FOLDERS:
        rows, folders = books.read(spark, book, name, at=at).unionByName(rows), {}
    return books.entry(rows, None, folders | {load: books.write(rows, book, name, load, None)[""]})


def load_log(spark: SparkSession, book: str, *, at: dict | None = None) -> DataFrame | None:
    """The load log: one row per file, that of its last load; None before the first."""
    rows = books.read(spark, book, "log", at=at)
    return None if rows is None else dedupe_first(rows, ["file_name"], [F.desc("load_id"), maintain.ties(rows)])


def in_inbox(path: str, inbox: str) -> bool:
    """Whether a file lies in the inbox or one folder down."""
    from urllib.parse import unquote, urlparse

    root, own = (unquote(urlparse(p).path).rstrip("/") for p in (inbox, path))
    return own.startswith(f"{root}/") and own[len(root) + 1:].count("/") <= 1


def stream_ingest(spark: SparkSession, inbox: str, *, book: str, checkpoint: str, max_files: int = 20, available_now: bool = True,
                  force: bool = False, max_reject_share: float = 0.01, last_load_wins: bool = False, now: str | None = None,
                  keep: int | None = None) -> StreamingQuery:
    """New ``.txt`` and ``.zip`` disclosure files of an inbox, or one folder down, picked up once and loaded, ``max_files`` at a time at most.

    Files with other names, and those further down, are passed over.  The stream is known to the book by its
    checkpoint location: a batch that is replayed after its manifest was written changes nothing.  With ``keep`` what
    none of the last ``keep`` manifests names is removed after each batch (``book.vacuum``), for a book that no other load writes.
    """
    import hashlib

    sid = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length bigint, content binary")
             .option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.{txt,TXT,zip,ZIP}").load(inbox).select("path"))
    known = files.filter(file_type(F.col("path")).isNotNull() & report_month(F.col("path")).isNotNull())

    def load(batch: DataFrame, bid: int) -> None:
        paths = sorted(r["path"] for r in batch.collect() if in_inbox(r["path"], inbox))  # max_files names
        load_files(batch.sparkSession, paths, book=book, force=force, max_reject_share=max_reject_share, last_load_wins=last_load_wins,
                   now=now, stream_id=sid, batch_id=bid)
        if keep is not None:
            books.vacuum(batch.sparkSession, book, keep=keep)

    w = known.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_state_counts(events: DataFrame, *, watermark: str = "1 day", window: str = "1 day",
                        key: str = "state") -> DataFrame:
    """Tumbling-window event and severe counts per key; state is dropped once the watermark passes a window.

    Rows older than the watermark are dropped from the micro-batch after the one
    that advanced it (Spark judges late rows against the previous batch's
    watermark); rows within the watermark delay are never dropped.
    """
    return (events.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("events"), F.sum(F.when(F.col("severity") == "severe", 1).otherwise(0))
                 .cast("bigint").alias("severe"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "events", "severe"))


def stream_alert_worst(alerts: DataFrame, *, watermark: str = "1 day") -> DataFrame:
    """Worst severity per (state, scenario), earliest on ties; replayed alerts are dropped within the watermark.

    The key space is states x scenarios (bounded), so the running state is small.
    The pick is a ``max`` over (rank, earliest time, smallest id) encoded in a struct.
    """
    a = alerts.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["event_id"])
    k = F.struct(rules.severity_rank(F.col("severity")).alias("r"), (-F.unix_micros("ts")).alias("t"),
                 (-F.col("event_id")).alias("i"))
    g = a.groupBy("state", "scenario_type").agg(F.max(F.struct(k.alias("k"), F.col("event_id"), F.col("ts"),
                                                               F.col("severity"))).alias("m"))
    return g.select("state", "scenario_type", F.col("m.event_id").alias("event_id"), F.col("m.ts").alias("ts"),
                    F.col("m.severity").alias("severity"))


ALERT_STATE = "expires long, rank int, at long, event_id long, severity string"


WAITING = 1 << 16  # alerts of a key that wait before they are cut to those that can become the worst


def _worst_alive_processor(ttl_us: int):
    """The processor of ``stream_alert_expiry``: a key has the alerts that can still become the worst and one timer, the end of its worst."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    columns = {"expires": np.int64, "rank": np.int64, "at": np.int64, "event_id": np.int64, "severity": object}

    def frontier(alerts: dict, now_ms: int) -> dict:
        """The alerts (columns of ``ALERT_STATE``) that are or can still become the worst, oldest and worst first.

        One that a worse one outlives never does, nor one with the time and rank of a smaller event_id.
        """
        order = np.lexsort((alerts["event_id"], -alerts["rank"], -alerts["at"]))
        order = order[alerts["expires"][order] > now_ms]
        at, rank = alerts["at"][order], alerts["rank"][order]
        keep = rank == np.maximum.accumulate(rank) if len(rank) else np.zeros(0, bool)
        keep[1:] &= (at[1:] != at[:-1]) | (rank[1:] != rank[:-1])
        return {c: v[order[keep][::-1]] for c, v in alerts.items()}

    class WorstAlive(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.alive = handle.getListState("alive", ALERT_STATE)

        def _held(self) -> dict:
            held = list(self.alive.get())
            return {c: np.array([a[i] for a in held], kind) for i, (c, kind) in enumerate(columns.items())}

        def _now(self, alerts: dict, key, timers):
            alerts = frontier(alerts, timers.getCurrentWatermarkInMs())
            rows = list(zip(*(v.tolist() for v in alerts.values())))
            if rows:
                self.alive.put(rows)
            else:
                self.alive.clear()
            ends, _, at, event, severity = rows[0] if rows else (None, 0, None, None, None)
            for ms in [ms for ms in self.handle.listTimers() if ms != ends]:
                self.handle.deleteTimer(ms)
            if ends is not None:
                self.handle.registerTimer(ends)
            at = pd.to_datetime(pd.Series([at], dtype="Int64"), unit="us")
            return pd.DataFrame({"state": [key[0]], "scenario_type": [key[1]], "event_id": pd.Series([event], dtype="Int64"), "ts": at, "severity": [severity]})

        def handleInputRows(self, key, rows, timerValues):
            alerts, parts, waiting = self._held(), [], 0

            def cut_to_frontier():
                whole = {c: np.concatenate([alerts[c], *(p[c] for p in parts)]) for c in columns}
                return frontier(whole, timerValues.getCurrentWatermarkInMs())

            for pdf in rows:
                at = pdf["at"].to_numpy(np.int64)
                parts.append({"expires": -(-(at + ttl_us) // 1000), "rank": pdf["rank"].to_numpy(np.int64), "at": at,
                              "event_id": pdf["event_id"].to_numpy(np.int64), "severity": pdf["severity"].to_numpy(object)})
                waiting += len(pdf)
                if waiting > max(WAITING, len(alerts["at"])):  # the sorts are in proportion to the rows, but for a logarithm
                    alerts, parts, waiting = cut_to_frontier(), [], 0
            yield self._now(cut_to_frontier(), key, timerValues)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            yield self._now(self._held(), key, timerValues)

        def close(self) -> None:
            pass

    return WorstAlive()


def stream_alert_expiry(alerts: DataFrame, *, ttl_seconds: int, watermark: str = "1 day") -> DataFrame:
    """Worst alert alive per (state, scenario), earliest on ties; an alert expires ``ttl_seconds`` after its time.

    When the watermark passes an alert's end, the next worst takes its place; a key without one
    gives a row with a null event.  The state of a key holds its live alerts, less those that a worse one
    outlives, and one timer, so its work is in proportion to its alerts.  Alerts without a state, scenario or severity are passed over.  A row goes out for each change (update mode); needs
    the RocksDB state store: ``use_rocksdb`` sets it.
    """
    a = alerts.withWatermark("ts", watermark).withColumn("rank", rules.severity_rank(F.col("severity")))
    a = a.filter(F.col("state").isNotNull() & F.col("scenario_type").isNotNull() & F.col("rank").isNotNull() & F.col("event_id").isNotNull())
    a = a.select("state", "scenario_type", F.col("event_id").cast("long").alias("event_id"), "ts", F.unix_micros("ts").alias("at"), F.col("rank").cast("int").alias("rank"), "severity")
    return a.groupBy("state", "scenario_type").transformWithStateInPandas(
        _worst_alive_processor(ttl_seconds * 1_000_000), "state string, scenario_type string, event_id long, ts timestamp, severity string",
        outputMode="Update", timeMode="EventTime")


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that timers and list state need; it also keeps large state off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_dedupe(df: DataFrame, keys, *, watermark: str = "1 day", ts: str = "ts") -> DataFrame:
    """First record per key within the watermark (a replayed delivery is dropped)."""
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> None:
    """Run a stream to completion (available-now) into a Parquet table, tagging each row with its batch id.

    Each micro-batch overwrites its own ``batch_id`` partition, so a batch that is
    replayed after a failure (``foreachBatch`` is at-least-once) replaces its
    earlier output instead of adding to it.
    """
    def write(b: DataFrame, bid: int) -> None:
        (b.withColumn("batch_id", F.lit(bid)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))

    q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()


def latest_per_key(table: DataFrame, keys) -> DataFrame:
    """Final value per key of an update-mode result table (the row of the latest batch)."""
    return dedupe_first(table, list(keys), [F.desc("batch_id")]).drop("batch_id")
