"""Alerts that expire, batch after batch, against brute force."""

import random
import time
from datetime import datetime, timedelta

import pytest

from loanlens.session import scratch_path
from loanlens.streaming import streams

RANK = {"severe": 3, "moderate": 2, "mild": 1}
START = datetime(2026, 1, 1)


def land(spark, path, rows):
    spark.createDataFrame(rows, "event_id long, ts timestamp, state string, scenario_type string, severity string").coalesce(1) \
        .write.mode("append").parquet(path)
    time.sleep(1.05)  # files are taken in the order of their times


def worst(rows, ttl, now):
    """Of each key the worst alert that lives beyond ``now``, the earliest on ties, the smallest id then."""
    out = {}
    for r in sorted({r[0]: r for r in rows}.values(), key=lambda r: (-RANK.get(r[4], 0), r[1], r[0])):
        if r[4] in RANK and r[2] and r[1] + ttl > now:
            out.setdefault((r[2], r[3]), (r[0], r[4]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_an_expired_alert_gives_way_to_the_next_worst(spark, seed):
    rng = random.Random(seed)
    base, ttl, rows, batches = scratch_path(spark, "expiry"), timedelta(hours=5), [], []
    for b in range(4):
        some = [(100 * b + i, START + timedelta(hours=4 * b, minutes=rng.randint(0, 239)), rng.choice(["TX", "FL", None]), rng.choice(["flood", "fire"]),
                 rng.choice(["severe", "moderate", "mild", "mild", "unknown"])) for i in range(8)]
        some += rng.sample(rows[-8:], 2) if rows else []  # delivered again, in time or too late to count
        rows += some
        batches.append(some)
        land(spark, f"{base}/in", some)
    streams.use_rocksdb(spark)
    source = spark.readStream.schema("event_id long, ts timestamp, state string, scenario_type string, severity string").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    alive = streams.stream_alert_expiry(source, ttl_seconds=5 * 3600, watermark="30 minutes")
    streams.run_to_table(alive, f"{base}/out", f"{base}/ckpt", mode="update")
    table = spark.read.parquet(f"{base}/out")
    got = {(r.state, r.scenario_type): (r.event_id, r.severity) for r in streams.latest_per_key(table, ["state", "scenario_type"]).collect() if r.event_id is not None}
    now = max(r[1] for r in rows) - timedelta(minutes=30)
    assert got == worst(rows, ttl, now)
    shown = {}
    for r in sorted(table.collect(), key=lambda r: r.batch_id):
        shown.setdefault((r.state, r.scenario_type), []).append(r.severity)
    assert any(RANK.get(b, 0) < RANK.get(a, 0) for s in shown.values() for a, b in zip(s, s[1:]))  # the worst of all time does not stay


def test_no_alert_is_left_in_the_end(spark):
    base = scratch_path(spark, "expiry")
    land(spark, f"{base}/in", [(1, START, "TX", "flood", "severe"), (2, START + timedelta(minutes=1), "TX", "flood", "mild")])
    land(spark, f"{base}/in", [(3, START + timedelta(days=2), "FL", "flood", "mild")])
    streams.use_rocksdb(spark)
    source = spark.readStream.schema("event_id long, ts timestamp, state string, scenario_type string, severity string").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    streams.run_to_table(streams.stream_alert_expiry(source, ttl_seconds=3600, watermark="0 seconds"), f"{base}/out", f"{base}/ckpt", mode="update")
    got = {r.state: r.event_id for r in streams.latest_per_key(spark.read.parquet(f"{base}/out"), ["state", "scenario_type"]).collect()}
    assert got == {"TX": None, "FL": 3}


class _Handle:
    """State and timers of one key, as a processor sees them, with the number of times it asks for them."""

    def __init__(self):
        self.rows, self.timers, self.reads, self.registered = [], set(), 0, 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.reads += 1
        return iter(self.rows)

    def put(self, rows):
        self.rows = rows

    def clear(self):
        self.rows = []

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, ms):
        self.registered += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class _Times:
    now = 0

    def getCurrentWatermarkInMs(self):
        return self.now


def test_a_key_has_one_timer_however_many_alerts_live():
    import numpy as np
    import pandas as pd

    n, rng, ttl = 150_000, np.random.default_rng(5), 10_000_000
    at = rng.integers(0, 20_000_000, n)
    rank = rng.integers(1, 4, n)
    ids = rng.permutation(n)
    processor, handle, times = streams._worst_alive_processor(ttl), _Handle(), _Times()
    processor.init(handle)
    pdf = pd.DataFrame({"at": at, "rank": rank, "event_id": ids, "severity": np.array(["", "mild", "moderate", "severe"], object)[rank]})
    got = next(processor.handleInputRows(("TX", "flood"), iter([pdf[:80_000], pdf[80_000:90_000], pdf[90_000:]]), times))
    assert handle.registered == 1 and handle.reads == 1 and len(handle.timers) == 1
    expires = -(-(at + ttl) // 1000)
    for now in (0, 12_345, 20_001, 29_999):  # next worst after each
        times.now = now
        if now:
            handle.timers -= {ms for ms in handle.timers if ms <= now}
            got = next(processor.handleExpiredTimer(("TX", "flood"), times, None))
        live = np.flatnonzero(expires > now)
        best = live[np.lexsort((ids[live], at[live], -rank[live]))[0]]
        assert got["event_id"][0] == ids[best] and len(handle.timers) == 1
    times.now = 30_000
    got = next(processor.handleExpiredTimer(("TX", "flood"), times, None))
    assert got["event_id"].isna()[0] and not handle.timers and not handle.rows
