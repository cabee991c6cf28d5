"""What loads and inboxes leave on disk: shuffles dropped, lines shuffled as they are and once, no line twice, old folders removed."""

import os
import zipfile

from pyspark.sql import functions as F

from conftest import SMALL
from loanlens.operators import maintain
from loanlens.plans import catalog_streaming, fixtures
from loanlens.plans.adapter import Tables
from loanlens.session import scratch_path
from loanlens.sources import records
from loanlens.sources.layouts import LL_FIELDS, LL_KEPT, LR_FIELDS, LR_KEPT
from loanlens.streaming import book as books
from loanlens.streaming import streams
from test_loader import put_file
from test_units import _liquidation_line, _loan_line

NOW = "2026-02-01 00:00:00"


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_") and n.endswith(".data")}


def test_a_load_leaves_no_shuffle_files(spark):
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    before = shuffle_files(spark)
    for month in ("202601", "202602"):
        streams.load_files(spark, [put_file(f"{box}/llmon1_{month}.txt", [_loan_line(i, month, i) for i in range(50)])], book=book, now=NOW)
    assert not shuffle_files(spark) - before


def test_the_one_shuffle_of_a_load_has_lines(spark):
    """Not 55 columns, nor the text that ends the order."""
    lines = spark.createDataFrame([(_loan_line(1, "202601", 5), "f", "202601", "1")], f"value string, source string, as_of_date string, {streams.KEY} string")
    df = maintain.first_records(lines, LL_FIELDS, key=streams.KEY, tasks=7, **streams.PICKS["loans"])
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, line in enumerate(plan) if "Exchange" in line]
    assert len(at) == 1 and ", 7)" in plan[at[0]]
    assert not any("to_json" in line or "split(" in line for line in plan[at[0]:])


def _set(line, fields, **values):
    own = line.split("|")
    for f, v in values.items():
        own[fields.index(f)] = v
    return "|".join(own)


def test_first_records_are_those_of_the_projections(spark):
    """Records that a month has twice: by balance, one that is no number last, then by the whole record and its file."""
    ll = [("a", _loan_line(1, "202601", 5)), ("b", _loan_line(1, "202601", 4)), ("c", _loan_line(1, "202602", 9)), ("a", _loan_line(2, "202601", 5)),
          ("a", _set(_loan_line(2, "202601", 5), LL_FIELDS, msa='7"\\é')), ("b", _set(_loan_line(2, "202601", 5), LL_FIELDS, msa="12", cusip_number=" 9 ")),
          ("b", _set(_loan_line(3, "202601", 5), LL_FIELDS, unpaid_principal_balance="x", state_code="AA")),
          ("a", _set(_loan_line(3, "202601", 5), LL_FIELDS, unpaid_principal_balance="", state_code="ZZ")), ("b", _loan_line(4, "202601", 1)), ("a", _loan_line(4, "202601", 1)),
          ("c", _set(_loan_line(4, "202602", 7), LL_FIELDS, as_of_date="199001")), ("c", _set(_loan_line(4, "202602", 7), LL_FIELDS, as_of_date="198901"))]
    ll += [(f, _set(_loan_line(20 + i, "202601", 5), LL_FIELDS, **{LL_FIELDS[8 + i]: v})) for i in range(40) for f, v in (("a", "3"), ("b", "22"), ("b", ""))]
    lr = [("a", _liquidation_line(1, "x", 5)), ("b", _liquidation_line(1, "y", 5)), ("c", _liquidation_line(1, "202602", 5)), ("a", _liquidation_line(2, "x", "")),
          ("b", _set(_liquidation_line(2, "x", "7"), LR_FIELDS, issuer_id="9"))]
    for prefix, rows, fields, kind in (("LL", ll, LL_FIELDS, "loans"), ("LR", lr, LR_FIELDS, "liquidations")):
        month = streams.PICKS[kind]["month"]
        lines = spark.createDataFrame([(v, s) for s, v in rows], "value string, source string")
        by_file = F.when(F.col("source") == "c", "202602").otherwise("202601")
        staging = records.split_records(lines, prefix, fields, key=streams.KEY).drop("line_hash", "bad_reason", "bad_line").withColumn(month, by_file)
        checked = records.checked_records(lines, prefix, fields, key=streams.KEY).withColumn(month, by_file)
        first = maintain.first_records(checked, fields, key=streams.KEY, tasks=3, **streams.PICKS[kind])
        pairs = [(maintain.liquidation_projection(first, unique=True), maintain.liquidation_projection(staging))] if prefix == "LR" else [
            (maintain.monthly_projection(first, unique=True), maintain.monthly_projection(staging, keys=[streams.KEY, "as_of_date"])),
            (maintain.static_projection(first.filter("last"), unique=True, keep=["as_of_date"]), maintain.static_projection(staging, keep=["as_of_date"]))]
        for got, want in pairs:
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert set(LL_KEPT) <= set(LL_FIELDS) and set(LR_KEPT) <= set(LR_FIELDS)


def test_a_stream_with_keep_removes_what_it_replaced(spark):
    """Delivered to three streams, each told to load all: the first stream's folders go, the book is as it was."""
    t = Tables(spark, SMALL)
    once, again = (books.read(spark, catalog_streaming._ingest(t, force), "monthly") for force in ((False,), (False, True, True)))
    assert once.exceptAll(again).count() == 0 and once.count() == again.count() > 0
    book = again.inputFiles()[0].split("/data/")[0]
    loads = books._names(spark, f"{book}/data/monthly")
    assert len(loads) < books.manifest(spark, book)["version"] - 1 and len(books._manifests(spark, book)) == 2


def test_an_inbox_has_each_line_once_and_nothing_else_lies_there(spark, monkeypatch):
    t, base = Tables(spark, SMALL), scratch_path(spark, "landed")
    monkeypatch.setattr(t, "landed", lambda name: f"{base}/{name}")
    before = shuffle_files(spark)
    path = fixtures.inbox(t)
    assert not shuffle_files(spark) - before
    root = base.removeprefix("file://").removeprefix("file:")
    assert os.listdir(root) == ["inbox_strays"]
    zipped, nested, flat = [], [], []
    for d, _, names in os.walk(path.removeprefix("file://").removeprefix("file:")):
        for n in (n for n in names if not n.startswith((".", "_")) and n != "readme.txt" and "old/2001" not in d):
            if n.endswith(".zip"):
                with zipfile.ZipFile(f"{d}/{n}") as z:
                    assert z.testzip() is None and len(z.namelist()) == 1
                    zipped += [(d[-6:], v) for v in z.read(z.namelist()[0]).decode().splitlines()]
            else:
                with open(f"{d}/{n}") as fh:
                    (flat if n.startswith("llmonliq1_") else nested).extend((d[-6:], v) for v in fh.read().splitlines())
    months = t.loan_monthly.groupBy((F.month("report_date") % 3 == 0).alias("z")).agg(F.count("*").alias("n"), F.sum((F.col("current_month_liquidation") == "Y").cast("int")).alias("q"))
    want = {r["z"]: r for r in months.collect()}
    assert (len(zipped), len(nested), len(flat)) == (want[True]["n"], want[False]["n"], want[True]["q"] + want[False]["q"])
    at = LL_FIELDS.index("as_of_date")
    assert all(v.split("|")[at] == m for m, v in zipped + nested) and len(set(zipped + nested)) == len(zipped + nested)
    assert {m[4:] for m, _ in zipped} <= {"03", "06", "09", "12"} and not {m[4:] for m, _ in nested} & {"03", "06", "09", "12"}
