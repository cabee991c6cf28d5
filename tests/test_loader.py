"""The loader and its book: skips, replacements, crashes, splitting buckets, order of files, rejected lines."""

import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from loanlens.operators import maintain
from loanlens.session import scratch_path
from loanlens.sources import records
from loanlens.streaming import book as books
from loanlens.streaming import streams
from test_units import _fill_inbox, _inbox_paths, _loan_line

NOW = "2026-02-01 00:00:00"


def put_file(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return f"file:{path}"


def contents(spark, book, tables=("monthly", "static", "liquidations", "log", "issuers")):
    found = {t: books.read(spark, book, t) for t in tables}
    return {t: None if df is None else sorted(map(str, df.collect())) for t, df in found.items()}


def test_stream_loads_every_inbox_file(spark):
    box, base = scratch_path(spark, "inbox"), scratch_path(spark, "tables")
    _fill_inbox(box)
    put_file(f"{box}/readme.txt", ["not a disclosure file"])
    put_file(f"{box}/a/b/llmon1_202601.txt", [_loan_line(99, "202601", 5)])
    book = f"{base}/book"
    books.put(spark, book, "issuers", spark.createDataFrame([(7, "Seven", "Small"), (8, "Eight", "Large")], "issuer_number int, issuer_name string, issuer_group string"))
    before = dt.datetime.now() - dt.timedelta(days=2)
    streams.stream_ingest(spark, box, checkpoint=f"{base}/ckpt", max_files=2, book=book).awaitTermination()
    monthly = books.read(spark, book, "monthly")
    assert {(r.report_date.month, r["count"]) for r in monthly.groupBy("report_date").count().collect()} == {(1, 20), (2, 10), (3, 26)}
    static = books.read(spark, book, "static")
    assert static.count() == 30 and static.agg(F.min("created_at")).first()[0] > before  # stamped with the current time
    assert sorted((r.disclosure_sequence_number, float(r.liquidation_balance)) for r in books.read(spark, book, "liquidations").collect()) \
        == [("3", 50.0), ("4", 60.0)]
    log = {r.file_name: (r.file_type, r.rows_loaded) for r in streams.load_log(spark, book).collect()}
    assert log == {"llmon1_202601.txt": ("loans", 20), "llmon1_202602.txt": ("loans", 10), "llmon1_202603.zip": ("loans", 26),
                   "llmonliq1_202602.txt": ("liquidations", 3)}
    assert {r.issuer_number: r.issuer_group for r in books.read(spark, book, "issuers").collect()} == {7: "Very Small", 8: "Large"}
    # another stream over the same inbox: every file is in the log, but for a stray one that comes later
    seen, version = contents(spark, book), books.manifest(spark, book)["version"]
    streams.stream_ingest(spark, box, checkpoint=f"{base}/ckpt2", book=book).awaitTermination()
    assert contents(spark, book) == seen
    assert books.manifest(spark, book)["tables"] == books.manifest(spark, book)["tables"] and books.manifest(spark, book)["version"] <= version + 1


def test_a_file_delivered_again_changes_nothing(spark):
    """Under its name or in a new folder; with other bytes it replaces its loans and months; force loads it."""
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    lines = [_loan_line(i, "202601", 1000 * i) for i in range(1, 9)]
    first = put_file(f"{box}/llmon1_202601.txt", lines)
    at = streams.load_files(spark, [first], book=book, now=NOW)
    seen = contents(spark, book)
    again = put_file(f"{box}/redelivery/llmon1_202601.txt", lines)
    assert streams.load_files(spark, [first, again], book=book, now="2026-03-01 00:00:00") == at
    assert contents(spark, book) == seen
    fixed = put_file(f"{box}/fixed/llmon1_202601.txt", [_loan_line(1, "202601", 5555), *lines[1:]])  # same length
    other = put_file(f"{box}/longer/llmon1_202601.txt", [*lines, _loan_line(9, "202601", 9)])
    assert os.path.getsize(first[5:]) == os.path.getsize(fixed[5:])
    streams.load_files(spark, [fixed], book=book, now=NOW)
    balance = lambda: {r.disclosure_sequence_number: float(r.unpaid_principal_balance) for r in books.read(spark, book, "monthly").collect()}
    assert balance() == {"1": 5555.0, **{str(i): 1000.0 * i for i in range(2, 9)}}
    streams.load_files(spark, [other, other.replace("longer/", "longer/")], book=book, now=NOW)
    assert balance()["9"] == 9.0 and balance()["1"] == 1000.0
    log = streams.load_log(spark, book).collect()
    assert [(r.file_name, r.rows_loaded) for r in log] == [("llmon1_202601.txt", 9)]
    version = books.manifest(spark, book)["version"]
    streams.load_files(spark, [other], book=book, force=True, now="2026-04-01 00:00:00")
    assert books.manifest(spark, book)["version"] == version + 1
    assert {str(r.last_updated)[:7] for r in books.read(spark, book, "static").collect()} == {"2026-04"}


def test_a_load_that_dies_leaves_the_old_book(spark, monkeypatch):
    """Stopped between the writes and the manifest: the old tables are whole, the replay loads once."""
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    _fill_inbox(box)
    paths = _inbox_paths(box)
    books.put(spark, book, "issuers", spark.createDataFrame([(7, "Seven", "Small")], "issuer_number int, issuer_name string, issuer_group string"))
    streams.load_files(spark, paths[:2], book=book, now=NOW, stream_id="s", batch_id=0)
    seen = contents(spark, book)
    real = books.commit
    monkeypatch.setattr(books, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt("the driver dies")))
    with pytest.raises(KeyboardInterrupt):
        streams.load_files(spark, paths[2:], book=book, now=NOW, stream_id="s", batch_id=1)
    monkeypatch.setattr(books, "commit", real)
    assert contents(spark, book) == seen
    for _ in range(2):  # the replay, and one more of the same batch
        streams.load_files(spark, paths[2:], book=book, now=NOW, stream_id="s", batch_id=1)
    whole = scratch_path(spark, "whole")
    books.put(spark, whole, "issuers", spark.createDataFrame([(7, "Seven", "Small")], "issuer_number int, issuer_name string, issuer_group string"))
    streams.load_files(spark, paths, book=whole, now=NOW)
    assert contents(spark, book, ("monthly", "static", "liquidations", "issuers")) == contents(spark, whole, ("monthly", "static", "liquidations", "issuers"))
    named = {"/".join(f.split("/")[:3]) for e in books.manifest(spark, book)["tables"].values() for f in e["folders"].values()}
    kept = contents(spark, book)
    assert books.vacuum(spark, book, keep=1)  # what the dead load left
    assert contents(spark, book) == kept
    left = {f"data/{t}/{n}" for t in books._names(spark, f"{book}/data") for n in books._names(spark, f"{book}/data/{t}")}
    assert left == named


def test_two_loads_from_one_manifest_cannot_both_commit(spark):
    book = scratch_path(spark, "book")
    rows = spark.range(3)
    at = books.manifest(spark, book)
    books.put(spark, book, "t", rows)
    with pytest.raises(RuntimeError, match="another load committed"):
        books.commit(spark, book, at, {})


def test_buckets_split_as_the_table_grows(spark, monkeypatch):
    """Begun by a small file; bounded buckets after a large one; a batch writes only the buckets of its loans."""
    monkeypatch.setattr(streams, "ROWS_PER_BUCKET", 20)
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    sizes = lambda: [r["count"] for r in books.read(spark, book, "static").groupBy("bucket").count().collect()]
    loaded = 0
    for month, n in (("202601", 10), ("202602", 200), ("202603", 330)):
        streams.load_files(spark, [put_file(f"{box}/llmon1_{month}.txt", [_loan_line(i, month, 10 * i) for i in range(n)])], book=book, now=NOW)
        entry = books.manifest(spark, book)["tables"]["static"]
        assert entry["n_rows"] == n == books.read(spark, book, "static").count() and entry["buckets"] == -(-n // 20)
        assert max(sizes()) <= 4 * 20  # a bucket that is next to split holds twice the mean
        loaded = n
    before = books.manifest(spark, book)["tables"]["static"]["folders"]
    streams.load_files(spark, [put_file(f"{box}/llmon1_202604.txt", [_loan_line(5, "202604", 1)])], book=book, now=NOW)
    after = books.manifest(spark, book)["tables"]["static"]["folders"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(after) == len(before)
    assert books.read(spark, book, "static").count() == loaded


@pytest.mark.parametrize("old, new", [(1, 2), (1, 9), (5, 6), (8, 9), (7, 19)])
def test_linear_hashing_moves_the_split_buckets_only(spark, old, new):
    moved = spark.range(2000).select(F.col("id").cast("string").alias("k")).select(books.bucket_of("k", old).alias("a"), books.bucket_of("k", new).alias("b"))
    rows = moved.collect()
    assert {r.a for r in rows if r.a != r.b} <= books.split_sources(old, new)
    assert {r.b for r in rows} == set(range(new))


@pytest.mark.parametrize("last", [False, True])
def test_files_may_come_in_any_order(spark, last):
    """Backwards or forwards, the latest month gives the attributes; with ``last_load_wins`` the last file does."""
    box = scratch_path(spark, "inbox")
    files = [put_file(f"{box}/llmon1_20260{m}.txt", [_loan_line(i, f"20260{m}", 100 * m, issuer=m) for i in range(m, 6 + m)]) for m in (1, 2, 3)]
    found = []
    for order in (files, files[::-1]):
        book = scratch_path(spark, "book")
        for f in order:
            streams.load_files(spark, [f], book=book, now=NOW, last_load_wins=last)
        found.append(sorted((r.disclosure_sequence_number, r.issuer_id, r.as_of_date) for r in books.read(spark, book, "static").collect()))
    assert (found[0] == found[1]) == (not last)
    assert found[0] == sorted((str(i), max(m for m in (1, 2, 3) if m <= i < 6 + m), f"20260{max(m for m in (1, 2, 3) if m <= i < 6 + m)}") for i in range(1, 9))


def test_merge_keeps_newer_versions(spark):
    target = spark.createDataFrame([(1, "a", 5, None, None), (2, "b", None, None, None), (3, "c", 5, None, None), (4, "d", 5, None, None)],
                                   "k int, x string, v int, created_at timestamp, last_updated timestamp")
    source = spark.createDataFrame([(1, "old", 4), (2, "new", 1), (3, "same", 5), (4, "none", None), (5, "ins", None)], "k int, x string, v int")
    got = {r.k: r.x for r in maintain.merge_scd1(target, source, ["k"], order_by=[F.col("x")], now=NOW, version="v").collect()}
    assert got == {1: "a", 2: "new", 3: "same", 4: "d", 5: "ins"}


def test_unknown_and_empty_files_fail_the_batch(spark):
    box, book = scratch_path(spark, "bad"), scratch_path(spark, "badbook")
    unknown = put_file(f"{box}/other.txt", [_loan_line(1, "202601", 5)])
    empty = put_file(f"{box}/llmon1_202601.txt", ["HD|nothing here"])
    with pytest.raises(ValueError, match="not a recognised disclosure file.*other.txt"):
        streams.load_files(spark, [unknown], book=book)
    with pytest.raises(Exception, match="no records found in .*llmon1_202601.txt"):
        streams.load_files(spark, [empty], book=book)
    assert books.manifest(spark, book)["version"] == 0


def test_bad_lines_are_rejected_with_a_reason(spark):
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    good = [_loan_line(i, "202601", i) for i in range(1, 400)]

    bad = ["LL|too|short", _loan_line(5000, "202601", 1) + "|extra"]
    from loanlens.sources.layouts import LL_FIELDS

    fields = _loan_line(6, "202601", 6).split("|")
    fields[LL_FIELDS.index("disclosure_sequence_number")] = " "

    bad.append("|".join(fields))
    path = put_file(f"{box}/llmon1_202601.txt", [*good[:100], *bad, *good[100:]])
    with pytest.raises(ValueError, match="3 of 402 loans records are not well formed"):
        streams.load_files(spark, [path], book=book, max_reject_share=0.005)
    assert books.manifest(spark, book)["version"] == 0
    streams.load_files(spark, [path], book=book, now=NOW)
    assert books.read(spark, book, "monthly").count() == len(good)
    got = sorted((r.file_name, r.bad_reason, r.bad_line) for r in books.read(spark, book, "rejects").collect())
    assert got == sorted(("llmon1_202601.txt", "no key" if b == bad[2] else "field count", b) for b in bad)
    assert [(r.rows_loaded, r.rows_rejected) for r in streams.load_log(spark, book).collect()] == [(399, 3)]


def test_many_loads_keep_one_log(spark, monkeypatch):
    monkeypatch.setattr(streams, "LOG_FOLDERS", 2)
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    for m in range(1, 6):
        streams.load_files(spark, [put_file(f"{box}/llmon1_20260{m}.txt", [_loan_line(1, f"20260{m}", m)])], book=book, now=NOW)
    assert len(books.manifest(spark, book)["tables"]["log"]["folders"]) <= 2
    assert streams.load_log(spark, book).count() == 5


def test_corrected_files_replace_their_counts(spark):
    """Load, correct some files, load again: the counts equal those made from the files as they are now."""
    rows = [(f"f{i % 7}", f"k{i % 3}", i % 5) for i in range(200)]
    counts = lambda r: spark.createDataFrame(r, "file string, k string, x int").groupBy("file", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"))
    schema = "k string, n long, s long"
    args = dict(keys=["k"], values=["n", "s"], file="file")
    target, given = spark.createDataFrame([], schema), spark.createDataFrame([], "file string, " + schema)
    for load in (rows[:120], rows[120:]):  # f0 to f6 come in both: the second replaces the first
        target, given = maintain.additive_replace(target, given, counts(load), **args)
    want = sorted(tuple(r) for r in counts(rows[120:]).groupBy("k").agg(F.sum("n"), F.sum("s")).collect())
    assert sorted(tuple(r) for r in target.collect()) == want
    again, given2 = maintain.additive_replace(target, given, counts(rows[120:]), **args)
    assert sorted(tuple(r) for r in again.collect()) == want and sorted(given2.collect()) == sorted(given.collect())
    # a file that became empty, and a key that goes with it
    only = [("f9", "only", 4)]
    target, given = maintain.additive_replace(target, given, counts(only), **args)
    assert ("only", 1, 4) in {tuple(r) for r in target.collect()}
    empty = spark.createDataFrame([("f9", None, None, None)], "file string, " + schema)
    target, given = maintain.additive_replace(target, given, empty, **args)
    assert sorted(tuple(r) for r in target.collect()) == want


def test_names_of_the_log(spark):
    paths = ["file:/in/llmon1_202601.txt", "file:/in/new/llmon1_202601.txt", "file:/in/file=llmon1_202601/part-0.txt", "file:/in/x.txt"]
    got = [r.n for r in spark.createDataFrame([(p,) for p in paths], "p string").select(records.load_name(F.col("p")).alias("n")).collect()]
    assert got == ["llmon1_202601.txt", "llmon1_202601.txt", "file=llmon1_202601/part-0.txt", "in/x.txt"]


def test_zip_and_text_of_the_same_name_in_one_batch(spark):
    box, book = scratch_path(spark, "inbox"), scratch_path(spark, "book")
    lines = [_loan_line(i, "202601", i) for i in range(5)]
    a = put_file(f"{box}/one/llmon1_202601.txt", lines)
    b = put_file(f"{box}/two/llmon1_202601.txt", lines)
    c = put_file(f"{box}/three/llmon1_202601.txt", [_loan_line(i, "202601", 50 + i) for i in range(5)])
    with zipfile.ZipFile(f"{box}/llmon1_202602.zip", "w") as z:
        z.writestr("llmon1_202602.txt", "\n".join(_loan_line(i, "202602", i) for i in range(4)))
    at = streams.load_files(spark, [a, b, c, f"file:{box}/llmon1_202602.zip"], book=book, now=NOW, stream_id="s", batch_id=3)
    assert at["streams"] == {"s": 3} and at["version"] == 2  # two contents of one name: two rounds
    assert streams.load_log(spark, book).count() == 2
