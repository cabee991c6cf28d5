"""Zip archives by seek: any size, members chosen and streamed, odd line ends, errors with names."""

import os
import tracemalloc
import zipfile

import pytest

from loanlens.session import scratch_path
from loanlens.sources import records, zips


def archive(path, members, prefix=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if prefix:
        with open(path, "wb") as fh:
            fh.truncate(prefix)  # a sparse file: archives may stand behind other data
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return f"file:{path}"


def test_an_archive_over_two_gigabytes_is_read(spark):
    base = scratch_path(spark, "zips")
    path = archive(f"{base}/llmon1_202601.zip", {"readme.txt": "x" * 5, "d/": "", "data.txt": "LL|1\r\nLL|2\n\n\r\nLL|é".encode("latin-1")}, prefix=(1 << 31) + 4096)
    assert os.path.getsize(path[5:]) > 1 << 31
    got = records.read_zip_members(spark, [path]).collect()
    assert [r.value for r in got] == ["LL|1", "LL|2", "LL|é"] and {r.source for r in got} == {path}


def test_memory_is_that_of_a_batch(spark):
    base = scratch_path(spark, "zips")
    line = "LL|" + "y" * 97
    path = archive(f"{base}/big.zip", {"data.txt": "\n".join([line] * 600_000)})  # 60 MB of lines
    tracemalloc.start()
    n = sum(len(b) for b in zips.lines(path, "latin-1", 5000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 600_000 and peak < 12 << 20


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_batches_hold_all_lines(spark, batch):
    base = scratch_path(spark, "zips")
    text = "\n".join(f"line {i}" for i in range(10)) + "\r\n"
    paths = [archive(f"{base}/a b%/{n}.zip", {"x.txt": text, "y.txt": "short"}) for n in "pq"]
    got = records.read_zip_members(spark, paths, batch_lines=batch).collect()
    assert sorted(r.value for r in got) == sorted(f"line {i}" for i in range(10) for _ in "pq")
    plain = records._whole_archives(spark, [f"{base}/a b%/p.zip"], "latin-1", batch).collect()
    assert sorted(r.value for r in plain) == sorted(f"line {i}" for i in range(10))


def test_empty_archives_fail_by_name(spark):
    path = archive(f"{scratch_path(spark, 'zips')}/none.zip", {})
    with pytest.raises(Exception, match="none.zip is an empty zip file"):
        records.read_zip_members(spark, [path]).collect()


def test_file_names_are_read_once_per_archive(spark):
    """No pattern is matched against the path of every line: months and types are joined to the lines by archive."""
    from conftest import SMALL
    from loanlens.plans import catalog_sources as sources
    from loanlens.plans.adapter import Tables

    plan = sources._src_zip_member(Tables(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "zip_lines" in line)
    over = [line for line in plan[:at] if "RLIKE" in line or "regexp_extract" in line]
    assert any("Join Inner" in line for line in plan[:at]) and not over, over


def test_names_and_folders_of_odd_paths(spark):
    """The same parts of a path as the patterns gave, on odd paths too."""
    from pyspark.sql import functions as F

    paths = ["a", "/a", "a/", "a/b", "a//b", "//", "", "/", "a/b/", "a/b/c d%20.txt", "file:/x/llmon1_202601.zip", "x/file=llmonliq1_202602/part-0", "é/ü", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    p = F.col("p")
    got = df.select(records.file_name(p).alias("n"), records.folder_name(p).alias("f"),
                    F.regexp_extract(p, r"([^/]+)$", 1).alias("wn"), F.regexp_extract(p, r"([^/]+)/[^/]+$", 1).alias("wf")).collect()
    assert all((r.n, r.f) == (r.wn, r.wf) for r in got), got


def test_text_files_get_their_months_by_name(spark):
    """One row per file, under the path that its lines carry, blanks and percent signs included."""
    base = f"{scratch_path(spark, 'texts')}/a b%20c"
    spark.createDataFrame([("LL|1", "llmon1_202601"), ("LL|2", "llmonliq1_202602"), ("LL|3", "other")], "value string, file string") \
        .write.partitionBy("file").text(base)
    got = records.read_lines(spark, base).join(records.file_months(spark, base), "source").select("value", "report_date", "file_type").collect()
    assert sorted((r.value, str(r.report_date), r.file_type) for r in got) == [
        ("LL|1", "2026-01-01", "loans"), ("LL|2", "2026-02-01", "liquidations"), ("LL|3", "None", None)]
