"""A book: loan tables that change together, each load by one manifest.

A load writes new folders (``data/<table>/load=<id>/<partition>=<value>``) for the months and
buckets that it touches and never changes a folder that exists.  A manifest says which folder
holds each partition of each table; it is written last, by one rename, so a reader sees a load
whole or not at all, and a driver that dies before the rename leaves the old book as it was.
Manifests are small: one entry per month or bucket.  Two loads that start from the same manifest
cannot both commit: the second finds its name taken and fails.  The folder's file system must
rename atomically (HDFS, ABFS, local disks).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EMPTY = {"version": 0, "tables": {}, "streams": {}}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _manifests(spark: SparkSession, book: str) -> list[str]:
    return [n for n in _names(spark, f"{book}/manifests") if n.startswith("v")]


def manifest(spark: SparkSession, book: str) -> dict:
    """The latest manifest: version, tables (partition, schema, folders, extra facts) and the last batch of each stream."""
    names = _manifests(spark, book)
    if not names:
        return json.loads(json.dumps(EMPTY))
    return json.loads(spark.read.text(f"{book}/manifests/{names[-1]}", wholetext=True).first()["value"])


def read(spark: SparkSession, book: str, name: str, *, only=None, at: dict | None = None) -> DataFrame | None:
    """A table of the book (None if it has none of that name); ``only`` names partitions to read."""
    entry = (at or manifest(spark, book))["tables"].get(name)
    if entry is None:
        return None
    schema = StructType.fromJson(entry["schema"])
    folders = [f for v, f in entry["folders"].items() if only is None or v in only]
    if not folders:
        return spark.createDataFrame([], schema)
    r = spark.read.schema(StructType(schema.fields).add("load", "string")).option("basePath", f"{book}/data/{name}")
    return r.parquet(*[f"{book}/{f}" for f in folders]).select(*schema.names)


def new_load(at: dict) -> str:
    return f"{at['version'] + 1:08d}-{uuid.uuid4().hex[:8]}"


def write(rows: DataFrame, book: str, name: str, load: str, partition: str | None) -> dict[str, str]:
    """Write ``rows`` as new folders of a load; the folder of each partition value (of "" without a partition)."""
    path = f"data/{name}/load={load}"
    w = rows.write
    (w.partitionBy(partition) if partition else w).parquet(f"{book}/{path}")
    if not partition:
        return {"": path}
    return {n.split("=", 1)[1]: f"{path}/{n}" for n in _names(rows.sparkSession, f"{book}/{path}") if n.startswith(f"{partition}=")}


def entry(rows: DataFrame, partition: str | None, folders: dict[str, str], **facts) -> dict:
    return {"partition": partition, "schema": json.loads(rows.schema.json()), "folders": folders, **facts}


def commit(spark: SparkSession, book: str, at: dict, tables: dict, streams: dict | None = None) -> dict:
    """The next manifest: that of ``at`` with ``tables`` in place; fails if another load committed meanwhile."""
    new = {"version": at["version"] + 1, "tables": {**at["tables"], **tables}, "streams": {**at["streams"], **(streams or {})}}
    fs, target = _fs(spark, f"{book}/manifests/v{new['version']:08d}.json")
    _, temp = _fs(spark, f"{book}/manifests/.new-{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps(new).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(temp, target):
        fs.delete(temp, False)
        raise RuntimeError(f"another load committed version {new['version']} of {book}")
    return new


def put(spark: SparkSession, book: str, name: str, rows: DataFrame, partition: str | None = None) -> dict:
    """Put a whole table into the book (a dimension, a first load)."""
    at = manifest(spark, book)
    return commit(spark, book, at, {name: entry(rows, partition, write(rows, book, name, new_load(at), partition))})


def vacuum(spark: SparkSession, book: str, *, keep: int = 2) -> list[str]:
    """Remove the load folders that none of the last ``keep`` manifests names, and the manifests before them.

    For a time when no load runs: a load's folders are unnamed until it commits.
    """
    names = _manifests(spark, book)
    used, gone = set(), []
    for n in names[-keep:]:
        m = json.loads(spark.read.text(f"{book}/manifests/{n}", wholetext=True).first()["value"])
        used |= {"/".join(f.split("/")[:3]) for e in m["tables"].values() for f in e["folders"].values()}
    for table in _names(spark, f"{book}/data"):
        gone += [f"data/{table}/{n}" for n in _names(spark, f"{book}/data/{table}") if f"data/{table}/{n}" not in used]
    gone += [f"manifests/{n}" for n in names[:-keep]]
    for path in gone:
        fs, p = _fs(spark, f"{book}/{path}")
        fs.delete(p, True)
    return gone


# -- buckets that split


def bucket_of(key: str, n: int):
    """Linear hashing: the bucket of ``key`` among ``n``.  With one more bucket only the rows of one bucket move."""
    high = 1 << max(0, n - 1).bit_length()
    h = F.xxhash64(key)
    at = F.pmod(h, F.lit(high))
    return F.when(at < n, at).otherwise(F.pmod(h, F.lit(max(1, high // 2)))).cast("int")


def split_sources(old: int, new: int) -> set[int]:
    """The buckets below ``old`` whose rows may move when the number grows to ``new``."""
    out = set()
    for b in range(old, new):
        while b >= old:
            b -= 1 << (b.bit_length() - 1)
        out.add(b)
    return out
