"""Exact duplicates through cuckoo-filter indexes of live digests.

Texts are compared without white space (0x20, 0x09-0x0D): their SHA-256 is the key.  A
``CuckooIndex`` holds short fingerprints in buckets of four; a fingerprint hit is verified
against the full key kept beside the slot, an insertion without a free slot moves others
on, and when that fails the table doubles and is filled again from the stored keys.
Keys can be deleted.

``dedup`` folds rows twice with such an index: in each task before the shuffle, so that a
group of copies sends one row per task however large it is, and per shard after it.
``update_index`` keeps an index table (a row per shard) under insertions and deletions;
``live`` looks rows up in it.

Defined results: a null text counts as empty, and all empty texts are one group; of a group
the row with the most code points stays, then the smallest doc_id (null doc_ids last);
repeated rows count each; an empty table gives none.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import written
from loanlens.llm.text import bytes_of, filled, slices, tidied

SLOTS, KICKS, LOAD = 4, 200, 0.9
FOLD_KEYS = 200_000  # live keys in a task's index before it is sent on and begun anew
SHARD_KEYS = 100_000  # rows per shard, which sets the number of shards
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True


class CuckooIndex:
    """Live keys (bytes of 16 or more) with a position each; hits are verified against the stored key."""

    def __init__(self, capacity: int = 1024):
        self.keys: list[bytes | None] = []
        self.free: list[int] = []
        self.n = 0
        self._make(capacity)

    def _make(self, capacity: int) -> None:
        size = 1
        while size * SLOTS * LOAD < capacity:
            size *= 2
        self.mask = size - 1
        self.buckets: list[list[tuple[int, int]]] = [[] for _ in range(size)]

    @staticmethod
    def _mark(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little")

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ ((mark + 1) * 0x5BD1E995)) & self.mask

    def find(self, key: bytes) -> int:
        """The position of a live key, or -1."""
        mark = self._mark(key)
        one = int.from_bytes(key[:8], "little") & self.mask
        for bucket in (one, self._other(one, mark)):
            for m, at in self.buckets[bucket]:
                if m == mark and self.keys[at] == key:
                    return at
        return -1

    def _place(self, mark: int, at: int) -> bool:
        bucket = int.from_bytes(self.keys[at][:8], "little") & self.mask
        for b in (bucket, self._other(bucket, mark)):
            if len(self.buckets[b]) < SLOTS:
                self.buckets[b].append((mark, at))
                return True
        for kick in range(KICKS):  # move another entry to its second bucket
            slot = kick % SLOTS
            (mark, at), self.buckets[bucket][slot] = self.buckets[bucket][slot], (mark, at)
            bucket = self._other(bucket, mark)
            if len(self.buckets[bucket]) < SLOTS:
                self.buckets[bucket].append((mark, at))
                return True
        return False

    def insert(self, key: bytes) -> int:
        """Position of ``key``, which becomes live; callers look it up with ``find`` first."""
        at = self.free.pop() if self.free else len(self.keys)
        if at == len(self.keys):
            self.keys.append(key)
        else:
            self.keys[at] = key
        self.n += 1
        if not self._place(self._mark(key), at):
            self._resize()
        return at

    def _resize(self) -> None:
        size = (self.mask + 1) * 2
        while True:  # from the stored keys, so nothing is lost with the entry that found no slot
            self._make(int(size * SLOTS * LOAD))
            if all(self._place(self._mark(k), at) for at, k in enumerate(self.keys) if k is not None):
                return
            size *= 2

    def delete(self, key: bytes) -> bool:
        at = self.find(key)
        if at < 0:
            return False
        entry = (self._mark(key), at)
        one = int.from_bytes(key[:8], "little") & self.mask
        for b in (one, self._other(one, entry[0])):
            if entry in self.buckets[b]:
                self.buckets[b].remove(entry)
                break
        self.keys[at] = None
        self.free.append(at)
        self.n -= 1
        return True

    def state(self) -> bytes:
        """The live keys, one after the other; the buckets are made again from them."""
        return b"".join(k for k in self.keys if k is not None)


def digests(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, chars (code points of the text), digest (SHA-256 of the text without white space), and columns ``also``."""

    @tidied("dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), filled(batch.column("text")), *(batch.column(c) for c in also)],
                                               ["doc_id", "text", *also])
            for part in slices(whole, "text"):
                raw, off = bytes_of(part.column("text"))
                lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                solid = ~_WHITE[raw]
                at = np.concatenate(([0], np.cumsum(solid)))[off]
                data = memoryview(raw[solid].tobytes())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(lead[off]), pa.int64()),
                    pa.array([hashlib.sha256(data[a:b]).digest() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    *(part.column(c) for c in also)], ["doc_id", "chars", "digest", *also])

    types = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", *also)}
    return docs.select("doc_id", "text", *also).mapInArrow(
        run, f"doc_id {types['doc_id']}, chars long, digest binary" + "".join(f", {c} {types[c]}" for c in also))


def _better(a: tuple, b: tuple) -> tuple:
    """Of two (chars, doc_id), the one that stays."""
    return min(a, b, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))


class _Groups:
    """Groups of equal keys under a cuckoo index."""

    def __init__(self):
        self.index, self.best, self.size = CuckooIndex(), [], []

    def add(self, key: bytes, chars: int, doc_id, n: int) -> None:
        at = self.index.find(key)
        if at < 0:
            self.index.insert(key)
            self.best.append((chars, doc_id))
            self.size.append(n)
        else:
            self.best[at] = _better(self.best[at], (chars, doc_id))
            self.size[at] += n

    def batch(self, schema: pa.Schema, extra: dict | None = None) -> pa.RecordBatch:
        rows = {"digest": self.index.keys, "chars": [b[0] for b in self.best], "doc_id": [b[1] for b in self.best], "n": self.size}
        return pa.RecordBatch.from_pydict({**rows, **(extra or {})}, schema=schema)


def _shards(rows: DataFrame) -> int:
    return max(1, rows.count() // SHARD_KEYS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _shard(n: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int")


def groups(rows: DataFrame) -> DataFrame:
    """Per distinct digest of ``rows`` (doc_id, chars, digest): digest, chars, doc_id of the row that stays, n."""
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([("digest", pa.binary()), ("chars", pa.int64()), ("doc_id", to_arrow_type(kind)), ("n", pa.int64())])

    @tidied("dedup")
    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Groups()
        for batch in batches:
            for d, c, k in zip(batch.column("doc_id").to_pylist(), batch.column("chars").to_pylist(), batch.column("digest").to_pylist()):
                held.add(k, c, d, 1)
            if held.index.n >= FOLD_KEYS:
                yield held.batch(arrow)
                held = _Groups()
        yield held.batch(arrow)

    def after(table: pa.Table) -> pa.Table:
        held = _Groups()
        for batch in table.to_batches():
            for x in zip(*(batch.column(c).to_pylist() for c in ("digest", "chars", "doc_id", "n"))):
                held.add(*x)
        return pa.Table.from_batches([held.batch(arrow)])

    schema = f"digest binary, chars long, doc_id {kind.simpleString()}, n long"
    folded = rows.mapInArrow(before, schema)
    return folded.withColumn("shard", _shard(_shards(rows))).groupBy("shard").applyInArrow(after, schema)


def dedup(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(digests(docs), "digests")
    many = (groups(rows).where("n > 1")
            .select(F.col("digest").alias("k"), F.col("doc_id").alias("keep"), F.col("n")))
    j = rows.join(many, F.col("digest") == F.col("k"), "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return j.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of each group.

    A row is known by doc_id and a hash of its text.  Of rows of a group that share the doc_id
    and the length of the row that stays, the smallest hash wins; rows equal in both are one.
    Only the rows that go are joined with the texts, not those that stay.
    """
    tagged = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    rows = written(digests(tagged, ("tag",)), "digests")
    many = groups(rows).where("n > 1").select(F.col("digest").alias("k"), F.col("doc_id").alias("keep"), F.col("chars").alias("most"))
    j = rows.join(many, F.col("digest") == F.col("k"))
    best = F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("chars") == F.col("most"))
    winner = j.where(best).groupBy(F.col("digest").alias("d")).agg(F.min("tag").alias("least"), F.count(F.lit(1)).alias("times"))
    j = j.join(winner, F.col("digest") == F.col("d"))
    gone = written(j.where(~(best & (F.col("tag") == F.col("least"))))
                   .select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")).distinct(), "gone")
    again = written(j.where(best & (F.col("tag") == F.col("least")) & (F.col("times") > 1)).groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")), "again")

    def match(t: DataFrame):
        return F.xxhash64(docs["text"]).eqNullSafe(t["__tag"]) & docs["doc_id"].eqNullSafe(t["__id"])

    stay = docs.join(gone, match(gone), "left_anti")
    if again.isEmpty():
        return stay
    once = stay.join(again, match(again), "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.join(again, match(again), "left_anti").unionByName(once)


def update_index(index: DataFrame | None, added: DataFrame, removed: DataFrame | None, shards: int) -> DataFrame:
    """An index table (shard, n_live, keys, counts) after insertions and deletions of digest rows.

    A digest stays live while more rows of it were added than removed; removing more than
    there are leaves none.  ``shards`` must stay the same for the life of an index.
    """
    spark = added.sparkSession
    empty = spark.createDataFrame([], "shard int, n_live long, keys binary, counts binary")
    none = F.lit(None).cast("binary")

    def ops(df: DataFrame, by: int) -> DataFrame:  # hot digests are summed before the shuffle
        return (df.groupBy("digest").agg(F.sum(F.lit(by)).cast("long").alias("by"))
                .select(_shard(shards).alias("shard"), "digest", "by", none.alias("keys"), none.alias("counts")))

    union = (index or empty).select("shard", none.alias("digest"), F.lit(0).cast("long").alias("by"), "keys", "counts").union(ops(added, 1))
    if removed is not None:
        union = union.union(ops(removed, -1))

    def apply(table: pa.Table) -> pa.Table:
        held, counts, changes = CuckooIndex(), [], {}
        rows = table.to_pylist()
        for r in rows:
            if r["keys"] is not None:
                for i, c in enumerate(np.frombuffer(r["counts"], "<i8").tolist()):
                    held.insert(r["keys"][32 * i:32 * i + 32])
                    counts.append(c)
            else:
                changes[r["digest"]] = changes.get(r["digest"], 0) + r["by"]
        for key, by in changes.items():
            at = held.find(key)
            if at >= 0 and counts[at] + by <= 0:
                held.delete(key)
            elif at >= 0:
                counts[at] += by
            elif by > 0:
                at = held.insert(key)
                counts[at:at + 1] = [by]
        live = [c for k, c in zip(held.keys, counts) if k is not None]
        return pa.table({"shard": pa.array([rows[0]["shard"]], pa.int32()), "n_live": pa.array([held.n], pa.int64()),
                         "keys": pa.array([held.state()], pa.binary()),
                         "counts": pa.array([np.array(live, "<i8").tobytes()], pa.binary())})

    return union.groupBy("shard").applyInArrow(apply, "shard int, n_live long, keys binary, counts binary")


def live(index: DataFrame, rows: DataFrame, shards: int) -> DataFrame:
    """Distinct digests of ``rows`` with ``is_live``: whether the index holds them."""
    asked = rows.select("digest").distinct().select(_shard(shards).alias("shard"), "digest")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        held = CuckooIndex()
        for keys in right.column("keys").to_pylist():
            for i in range(0, len(keys), 32):
                held.insert(keys[i:i + 32])
        keys = left.column("digest").to_pylist()
        return pa.table({"digest": pa.array(keys, pa.binary()), "is_live": pa.array([held.find(k) >= 0 for k in keys], pa.bool_())})

    return (asked.groupBy("shard").cogroup(index.groupBy("shard"))
            .applyInArrow(look, "digest binary, is_live boolean"))
