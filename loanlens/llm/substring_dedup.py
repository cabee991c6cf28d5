"""Removal of passages that occur earlier, found at difference-cover anchors.

A window is ``WINDOW`` consecutive words.  Anchors are shorter runs that start at word
positions whose remainder modulo ``PERIOD`` lies in ``COVER``.  Every remainder is a
difference of two members of the cover, so two equal windows, wherever they start, have
a common anchor: at the same distance from both starts a position of the cover.  Windows
without an anchor that occurs twice are therefore first and only; only the others are
hashed whole (the extension) and compared.

Documents lie in chunks of ascending doc_id, so "earlier" is the order of chunks, then the
order within one.  A chunk sends each distinct hash once, packed by bucket of the hash
space, and gets a bit back for each: first whether an anchor occurs elsewhere, then whether
an earlier chunk has the window.  A passage that is in a third of all documents is one entry
per chunk.  The text itself is shuffled once.

Defined results: null texts have no words; rows with equal doc_id are ordered by text;
texts shorter than a window are kept whole; an empty table gives none.  Only doc_id (an
integer, nulls first) and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.ranges import range_bucket
from loanlens.llm.text import bytes_of, filled, mix, rest, run_hashes, word_hashes, word_spans

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
CHUNK_BYTES = 8 << 20  # text of a chunk, about


def is_cover(period: int, cover: tuple[int, ...]) -> bool:
    """Whether every remainder is a difference of two members."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


class _Chunk:
    """Words and hashes of a chunk, in order of (doc_id, text)."""

    def __init__(self, docs: pa.Table, window: int, period: int, cover: tuple[int, ...]):
        rest()  # what the chunk before held
        docs = docs.select(["doc_id", "text"]).combine_chunks()
        order = pc.sort_indices(docs, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
        self.docs = docs.take(order).combine_chunks()
        text = self.docs.column("text")
        text = filled(text.chunk(0) if text.num_chunks else pa.array([], pa.string()))
        self.raw, self.off = bytes_of(text)
        self.starts, self.ends, self.first = word_spans(self.raw, self.off)
        self.words = word_hashes(self.raw, self.starts, self.ends)
        self.window, self.n = window, np.diff(self.first)
        place = np.arange(len(self.words)) - np.repeat(self.first[:-1], self.n)
        left = np.repeat(self.n, self.n) - place  # words from here to the end of the document
        self.has_window = left >= window
        run = window - period + 1
        long_enough = np.repeat(self.n >= window, self.n)
        spots = np.isin(np.arange(period), cover)[place % period] if len(place) else np.zeros(0, bool)
        self.anchor_at = np.flatnonzero(spots & (left >= run) & long_enough)
        self.period = period
        self.anchors = run_hashes(self.words, run, self.anchor_at)

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of windows that hold a repeated anchor at distance 0 .. period - 1."""
        mark = np.zeros(len(self.words) + 1, np.int64)
        mark[1:][self.anchor_at[repeated]] = 1
        total = np.cumsum(mark)
        at = np.flatnonzero(self.has_window)
        return at[total[np.minimum(at + self.period, len(self.words))] > total[at]]

    def window_hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each window: one to compare, one to choose the bucket."""
        return run_hashes(self.words, self.window, at), run_hashes(mix(self.words + np.uint64(0x51ED2701)), self.window, at)


def _packed(chunk: int, value: np.ndarray, bucket: np.ndarray, kind: type) -> pa.Table:
    """A row per bucket with the values for it, in the order that ``_unpacked`` gives the answers back."""
    order = np.argsort(bucket, kind="stable")
    bucket, value = bucket[order], value[order].astype(kind)
    ids, begin = np.unique(bucket, return_index=True)
    cuts = np.append(begin, len(bucket))
    return pa.table({"chunk": pa.array(np.full(len(ids), chunk), pa.int32()), "bucket": pa.array(ids, pa.int32()),
                     "blob": pa.array([value[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def _unpacked(replies: dict[int, bytes], bucket: np.ndarray) -> np.ndarray:
    """The answer bit of each value."""
    order = np.argsort(bucket, kind="stable")
    ids, count = np.unique(bucket, return_counts=True)
    bits = [np.unpackbits(np.frombuffer(replies[b], np.uint8), count=c) for b, c in zip(ids.tolist(), count.tolist())]
    out = np.zeros(len(bucket), bool)
    out[order] = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
    return out


def _answers(kind: type, first_only: bool):
    """Per bucket: the bit of each value says whether another chunk (``first_only``: an earlier one) has it."""

    def run(table: pa.Table) -> pa.Table:
        chunk = np.array(table.column("chunk").to_pylist())
        blobs = [np.frombuffer(b, kind) for b in table.column("blob").to_pylist()]
        order = np.argsort(chunk)
        value = np.concatenate([blobs[i] for i in order])
        size = [len(blobs[i]) for i in order]
        _, first, back, count = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
        bit = np.arange(len(value)) > first[back] if first_only else count[back] > 1
        cuts = np.concatenate(([0], np.cumsum(size)))
        return pa.table({"chunk": pa.array(chunk[order], pa.int32()), "bucket": table.column("bucket").take(pa.array(order)),
                         "bits": pa.array([np.packbits(bit[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})

    return run


def _replies(table: pa.Table, kind: str) -> dict[int, bytes]:
    return {r["bucket"]: r["bits"] for r in table.to_pylist() if r["kind"] == kind}


def deduplicate(docs: DataFrame, window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, removed (array of (start, length) in words), kept (words left, joined by a space)."""
    if not is_cover(period, cover) or not 1 <= period <= window:
        raise ValueError("cover is no difference cover of the period, or the period is longer than the window")
    spark, slim = docs.sparkSession, docs.select("doc_id", "text")
    total = slim.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    chunks = max(-(-total // chunk_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = slim.withColumn("chunk", range_bucket(slim, "doc_id", chunks))

    def anchor_parts(c: _Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        value, back, count = np.unique(c.anchors, return_inverse=True, return_counts=True)
        return value, (mix(value) % np.uint64(chunks)).astype(np.int64), back, count > 1

    def send_anchors(table: pa.Table) -> pa.Table:
        value, bucket, _, _ = anchor_parts(_Chunk(table, window, period, cover))
        return _packed(table.column("chunk")[0].as_py(), value, bucket, np.uint32)  # 32 bits do: a false hit only adds candidates

    def candidates(c: _Chunk, replies: dict[int, bytes]) -> np.ndarray:
        _, bucket, back, here = anchor_parts(c)
        return c.candidates((_unpacked(replies, bucket) | here)[back])

    def window_parts(c: _Chunk, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own, other = c.window_hashes(at)
        value, first = np.unique(own, return_index=True)
        return value, (other[first] % np.uint64(chunks)).astype(np.int64), first

    def send_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        c = _Chunk(table, window, period, cover)
        value, bucket, _ = window_parts(c, candidates(c, _replies(replies, "anchor")))
        return _packed(table.column("chunk")[0].as_py(), value, bucket, np.uint64)

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        c = _Chunk(table, window, period, cover)
        at = candidates(c, _replies(replies, "anchor"))
        _, bucket, first = window_parts(c, at)
        earlier = np.ones(len(at), bool)
        earlier[first] = _unpacked(_replies(replies, "window"), bucket)
        cover_of = np.zeros(len(c.words) + 1, np.int64)
        np.add.at(cover_of, at[earlier], 1)
        np.add.at(cover_of, at[earlier] + window, -1)
        gone = np.cumsum(cover_of)[:-1] > 0
        return _result(c, gone)

    schema = "chunk int, bucket int, blob binary"
    reply = "chunk int, bucket int, bits binary"
    by = dealt.groupBy("chunk")
    anchors = by.applyInArrow(send_anchors, schema).groupBy("bucket").applyInArrow(_answers(np.uint32, False), reply)
    anchors = anchors.withColumn("kind", F.lit("anchor"))
    windows = (by.cogroup(anchors.groupBy("chunk")).applyInArrow(send_windows, schema)
               .groupBy("bucket").applyInArrow(_answers(np.uint64, True), reply).withColumn("kind", F.lit("window")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return by.cogroup(anchors.unionByName(windows).groupBy("chunk")).applyInArrow(
        remove, f"doc_id {kind}, n_words long, n_removed long, removed array<struct<start:long,length:long>>, kept string")


def _result(c: _Chunk, gone: np.ndarray) -> pa.Table:
    """Rows of a chunk from the words that go."""
    data = c.raw.tobytes()
    n_gone = np.concatenate(([0], np.cumsum(gone)))
    spans, kept = [], []
    for a, b in zip(c.first[:-1], c.first[1:]):
        own = np.concatenate(([False], gone[a:b], [False]))
        edge = np.flatnonzero(own[1:] != own[:-1]).reshape(-1, 2)
        spans.append([{"start": int(x), "length": int(y - x)} for x, y in edge])
        stay = np.flatnonzero(~gone[a:b]) + a
        kept.append(b" ".join([data[x:y] for x, y in zip(c.starts[stay].tolist(), c.ends[stay].tolist())]))
    return pa.table({"doc_id": c.docs.column("doc_id"), "n_words": pa.array(c.n, pa.int64()),
                     "n_removed": pa.array(n_gone[c.first[1:]] - n_gone[c.first[:-1]], pa.int64()),
                     "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                     "kept": pa.array([k.decode() for k in kept], pa.string())})
