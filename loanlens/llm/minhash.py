"""Near duplicates by MinHash: many universal hash minima, banding, signature verification, exact confirmation.

A document is the set of its distinct ``k``-word shingles (64-bit hashes of lower-cased words).
Two documents link when 100 * intersection >= percent * union.

1. Equal sets are one node, however many copies there are.
2. BANDS x BAND_ROWS minima of universal hashes (a * x + b) sign a node; the minima of a band are
   its key.  With 32 bands of 4, a pair at 0.85 shares no key with a probability of 5e-11.
3. A pair of a bucket goes on if its signatures agree in a share of ``percent`` less SLACK at
   least: more than six standard deviations under the threshold.
4. Round one: each node of a bucket against the smallest one.  Round two, only where a bucket
   holds nodes of several components: all pairs between components by signature, block by block,
   then the exact sets of the nodes that keep a partner; a block sends links that join two
   components only, so what is sent is in proportion to the rows of the bucket, not to its pairs.
5. Links are confirmed on full sets; components by large-star and small-star.

Defined results: a null text or one without words has an empty set and is alone; equal texts are
in one component; rows that share a doc_id but not the text are documents of their own; a null
doc_id links as any other; the component is its smallest doc_id (null only if all of
its doc_ids are); ``kept`` says that doc_id is the component, so rows of a component that share
its doc_id stay together.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.blocks import completed, links, spans, walk
from loanlens.llm.star_components import components
from loanlens.llm.store import dropped, written
from loanlens.llm.text import bytes_of, filled, lower_ascii, mix, shingles, slices, tidied, word_hashes, word_spans

BANDS, BAND_ROWS = 32, 4
SLACK = 0.2  # of the share of agreeing minima under the threshold; the standard deviation is 0.032
_RUN = 1 << 14  # items
_SEED = 20250117


def _hashes() -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of the universal hashes; the same in every task."""
    r = np.random.RandomState(_SEED).randint(0, 2**32, (4, BANDS * BAND_ROWS)).astype(np.uint64)
    return (r[0] << np.uint64(32)) | r[1] | np.uint64(1), (r[2] << np.uint64(32)) | r[3]


def minima(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The minima (sets x hashes) of sets ``items[first[i]:first[i + 1]]``; an empty set has the largest value everywhere."""
    a, b = _hashes()
    out = np.full((len(first) - 1, len(a)), ~np.uint64(0))
    full = np.flatnonzero(np.diff(first))
    at = 0
    while at < len(full):  # some sets at a time, so that their items stay in the cache for all hashes
        base = first[full[at]]
        end = max(at + 1, int(np.searchsorted(first[full + 1], base + _RUN, side="right")))
        part, own_first = items[base:first[full[end - 1] + 1]], first[full[at:end]] - base
        value = np.empty_like(part)
        for h in range(len(a)):
            np.multiply(part, a[h], out=value)
            value += b[h]
            out[full[at:end], h] = np.minimum.reduceat(value, own_first)
        at = end
    return mix(out)


def band_keys(least: np.ndarray) -> np.ndarray:
    """The key of each band (sets x bands) from the minima."""
    part = least.reshape(len(least), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2])
    for r in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key


def _identity(items: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """128 bits of each set: sums of two scrambles of its shingles, with its size."""
    out = []
    for salt in (0x51ED27, 0xC0FFEE5):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(items ^ np.uint64(salt)))))
        out.append(mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64))
    return out


def _sets_of(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        at = batch.schema.names.index("text")
        for part in slices(batch.set_column(at, "text", filled(batch.column(at))), "text"):
            raw, off = bytes_of(part.column("text"))
            raw = lower_ascii(raw)
            starts, ends, first = word_spans(raw, off)
            yield part, *shingles(word_hashes(raw, starts, ends), first, k)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n (set size), node and check (128 bits of the set), sig (a byte of each minimum), keys (of the bands)."""

    @tidied("minhash")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, items, first in _sets_of(batches, k):
            node, check = _identity(items, first)
            least = minima(items, first)
            sig = least.astype(np.uint8)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(least).ravel().view(np.int64)), BANDS)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(first), pa.int64()), pa.array(node), pa.array(check),
                 pa.array([row.tobytes() for row in sig], pa.binary()), keys.cast(pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n", "node", "check", "sig", "keys"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "text_hash").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n long, node long, check long, sig binary, keys array<long>")


def _full_sets(docs: DataFrame, k: int) -> DataFrame:
    """n, node, check, items (sorted shingles) of each text."""

    @tidied("minhash")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, items, first in _sets_of(batches, k):
            node, check = _identity(items, first)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(items.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(first), pa.int64()), pa.array(node), pa.array(check), lists],
                                             ["n", "node", "check", "items"])

    return docs.select("text").mapInArrow(run, "n long, node long, check long, items array<long>")


def agreeing(block: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of rows of a block, of different components, whose signatures agree in ``least`` places at least.

    Rows of side 1 are compared with those of side 0 only, if there are any.
    """
    comp, n, side = (block.column(c).to_numpy() for c in ("comp", "n", "side"))
    sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint8).reshape(len(comp), -1)
    two = side.any()
    cols = np.flatnonzero(side == 1) if two else np.arange(len(comp))
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in np.flatnonzero(side == 0):
        j = cols if two else cols[i + 1:]
        j = j[comp[j] != comp[i]]
        if len(j):
            j = j[np.count_nonzero(sig[j] == sig[i], axis=1) >= least]
            out_i.append(np.full(len(j), i))
            out_j.append(j)
    return np.concatenate(out_i), np.concatenate(out_j)


def _least(percent: int) -> int:
    return max(1, int((percent / 100 - SLACK) * BANDS * BAND_ROWS))


def _alive(placed: DataFrame, percent: int) -> DataFrame:
    """Members (key, node) with a partner of another component by their signatures."""
    least = _least(percent)

    def each(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(0, np.int64)]
        for x, y in spans(begin, table.num_rows):
            if y - x > 1:
                i, j = agreeing(table.slice(x, y - x), least)
                found.append(np.unique(np.concatenate((i, j))) + x)
        at = np.concatenate(found)
        key, node = (table.column(c).to_numpy()[at] for c in ("key", "node"))
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(node, pa.int64())], ["key", "node"])

    return walk(placed, each, "key long, node long", "minhash")


def _block_links(placed: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between components of a block, confirmed on full sets: fewer than it has rows."""
    least = _least(percent)

    def each(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        for x, y in spans(begin, table.num_rows):
            if y - x > 1:
                block = table.slice(x, y - x)
                yield links(block, *agreeing(block, least), percent)

    return walk(placed, each, "u long, v long", "minhash")


def _heads(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) of the nodes of each bucket to its smallest one, by signature and then on full sets."""
    head = members.groupBy("key").agg(F.min("node").alias("v"))
    pairs = members.join(head, "key").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    a = sets.select(F.col("node").alias("u"), F.col("id").alias("du"), F.col("sig").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("id").alias("dv"), F.col("sig").alias("sv"))
    least = _least(percent)

    @tidied("minhash")
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("su", "sv"))
            ok = pa.array(np.count_nonzero(x == y, axis=1) >= least)
            yield batch.select(["du", "dv"]).filter(ok)

    signed = pairs.join(a, "u").join(b, "v").select("du", "dv", "su", "sv")
    signed = signed.mapInArrow(near, "du long, dv long")
    x = sets.select(F.col("id").alias("du"), F.col("items").alias("iu"))
    y = sets.select(F.col("id").alias("dv"), F.col("items").alias("iv"))
    both = F.size(F.array_intersect("iu", "iv"))
    return signed.join(x, "du").join(y, "dv").withColumn("both", both) \
        .where(100 * F.col("both") >= percent * (F.size("iu") + F.size("iv") - F.col("both"))) \
        .select(F.col("du").alias("u"), F.col("dv").alias("v"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = written(signatures(docs, k), "minhash")
    table = written(signed.select("doc_id", "text_hash", "n", "node", "check"), "minhash-rows")
    real = table.where("n > 0")
    reps = written(real.groupBy("node", "check", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("r"))
                   .select(F.monotonically_increasing_id().alias("id"), "node", "check", "n", "r.doc_id", "r.text_hash"), "minhash-nodes")

    rows = signed.where("n > 0").dropDuplicates(["node"]).select(F.explode("keys").alias("key"), "node")
    many = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key")
    members = written(rows.join(many, "key", "left_semi"), "minhash-members")
    # buckets of the same nodes are one: the smallest key stays
    a, b = (F.sum(F.shiftright(F.xxhash64("node", F.lit(s)), 20)) for s in (0, 7))
    tagged = members.groupBy("key").agg(a.alias("a"), b.alias("b"), F.count(F.lit(1)).alias("c"))
    chosen = tagged.groupBy("a", "b", "c").agg(F.min("key").alias("key")).select("key")
    every, members = members, written(members.join(chosen, "key", "left_semi"), "minhash-buckets")
    dropped(every)

    nodes = members.select("node").distinct()
    wanted = reps.join(nodes, "node", "left_semi").select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    sig = signed.select("node", "check", "n", "sig").join(nodes, "node", "left_semi").dropDuplicates(["node", "check", "n"])
    full = _full_sets(docs.join(wanted, F.expr("doc_id <=> __d and text_hash <=> __t"), "left_semi"), k)
    full = full.join(reps.select("node", "check", "n", "id"), ["node", "check", "n"]).dropDuplicates(["id"])
    sets = written(full.join(sig, ["node", "check", "n"]).select("id", "node", "n", "sig", "items"), "minhash-sets")
    dropped(signed)

    comp = components(written(_heads(members, sets, percent), "minhash-links"))
    comp = completed(members, sets, comp, components, lambda g: _alive(g, percent), lambda g: _block_links(g, percent), ["sig"], ["sig", "items"])

    least = written(reps.join(comp.withColumnRenamed("node", "id"), "id", "left")
                    .select("node", "check", "n", F.coalesce("component", "id").alias("class"),
                            "doc_id"), "minhash-classes")
    dropped(sets)
    top = least.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    linked = real.join(least.drop("doc_id").join(top, "class"), ["node", "check", "n"]) \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.expr("doc_id <=> component_id").alias("kept"))
    alone = table.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)
