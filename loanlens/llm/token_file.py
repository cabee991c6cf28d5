"""Token ids as directly addressable codes, written and read as Parquet tables.

Documents are ordered by doc_id (a range shuffle) and encoded where they lie.  A row
of the table is a segment of whole documents.  Its ids are cut into chunks of eight
bits: level 0 holds the low chunk of each id, a continuation bitmap says which ids go
on, level 1 holds the next chunk of those, and so on.  A rank directory per bitmap
counts the set bits before each block of 512, so the chunk of token i on the next
level is found without decoding its neighbours.

Defined results: a null or empty text has the end id only; rows with equal doc_id keep
an order by text; null doc_ids come first; other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.store import part_bases, written
from loanlens.llm.text import filled, slices, tidied
from loanlens.llm.token_ids import SLICE, encoder, with_end

BLOCK_BITS = 512  # of a rank directory
_ORDER = ["doc_id", "text"]


def dac_encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of each level."""
    chunks, bitmaps, ranks = [], [], []
    rest = np.asarray(ids, np.uint32)
    while True:
        more = rest > 255
        chunks.append((rest & 255).astype(np.uint8).tobytes())
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        blocks = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), BLOCK_BITS)) if len(more) else np.zeros(0, np.int64)
        ranks.append(np.concatenate(([0], np.cumsum(blocks))).astype("<u4").tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            return chunks, bitmaps, ranks


def dac_decode(chunks: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment, from the last level to the first."""
    out = None
    for c, b in zip(reversed(chunks), reversed(bitmaps)):
        own = np.frombuffer(c, np.uint8).astype(np.uint32)
        if out is not None and len(out):
            more = np.unpackbits(np.frombuffer(b, np.uint8), count=len(own), bitorder="little").astype(bool)
            own[more] |= out << np.uint32(8)
        out = own
    return out


def dac_access(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], at: np.ndarray) -> np.ndarray:
    """The ids at positions ``at``: one chunk, one bit and one rank per level, no decoding around them."""
    at = np.asarray(at, np.int64)
    out, live = np.zeros(len(at), np.uint32), np.arange(len(at))
    for level, (c, b, r) in enumerate(zip(chunks, bitmaps, ranks)):
        out[live] |= np.frombuffer(c, np.uint8)[at].astype(np.uint32) << np.uint32(8 * level)
        bits, rank = np.frombuffer(b, np.uint8), np.frombuffer(r, "<u4").astype(np.int64)
        on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        live, at = live[on], at[on]
        if not len(at):
            break
        block = at // BLOCK_BITS
        padded = np.concatenate((bits, np.zeros(BLOCK_BITS // 8, np.uint8)))
        inside = np.unpackbits(padded[(block * BLOCK_BITS // 8)[:, None] + np.arange(BLOCK_BITS // 8)], axis=1, bitorder="little")
        at = rank[block] + (inside * (np.arange(BLOCK_BITS) < (at % BLOCK_BITS)[:, None])).sum(1, dtype=np.int64)
    return out


def _rank(bits: np.ndarray, rank: np.ndarray, at: int) -> int:
    """Set bits before ``at``: those before its block by the directory, the others by counting."""
    block = at // BLOCK_BITS
    inside = np.unpackbits(bits[block * BLOCK_BITS // 8:(at + 7) // 8], count=at - block * BLOCK_BITS, bitorder="little")
    return int(rank[block]) + int(np.count_nonzero(inside))


def dac_range(chunks: list[np.ndarray], bitmaps: list[np.ndarray], ranks: list[np.ndarray], start: int, n: int) -> np.ndarray:
    """The ids at ``start`` .. ``start + n``, of a document say: a run of a level goes on as a run of the next one.

    Levels as numpy arrays (bytes, bytes, counts); nothing before or behind the run is decoded.
    """
    out, live, width = np.zeros(n, np.uint32), None, n
    for level, (c, b, r) in enumerate(zip(chunks, bitmaps, ranks)):
        own = c[start:start + width].astype(np.uint32) << np.uint32(8 * level)
        live = np.arange(n) if live is None else live
        out[live] |= own
        first = start // 8
        more = np.unpackbits(b[first:(start + width + 7) // 8], count=start - 8 * first + width, bitorder="little")[start - 8 * first:].astype(bool)
        live = live[more]
        if not len(live):
            break
        start, width = _rank(b, r, start), len(live)
    return out


def _schema(doc_id: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()),
        T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(doc_id)), T.StructField("sizes", T.ArrayType(T.LongType())),
        *(T.StructField(c, T.ArrayType(T.BinaryType())) for c in ("chunks", "bitmaps", "ranks"))])


def segments(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """Encoded segments of ``docs`` in ascending doc_id order.

    ``part`` ascends with doc_id; ``before`` counts the ids of earlier segments of the part.
    A segment holds the documents of one slice of text, so one document at least.
    """
    schema = _schema(docs.schema["doc_id"].dataType)

    @tidied("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before, count = encoder(tokenizer_file), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), filled(batch.column("text"))], _ORDER)
            for piece in slices(whole, "text", SLICE):
                ids, off = with_end(*enc.encode(piece.column("text")), end_id)
                row = dict(part=part, segment=count, before=before, n_tokens=len(ids),
                           doc_ids=piece.column("doc_id").to_pylist(), sizes=np.diff(off).tolist())
                row["chunks"], row["bitmaps"], row["ranks"] = dac_encode(ids)
                yield pa.RecordBatch.from_pylist([row], schema=arrow)
                before, count = before + len(ids), count + 1

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return (docs.select(*_ORDER).repartitionByRange("doc_id").sortWithinPartitions(*_ORDER)
            .mapInArrow(run, schema))


def write(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """Write the segments of ``docs`` into the shared folder; the table read back, with ``base`` ids before each part."""
    table = written(segments(docs, tokenizer_file, end_id), "token-file")
    return table.join(part_bases(table, "part", "n_tokens"), "part")


CHECKED = 100  # doc_ids divisible by it are read by direct access as well


def read(table: DataFrame) -> DataFrame:
    """Per document of a written table: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Segments are decoded as a whole; documents whose doc_id CHECKED divides are also read by direct
    access from their start, by rank, and a file whose two readings differ fails with the document.
    """

    @tidied("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = {c: batch.column(c)[row] for c in batch.schema.names}
                chunks, bitmaps = x["chunks"].as_py(), x["bitmaps"].as_py()
                ids = dac_decode(chunks, bitmaps).astype("<u4")
                sizes = np.array(x["sizes"].as_py(), np.int64)
                off = np.concatenate(([0], np.cumsum(sizes)))
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                levels = [np.frombuffer(c, np.uint8) for c in chunks], [np.frombuffer(b, np.uint8) for b in bitmaps], \
                    [np.frombuffer(r, "<u4") for r in x["ranks"].as_py()]
                for k, doc_id in enumerate(x["doc_ids"].as_py()):
                    if isinstance(doc_id, int) and doc_id % CHECKED == 0:
                        own = dac_range(*levels, int(off[k]), int(sizes[k])).astype("<u4")
                        if zlib.crc32(own.tobytes()) != crc[k]:
                            raise ValueError(f"the token file is damaged at document {doc_id}")
                yield pa.RecordBatch.from_arrays([
                    x["doc_ids"].values, pa.array(off[:-1] + x["base"].as_py() + x["before"].as_py(), pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = table.schema["doc_ids"].dataType.elementType.simpleString()
    return table.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def access(table: DataFrame, requests: DataFrame) -> DataFrame:
    """Ids of single tokens: ``requests`` (doc_id, at) gives (doc_id, at, id); none for positions outside a document.

    Requests meet their segment only; its distinct positions are looked up by rank.
    """
    sizes = F.transform("sizes", lambda x: F.coalesce(x, F.lit(0)))
    inside = Window.partitionBy("part", "segment").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    index = (table.select("part", "segment", F.posexplode(F.arrays_zip("doc_ids", sizes.alias("sizes"))).alias("k", "d"))
             .select("part", "segment", F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("size"),
                     F.coalesce(F.sum("d.sizes").over(inside), F.lit(0)).alias("first")))
    wanted = (requests.select("doc_id", "at").distinct().join(index, "doc_id").where("at >= 0 and at < size")
              .groupBy("part", "segment").agg(F.collect_list(F.struct("doc_id", "at", (F.col("first") + F.col("at")).alias("spot"))).alias("wanted")))
    kind = requests.schema["doc_id"].dataType.simpleString()

    @tidied("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = dac_access(row["chunks"], row["bitmaps"], row["ranks"], np.array([w["spot"] for w in row["wanted"]]))
                yield pa.RecordBatch.from_pylist([{"doc_id": w["doc_id"], "at": w["at"], "id": int(i)} for w, i in zip(row["wanted"], got)])

    return (wanted.join(table, ["part", "segment"]).select("wanted", "chunks", "bitmaps", "ranks")
            .mapInArrow(run, f"doc_id {kind}, at {requests.schema['at'].dataType.simpleString()}, id long"))
