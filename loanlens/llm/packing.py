"""Concatenate and cut: documents become one stream of token ids, cut into fixed windows.

First pass: each task encodes its rows as they lie and writes ids and running offsets
to the shared folder.  The totals of the tasks (one number each) get prefix sums, which
give every document its place in the whole stream.  Second pass: windows of ``length``
ids cut the stream; a boundary record per piece says which ids of which document lie
where.  Only the last sequence can be short, so no padding lies anywhere else.

Defined results: a null or empty text is its end id only; repeated rows are packed as
often as they occur; documents keep the order of the files read; an empty table gives none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import part_bases, written
from loanlens.llm.text import filled, slices, tidied
from loanlens.llm.token_ids import SLICE, encoder, with_end


def encoded(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """Written table of doc_id, part, before (ids of the part before this document), n_tokens, ids (32-bit binary)."""

    @tidied("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), filled(batch.column("text"))], ["doc_id", "text"])
            for piece in slices(whole, "text", SLICE):
                ids, off = with_end(*encoder(tokenizer_file).encode(piece.column("text")), end_id)
                raw = pa.Array.from_buffers(pa.binary(), len(off) - 1, [
                    None, pa.py_buffer((4 * off).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(np.full(len(off) - 1, part), pa.int32()),
                    pa.array(before + off[:-1], pa.int64()), pa.array(np.diff(off), pa.int64()), raw],
                    ["doc_id", "part", "before", "n_tokens", "ids"])
                before += len(ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, part int, before long, n_tokens long, ids binary"), "packing-ids")


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = 2048, with_ids: bool = False) -> DataFrame:
    """Boundary records: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, as binary)."""
    table = encoded(docs, tokenizer_file, end_id)
    placed = table.join(part_bases(table, "part", "n_tokens"), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("place"), "n_tokens", "ids")

    @tidied("tokens")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            size = batch.column("n_tokens").to_numpy()
            count = (place + size - 1) // length - place // length + 1
            row = np.repeat(np.arange(len(size)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(place[row], (place[row] // length + nth) * length)
            end = np.minimum(place[row] + size[row], (place[row] // length + nth + 1) * length)
            own = [memoryview(x.as_buffer()) for x in batch.column("ids")]
            cut = [own[r][4 * (a - place[r]):4 * (b - place[r])] for r, a, b in zip(row, begin, end)]
            cols = [batch.column("doc_id").take(pa.array(row)), pa.array(begin - place[row]), pa.array(end - begin),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64()), pa.array(size[row]),
                    pa.array(begin // length), pa.array(begin % length)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array([bytes(c) for c in cut], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long" + ", ids binary" * with_ids)


def sequences(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = 2048) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (32-bit binary), boundaries (doc_id, start, length, offset).

    A sequence gathers ``length`` ids at most, however many documents it holds.
    """
    parts = pieces(docs, tokenizer_file, end_id, length, with_ids=True)
    return (parts.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"),
                 F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"))
            .select("sequence_id", "n_tokens", F.expr("aggregate(p.ids, X'', (a, x) -> concat(a, x))").alias("ids"),
                    F.transform("p", lambda x: F.struct(x.doc_id.alias("doc_id"), x.start.alias("start"),
                                                        x.length.alias("length"), x.offset.alias("offset"))).alias("boundaries")))
