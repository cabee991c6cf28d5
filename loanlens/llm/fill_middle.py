"""Fill-in-the-middle transformation with memoised content-defined chunks.

A text is n units, ``[A-Za-z]+|[^A-Za-z]`` from left to right over code points; two cuts between
units give a prefix, a middle and a suffix, put in the order prefix-suffix-middle (``psm``) or
suffix-prefix-middle (``spm``) behind the marks ``<P>``, ``<S>`` and ``<M>``.

A rolling hash over WINDOW bytes cuts a text into chunks where its low bits are zero, so texts that
share a passage share the chunks inside it.  A cache per worker holds the summary of each chunk
(units, code points, whether it begins and ends with a letter), found by the content of the
chunk, not by its hash alone.  Units of a text are the sums over its chunks less the joins where a word runs on
from one chunk into the next; the same sums find the chunk of a cut, and only that chunk is read.
A longest chunk bounds what a cut reads.  The work is row by row: no shuffle.

Defined results: a null text is empty; an empty text, one that holds a mark, and the share of
documents beyond ``rate`` stay ``plain``.  The draws come from SHA-256 of ``seed:doc_id``, so they
are alike in every run (a null doc_id draws as the empty word); rows that share a doc_id share
the draws.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.text import _BASE, _BYTE, _INVERSE, _power, bytes_of, cached, filled, mix, slices, tidied

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW = 16  # bytes of the rolling hash
SHORT, LONG = 256, 8192  # bytes of the shortest and the longest chunk (but for the last one of a text)
_MASK = np.uint64(1023)  # a hit every 1024 bytes or so
CACHE_BYTES = 32 << 20  # chunk contents that a worker keeps


def _letters(raw: np.ndarray) -> np.ndarray:
    low = raw | np.uint8(32)
    return (low >= 97) & (low <= 122)


def _unit_starts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which bytes begin a unit; ``first`` are the positions where texts (or chunks) begin."""
    letter = _letters(raw)
    out = (raw & 0xC0) != 0x80
    out[1:] &= ~(letter[1:] & letter[:-1])
    out[first[first < len(raw)]] = True
    return out


def chunk_ends(raw: np.ndarray, off: np.ndarray) -> tuple[list[int], np.ndarray]:
    """End of each chunk of the texts, and the index of the first chunk of each text (one more at the end)."""
    hits: list[int] = []
    if len(raw) > WINDOW:
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _power(len(raw), _BASE)[:len(raw)], out=total[1:])
        rolled = (total[WINDOW:] - total[:-WINDOW]) * _power(len(raw), _INVERSE)[:len(raw) + 1 - WINDOW]
        at = np.flatnonzero((mix(rolled) & _MASK) == 0) + WINDOW
        at = at[at < len(raw)]
        hits = at[(raw[at] & 0xC0) != 0x80].tolist()  # between code points only
    ends: list[int] = []
    first = np.zeros(len(off), np.int64)
    bounds = off.tolist()
    for t, (pos, stop) in enumerate(zip(bounds[:-1], bounds[1:])):
        while stop - pos > SHORT:
            k = bisect_left(hits, pos + SHORT)
            end = hits[k] if k < len(hits) and hits[k] < stop else stop
            if end - pos > LONG:
                end = pos + LONG
                while raw[end] & 0xC0 == 0x80:
                    end += 1
            ends.append(end)
            pos = end
        if pos < stop:
            ends.append(stop)
        first[t + 1] = len(ends)
    return ends, first


class ChunkCache:
    """Summaries of chunks by content: (units, code points, begins with a letter, ends with a letter)."""

    def __init__(self) -> None:
        self.cache_clear()

    def cache_clear(self) -> None:
        self.known: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.held = 0

    def summaries(self, chunks: list[bytes]) -> np.ndarray:
        """One row for each chunk; those that are not known are counted together."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if new:
            size = sum(map(len, new))
            if self.held + size > CACHE_BYTES:  # start anew with what is in use now
                self.cache_clear()
                new = list(dict.fromkeys(chunks))
            self.held += sum(map(len, new))
            raw = np.frombuffer(b"".join(new), np.uint8)
            first = np.concatenate(([0], np.cumsum([len(c) for c in new])[:-1])).astype(np.int64)
            units = np.add.reduceat(_unit_starts(raw, first).astype(np.int64), first)
            chars = np.add.reduceat(((raw & 0xC0) != 0x80).astype(np.int64), first)
            letter = _letters(raw)
            last = np.append(first[1:], len(raw)) - 1
            self.known.update(zip(new, zip(units.tolist(), chars.tolist(), letter[first].tolist(), letter[last].tolist())))
        return np.array([self.known[c] for c in chunks], np.int64).reshape(-1, 4)


_chunks = cached(ChunkCache())


class Units:
    """Units of the texts of a slice: their number, and where the u-th one begins."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw, self.off = raw, off
        ends, self.first = chunk_ends(raw, off)
        self.begins = np.concatenate(([0], ends[:-1])).astype(np.int64) if ends else np.zeros(0, np.int64)
        self.ends = np.array(ends, np.int64)
        data = raw.tobytes()
        found = _chunks.summaries([data[a:b] for a, b in zip(self.begins.tolist(), ends)])
        joined = np.zeros(len(found), np.int64)  # a word runs on from the chunk before
        if len(found):
            joined[1:] = found[1:, 2] & found[:-1, 3]
            joined[self.first[:-1][self.first[:-1] < len(found)]] = 0
        self.joined = joined
        self.units = np.concatenate(([0], np.cumsum(found[:, 0] - joined)))
        self.chars = np.concatenate(([0], np.cumsum(found[:, 1])))

    def count(self, t: int) -> int:
        return int(self.units[self.first[t + 1]] - self.units[self.first[t]])

    def place(self, t: int, u: int) -> tuple[int, int]:
        """(byte, code point) from the beginning of text ``t`` where ``u`` units end."""
        a, b = int(self.first[t]), int(self.first[t + 1])
        want = int(self.units[a]) + u
        if want >= self.units[b]:
            return int(self.off[t + 1] - self.off[t]), int(self.chars[b] - self.chars[a])
        c = int(np.searchsorted(self.units, want, side="right")) - 1
        raw = self.raw[self.begins[c]:self.ends[c]]
        starts = np.flatnonzero(_unit_starts(raw, np.zeros(1, np.int64)))
        at = int(starts[want - int(self.units[c]) + int(self.joined[c])])
        chars = int(np.count_nonzero((raw[:at] & 0xC0) != 0x80))
        return int(self.begins[c] - self.off[t]) + at, int(self.chars[c] - self.chars[a]) + chars


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), output (text), prefix_chars, middle_chars (null if plain).

    ``rate`` per cent of the documents are transformed, ``spm_rate`` per cent of those as ``spm``.
    """

    @tidied("fill_middle")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
        for batch in batches:
            at = batch.schema.names.index("text")
            for part in slices(batch.set_column(at, "text", filled(batch.column(at))), "text"):
                raw, off = bytes_of(part.column("text"))
                units, data = Units(raw, off), raw.tobytes()
                rows = []
                for t, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    text, n = data[off[t]:off[t + 1]], units.count(t)
                    draw = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
                    h1, h2, h3, h4 = (int(draw[x:x + 8], 16) for x in (0, 8, 16, 24))
                    if not text or h3 % 100 >= rate or p in text or s in text or m in text:
                        rows.append((n, "plain", text, None, None))
                        continue
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    (x, cx), (y, cy) = units.place(t, a), units.place(t, b)
                    if h4 % 100 < spm_rate:
                        rows.append((n, "spm", b"".join((s, text[y:], p, text[:x], m, text[x:y])), cx, cy - cx))
                    else:
                        rows.append((n, "psm", b"".join((p, text[:x], s, text[y:], m, text[x:y])), cx, cy - cx))
                n, form, output, prefix, middle = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form), pa.array(output, pa.binary()).cast(pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())],
                    ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, form string, output string, prefix_chars long, middle_chars long")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made from: its parts hold no mark, so the marks cut it as they joined it."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2])) \
        .when(F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(F.col(output))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the SHA-256 of the output and of the text restored from it."""
    return transform(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                                  F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


FIM_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(u)::BIGINT AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
             array_to_string(list_slice(u, b + 1, n), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
              ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
