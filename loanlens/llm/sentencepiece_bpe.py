"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A slice of texts becomes its distinct words (a run of spaces with the characters
that follow it; no piece of such a model spans two words).  The words lie in one
flat symbol array.  Each round looks up the rank of every adjacent pair, takes the
smallest rank of each word (segmented minimum), merges the leftmost non-overlapping
pairs of that rank at once, and compacts the array; words without a pair leave it.
Texts are put together again by gathering the ids of their words.

Defined results: a null or empty text has only the begin and end ids and decodes to
the empty string; characters outside the vocabulary become byte pieces; U+2581 in a
text is a space, as in the library.  Other columns pass through untouched; an output
column that the input already has raises ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loanlens.llm.text import bytes_of, cached, filled, slices, tidied

_SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format


class PieceBpe:
    """The tables of one model: characters, mergeable pairs with ranks, surfaces."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            m.ParseFromString(f.read())
        spec = m.normalizer_spec
        kinds = [p.type for p in m.pieces]
        if (m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or spec.precompiled_charsmap
                or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or _USER in kinds or _UNUSED in kinds):
            raise ValueError("only byte-fallback BPE models with identity normalisation and a leading space are covered")
        pieces = [p.piece for p in m.pieces]
        if any(_SPACE in p.lstrip(_SPACE) for p, k in zip(pieces, kinds) if k == _NORMAL):
            raise ValueError("a piece of this model spans two words")
        self.bos, self.eos = pieces.index("<s>"), pieces.index("</s>")
        normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == _NORMAL}
        if any(c not in normal for p in normal for c in p):
            raise ValueError("a piece of this model has a character that is no piece")
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in normal.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.byte = np.zeros(256, np.int32)
        for i, k in enumerate(kinds):
            if k == _BYTE:
                self.byte[int(pieces[i][3:-1], 16)] = i
        score = np.array([p.score for p in m.pieces])
        rank = np.unique(-score, return_inverse=True)[1]  # equal scores share a rank: the leftmost goes first
        self.size = len(pieces)
        pairs, safe = [], np.ones(self.size, bool)
        for p, i in normal.items():
            for j in range(1, len(p)):
                a, b = normal.get(p[:j]), normal.get(p[j:])
                if a is not None and b is not None:
                    pairs.append((a * self.size + b, i))
                    for part, text in ((a, p[:j]), (b, p[j:])):
                        if len(text) > 1 and rank[i] <= rank[part]:
                            safe[part] = False  # merging it opens a better pair: one merge at a time
        pairs.sort()
        self.key, self.merged = np.array(pairs, np.int64).T.copy()
        self.merged = self.merged.astype(np.int32)
        self.rank, self.safe = rank.astype(np.int32), safe
        surface = [b"" if k == _CONTROL else " ⁇ ".encode() if k == _UNKNOWN
                   else bytes([int(p[3:-1], 16)]) if k == _BYTE else p.replace(_SPACE, " ").encode()
                   for p, k in zip(pieces, kinds)]
        self.is_byte, self.is_control = np.array(kinds) == _BYTE, np.array(kinds) == _CONTROL
        self.spaced = np.array([k == _NORMAL and p.startswith(_SPACE) for p, k in zip(pieces, kinds)])
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_at = np.concatenate(([0], np.cumsum([len(s) for s in surface])))

    # -- encoding

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair merges into, or -1."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.merged[at], -1)

    def _words(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word (its leading spaces as 0x20) and the offset of each word's ids."""
        head = np.flatnonzero((raw & 0xC0) != 0x80)
        width = np.diff(np.append(head, len(raw)))
        pad = np.concatenate((raw, np.zeros(4, np.uint8))).astype(np.int32)
        b0, b1, b2, b3 = (pad[head + j] for j in range(4))
        code = np.where(width == 1, b0, np.where(width == 2, (b0 & 31) << 6 | b1 & 63, np.where(
            width == 3, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63,
            (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63)))
        code[code == 32] = ord(_SPACE)
        known = self.char[code]
        word_of_char = np.searchsorted(off, head, side="right") - 1
        times = np.where(known >= 0, 1, width)  # an unknown character is its bytes, which never merge
        sym = np.repeat(known, times)
        word = np.repeat(word_of_char, times)
        if (known < 0).any():
            first = np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(head, times) + np.arange(len(sym)) - first
            sym = np.where(sym < 0, self.byte[raw[np.minimum(at, len(raw) - 1)]], sym)
        n = len(off) - 1
        done_word, done_sym = [], []
        while len(sym):
            new = np.full(len(sym), -1, np.int32)
            new[:-1] = np.where(word[1:] == word[:-1], self._lookup(sym[:-1], sym[1:]), -1)
            rank = np.where(new >= 0, self.rank[new], np.iinfo(np.int32).max)
            begin = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            count = np.diff(np.append(begin, len(sym)))
            least = np.minimum.reduceat(rank, begin)
            open_ = least < np.iinfo(np.int32).max
            if not open_.all():
                out = ~np.repeat(open_, count)
                done_word.append(word[out])
                done_sym.append(sym[out])
                sym, word, new, rank = sym[~out], word[~out], new[~out], rank[~out]
                least, count = least[open_], count[open_]
                if not len(sym):
                    break
            pick = np.flatnonzero(rank == np.repeat(least, count))
            run = np.concatenate(([True], pick[1:] != pick[:-1] + 1))
            place = np.arange(len(pick)) - np.repeat(np.flatnonzero(run), np.diff(np.append(np.flatnonzero(run), len(pick))))
            pick = pick[place % 2 == 0]
            unsafe = ~self.safe[new[pick]]
            if unsafe.any():  # of a word whose best merge opens a better one, only the leftmost
                first = np.concatenate(([True], word[pick][1:] != word[pick][:-1]))
                careful = np.zeros(n, bool)
                careful[word[pick[unsafe]]] = True
                pick = pick[first | ~careful[word[pick]]]
            sym[pick] = new[pick]
            keep = np.ones(len(sym), bool)
            keep[pick + 1] = False
            sym, word = sym[keep], word[keep]
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=n))))

    def encode(self, texts: pa.Array, ends: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offset of each text's ids; with ``ends``, between begin and end ids."""
        texts = pc.replace_substring(filled(texts), _SPACE, " ")
        raw, off = bytes_of(texts)
        size = np.diff(off)
        some = off[:-1][size > 0]
        shift = np.cumsum(size > 0)
        raw = np.insert(raw, some, 32)  # the leading space
        off = off + np.concatenate(([0], shift))
        space = raw == 32
        begin = np.zeros(len(raw), bool)
        begin[1:] = space[1:] & ~space[:-1]
        begin[off[:-1][size > 0]] = True
        at = np.flatnonzero(begin)
        flat = pa.Array.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(raw)])
        coded = flat.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own, start = self._words(*bytes_of(coded.dictionary)) if len(at) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        count = np.diff(start)[which]
        before = np.concatenate(([0], np.cumsum(count)))
        ids = own[np.repeat(start[which] - before[:-1], count) + np.arange(before[-1])]
        first = before[np.searchsorted(at, off)]
        if not ends:
            return ids, first
        n = len(off) - 1
        out_at = first + 2 * np.arange(n + 1)
        out = np.empty(out_at[-1], np.int32)
        spot = np.ones(len(out), bool)
        out[out_at[:-1]], out[out_at[1:] - 1] = self.bos, self.eos
        spot[out_at[:-1]] = spot[out_at[1:] - 1] = False
        out[spot] = ids
        return out, out_at

    # -- decoding

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each sequence of ids; bytes that form no character become U+FFFD each."""
        ids = np.asarray(ids, np.int64)
        width = np.diff(self.surface_at)[ids]
        before = np.concatenate(([0], np.cumsum(width)))
        raw = self.surface[np.repeat(self.surface_at[ids] - before[:-1], width) + np.arange(before[-1])]
        first_real = np.minimum.accumulate(np.where(self.is_control[ids], len(ids), np.arange(len(ids)))[::-1])[::-1]
        controls = np.concatenate(([0], np.cumsum(self.is_control[ids])))
        out, data, cut = [], raw.tobytes(), before[off]
        for i in range(len(off) - 1):
            lo, hi = cut[i], cut[i + 1]
            if off[i] < off[i + 1]:
                at = first_real[off[i]]
                if at < off[i + 1] and self.spaced[ids[at]]:
                    lo += 1  # the leading space that encoding put there
            text = data[lo:hi]
            try:
                text.decode()
                split = off[i] + 2 < off[i + 1] and controls[off[i + 1] - 1] - controls[off[i] + 1]
            except UnicodeDecodeError:
                split = True
            if split:  # a control id also ends a run of byte pieces
                text = self._mended(ids[off[i]:off[i + 1]])
            out.append(text)
        return out

    def _mended(self, ids: np.ndarray) -> bytes:
        """Decode ids whose byte pieces are not all valid UTF-8: each stray byte becomes U+FFFD."""
        parts, run, begun = [], bytearray(), False

        def flush():
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        parts.append(bytes(run[at:at + n]).decode().encode())
                        break
                    except UnicodeDecodeError:
                        n = 0
                parts.extend([] if n else ["�".encode()])
                at += n or 1
            run.clear()

        for i in ids:
            s = bytes(self.surface[self.surface_at[i]:self.surface_at[i + 1]])
            if self.is_byte[i]:
                run += s
                begun = True
                continue
            flush()
            parts.append(s[1:] if not begun and self.spaced[i] else s)
            begun = begun or not self.is_control[i]
        flush()
        return b"".join(parts)


@cached
@lru_cache(maxsize=2)
def model(model_file: str) -> PieceBpe:
    return PieceBpe(model_file)


def _added(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    clash = {f.name.lower() for f in fields} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    return T.StructType(df.schema.fields + fields)


def encode(df: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids", ends: bool = True) -> DataFrame:
    """Add ``ids_col`` (array of int), the ids of ``text_col``."""
    schema = _added(df, [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)])

    @tidied("sentencepiece")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(model_file)
        for batch in batches:
            for part in slices(batch, text_col):
                ids, off = bpe.encode(part.column(text_col), ends)
                col = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, col], [*part.schema.names, ids_col])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col`` (string), the text of the ids in ``ids_col``; null ids decode to the empty string."""
    schema = _added(df, [T.StructField(text_col, T.StringType(), False)])

    @tidied("sentencepiece")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(model_file)
        for batch in batches:
            lists = pc.fill_null(batch.column(ids_col), pa.scalar([], batch.column(ids_col).type))
            off = np.asarray(lists.offsets, np.int64)
            ids = lists.values.slice(off[0], off[-1] - off[0]).to_numpy(zero_copy_only=False)
            texts = bpe.decode(ids, off - off[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.decode() for t in texts], pa.string())],
                                             [*batch.schema.names, text_col])

    return df.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Encode and decode each text; only digests of both leave the task.

    Columns doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit), decoded_sha256 (UTF-8).
    """

    @tidied("sentencepiece")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(model_file)
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([batch.column("doc_id"), filled(batch.column("text"))], ["doc_id", "text"])
            for part in slices(whole, "text", 8 << 20):
                ids, off = bpe.encode(part.column("text"))
                raw = ids.astype("<u4").tobytes()
                texts = bpe.decode(ids, off)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(off), pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(off[:-1], off[1:])], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
