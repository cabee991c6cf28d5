"""Numpy helpers on the UTF-8 bytes of many texts at once.

A chunk of texts is one byte array with an offset per text, as Arrow holds it.
Words are runs of bytes outside 0x20 and 0x09-0x0D, so they never cross texts.
Word and shingle hashes are 64-bit and alike in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # texts handled at once in a task; a longer single text is handled alone
_TABLE = np.random.RandomState(20240607).randint(0, 2**32, (256, 2)).astype(np.uint64)
_BYTE = (_TABLE[:, 0] << np.uint64(32)) | _TABLE[:, 1]
_BASE = 0x9E3779B97F4A7C15  # odd, so powers have an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # gives freed memory back, where the C library can
_owner: list[str] = []
_caches: list[Callable[[], None]] = []


def cached(f):
    """Register an ``lru_cache`` function: it is cleared when the worker goes over to another operator."""
    _caches.append(f.cache_clear)
    return f


def rest() -> None:
    """Give memory that is free back to the machine, which the executor's other processes share."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidied(owner: str):
    """Wrap the function of a task.  Python workers serve one stage after another: what another operator
    kept goes when a task of ``owner`` starts, and free memory goes back when it ends."""

    def wrap(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if _owner != [owner]:
                for clear in [*_caches, _powers.clear]:
                    clear()
                _owner[:] = [owner]
            try:
                yield from run(batches)
            finally:
                rest()

        return task

    return wrap


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text (one row at least)."""
    off = offsets_of(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = min(end, n)


def offsets_of(arr: pa.Array) -> np.ndarray:
    size = 8 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else 4
    kind = np.int64 if size == 8 else np.int32
    if len(arr) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(arr.buffers()[1], kind, len(arr) + 1, arr.offset * size).astype(np.int64)


def bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets start at 0."""
    off = offsets_of(arr)
    data = arr.buffers()[2] if len(arr) else None
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def filled(arr: pa.Array) -> pa.Array:
    """Nulls as empty strings."""
    if not arr.null_count:
        return arr
    import pyarrow.compute as pc

    return pc.fill_null(arr, "")


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of the first word of each text (one more at the end)."""
    word = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    edge_before = np.concatenate(([True], ~word[:-1])) | first[:-1] if len(raw) else np.zeros(0, bool)
    edge_after = np.concatenate((~word[1:], [True])) | first[1:] if len(raw) else np.zeros(0, bool)
    starts, ends = np.flatnonzero(word & edge_before), np.flatnonzero(word & edge_after) + 1
    return starts, ends, np.searchsorted(starts, off)


def _power(n: int, base: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, SLICE_BYTES + 1), np.uint64)
        have[1:] = np.uint64(base)
        have = np.multiply.accumulate(have)
        if n <= SLICE_BYTES + 1:
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a fixed bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, scrambled with its length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _power(len(raw), _BASE)[:len(raw)], out=total[1:])
    own = (total[ends] - total[starts]) * _power(len(raw), _INVERSE)[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(words: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
    """Hash of the ``k`` consecutive words from each position in ``at``."""
    out = np.full(len(at), k, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + words[at + j])
    return out


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each text, sorted, and the offset of each text's set.

    A text of fewer than ``k`` words has its whole sequence as the one shingle; without words, none.
    """
    n = np.diff(first)
    per = np.where(n >= k, n - k + 1, 0)
    base = np.repeat(first[:-1], per)
    rank = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    doc = np.repeat(np.arange(len(n)), per)
    own = run_hashes(words, k, base + rank)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([run_hashes(words, int(n[i]), first[i:i + 1])[0] for i in short], np.uint64)
        doc, own = np.concatenate((doc, short)), np.concatenate((own, whole))
    order = np.lexsort((own, doc))
    doc, own = doc[order], own[order]
    keep = np.ones(len(own), bool)
    keep[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
    doc, own = doc[keep], own[keep]
    return own, np.searchsorted(doc, np.arange(len(n) + 1))
