"""Ids of whole texts by a vocabulary file of the tokenizers library, word by word.

Byte-level and word-end BPE never join what a space separates, nor a letter and the
stop or comma after it.  So a text is cut there, each distinct piece of a slice is
encoded once by the library, and the texts are gathered from the pieces' ids.  ``keeps_space`` says that the space belongs
to the piece after it (byte-level BPE); texts in which a space meets other white space
or an end are then encoded whole, as a run of white space is one unit there.  A text that
holds an added token of the vocabulary goes to the library whole and as it stands, which
gives that token its own id, as the library does by default.
Null texts count as empty and have no ids.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loanlens.llm.text import bytes_of, cached, filled, lower_ascii

_WHITE = r"\x00-\x20\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}"
_UNSAFE = f"(^|[{_WHITE}]) | ([{_WHITE}]|$)"
_LETTERS = re.compile("[ ]?[a-zß-öø-ÿA-Z]+")  # one unit for the library's split; NFC leaves it as it is
_PLAIN = re.compile("[ ]?[!-~À-ɏ]+")  # pieces that can be encoded many in one call
CACHE_PIECES = 500_000  # pieces remembered by a Python worker between slices; beyond it, the rarer ones go
_JOINED = 1000  # pieces in one call
SLICE = 8 << 20  # bytes of text encoded at once: what a Python worker holds beside its batch is some times as much
# classes of bytes, as bits: ASCII letter, full stop or comma, space, newline, visible ASCII
_A, _STOP, _BLANK, _LINE, _SEEN = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] |= _SEEN
_CLASS[65:91] |= _A
_CLASS[97:123] |= _A
_CLASS[[44, 46]] |= _STOP
_CLASS[32] |= _BLANK
_CLASS[10] |= _LINE


class WordEncoder:
    def __init__(self, file: str, added: bool = False):
        """``added``: the vocabulary's added tokens are known in texts; otherwise their characters are plain text."""
        # tasks are the parallel units; the library's own threads would each keep memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.keeps_space = "ByteLevel" in str(self.tokenizer.pre_tokenizer) and "Split" not in str(self.tokenizer.pre_tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self._set_letters()
        self.separator = "\n" if self.keeps_space else " \x00 "
        alone = self.tokenizer.encode(self.separator.strip(" "), add_special_tokens=False).ids
        self.separator_id = alone[0] if len(alone) == 1 else None
        self._reset()

    def _set_letters(self) -> None:
        """The model alone, without the library's normalisation and split, for words of letters only.

        Such a word is one unit there, so it is handed over as the model sees it: bytes as the
        printable characters of byte-level vocabularies, its space in front or its end mark behind.
        """
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        size = self.tokenizer.get_vocab_size()
        vocab = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        if self.keeps_space:
            self.mark = np.array([v.startswith("Ġ") for v in vocab])
        else:
            self.mark = np.array([v.endswith("</w>") for v in vocab])
        self.letters = Tokenizer(self.tokenizer.model) if self.mark.any() else None
        if self.letters is not None:
            self.letters.pre_tokenizer = CharDelimiterSplit(" ")
            split = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.printable = {ord(c): split(c)[0][0] for c in "".join(map(chr, range(0xDF, 0x100)))}

    def _letter_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_ids`` for words of letters (with their space where the vocabulary keeps it)."""
        front = "Ġ" if self.keeps_space else ""
        words = [front + w if w.isascii() else front + w.translate(self.printable) for w in (p.lstrip(" ") for p in pieces)]
        calls = [" ".join(words[i:i + _JOINED]) for i in range(0, len(words), _JOINED)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.letters.encode_batch_fast(calls, add_special_tokens=False)])
        marks = np.flatnonzero(self.mark[ids])
        assert len(marks) == len(pieces)
        return ids, np.diff(np.append(marks, len(ids))) if self.keeps_space else np.diff(marks, prepend=-1)

    def _reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)  # of the known pieces, then of those of this slice
        self.end = 0  # of the known pieces' ids
        self.start, self.count, self.uses = (np.zeros(CACHE_PIECES + 2, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep the pieces used most, as many as leave half of the room free."""
        uses = self.uses[:len(self.known)]
        least = 2
        while (uses > least).sum() > CACHE_PIECES // 2:
            least *= 2
        kept = [(p, i) for p, i in self.known.items() if uses[i] > least]
        ids, start, count = self.ids, self.start, self.count
        self._reset()
        spots = np.array([i for _, i in kept], np.int64)
        size = count[spots]
        end = np.cumsum(size)
        self.end = int(size.sum())
        self.ids = np.zeros(max(1 << 20, 2 * self.end), np.uint32)
        self.ids[:self.end] = ids[np.repeat(start[spots] - end + size, size) + np.arange(self.end)]
        self.start[:len(kept)], self.count[:len(kept)], self.uses[:len(kept)] = end - size, size, uses[spots] // 2
        self.known = {p: j for j, (p, _) in enumerate(kept)}

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        got = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
        return np.array([i for e in got for i in e.ids], np.uint32), np.array([len(e.ids) for e in got], np.int64)

    def _joined_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_ids`` for plain pieces: many in one call, parted by an id that none of them has."""
        calls = [self.separator.join(pieces[i:i + _JOINED]) + self.separator for i in range(0, len(pieces), _JOINED)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(calls, add_special_tokens=False)])
        ends = np.flatnonzero(ids == self.separator_id)
        assert len(ends) == len(pieces)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _learn(self, pieces: list[bytes], keep: int) -> None:
        """Encode ``pieces``; the first ``keep`` become known, the others are there for this slice."""
        texts = [p.decode() for p in pieces]
        space, letters = self.keeps_space, self.letters is not None

        def how(t: str) -> int:
            if letters and (not space or t[0] == " "):
                word = t[1:] if t[0] == " " else t
                if word.isalpha() if word.isascii() else _LETTERS.fullmatch(t):
                    return 0
            return 1 if self.separator_id is not None and _PLAIN.fullmatch(t) else 2

        kinds = np.fromiter(map(how, texts), np.int64, len(texts))
        n, end = len(self.known), self.end
        while n + len(texts) > len(self.start):
            self.start, self.count, self.uses = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.count, self.uses))
        known_end = end
        for part in (slice(0, keep), slice(keep, None)):  # the ids of known pieces lie before the others
            for kind, encode in enumerate((self._letter_ids, self._joined_ids, self._ids)):
                some = np.flatnonzero(kinds[part] == kind) + (part.start or 0)
                if not len(some):
                    continue
                ids, sizes = encode([texts[i] for i in some])
                while len(self.ids) < end + len(ids):
                    self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
                self.ids[end:end + len(ids)] = ids
                self.start[n + some] = end + np.cumsum(sizes) - sizes
                self.count[n + some] = sizes
                end += len(ids)
            if part.start == 0:
                known_end = end
        self.end = known_end
        self.uses[n:n + len(texts)] = 0
        self.known.update(zip(pieces[:keep], range(n, n + keep)))

    def _holders(self, texts: pa.Array) -> np.ndarray:
        """Indexes of the texts that hold an added token."""
        if not self.added:
            return np.zeros(0, np.int64)
        blob = bytes_of(texts)[0].tobytes()
        here = [t for t in self.added if t.encode() in blob]
        hold = np.zeros(len(texts), bool)
        for t in here:
            hold |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False).astype(bool)
        return np.flatnonzero(hold)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32-bit) of all texts, and the offset of each text's ids."""
        texts = filled(texts)
        some = self._holders(texts)
        if not len(some):
            return self._by_piece(texts)
        hold = np.zeros(len(texts), bool)
        hold[some] = True
        ids, off = self._by_piece(pc.if_else(pa.array(hold), pa.scalar("", texts.type), texts))
        self.tokenizer.encode_special_tokens = False
        try:
            own, sizes = self._ids(texts.take(pa.array(some)).to_pylist())
        finally:
            self.tokenizer.encode_special_tokens = True
        count = np.diff(off)
        count[some] = sizes
        return np.insert(ids, np.repeat(off[some], sizes), own), np.concatenate(([0], np.cumsum(count)))

    def _by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode`` for texts without nulls that hold no added token."""
        raw, off = bytes_of(texts)
        if not self.keeps_space:  # this vocabulary is for lower case
            raw = lower_ascii(raw)
        n = len(off) - 1
        whole = np.zeros(n, bool)
        if self.keeps_space:
            whole = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False).astype(bool)
        kind = _CLASS[raw]
        before, here = kind[:-1], kind[1:]
        newline = (here & _LINE != 0) & (before & _SEEN != 0)
        cut = kind & _BLANK != 0
        cut[1:] |= ((here & _STOP != 0) & (before & _A != 0)) | newline
        cut[2:] |= newline[:-1] & (here[1:] & _SEEN != 0)
        if whole.any():
            cut &= ~np.repeat(whole, np.diff(off))
        cut[off[:-1][np.diff(off) > 0]] = True
        at = np.flatnonzero(cut)
        if len(self.known) > CACHE_PIECES:
            self._forget()
        flat = pa.Array.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = flat.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy(zero_copy_only=False)
        times = np.bincount(index, minlength=len(pieces))
        code = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(code < 0)
        again = times[new] > 1  # pieces that occur once are not worth remembering
        new = np.concatenate((new[again], new[~again]))
        if len(new):
            code[new] = len(self.known) + np.arange(len(new))
            self._learn([pieces[i] for i in new], int(again.sum()))
        self.uses[code] += times
        which = code[index]
        count = self.count[which]
        before = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(self.start[which] - before[:-1], count) + np.arange(before[-1])]
        pa.default_memory_pool().release_unused()
        return ids, before[np.searchsorted(at, off)]


@cached
@lru_cache(maxsize=2)
def encoder(file: str) -> WordEncoder:
    return WordEncoder(file, added=True)


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each sequence."""
    new = off + np.arange(len(off))
    out = np.empty(new[-1], ids.dtype)
    spot = np.ones(len(out), bool)
    out[new[1:] - 1] = end_id
    spot[new[1:] - 1] = False
    out[spot] = ids
    return out, new
