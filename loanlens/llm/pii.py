"""Format-preserving pseudonyms for personal data in texts.

Candidates are found by pattern and validated (card numbers by Luhn, IBANs by modulo 97,
social security numbers and telephone numbers by their ranges, network addresses by their parts,
dates by the calendar, with English month names too).  Where a run of characters is no valid value, its shorter readings are
tried, and the search goes on behind what was accepted.  The value, freed of separators, is permuted within its format by a
keyed Feistel network: alternate halves of a mixed-radix number are added up with a keyed
hash of the other half, and values outside the format are walked on until one is inside.
A permutation gives equal values equal pseudonyms in every document and different values
different ones; check digits are made anew, separators and letter case stay.  A day has one
pseudonym in all forms, its day of the month over 12 if that of the day is, so that each form reads as before.  Values of
credentials (``password=`` up to the closing quote or white space, bearer and web tokens, access
key ids, private key blocks) are permuted alike.

Defined results: a null text stays null and has no finds; a text without personal data is
returned unchanged; overlapping finds count once, the longer and then the earlier one.
Other columns pass through; ValueError if one is called like the column of finds.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loanlens.llm.text import cached, tidied

ROUNDS = 8
PIECE = 96  # half of it, 48 letters, is under the 256 bits of a round's hash
_YEARS = (1900, 2099)
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# English names of the months.
_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_MONTH = "(?i:" + "|".join(f"{m}|{m[:3]}\\.?" + ("|Sept\\.?" if m == "September" else "") for m in _MONTHS) + ")"
_NAMED = re.compile(rf"(?P<d>\d{{1,2}})(?P<o>(?i:st|nd|rd|th)?)(?P<s1> (?:of )?)(?P<m>{_MONTH})(?P<s2>,? )(?P<y>\d{{4}})$"
                    rf"|(?P<m2>{_MONTH})(?P<t1> )(?P<d2>\d{{1,2}})(?P<o2>(?i:st|nd|rd|th)?)(?P<t2>,? )(?P<y2>\d{{4}})$")
_PATTERNS = {
    "email": r"(?<![\w.%+-])\w[\w.%+'-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "iban": r"(?<!\w)(?:[A-Z]{2}|[a-z]{2})\d{2}(?:[ -]?[A-Z0-9]{4}){2,7}(?:[ -]?[A-Z0-9]{1,3})?(?!\w)"
            r"|(?<!\w)[a-z]{2}\d{2}(?:[ -]?[a-z0-9]{4}){2,7}(?:[ -]?[a-z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.-])\d(?:(?: ?\d){12,18}|(?:-?\d){12,18})",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w.])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
             r"|(?<![\w.])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)"
             r"|(?<![\w.,/=#-])[2-9]\d{2}[2-9]\d{6}(?![\w/-]|[.,]\d)",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)|(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)",
    "date": r"(?:(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4})"
            r"|(?:(?<![\w/.-])|(?<=\d\d/\d\d/\d{4}/)|(?<=\d{4}/\d\d/\d\d/))(?:\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}))"
            r"(?:(?=[Tt]\d{2})|(?![\w-]|\.\d))"
            rf"|(?<![\w.-])\d{{1,2}}(?i:st|nd|rd|th)? (?:of )?{_MONTH},? \d{{4}}(?![\w-])"
            rf"|(?<![\w.-]){_MONTH} \d{{1,2}}(?i:st|nd|rd|th)?,? \d{{4}}(?![\w-])",
    "secret": r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\\?[\"']?\s*[=:]\s*"
              r"(?:\\?\"((?:[^\"\\\n]|\\[^\"\n]){6,256})\\?\"|\\?'((?:[^'\\\n]|\\[^'\n]){6,256})\\?'|([^\s\"'\\<>]{5,256}[^\s\"'\\<>,;.:)\]}]))"
              r"|(?<!\w)((?:AKIA|ASIA)[A-Z0-9]{16})(?!\w)|(?<!\w)(gh[pousr]_[A-Za-z0-9]{20,255})(?!\w)|(?<!\w)(sk-[A-Za-z0-9]{20,255})(?!\w)"
              r"|(?i:authorization)\\?[\"']?\s*[:=]\s*\\?[\"']?(?i:bearer|basic|token)\s+([A-Za-z0-9._~+/=-]{6,2048})"
              r"|(?<!\w)(?i:bearer)\s+(?=[A-Za-z._~+/=-]{0,2048}\d)([A-Za-z0-9._~+/=-]{16,2048})"
              r"|(?<!\w)(eyJ[A-Za-z0-9_-]{6,2048}\.[A-Za-z0-9_-]{6,4096}\.[A-Za-z0-9_-]{6,2048})|(?<!\w)(xox[abeoprs]-[A-Za-z0-9-]{10,255})"
              r"|(?<!\w)(AIza[A-Za-z0-9_-]{35})(?!\w)|-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----((?:[^-]|-(?!----)){16,20000})-----END",
}
_COMPILED = {k: re.compile(p) for k, p in _PATTERNS.items()}
_DIGIT = re.compile(r"\d")
# Where a reading of a run may end: no part of a word follows, nor a hyphen that joins a card number to one.
_STOPS = {"card": re.compile(r"(?<=\d)(?!\w|-(?!\d))"), "iban": re.compile(r"(?<=\w)(?!\w)"), "phone": re.compile(r"(?<=[\d)])(?!\w)")}
# Length of an IBAN by its country.
_IBAN_LENGTH = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for c in codes.split()}


def feistel(key: bytes, tweak: str, value: int, left: int, right: int) -> int:
    """A keyed permutation of 0 .. left * right - 1."""
    a, b = divmod(value, right)
    for r in range(ROUNDS):
        h = hashlib.blake2b(f"{tweak}|{r}|{b if r % 2 == 0 else a}".encode(), key=key, digest_size=32)
        f = int.from_bytes(h.digest(), "big")
        if r % 2 == 0:
            a = (a + f) % left
        else:
            b = (b + f) % right
    return a * right + b


def _string(key: bytes, kind: str, text: str, valid: Callable[[str], bool] = lambda s: True) -> str:
    """Permute digits and letters of ``text`` among those of their class; other characters stay.

    Longer texts than PIECE are permuted piece by piece, each in its own way.
    """
    if len(text) > PIECE:
        return "".join(_string(key, f"{kind}#{i}", text[i:i + PIECE]) for i in range(0, len(text), PIECE))
    classes = [next((c for c in (_DIGITS, _LOWER, _UPPER) if ch in c), None) for ch in text]
    spots = [(i, c) for i, c in enumerate(classes) if c]
    half = len(spots) // 2
    left = right = 1
    for i, (_, c) in enumerate(spots):
        left, right = (left * len(c), right) if i < half else (left, right * len(c))
    tweak = kind + "|" + "".join("-" if c is None else c[0] for c in classes) + "|" + "".join(ch for ch, c in zip(text, classes) if not c)
    value = 0
    for i, c in spots:
        value = value * len(c) + c.index(text[i])
    while True:
        value = feistel(key, tweak, value, left, right)
        out, rest = list(text), value
        for i, c in reversed(spots):
            rest, d = divmod(rest, len(c))
            out[i] = c[d]
        got = "".join(out)
        if valid(got):
            return got


def _put(text: str, solid: str, is_value: Callable[[str], bool]) -> str:
    """``text`` with the characters of the value replaced by those of ``solid``."""
    chars = iter(solid)
    return "".join(next(chars) if is_value(c) else c for c in text)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _nanp(d: str) -> bool:
    return d[0] in "23456789" and d[3] in "23456789"


def _card(key: bytes, text: str) -> str | None:
    d = re.sub(r"\D", "", text)
    if len(d) < 13 or not luhn(d) or len(set(d)) == 1:
        return None
    body = d[0] + _string(key, "card", d[1:-1])
    return _put(text, body + next(c for c in _DIGITS if luhn(body + c)), str.isdigit)


def _iban(key: bytes, text: str) -> str | None:
    s = re.sub("[ -]", "", text).upper()
    if not 15 <= len(s) <= 34 or _mod97(s) != 1:
        return None
    if ("-" in text or text[:2].islower()) and _IBAN_LENGTH.get(s[:2]) != len(s):  # odd forms of known countries only
        return None
    body = _string(key, f"iban{s[:2]}", s[4:])
    new = _put(text, s[:2] + f"{98 - _mod97(s[:2] + '00' + body):02d}" + body, str.isalnum)
    return new.lower() if text[:2].islower() else new


def _phone(key: bytes, text: str) -> str | None:
    d = re.sub(r"\D", "", text)
    if len(d) == 10 and _nanp(d):
        return _put(text, _string(key, "phone1", d, _nanp), str.isdigit)
    if len(d) == 11 and d[0] == "1" and _nanp(d[1:]):  # linked with the number written without the 1
        return _put(text, "1" + _string(key, "phone1", d[1:], _nanp), str.isdigit)
    if text.startswith("+") and 8 <= len(d) <= 15:
        return _put(text, d[:2] + _string(key, f"phone{d[:2]}", d[2:]), str.isdigit)
    return None


def _ip6(key: bytes, text: str) -> str | None:
    """Addresses of three groups or more; a global one stays global, its groups are written as before, in full or not."""
    try:
        value = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    if sum(map(bool, text.split(":"))) < 3:
        return None
    top = value >> 125
    while True:
        value = feistel(key, "ip6", value, 1 << 64, 1 << 64)
        if value >> 125 == top:
            new = ipaddress.IPv6Address(value)
            return str(new) if "::" in text else ":".join(f"{int(g, 16):x}" for g in new.exploded.split(":"))


def _ip(key: bytes, text: str) -> str | None:
    if ":" in text:
        return _ip6(key, text)
    octets = [int(o) for o in text.split(".")]
    if max(octets) > 255 or any(len(o) > 1 and o[0] == "0" for o in text.split(".")):
        return None
    value = int.from_bytes(bytes(octets), "big")
    if not 1 <= octets[0] <= 223 or octets[0] == 127:
        return None
    while True:
        value = feistel(key, "ip", value, 1 << 16, 1 << 16)
        first = value >> 24
        if 1 <= first <= 223 and first != 127:
            return ".".join(str(b) for b in value.to_bytes(4, "big"))


def _day(y: int, m: int, d: int) -> datetime.date | None:
    try:
        return datetime.date(y, m, d) if _YEARS[0] <= y <= _YEARS[1] else None
    except ValueError:
        return None


@cached
@lru_cache(maxsize=1 << 17)
def _new_day(key: bytes, day: datetime.date) -> datetime.date:
    """The pseudonym of a day, the same for all its forms: days of the month up to 12 and over 12 are permuted apart."""
    low, per = (1, 12) if day.day <= 12 else (13, 19)
    value = ((day.year - _YEARS[0]) * 12 + day.month - 1) * per + day.day - low
    while True:
        value = feistel(key, f"date{low}", value, 240, per * 10)  # 2400 months
        month, d = divmod(value, per)
        new = _day(_YEARS[0] + month // 12, month % 12 + 1, d + low)
        if new:
            return new


def _ordinal(day: int, like: str) -> str:
    end = "th" if day in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")
    return "" if not like else end.upper() if like.isupper() else end


def _named_date(key: bytes, text: str) -> str | None:
    g = _NAMED.match(text)
    day, month, year = (int(g["d"] or g["d2"]), (g["m"] or g["m2"]), int(g["y"] or g["y2"]))
    value = _day(year, next(i for i, m in enumerate(_MONTHS, 1) if m[:3].lower() == month[:3].lower()), day)
    if value is None:
        return None
    new = _new_day(key, value)
    name = _MONTHS[new.month - 1]
    if month.rstrip(".").lower() not in (m.lower() for m in _MONTHS) or month.lower() == "may." or len(month.rstrip(".")) == 3 and month.lower() != "may":
        name = name[:3] + "." * month.endswith(".")
    name = name.upper() if month.isupper() else name.lower() if month.islower() else name
    first = f"{new.day:02d}" if (g["d"] or g["d2"])[0] == "0" else str(new.day)
    if g["d"]:
        return f"{first}{_ordinal(new.day, g['o'])}{g['s1']}{name}{g['s2']}{new.year}"
    return f"{name}{g['t1']}{first}{_ordinal(new.day, g['o2'])}{g['t2']}{new.year}"


def _date(key: bytes, text: str) -> str | None:
    """Year first, day first with stops, or with slashes month first; day first where that is the only reading; by name."""
    if not text.isascii():
        return None
    if any(c.isalpha() for c in text):
        return _named_date(key, text)
    sep = next(c for c in text if not c.isdigit())
    parts = text.split(sep)
    year_first = len(parts[0]) == 4
    y, m, d = map(int, parts if year_first else parts[::-1])
    month_first = sep == "/" and not year_first and not (d <= 31 and int(parts[0]) > 12)
    value = _day(y, d, m) if month_first else _day(y, m, d)
    if value is None:
        return None
    new = _new_day(key, value)
    order = ([new.year, new.month, new.day] if year_first else [new.month, new.day, new.year] if month_first else [new.day, new.month, new.year])
    padded = all(len(p) > 1 for p in parts)
    return sep.join(f"{n:02d}" if padded else str(n) for n in order)


def _email(key: bytes, text: str) -> str | None:
    """The name before the @ is permuted in lower case; upper case is put back by position."""
    name, host = text.rsplit("@", 1)
    new = _string(key, "email|" + host.lower(), "".join(c.lower() if c.isascii() else c for c in name))
    return "".join(n.upper() if o.isascii() and o.isupper() else n for n, o in zip(new, name)) + "@" + host


def _ssn_new(key: bytes, text: str) -> str | None:
    d = re.sub(r"\D", "", text)
    return _put(text, _string(key, "ssn", d, _ssn), str.isdigit) if _ssn(d) else None


def _secret(key: bytes, text: str) -> str | None:
    return _string(key, "secret", text)


_MAKERS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn_new, "phone": _phone, "ip": _ip,
           "date": _date, "secret": _secret}


def _ends(kind: str, text: str, start: int, end: int) -> Iterator[int]:
    """Where a value that starts the run may end: the longest reading first, an IBAN of a known country first at its length."""
    if kind not in _STOPS:
        yield end
        return
    ends = [e for e in range(end, start, -1) if _STOPS[kind].match(text, e)]
    length = _IBAN_LENGTH.get(text[start:start + 2].upper()) if kind == "iban" else None
    if length:
        yield from (e for e in ends if e - start - text.count(" ", start, e) - text.count("-", start, e) == length)
        ends = ends[:1]  # the whole run
    yield from ends


def _finds(kind: str, text: str, key: bytes) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the valid values of a kind, none of which overlap."""
    at = 0
    while m := _COMPILED[kind].search(text, at):
        start, end = m.span(m.lastindex or 0)
        at = m.start() + 1
        for e in _ends(kind, text, start, end):
            new = _MAKERS[kind](key, text[start:e])
            if new is not None:
                yield start, e, kind, new
                at = e
                break


def replace(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each find in it."""
    lower = None
    kinds = []
    digits = _DIGIT.search(text) is not None
    for kind in _COMPILED:
        if kind == "email":
            here = "@" in text
        elif kind == "secret":
            lower = text.lower() if lower is None else lower
            here = any(x in lower for x in ("passw", "pwd", "secret", "token", "key", "akia", "asia", "gh", "sk-", "bearer", "authorization", "eyj", "xox", "aiza"))
        elif kind == "ip":
            here = digits or "::" in text
        else:
            here = digits
        if here:
            kinds.append(kind)
    found = []
    for kind in kinds:
        found += _finds(kind, text, key)
    if not found:
        return text, []
    taken: list[tuple[int, int, str, str]] = []  # by place, none of them overlap
    for f in sorted(found, key=lambda f: (f[0] - f[1], f[0])):
        i = bisect_left(taken, f)
        if (i == 0 or taken[i - 1][1] <= f[0]) and (i == len(taken) or f[1] <= taken[i][0]):
            taken.insert(i, f)
    out, at, spans = [], 0, []
    for start, end, kind, new in taken:
        out += [text[at:start], new]
        at = end
        spans.append((kind, start, end))
    return "".join(out) + text[at:], spans


def pseudonymise(df: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = "pii") -> DataFrame:
    """``df`` with pseudonyms in ``text_col`` and, unless None, ``spans_col``: array of (kind, start, end).

    Network addresses, and dates whose parts are not padded or named, can change in length; spans are those of the text given.
    ``key`` is 1 to 64 bytes; whoever holds it can undo the permutation.
    """
    if not 1 <= len(key) <= 64:
        raise ValueError("the key has 1 to 64 bytes")
    fields = list(df.schema.fields)
    if spans_col:
        if spans_col.lower() in (c.lower() for c in df.columns):
            raise ValueError(f"column {spans_col} exists already")
        span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
        fields.append(T.StructField(spans_col, T.ArrayType(span), False))
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @tidied("pii")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for t in batch.column(text_col):
                new, found = (None, []) if not t.is_valid else replace(t.as_py(), key)
                texts.append(new)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            out = batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(texts, batch.column(text_col).type))
            if spans_col:
                out = pa.RecordBatch.from_arrays([*out.columns, pa.array(spans, arrow_span)], [*out.schema.names, spans_col])
            yield out

    return df.mapInArrow(run, T.StructType(fields))
