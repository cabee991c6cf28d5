"""Language of a text by compression with per-language zstandard dictionaries.

A raw-content dictionary per language is made from a bounded sample of labelled texts.
A whole text, its letters in lower case, is compressed with each dictionary in blocks of
``BLOCK`` characters; the language with the smallest total wins.  ``score`` is the share by
which the runner-up is larger.  ``calibrate`` sets the share that a text of a length has to
show from all labelled texts outside the dictionaries.  Sizes are whole bytes, so texts under the
least of ``LENGTHS`` often tie; a tied one is accepted if half of its three-letter runs lie in
a dictionary.  Longer ties are rejected.
Without it, a text of ``min_letters`` or more whose share is under ``min_margin`` is rejected.

Defined results: null texts and texts without a letter are ``und`` with score 0 and not
accepted; equal sizes go to the language with more labelled rows, then by name.  With a
single learned language the score is 1; with none, as from an empty table, every text is ``und``.  Other
columns pass through; ``predict`` raises ValueError if they hold one of its output columns,
which can be named otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.store import written
from loanlens.llm.text import cached, tidied

BLOCK = 4096  # characters compressed at once
LEVEL = 6
SAMPLE_ROWS = 150  # labelled rows drawn per language for its dictionary, which holds some 30 texts
DICT_BYTES = 64 << 10  # size of a dictionary at most
MAX_LANGUAGES = 1000
MIN_MARGIN = 0.002
MIN_LETTERS = 200
LENGTHS = (40, 80, 160, 320, 640, 1280)  # least letters and spaces of the classes that have a margin of their own
QUANTILE, SHARE = 0.05, 0.5  # a margin is this share of this quantile of the correct texts' scores
STEPS = 1 << 16  # scores are counted in steps of this part of 1
LEAST_TEXTS = 20  # correct texts of a language and class at least, to count for a margin
_LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(r"[\W\d_]+")


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary) from rows (doc_id, text, lang), languages with most rows first.

    Per language ``sample_rows`` distinct doc_ids at most are drawn by a hash, those of texts of common
    length first, one row of each; their texts, cut to what the dictionary can still take, are joined
    up to ``dict_bytes`` before they reach the driver.
    """
    rows = labelled.where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    first = F.min(F.struct((~F.length("text").between(300, 8000)).alias("odd"), F.xxhash64("text").alias("hash"))).alias("t")
    slim = rows.groupBy("doc_id", "lang").agg(first).select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"), "t.odd", F.col("t.hash").alias("__text"))
    rank = F.row_number().over(Window.partitionBy("__lang").orderBy("odd", F.xxhash64("__id"), "__id"))
    drawn = slim.withColumn("__rank", rank).where(F.col("__rank") <= sample_rows)  # and MAX_LANGUAGES at most
    same = rows["doc_id"].eqNullSafe(F.col("__id")) & (rows["lang"] == F.col("__lang")) & (F.xxhash64(rows["text"]) == F.col("__text"))
    room = 2 * dict_bytes  # characters; what is no letter goes
    sample = rows.join(F.broadcast(drawn), same).select("lang", "__rank", F.substring("text", 1, dict_bytes).alias("text")).dropDuplicates(["lang", "__rank"])
    before = Window.partitionBy("lang").orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1)  # sample_rows at most
    sample = sample.withColumn("__room", room - F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))).where("__room > 0")
    texts = sample.select("lang", "__rank", F.expr("substring(text, 1, int(__room))").alias("text")) \
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("__rank", "text"))).alias("t")).select("lang", "t.text").collect()
    found = {r["lang"]: b" ".join(_plain(t).encode() for t in r["text"])[:dict_bytes] for r in texts}
    return [(lang, found.get(lang) or b" ") for lang in sorted(counts, key=lambda x: (-counts[x], x))]


def _plain(text: str) -> str:
    return _OTHER.sub(" ", text.lower())


@cached
@lru_cache(maxsize=2)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in model:
        d = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)))
    return out


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float, int]:
    """(language, score, letters and spaces looked at) of one whole text."""
    if not model or not text or not _LETTER.search(text):
        return "und", 0.0, 0
    text = _plain(text)
    blocks = [text[i:i + BLOCK].encode() for i in range(0, len(text), BLOCK)]
    sizes = [(sum(len(c.compress(b)) for b in blocks), i, lang) for i, (lang, c) in enumerate(_compressors(model))]
    if len(sizes) == 1:
        return sizes[0][2], 1.0, len(text)
    best, second = sorted(sizes)[:2]
    return best[2], (second[0] - best[0]) / second[0], len(text)


def scored(docs: DataFrame, model: list[tuple[str, bytes]], names: tuple[str, str, str, str, str], label: str | None = None) -> DataFrame:
    """Add to ``docs``, named as ``names`` says, the language, score and letters of ``classify``, whether a short
    tie is familiar, and the marks of a row with a ``label``: its scores as it is cut to the least length of each class (whole
    in the last), null where that is not reached or the language found is another.  A text in a dictionary has no marks.
    """
    kinds = (T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.ArrayType(T.DoubleType()))
    fields = [T.StructField(n, k, n == names[4]) for n, k in zip(names, kinds)]
    clash = {f.name.lower() for f in fields} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    frozen = tuple((lang, bytes(d)) for lang, d in model)  # at most MAX_LANGUAGES x DICT_BYTES

    def marks(text: str, lang: str, whole: tuple[str, float, int]) -> list[float | None] | None:
        plain = _plain(text)
        if any(plain[:LENGTHS[0]].encode() in d for _, d in frozen):
            return None
        out = []
        for least in LENGTHS:
            found = ("und", 0.0) if len(plain) < least else whole if least == LENGTHS[-1] else classify(plain[:least], frozen)
            out.append(found[1] if found[0] == lang else None)
        return out

    @tidied("language")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            labels = batch.column(label).to_pylist() if label else [None] * len(texts)
            got = [classify(t, frozen) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.int32()),
                 pa.array([g[0] != "und" and g[1] == 0 and g[2] < LENGTHS[0] and _familiar(t, frozen) for t, g in zip(texts, got)], pa.bool_()),
                 pa.array([None if x is None or t is None else marks(t, x, g) for t, x, g in zip(texts, labels, got)], pa.list_(pa.float64()))],
                [*batch.schema.names, *names])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + fields))


def margins_of(rows: DataFrame) -> list[tuple[int, float]]:
    """(least letters, margin) by class of length, from rows (lang, marks), all of them.

    The margin is half of the 5 % quantile of the scores of correctly named texts, in the language where
    that is smallest: fewer than 5 % of the clean texts of any language can be under it.  A class
    without enough texts has ``MIN_MARGIN``.  Scores are counted in steps of 1 / ``STEPS``, so a language and
    class has that many counts at most; only the quantiles reach the driver.
    """
    each = rows.where("marks is not null").select("lang", F.posexplode("marks").alias("class", "score")).where("score is not null")
    counts = each.groupBy("class", "lang", (F.floor(F.col("score") * STEPS) / STEPS).alias("score")).agg(F.count(F.lit(1)).alias("n"))
    found = (counts.groupBy("class", "lang").agg(F.percentile("score", F.lit(QUANTILE), F.col("n")).alias("low"), F.sum("n").alias("n"))
             .where(F.col("n") >= LEAST_TEXTS).groupBy("class").agg(F.min("low").alias("low")).collect())
    low = {LENGTHS[r["class"]]: r["low"] for r in found}
    return [(least, max(MIN_MARGIN, SHARE * low.get(least, 0.0))) for least in LENGTHS]


def calibrate(labelled: DataFrame, model: list[tuple[str, bytes]]) -> list[tuple[int, float]]:
    """The margins that every row (text, lang) sets that has both; see ``margins_of``."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    return margins_of(scored(rows, model, ("name", "score", "letters", "familiar", "marks"), "lang").select("lang", "marks"))


def _familiar(text: str, model: tuple[tuple[str, bytes], ...]) -> bool:
    """Whether a dictionary has half of the three-letter runs (with the blanks at the ends) of a short text."""
    plain = f" {_plain(text).strip()} "
    runs = [plain[i:i + 3].encode() for i in range(len(plain) - 2)]
    return any(2 * sum(r in d for r in runs) >= len(runs) for _, d in model)


def accepts(text: str | None, result: tuple[str, float, int], model: tuple[tuple[str, bytes], ...], margins: list[tuple[int, float]]) -> bool:
    """Whether a result of ``classify`` shows the margin of its length; ``und`` and longer ties never do."""
    lang, score, letters = result
    if lang == "und":
        return False
    if score == 0:
        return letters < LENGTHS[0] and _familiar(text, model)
    return score >= max(((n, m) for n, m in margins if n <= letters), default=(0, 0.0))[1]


def predict(docs: DataFrame, model: list[tuple[str, bytes]], min_margin: float = MIN_MARGIN,
            min_letters: int = MIN_LETTERS, margins: list[tuple[int, float]] | None = None,
            names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """Add lang_pred, score and accepted (or as ``names`` says) to ``docs``; only ``text`` is looked at.  ``margins`` are those of ``calibrate``."""
    fields = [T.StructField(n, k, False) for n, k in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()))]
    clash = {f.name.lower() for f in fields} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    frozen = tuple((lang, bytes(d)) for lang, d in model)  # at most MAX_LANGUAGES x DICT_BYTES

    @tidied("language")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = [classify(t, frozen) for t in texts]
            lang, score = [g[0] for g in got], [g[1] for g in got]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array([x != "und" and (s >= min_margin or n < min_letters) if margins is None else accepts(t, (x, s, n), frozen, margins)
                           for t, (x, s, n) in zip(texts, got)], pa.bool_())],
                [*batch.schema.names, *names])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + fields))


def calibrated(docs: DataFrame, model: list[tuple[str, bytes]], names: tuple[str, str, str] = ("lang_pred", "score", "accepted"),
               label: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``predict`` with the margins that all rows of ``docs`` with a ``label`` set, as those of ``calibrate``.

    Every text is compared once: the scores and the columns ``keep`` (or all) are written, the margins come from what is written.
    """
    keep = docs.columns if keep is None else keep
    letters, familiar, marks = (f"__{x}" + "_" * max([0, *map(len, [*docs.columns, *names])]) for x in ("letters", "familiar", "marks"))
    each = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, label, names[0], names[1], letters, familiar, marks])]
    table = written(scored(docs, model, (*names[:2], letters, familiar, marks), label).select(*each), "language")
    margin = F.lit(0.0)
    for least, m in margins_of(table.select(F.col(f"`{label}`").alias("lang"), F.col(marks).alias("marks"))):
        margin = F.when(F.col(letters) >= least, m).otherwise(margin)
    score = F.col(f"`{names[1]}`")
    accepted = (F.col(f"`{names[0]}`") != "und") & F.when(score == 0, F.col(familiar)).otherwise(score >= margin)
    return table.select(*[F.col(f"`{c}`") for c in [*keep, *names[:2]]], accepted.alias(names[2]))


def recognised(docs: DataFrame, model: list[tuple[str, bytes]], margins: list[tuple[int, float]] | None = None) -> DataFrame:
    """The documents whose language is accepted, with the columns they have, whatever these are called."""
    names = tuple(f"__language_{i}" + "_" * max([0, *map(len, docs.columns)]) for i in range(3))
    out = predict(docs, model, margins=margins, names=names)
    return out.where(F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])


def held_out() -> Column:
    """Documents never learned from: crc32 of doc_id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
