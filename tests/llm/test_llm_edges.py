"""Every operator and pipeline stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import datetime

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanlens.llm import (exact_dedup, jaccard_join, language_id, licences, packing, pii, sentencepiece_bpe, simhash,
                          substring_dedup, token_file)
from loanlens.llm.queries import vocabulary

LONG = "long words of a very long text " * 4000
ROWS = [(1, "the cat sat on the mat and the dog lay by the fire"), (2, "the cat sat on the mat and the dog lay by the fire"),
        (2, "the cat sat on the mat and the dog lay by the fire"), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, "x"),
        (None, "no id"), (None, None), (8, "été 日本 😀 ▁ \x00 end"), (6, LONG + "tail")]
CLASH = ["lang", "source", "n_chars", "n", "node", "check", "keys", "bucket", "chunk", "digest", "part", "k", "u", "v", "place", "__t"]

OPERATORS = {
    "sentencepiece": lambda d: sentencepiece_bpe.round_trip_digests(d, vocabulary("piece_bpe_32k.model")),
    "sentencepiece_columns": lambda d: sentencepiece_bpe.decode(
        sentencepiece_bpe.encode(d, vocabulary("piece_bpe_32k.model")), vocabulary("piece_bpe_32k.model")),
    "simhash": simhash.edited_likeness,
    "pii": lambda d: pii.pseudonymise(d, b"k"),
    "language_id": lambda d: language_id.predict(d, [("en", b"the cat and the dog"), ("fr", b"le chat et le chien")]),
    "jaccard_join": lambda d: jaccard_join.similar(d, 3, 90),
    "substring_dedup": substring_dedup.deduplicate,
    "licences": licences.scan,
    "token_file": lambda d: token_file.read(token_file.write(d, vocabulary("byte_bpe_50k.json"), 0)),
    "packing": lambda d: packing.pieces(d, vocabulary("word_bpe_49k.json"), 1),
    "sequences": lambda d: packing.sequences(d, vocabulary("word_bpe_49k.json"), 1),
    "exact_dedup": exact_dedup.dedup,
    "exact_kept": exact_dedup.kept,
}
ONE_ROW_EACH = set(OPERATORS) - {"packing", "sequences", "exact_kept"}


def frame(spark, rows, columns=CLASH):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    return df.select("*", *[F.lit("en" if c == "lang" else None).cast(kinds.get(c, "string")).alias(c) for c in columns])


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_takes_awkward_rows(spark, name):
    out = OPERATORS[name](frame(spark, ROWS)).collect()
    if name in ONE_ROW_EACH:
        assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator_takes_an_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).collect() == []


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_takes_awkward_and_empty_tables(spark, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    columns = ["lang", "source", "n_chars"]
    docs = frame(spark, ROWS, columns)
    out = function(spark, docs, "")
    rows = out.collect()
    assert len(rows) <= len(ROWS) or stage == "packing"
    if stage != "packing":
        assert out.columns == docs.columns
    assert function(spark, frame(spark, [], columns), "").collect() == []


def test_empty_tables_teach_no_language(spark):
    assert language_id.fit(frame(spark, [])) == [] == language_id.fit(frame(spark, ROWS).withColumn("lang", F.lit(None).cast("string")))
    got = language_id.predict(frame(spark, ROWS), []).collect()
    assert {(r.lang_pred, r.score, r.accepted) for r in got} == {("und", 0.0, False)}


@pytest.mark.parametrize("columns", [["lang", "source", "n_chars", "score", "accepted", "lang_pred"], ["lang", "source", "n_chars", "__language_0"]])
def test_language_stage_takes_clashing_columns(spark, columns):
    docs = frame(spark, ROWS, columns)
    out = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "")
    assert out.columns == docs.columns and out.count() <= len(ROWS)


def test_a_repeated_id_does_not_widen_the_sample(spark):
    """One doc_id 10,000 times with as many texts: one row of it is drawn, and a dictionary is all that is collected."""
    text = F.concat(F.lit("some words number "), F.col("id").cast("string"))
    many = spark.range(10_000).select(F.lit(5).cast("long").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    other = spark.range(3).select((F.col("id") + 10).alias("doc_id"), F.lit("quelques mots de plus").alias("text"), F.lit("fr").alias("lang"))
    model = dict(language_id.fit(many.unionByName(other)))
    assert len(model["en"]) <= len("some words number 9999") and model["fr"].count(b"quelques") == 3
    long = spark.range(200).select("id", F.repeat(F.lit("long words "), 9000).alias("text"), F.lit("en").alias("lang")).withColumnRenamed("id", "doc_id")
    assert len(language_id.fit(long, dict_bytes=1000)[0][1]) == 1000


@pytest.mark.parametrize("name, column", [("sentencepiece_columns", "ids"), ("pii", "pii"), ("language_id", "score"), ("licences", "licences")])
def test_output_columns_that_exist_are_refused(spark, name, column):
    with pytest.raises(ValueError):
        OPERATORS[name](frame(spark, ROWS, [column]))


def test_defined_results_of_empty_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert {r.n_shingles for r in jaccard_join.similar(docs).collect()} == {0}
    assert {(r.keep_id, r.group_size) for r in exact_dedup.dedup(docs).collect()} == {(3, 3)}  # the longest original text stays
    assert {r.fingerprint for r in simhash.edited_likeness(docs).collect()} == {"0" * 16}
    assert {(r.n_words, r.kept) for r in substring_dedup.deduplicate(docs).collect()} == {(0, "")}
    assert {(r.lang_pred, r.score, r.accepted) for r in language_id.predict(docs, [("en", b"the")]).collect()} == {("und", 0.0, False)}
    assert {(r.length, r.doc_tokens) for r in packing.pieces(docs, vocabulary("word_bpe_49k.json"), 1).collect()} == {(1, 1)}


def test_extra_columns_of_many_types_pass_through(spark):
    docs = spark.createDataFrame([(1, "call 386-555-3733", [1, 2], {"a": 1.5}, datetime.date(2024, 1, 2))],
                                 "doc_id long, text string, a array<int>, m map<string,double>, d date")
    for out in (pii.pseudonymise(docs, b"k"), language_id.predict(docs, [("en", b"call")]), licences.scan(docs)):
        row = out.collect()[0]
        assert (row.a, row.m, row.d) == ([1, 2], {"a": 1.5}, datetime.date(2024, 1, 2))
