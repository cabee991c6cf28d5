"""A corpus pipeline: documents to packed token sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns
what it keeps, with the columns of ``documents``, or for the last stage the packed pieces.
``run`` applies them in turn, each result written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import exact_dedup, jaccard_join, language_id, packing, pii
from loanlens.llm.queries import PII_KEY, vocabulary
from loanlens.llm.store import documents, for_documents, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; all labelled ones set the margins.

    They are compared in a pass of their own: a table of whole texts with their scores would lie on disk until the last stage.
    """
    for_documents(spark)
    labelled = docs.select("doc_id", "text", "lang")
    model = language_id.fit(labelled)
    return language_id.recognised(docs, model, language_id.calibrate(labelled, model))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that are equal but for white space."""
    for_documents(spark)
    return exact_dedup.kept(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each component of similar documents (five-word shingles, 0.8)."""
    for_documents(spark)
    return jaccard_join.kept(docs, k=5, percent=80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data; n_chars counts the new text."""
    for_documents(spark)
    out = pii.pseudonymise(docs, PII_KEY, spans_col=None)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the packed sequences."""
    for_documents(spark)
    return packing.pieces(docs, vocabulary("word_bpe_49k.json"), end_id=1)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("pii", pseudonyms), ("packing", pack)]
ORACLE_SQL = None  # compression, signature trees and Feistel permutations have no SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
