"""The registered queries of this subpackage: one per operator, over the whole documents table.

``QUERIES`` maps a name to (function of (spark, sf_dir), DuckDB SQL or None).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import (conversation_trie, exact_dedup, fill_middle, jaccard_join, language_id, licences, minhash, packing, pii,
                          sentencepiece_bpe, simhash, substring_dedup, token_file)
from loanlens.llm.store import documents

PII_KEY = b"a key for tests; production passes its own"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine of the cluster."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.round_trip_digests(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_likeness_and_neighbours(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_found"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learned = docs.select("doc_id", "text", F.when(~language_id.held_out(), F.col("lang")).alias("lang"))
    out = language_id.calibrated(learned, language_id.fit(learned), keep=["doc_id"])
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(documents(spark, sf_dir), k=3, percent=90)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.deduplicate(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licences.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                      F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.read(token_file.write(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=0))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=1)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), k=5, percent=85)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(documents(spark, sf_dir))


OP10_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents),
g AS (SELECT doc_id, k, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY k) AS group_size
      FROM t WINDOW w AS (PARTITION BY k ORDER BY length(raw) DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM g"""

QUERIES = {
    "op1_sentencepiece": (op1_sentencepiece, None),
    "op2_simhash": (op2_simhash, None),
    "op3_pii": (op3_pii, None),
    "op4_language_id": (op4_language_id, None),
    "op5_jaccard_join": (op5_jaccard_join, None),
    "op6_substring_dedup": (op6_substring_dedup, None),
    "op7_licences": (op7_licences, licences.scan_sql()),
    "op8_token_file": (op8_token_file, None),
    "op9_packing": (op9_packing, None),
    "op10_exact_dedup": (op10_exact_dedup, OP10_SQL),
    "op11_minhash": (op11_minhash, None),
    "op12_conversation_trie": (op12_conversation_trie, conversation_trie.TRIE_SQL),
    "op13_fill_middle": (op13_fill_middle, fill_middle.FIM_SQL),
}
