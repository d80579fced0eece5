"""The corpus pipeline: language ID, exact and near deduplication, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with all columns of
``docs``; the last one returns the encoded documents. A stage reads only what the one before it
kept. ``run`` writes what passes between stages to the shared folder, so a stage that scans its
input more than once, or loses an executor, does not repeat the earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, exact_dedup, language_id, mixing, simhash
from plumbline.llm.common import settle
from plumbline.llm.queries import pattern, vocabulary


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language, ``lang`` as predicted; those without letters or in none of the languages go."""
    model = language_id.fit(docs.filter(language_id.learned_rows(F.col("doc_id"))))
    return language_id.keep_learned(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A to Z, the one with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash fingerprints of four-word shingles, 4 or fewer differing bits, the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents beyond a source's budget go, others repeat."""
    return mixing.sample_text(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (little-endian unsigned 32-bit), ids_sha256, decoded_sha256."""
    rows = byte_bpe.round_trip(docs, vocabulary("byte_bpe_50k.tiktoken"), pattern())
    return rows.select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"), "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identified), ("exact_dedup", without_copies), ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed), ("byte_bpe", encoded)]

ORACLE_SQL = None  # language models, fingerprints and merges are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
