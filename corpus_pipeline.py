"""A training-data pipeline over ``documents``: identify the language, drop
near-duplicates, drop benchmark leaks, redact secrets, pack into sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; ``run`` writes each stage's result to the shared checkpoint folder and
reads it back as the next one's documents.  All but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import langid, packing, secret_scan, simhash, winnow
from eventide.llm.common import free_name, shared_path, small_batches
from eventide.llm.queries import tokenizer_json

# A document is rejected if its language cannot be told: no letter at all, or
# less than this share of what is usual in the best language (its coverage: the
# share of its training n-grams that the model keeps) is known in it.
MIN_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages that the corpus names."""
    small_batches(spark)
    model = langid.train(docs)
    lang, score, usual = (free_name(docs, c) for c in ("_language", "_language_score", "_language_coverage"))
    found = langid.identify(docs, model, lang_out=lang, score_out=score, coverage_out=usual)
    return found.filter((F.col(lang) != langid.UNDETERMINED) & (F.col(score) > 0)
                        & (F.col(score) >= MIN_LANGUAGE_SCORE * F.col(usual))).drop(lang, score, usual)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that holds ten consecutive words of a benchmark item."""
    small_batches(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return winnow.drop_contaminated(docs, items, span=10, gram=5)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays."""
    small_batches(spark)
    return secret_scan.redact(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece, with its ids."""
    small_batches(spark)
    # the other stages' Python workers are still there: a smaller word cache
    return packing.pack(docs, tokenizer_json(), capacity=2048, cache_words=150_000)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("redact_secrets", redact_secrets), ("pack", pack)]

# Majority-vote fingerprints, connected components and BPE packing have no
# DuckDB form; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = shared_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
