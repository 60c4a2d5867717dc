"""Corpus pipeline: language ID, near-duplicates, secrets, source mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import bpe, langid, mixing, secret_scan, simhash
from vaultline.llm.common import fresh, settled, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with some likeness to a learnt language; those without a letter, or wholly unlike every profile, go."""
    profiles = langid.learn_profiles(docs)
    found = fresh("_judged", docs.columns)
    judged = docs.withColumn(found, langid.judged(F.col("text"), profiles))
    return judged.where((F.col(f"{found}.lang_pred") != langid.UNKNOWN) & (F.col(f"{found}.score") > 0)).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights: documents as often as the mix takes them."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and the decoded text."""
    return bpe.encode_documents(docs)


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates), ("secret_scan", secrets),
          ("mixing", mixture), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(spark, partial(stage, spark, docs, sf_dir))
    return docs


# Hash-chosen shingles, a forest and a tokenizer are beyond SQL: tested by brute force.
ORACLE_SQL = None
