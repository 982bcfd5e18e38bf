"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing, tokens.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns
a DataFrame that is written as Parquet and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm import bpe, exact_dedup, mixing, toxicity, weighted_minhash
from loadcast.llm.frames import read, stage
from loadcast.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one document stays."""
    return weighted_minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; a document taken for a second epoch is there twice."""
    return mixing.mix(docs).drop("epoch")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of ids and decoded text."""
    return bpe.encode_with_digests(docs, TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("near dedup", drop_near_copies),
          ("mixing", mix_sources), ("tokens", encode_tokens)]

# Scores, band hashes and BPE merges have no SQL form: the stages are tested against
# brute-force versions on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
