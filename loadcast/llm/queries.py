"""Registered queries of the operators: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat_format, collision_ann, exact_dedup, host_reputation, language_id, license_scan,
               merkle_manifest, mixing, packing, spelling_groups, toxicity, weighted_minhash)
from .frames import read
from .manifest_sql import OP13_SQL

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

OP1_SQL = """
SELECT doc_id, MAX(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
       doc_id = MAX(doc_id) OVER same AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY sha256(COALESCE(text, '')))"""


def op1_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; text models trained on labelled documents."""
    return language_id.identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"))


def op3_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"), TOKENIZER)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-1) whose texts are control strings."""
    marks = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(marks).alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.conversation_digests(rows.unionByName(extra))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of a document that the mixture takes."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "epoch", mixing.domain_of(F.col("source")).alias("domain"),
                        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                        mixing.token_count(F.col("text")).alias("n_tokens"))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    outcomes = host_reputation.outcomes_from_labels(pages, read(spark, sf_dir, "labels"))
    return host_reputation.judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op7_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document; class_id is the doc_id of the document that stays."""
    return weighted_minhash.near_classes(read(spark, sf_dir, "documents")).withColumn("class_id", F.col("keep_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


def op11_instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), TOKENIZER).drop("loss_from", "ids")


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verify(merkle_manifest.build_manifest(read(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_cuckoo_dedup, op2_language_id, op3_streaming_bpe, op4_chat_format, op5_mixture,
                                    op6_host_reputation, op7_collision_ann, op8_weighted_minhash, op9_toxicity,
                                    op10_license_scan, op11_instruction_packing, op12_spelling_groups,
                                    op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op1_cuckoo_dedup": OP1_SQL, "op5_mixture": mixing.oracle(),
            "op6_host_reputation": host_reputation.oracle(), "op13_merkle_manifest": OP13_SQL}
