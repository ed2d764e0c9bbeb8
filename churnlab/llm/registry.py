"""Queries of the training-data operators over the test tables.

Each applies one operator, with its production parameters, to its whole table
and names the columns as its contract does.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm import alignment, exact, html, lm, mixing, negatives, packing, quality, secrets, simhash, sketch, spm, warc
from churnlab.llm.common import table
from churnlab.llm.oracle import ORACLE  # noqa: F401  (read by the driver's entry)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scanned(docs, secrets.learn_formats(docs))
    return found.select(F.col("id").alias("doc_id"), *secrets.digest_columns())


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spm.encoded(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "round_trip", "parity")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_pairs(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select(F.col("id").alias("doc_id"), "lang", "n_tokens", "perplexity", "threshold", "kept")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_decisions(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.aligned(table(spark, sf_dir, "documents"), *paths).withColumnRenamed("id", "doc_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 50 == 0)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_simhash_near_dedup,
        op3_secret_scans,
        op4_sentencepiece,
        op5_fingerprints,
        op6_quality_classifier,
        op7_exact_dedup,
        op8_warc,
        op9_html_extraction,
        op10_lm_scoring,
        op11_alignment,
        op12_hard_negatives,
        op13_packing,
    )
}
