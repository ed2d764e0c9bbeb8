"""From raw documents to token ids: the training-data operators in a row.

Each stage works on all rows that the stage before it kept; its result is
written as Parquet and read again. All but the last stage return rows with the
columns of ``documents``. Not expressible in SQL as a whole (a language model, a
similarity search and a tokenizer): ``run`` is tested against a brute-force
version in tests/llm/.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.llm import exact, mixing, quality, simhash, spm
from churnlab.llm.common import table, written

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.quality_kept(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.exact_kept(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, at most two differing bits."""
    return simhash.near_kept(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources as often as the mixture shows them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return spm.encoded(docs).select(F.col("id").alias("doc_id"), "n_tokens", "ids", "round_trip", "parity")


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("sentencepiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
