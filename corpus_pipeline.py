"""The corpus pipeline: documents through five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import bpe, decontam, language, neardup, secret_spans
from tidewell.llm.queries import BYTE_BPE
from tidewell.session import materialize


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a determined language; fills missing languages."""
    return language.keep_identified(docs, language.fit(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    return secret_spans.redact(docs, secret_spans.fit(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text: (doc_id, n_tokens, ids)."""
    return bpe.encode(docs, BYTE_BPE).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("language_id", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", redact),
    ("bpe", tokenise),
]

# Learned models, hashing and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
