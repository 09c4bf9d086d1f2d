"""A corpus from raw documents to packed sequences: each stage is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retrospect.llm import exact_dedup, language, packing, secrets, simhash
from retrospect.llm.common import documents, materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null or without a letter) go."""
    return language.keep_identified(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest doc_id stays, once even if it is repeated; texts without any doc_id have one row too."""
    return exact_dedup.keep_last(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of the least doc_id stays."""
    return simhash.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to [SECRET]; every document stays."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

#: Language models, Hamming links and tokens are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
