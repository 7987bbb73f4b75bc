"""Corpus pipeline: toxic documents out, one row of equal texts, one document of each near-duplicate group, benchmark passages out, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents, the last one the
documents' tokens. It works on all that the stage before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recollect.llm import bpe, decontaminate, exact_dedup, ngram_join, queries, toxicity
from recollect.runtime import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, queries.toxicity_model(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN, spaced=True, with_ids=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Trained classifiers and tokenization are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
