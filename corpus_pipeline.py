"""Corpus pipeline: raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomrate.llm import exact_dedup, mix, ngram_join, packing, toxicity
from roomrate.llm.common import written


def _clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_copies(docs)


#: Near copies share shingles of so many words with at least so many hundredths of Jaccard similarity.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.representatives(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for."""
    return mix.mixed(docs)


def _packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.packed(docs)


#: Each stage reads what its predecessor wrote; all but the last return the columns of documents.
STAGES = [
    ("toxicity", _clean),
    ("exact_dedup", _unique),
    ("ngram_join", _distinct),
    ("mix", _mixed),
    ("packing", _packed),
]

#: Training, tokenizing and packing are beyond SQL; tests/llm holds each stage against brute
#: force, and toxicity's decisions against the labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
