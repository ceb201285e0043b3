"""A training corpus in five stages, each an operator of `candlemill.llm`.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. The
first four return the columns of `documents`, further ones included, the last one the encoded documents.

NULL texts count as empty and are judged like any other; long texts are judged whole. Rows of
NULL id are never labelled and never near copies. Of rows that repeat id and text near-dedup keeps one;
rows that share an id only are judged each by its text there. Empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from candlemill.llm import bpe, decontaminate, near_dups, quality, toxicity
from candlemill.llm.common import table
from candlemill.llm.queries import VOCABULARY
from candlemill.session import written


def inoffensive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dups.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", inoffensive),
    ("quality", good),
    ("near-dedup", deduplicated),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

ORACLE_SQL = None  # models and tokenizer are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
