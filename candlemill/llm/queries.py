"""One registered query per operator, over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    chat,
    decontaminate,
    embed_dups,
    filter_audit,
    html_text,
    language_id,
    licenses,
    near_dups,
    quality,
    spelling,
    suffix_tree,
    toxicity,
)
from .common import table

VOCABULARY = "word_bpe_49k.json"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(table(spark, sf_dir, "documents"))


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.report(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dups.find_duplicates(table(spark, sf_dir, "embeddings"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.report(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.report(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_turns(turns.unionByName(chat.control_conversation(spark))))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_licenses": op4_licenses,
    "op5_decontaminate": op5_decontaminate,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_html": op9_html,
    "op10_chat": op10_chat,
    "op11_language": op11_language,
    "op12_spelling": op12_spelling,
    "op13_filter_audit": op13_filter_audit,
}
