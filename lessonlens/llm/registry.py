"""The queries of this subpackage, over the whole ``documents``, ``conversations`` and ``embeddings`` tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lessonlens.llm import (chat, clusters, decontaminate, language, licenses, perplexity, pii, quality, simhash,
                            suffixes, topk, whitening)
from lessonlens.llm.common import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.query(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def op8_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.rules(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lessonlens.llm import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.query(table(spark, sf_dir, "embeddings"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_decontaminate, op3_license_scan, op4_language_id, op5_quality, op6_suffix_dedup,
        op7_chat_format, op8_perplexity_rules, op9_pii, op10_bpe, op11_whitening, op12_exact_topk, op13_clusters)}

ORACLE: dict[str, str] = {
    "op3_license_scan": licenses.oracle(), "op7_chat_format": chat.ORACLE, "op12_exact_topk": topk.ORACLE,
    "op13_clusters": clusters.oracle()}
