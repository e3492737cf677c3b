"""Documents to training tokens: five stages, each written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lessonlens.llm import bpe, decontaminate, pii, quality, simhash
from lessonlens.llm.common import prepare, stored
from lessonlens.llm.registry import table, vocabulary_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier, fitted on ``labels``, rejects."""
    prepare(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    prepare(spark)
    return simhash.representatives(docs, shingle=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that share a passage with an item of ``benchmark``."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    prepare(spark)
    return pii.redact(docs)


def byte_pair_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, with digests of the ids and of the text decoded from them."""
    prepare(spark)
    return bpe.digests(docs, vocabulary_path(), with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", byte_pair_encoding),
]

# No stage but the fourth could be stated in SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
