"""A training-data pipeline of five stages over the table ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import decontamination, language, packing, secrets, simhash
from tillflow.llm.work import new_folder, prepared, table


# Texts go to the Python workers in smaller batches here, as stages also hold what they make of them.
BATCH_BYTES = 8 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that holds three words in ten, go."""
    prepared(spark, BATCH_BYTES)
    return language.accepted(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose SimHashes of four-word shingles are linked at up to four bits, that with the smallest id stays."""
    prepared(spark, BATCH_BYTES)
    return simhash.deduplicated(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a shorter one whole) go."""
    prepared(spark, BATCH_BYTES)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets and linked parts of credentials are masked in their texts."""
    prepared(spark, BATCH_BYTES)
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences of 2048."""
    prepared(spark, BATCH_BYTES)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("without_benchmarks", without_benchmarks),
    ("without_secrets", without_secrets),
    ("packed", packed),
]

# Neither the model of the first stage nor the tokenizer of the last can be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's documents."""
    docs = table(prepared(spark, BATCH_BYTES), sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
