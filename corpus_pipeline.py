"""A corpus pipeline: documents in, token files out. Part of the subpackage `llm`.

Every stage takes what its predecessor kept, as a table of the columns of `documents`, and its
decisions take effect: rejected documents, further members of near-duplicate groups and documents
that hold benchmark passages go; the mix repeats and leaves out documents; the last stage writes
token files and returns a row per document of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import decontaminate, language, mixing, simhash, token_files
from linkloom.llm.common import fold, text_batches
from linkloom.llm.queries import tokenizer_path
from linkloom.operators.materialize import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: those without a letter."""
    text_batches(spark)
    model = language.learn(language.training_fold(docs, fold("doc_id")))
    return language.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that with the least id."""
    text_batches(spark)
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or a shorter item."""
    text_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_leaks(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources reach their targets."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and a row of each document read back from them."""
    dictionary, shards = token_files.write_token_files(docs, tokenizer_path())
    return token_files.checksums(token_files.read_token_files(dictionary, shards))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# Fingerprints, language models and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
