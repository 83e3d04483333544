"""Five stages that turn documents into token files.

Each stage reads all that the one before it kept, decides, and is written before the
next begins. ``run`` writes to the shared folder of the cluster.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import contamination, language, mixing, simhash, tokens
from marlstone.llm.common import table
from marlstone.session import shared_folder

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or text have no language and go."""
    return language.in_a_language(docs, language.train(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies stays (three-word shingles, fingerprints linked at two or fewer bits)."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    return contamination.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder; returns what they hold, one row per document."""
    return tokens.write_and_read(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_weights", mixing_to_weights),
    ("token_output", token_output),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/corpus-pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
