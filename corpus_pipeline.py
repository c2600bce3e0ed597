"""A training-data pipeline over ``documents``: language, quality, near-duplicates, leaks, token ids.

Each stage is given what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import bpe, decontam, icws, ppm, quality
from tidewater.llm.common import load, run_dir, written
from tidewater.llm.queries import RANKS


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no known language (null and wordless ones included)."""
    return ppm.keep_known(docs, ppm.train(docs))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the quality classifier rejects."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate class."""
    return icws.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontam.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and digest of the bytes decoded from them."""
    return bpe.report(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("language", language), ("quality", good), ("near_dedup", unique), ("decontaminate", clean), ("encode", tokens)]

#: Models, samples of sets and merges have no SQL: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return docs
