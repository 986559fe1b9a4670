"""Five stages from raw documents to token ids: quality rules, exact and near deduplication, mixing of the
sources, byte-level BPE. Each stage gets what its predecessor kept, and its decisions take effect."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.llm import bpe, exact_dedup, mixing, near_dup, quality_rules  # noqa: E402
from tidegauge.llm.common import ship_package, stored  # noqa: E402
from tidegauge.llm.queries import tokenizer  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of quality rules does not reject."""
    ship_package(spark)
    return quality_rules.passing(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id."""
    ship_package(spark)
    return near_dup.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those it does not take are gone."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their packed token ids and the number of tokens."""
    ship_package(spark)
    path, pattern = tokenizer()
    return bpe.tokenize(docs, path, pattern)


STAGES = [
    ("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies),
    ("mixing", mixed), ("byte-level BPE", encoded),
]

# Sketches and merges are not SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; every stage's rows are written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
