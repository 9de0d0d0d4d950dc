"""The corpus pipeline: quality rules, near duplicates, personal data, mixing, packing.

Every stage takes what the one before kept, written as Parquet, and all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridtally.llm import jaccard, mixing, pii, quality  # noqa: E402
from gridtally.llm.common import new_path  # noqa: E402
from gridtally.llm.queries import PII_SECRET, packed  # noqa: E402


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share eight tenths of their five-word shingles, directly or by way of others,
    the one with the smallest id stays."""
    return jaccard.keep_one(docs, k=5, num=80, den=100)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates; ``n_chars`` follows the text."""
    return pii.replace(docs, PII_SECRET)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's rate has it."""
    return mixing.emit(docs, mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed(docs)


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("PII", surrogates),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]
#: Shingle graphs and tokenizers have no SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage{i}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
