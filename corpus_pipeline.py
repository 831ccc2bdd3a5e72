"""A training corpus from raw documents: rules, exact and near dedup, mixing, packing.

Every stage takes what the one before kept, as Parquet that has been written and read again, so
a lost executor costs the running stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cargolens.llm import grace_dedup, minhash, mixing, quality_rules, sum_of_squares
from cargolens.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality_rules.quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    return grace_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 over five words."""
    return minhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' weights ask for, shuffled within output shards."""
    return mixing.in_order(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return sum_of_squares.packed_documents(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies),
          ("mixing", mixed), ("packing", packed)]

ORACLE_SQL = None  # SQL has neither the tokenizer nor the seeded draws; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
