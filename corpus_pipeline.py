"""The corpus pipeline: documents in, sharded training documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import decontamination, jaccard, language, mixing, sharding
from roomledger.session import materialize


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that was learned; those without letters or like none of them go."""
    return language.keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each document as often as the mix reads it."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    return sharding.shard_documents(docs)


STAGES = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# Kernels and signature trees have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the documents, each to what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
