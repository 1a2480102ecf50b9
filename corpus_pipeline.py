"""From raw documents to sharded training data: stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import decontaminate, langid, mixing, near_dedup, sharding
from ridgeline.llm.common import scratch, table

SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.without_near_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of ten words of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources takes them, 0 to 3 times."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with shard and slot."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontamination),
    ("mix", mixture),
    ("shard", shards),
]

#: MinHash groups and language models have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
