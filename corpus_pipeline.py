"""From documents to training shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, quality_rules, sharding, simhash
from tidemark.llm.staging import staged

SHARDS = 8


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality_rules.passing(docs)


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of shingles of four words that chains of links of at
    most four differing bits connect. The first document in the table stays."""
    return simhash.first_of_each(docs, shingle=4, threshold=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the weights of their sources ask for."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in random order, dealt to shards."""
    return sharding.dealt(docs, shards=SHARDS)


STAGES = [
    ("quality_rules", good_quality),
    ("near_duplicates", near_unique),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
