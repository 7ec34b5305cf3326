"""Corpus pipeline: quality rules, exact and near deduplication, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, minhash, mixing, packing, quality_rules
from tessera.llm.common import materialize, rest
from tessera.llm.registry import tokenizer_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))
    return quality_rules.filter_documents(docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.filter_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8 or more), the smallest doc_id stays."""
    rest(spark)  # the stage that needs most memory begins without what others have left
    return minhash.filter_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a row for each time; a shard's rows lie together, in their drawn order."""
    return mixing.mix(docs).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row, with its sequence and place; rows that the mix has taken more than once are dealt apart."""
    rest(spark)
    # Small caches and groups: a worker's memory also holds what earlier stages left.
    found = packing.pack_documents(docs, tokenizer_path(), cache_words=200_000, cache_letters=200_000, keep_cache=False, group_bytes=1 << 20)
    return found.withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", rules), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("packing", packed)]

#: Tokens and the splitting tree's draws are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
