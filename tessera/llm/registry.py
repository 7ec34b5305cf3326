"""The subpackage's queries, each over the whole of its tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, exact_dedup, license_scan, line_dedup, minhash, mixing, packing, quality_classifier, quality_rules, warc
from tessera.llm.oracle import ORACLE

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _labels(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2).withColumnRenamed("id", "doc_id")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents")).drop("hits").withColumnRenamed("id", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "n_lines", "n_dropped", "text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(_table(spark, sf_dir, "documents"))
    draws = F.array_join(F.transform("draws", lambda d: F.concat_ws(":", d["epoch"], d["shard"], d["place"])), ",")
    return planned.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"),
                          draws.alias("draws"))


#: One more conversation, of control strings.
HARD = "\\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(hard)
    chats = chat.format_chats(chat.linear(turns))
    read = chat.read_turns(F.col("formatted"))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.withColumn("read", read).withColumn("under", chat.loss_text(F.col("formatted"), F.col("loss"))).select(
        F.col("conv").alias("conv_id"), F.size("read").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"), F.sha2(F.col("under").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.quality_classifier(_table(spark, sf_dir, "documents"), _labels(spark, sf_dir))
    return found.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_quality_rules, op2_exact_dedup, op3_warc, op4_minhash, op5_license_scan, op6_line_dedup, op7_packing, op8_mixing, op9_chat, op10_quality_classifier)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
