"""The driver's tables as record-linkage inputs.

Documents become three sources by the number of their ``source`` modulo three (the
first, if it is null): the first eight words, or all of them, are the name (every tenth begins with a Devanagari word), English
is the United States, German is India, another language is a country of its own, and an address
is made of the id, two further words, a state and a postal code.  Equal texts in different
sources are true matches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """entity_id, n (0 for the anchor source), country, business_name (with whole, all words of the text), business_address, text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    docs = docs.withColumn("n", F.coalesce(F.substr("source", F.lit(4)).cast("int") % 3, F.lit(0)))
    # Ten words are taken; the first part may be empty and the twelfth is the rest of the text, so a long one is not cut into all its words.
    words = F.filter(F.split("text", "[ \\n\\t\\r]+", -1 if whole else 12), lambda w: w != "")
    docs = docs.withColumn("w", words)
    tail = F.replace(F.array_join(F.slice("w", 9, 2), " "), F.lit(","), F.lit(""))
    number, india = (F.col("doc_id") % 97).cast("string"), F.col("lang") == "de"
    end = F.when(india, F.concat(F.lit(", Maharashtra, "), F.lpad(number, 6, "4"))).otherwise(F.concat(F.lit(", NC "), F.lpad(number, 5, "0")))
    before = F.when(F.col("doc_id") % 10 == 3, "कंपनी ").otherwise("")
    return docs.select(F.concat(F.lit("S"), F.col("n") + 1, F.lit("-"), F.col("doc_id")).alias("entity_id"), "n",
                       F.when(F.col("lang") == "en", "US").when(india, "India").otherwise(F.col("lang")).alias("country"),
                       F.concat(before, F.array_join("w" if whole else F.slice("w", 1, 8), " ")).alias("business_name"),
                       F.concat(F.col("doc_id"), F.lit(" Main St, "), tail, end).alias("business_address"), "text")


def truth_of(rows: DataFrame) -> DataFrame:
    """(source1_entity_id, other_entity_id) of equal texts across sources."""
    key = rows.select("entity_id", "n", F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    a = key.where("n = 0").select("h", F.col("entity_id").alias("source1_entity_id"))
    return a.join(key.where("n > 0").select("h", F.col("entity_id").alias("other_entity_id")), "h").drop("h")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic addresses of customers in four styles: id, country, address."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    k, style = F.col("id").cast("string"), F.col("id") % 4
    text = (F.when(style == 0, F.concat(F.lit("ASHEVILLE, NC, "), k, F.lit(" 1/2 PEBBLE WALK")))
            .when(style == 1, F.concat(k, F.lit(" Juniper Dr, Cedar Falls, South Dakota "), F.lpad(k, 5, "2")))
            .when(style == 2, F.concat(F.lit("H-"), k, F.lit(", LOTUS ENCLAVE, NAGPUR, Maharashtra, "), F.lpad(k, 6, "4")))
            .otherwise(F.concat(k, F.lit("b Quai du Vieux Moulin, 31000, Toulouse"))))
    return c.select("id", F.when(style < 2, "US").when(style == 2, "India").otherwise("France").alias("country"), text.alias("address"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, entity_id, country (the label) and vector of the embeddings table."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.format_string("V%08d", "vec_id").alias("entity_id"), F.col("label").cast("string").alias("country"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
