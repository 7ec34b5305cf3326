"""Normalised records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import address, text
from tessera.functions.constants import NAME_TOKENS


def normalize(records: DataFrame) -> DataFrame:
    """records(entity_id, business_name, business_address, country) with the normalised name and address columns."""
    df = records.withColumns({
        "business_name": F.coalesce("business_name", F.lit("")), "business_address": F.coalesce("business_address", F.lit("")),
        "country": F.coalesce("country", F.lit("UNK"))})
    df = df.withColumns({
        "name_tokens": text.mapped_tokens(text.clean(F.col("business_name")), NAME_TOKENS), "has_devanagari": text.has_devanagari(F.col("business_name")),
        "_clean": text.clean(F.col("business_address")), "_parts": address.folded_segments(F.col("business_address"))})
    df = df.withColumns({
        "norm_name": F.array_join("name_tokens", " "), "norm_addr": address.norm_addr(F.col("_clean")),
        "zip": F.when(F.col("_clean") != "", address.postal(F.col("business_address"), F.col("country"))), "house_no": address.house_no(F.col("_clean"))})
    df = df.withColumn("state", address.state(F.col("norm_addr"), F.col("country")))
    df = df.withColumn("city", F.when(F.col("_clean") != "", address.city(F.col("business_address"), F.col("_parts"), F.col("state"))))
    return df.drop("_clean", "_parts")
