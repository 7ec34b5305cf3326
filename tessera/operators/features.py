"""Pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.similarity import kernel_udf, kernels_udf

#: The model's inputs, in order.
FEATURES = [
    "name_jaro_winkler", "name_levenshtein_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_partial_ratio", "name_len_diff",
    "name_common_token_frac", "name_first_token_match", "addr_token_sort_ratio", "addr_partial_ratio", "city_exact_match", "city_fuzzy_score",
    "state_exact_match", "zip_exact_match", "zip_present_both", "house_no_exact_match", "country_match", "name_char_3gram_cosine",
    "name_char_4gram_cosine", "addr_char_3gram_cosine", "name_trigram_jaccard", "name_soundex_match",
]


def entity_side(df: DataFrame) -> DataFrame:
    """What an entity brings to each of its pairs, computed once per entity."""
    name, addr = F.col("norm_name"), F.col("norm_addr")
    return df.select("entity_id", "country", "norm_name", "norm_addr", "name_tokens", "zip", "state", "city", "house_no",
                     text.gram_vector(text.gram_codes(name, 3)).alias("g3"), text.gram_vector(text.gram_codes(name, 4)).alias("g4"),
                     text.gram_vector(text.gram_codes(addr, 3)).alias("ga"), text.trigram_set(name).alias("tri"), text.soundex_code(name).alias("sdx"))


def with_sides(pairs: DataFrame, s1: DataFrame, other: DataFrame) -> DataFrame:
    """pairs with structs l and r of the two entities; Catalyst prunes the columns that are not used."""
    left = s1.select(F.col("entity_id").alias("source1_entity_id"), F.struct("*").alias("l"))
    right = other.select(F.col("entity_id").alias("other_entity_id"), F.struct("*").alias("r"))
    return pairs.join(left, "source1_entity_id", "left").join(right, "other_entity_id", "left")


def native_features() -> dict[str, Column]:
    l, r = F.col("l"), F.col("r")  # noqa: E741
    same = lambda c: F.coalesce(l[c] == r[c], F.lit(False)).cast("int")
    both = (F.length(l["norm_name"]) > 0) & (F.length(r["norm_name"]) > 0)
    first = lambda s: F.try_element_at(s["name_tokens"], F.lit(1))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return {
        "name_len_diff": F.abs(F.length(F.coalesce(l["norm_name"], F.lit(""))) - F.length(F.coalesce(r["norm_name"], F.lit("")))),
        "name_common_token_frac": zero(text.token_overlap(l["name_tokens"], r["name_tokens"])),
        "name_first_token_match": F.coalesce((first(l) == first(r)).cast("double"), F.lit(0.0)),
        "city_exact_match": same("city"), "state_exact_match": same("state"), "zip_exact_match": same("zip"),
        "zip_present_both": (l["zip"].isNotNull() & r["zip"].isNotNull()).cast("int"), "house_no_exact_match": same("house_no"),
        "country_match": (F.coalesce(l["country"], F.lit("UNK")) == F.coalesce(r["country"], F.lit("UNK"))).cast("int"),
        "name_char_3gram_cosine": zero(text.gram_cosine(l["g3"], r["g3"])), "name_char_4gram_cosine": zero(text.gram_cosine(l["g4"], r["g4"])),
        "addr_char_3gram_cosine": zero(text.gram_cosine(l["ga"], r["ga"])), "name_trigram_jaccard": zero(text.set_overlap(l["tri"], r["tri"])),
        "name_soundex_match": F.coalesce((both & (l["sdx"] == r["sdx"])).cast("double"), F.lit(0.0)),
    }


#: Features that pair_features() takes from the strings, so that no gram arrays go through its joins.
_GRAMS = {"name_char_3gram_cosine": "_s.n_cosine3", "name_char_4gram_cosine": "_s.n_cosine4", "addr_char_3gram_cosine": "_s.a_cosine3", "name_trigram_jaccard": "_s.n_trigram_jaccard"}


def pair_features(pairs: DataFrame, s1: DataFrame, other: DataFrame) -> DataFrame:
    """pairs with FEATURES; other columns of pairs (ann_score, provenance) are carried."""
    side = lambda df: df.select("entity_id", "country", "norm_name", "norm_addr", "name_tokens", "zip", "state", "city", "house_no", text.soundex_code(F.col("norm_name")).alias("sdx"))
    df = with_sides(pairs, side(s1), side(other)).withColumns({n: c for n, c in native_features().items() if n not in _GRAMS})
    scored = kernels_udf(n=("jaro_winkler", "ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio", "cosine3", "cosine4", "trigram_jaccard"),
                         a=("token_sort_ratio", "partial_ratio", "cosine3"), c=("ratio",))  # one UDF: each would have a Python worker of its own beside every task
    df = df.withColumn("_s", scored(*(f"{side}.{c}" for c in ("norm_name", "norm_addr", "city") for side in "lr")))
    filled = lambda c: (F.length(F.col(f"l.{c}")) > 0) & (F.length(F.col(f"r.{c}")) > 0)
    df = df.withColumns({
        **{n: F.col(c) for n, c in _GRAMS.items()},
        "name_jaro_winkler": F.col("_s.n_jaro_winkler"), "name_levenshtein_ratio": F.col("_s.n_ratio"), "name_token_sort_ratio": F.col("_s.n_token_sort_ratio"),
        "name_token_set_ratio": F.col("_s.n_token_set_ratio"), "name_partial_ratio": F.col("_s.n_partial_ratio"),
        "addr_token_sort_ratio": F.when(filled("norm_addr"), F.col("_s.a_token_sort_ratio")).otherwise(0.0),
        "addr_partial_ratio": F.when(filled("norm_addr"), F.col("_s.a_partial_ratio")).otherwise(0.0),
        "city_fuzzy_score": F.when(filled("city"), F.col("_s.c_ratio")).otherwise(0.0)})
    return df.select(*pairs.columns, *FEATURES)


def quick_score(pairs: DataFrame, s1: DataFrame, other: DataFrame) -> DataFrame:
    """pairs with _q: the token-set ratio of the names, 0 to 100."""
    slim = lambda df: df.select("entity_id", "norm_name")
    score = kernel_udf("token_set_ratio")
    return with_sides(pairs, slim(s1), slim(other)).withColumn("_q", 100 * score("l.norm_name", "r.norm_name")["token_set_ratio"]).select(*pairs.columns, "_q")
