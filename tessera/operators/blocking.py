"""Candidate generation: guarded equi-joins on tokens, phonetic codes and trigrams, and joins on postal code and city.

A guarded block is used only if it is small on both sides; the guard is a semi-join
with pre-aggregated block counts, so no oversized block is ever joined.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.constants import MAX_BLOCK_PAIRS, MAX_BLOCK_SIDE
from tessera.functions.similarity import best_token_sets


def keyed(df: DataFrame, kind: str) -> DataFrame:
    """(entity_id, country, key) of one blocker; an entity has a key at most once."""
    base = df.select("entity_id", "country", *{"token": ["name_tokens"], "soundex": ["norm_name"], "trigram": ["norm_name"]}.get(kind, ["zip", "city", "name_tokens"]))
    if kind == "token":
        return base.select("entity_id", "country", F.explode(text.blocking_tokens(F.col("name_tokens"))).alias("key"))
    if kind == "soundex":
        return base.select("entity_id", "country", text.soundex_code(F.col("norm_name")).alias("key")).where(~F.col("key").isin("", "0000"))
    if kind == "trigram":
        return base.select("entity_id", "country", F.explode(text.trigram_set(F.col("norm_name"))).alias("key"))
    if kind == "zip":
        return base.select("entity_id", "country", F.col("zip").alias("key")).where("key is not null")
    # Filtered inside a generator: a plain filter on city would be pushed down and would evaluate the parser again.
    both = F.struct(F.col("city"), F.try_element_at("name_tokens", F.lit(1)).alias("first"))
    return base.select("entity_id", "country", F.explode(F.filter(F.array(both), lambda k: k["city"].isNotNull() & k["first"].isNotNull())).alias("key"))


def block_stats(a: DataFrame, b: DataFrame) -> DataFrame:
    """(country, key, s1_count, other_count, est_pairs) of the blocks found on both sides.  a, b: as from keyed(), each key of an entity once."""
    count = lambda df, name: df.groupBy("country", "key").agg(F.count("*").alias(name))
    both = count(a, "s1_count").join(count(b, "other_count"), ["country", "key"])
    return both.withColumn("est_pairs", F.col("s1_count") * F.col("other_count"))


def safe(max_pairs: int = MAX_BLOCK_PAIRS, max_side: int = MAX_BLOCK_SIDE):
    return (F.col("est_pairs") <= max_pairs) & (F.col("s1_count") <= max_side) & (F.col("other_count") <= max_side)


def guard_report(stats: DataFrame, max_pairs: int = MAX_BLOCK_PAIRS, max_side: int = MAX_BLOCK_SIDE) -> DataFrame:
    ok = safe(max_pairs, max_side)
    return stats.agg(F.count("*").alias("blocks"), F.coalesce(F.sum((~ok).cast("long")), F.lit(0)).alias("skipped"),
                     F.coalesce(F.sum(F.when(~ok, F.col("est_pairs"))), F.lit(0)).alias("avoided_pairs"),
                     F.coalesce(F.sum(F.when(ok, F.col("est_pairs"))), F.lit(0)).alias("kept_pairs"))


def _joined(a: DataFrame, b: DataFrame) -> DataFrame:
    left = a.select("country", "key", F.col("entity_id").alias("source1_entity_id"))
    return left.join(b.select("country", "key", F.col("entity_id").alias("other_entity_id")), ["country", "key"])


def block(s1: DataFrame, other: DataFrame, kind: str, *, max_pairs: int = MAX_BLOCK_PAIRS, max_side: int = MAX_BLOCK_SIDE, guard: bool | None = None) -> DataFrame:
    """Distinct pairs of one blocker: token, soundex (guarded), zip, city_first (unguarded, unless guard says so: a key that many records share gives all their pairs)."""
    return meetings(s1, other, kind, max_pairs=max_pairs, max_side=max_side, guard=guard).distinct()


def meetings(s1: DataFrame, other: DataFrame, kind: str, *, max_pairs: int = MAX_BLOCK_PAIRS, max_side: int = MAX_BLOCK_SIDE, guard: bool | None = None) -> DataFrame:
    """The pairs of block(), each as often as it has a key in common."""
    a, b = keyed(s1, kind), keyed(other, kind)
    if kind in ("token", "soundex") if guard is None else guard:
        a = a.join(block_stats(a, b).where(safe(max_pairs, max_side)).select("country", "key"), ["country", "key"], "left_semi")
    return _joined(a, b).select("source1_entity_id", "other_entity_id")


def block_trigram(s1: DataFrame, other: DataFrame, *, min_jaccard: float = 0.3, max_pairs: int = MAX_BLOCK_PAIRS, max_side: int = MAX_BLOCK_SIDE) -> DataFrame:
    """(source1_entity_id, other_entity_id, jaccard): shared trigrams count only in safe blocks, sizes count all."""
    a, b = keyed(s1, "trigram"), keyed(other, "trigram")
    a = a.join(block_stats(a, b).where(safe(max_pairs, max_side)).select("country", "key"), ["country", "key"], "left_semi")
    shared = _joined(a, b).groupBy("source1_entity_id", "other_entity_id").agg(F.count("*").alias("shared"))
    size = lambda df, side: df.select(F.col("entity_id").alias(f"{side}_entity_id"), F.size(text.trigram_set(F.col("norm_name"))).alias(f"{side}_n"))
    sized = shared.join(size(s1, "source1"), "source1_entity_id").join(size(other, "other"), "other_entity_id")
    jaccard = F.col("shared") / F.greatest(F.col("source1_n") + F.col("other_n") - F.col("shared"), F.lit(1))
    return sized.withColumn("jaccard", jaccard).where(F.col("jaccard") >= min_jaccard).select("source1_entity_id", "other_entity_id", "jaccard")


KINDS = ("token", "soundex", "zip", "city_first", "trigram")
#: Anchor records of a block that meet its other records in one task.
MEETING = 2048


def best_of_blocks(s1: DataFrame, other: DataFrame, kind: str, k: int) -> DataFrame:
    """Of the pairs of a blocker without a guard, the k best of each record of s1 by quick score, then id, in each of its blocks.

    The records of a block meet in Python, so that its pairs are scored without being written
    or shuffled: what is ranked below these in a block is not among the k best of a larger pool.
    """
    name = lambda df: df.select("entity_id", "norm_name")
    a, b = (keyed(df, kind).withColumn("key", F.to_json(F.struct("key"))) for df in (s1, other))  # text, whatever the key is
    parts = block_stats(a, b).select("country", "key", F.ceil(F.col("s1_count") / MEETING).cast("int").alias("parts"))
    n = int(s1.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = F.pmod(F.xxhash64("country", "key", "part"), F.lit(n)).alias("task")  # small blocks go to a task together
    dealt = lambda df, part: df.join(parts, ["country", "key"]).withColumn("part", part)
    met = lambda df, side: df.join(name(side), "entity_id").select("*", task).drop("parts").repartition(n, "task").groupBy("task")
    a = met(dealt(a, F.pmod(F.xxhash64("entity_id"), F.col("parts")).cast("int")), s1)
    b = met(dealt(b, F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), other)

    def best(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        keys, y = ["country", "key", "part"], y.sort_values("entity_id")
        of, left, right = y.groupby(keys).indices, [], []
        for block, i in x.groupby(keys).indices.items():
            j = of.get(block, np.zeros(0, np.int64))
            p, q = best_token_sets(*(df["norm_name"].fillna("").to_numpy()[at].tolist() for df, at in ((x, i), (y, j))), k)
            left.append(x["entity_id"].to_numpy()[i][p])
            right.append(y["entity_id"].to_numpy()[j][q])
        return pd.DataFrame({"source1_entity_id": np.concatenate(left), "other_entity_id": np.concatenate(right)}) if left else pd.DataFrame({c: [] for c in ("source1_entity_id", "other_entity_id")}, dtype=object)

    return a.cogroup(b).applyInPandas(best, "source1_entity_id string, other_entity_id string")


def lexical_candidates(s1: DataFrame, other: DataFrame, best: int | None = None, keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = lambda _, make: make(), **guard: int) -> DataFrame:
    """Distinct union of the five blockers.  best: of the postal codes and cities, which have no guard, only the pairs that can be among so many best of an entity by quick score.

    keep(kind, make) may write what make() has, so that the driver plans one blocker at a time.
    """
    def pairs(kind: str) -> DataFrame:
        if kind == "trigram":
            return block_trigram(s1, other, **guard).drop("jaccard")
        return best_of_blocks(s1, other, kind, best) if best is not None and kind in ("zip", "city_first") else block(s1, other, kind, **guard)

    return reduce(DataFrame.unionByName, (keep(k, lambda k=k: pairs(k)) for k in KINDS)).distinct()
