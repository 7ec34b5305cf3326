"""Exact deduplication with a heavy-hitter split (operator 2).

Texts are equal when identical after each run of ASCII white space has become
one space; equality is that of the SHA-256 of the normalised text.  Digests are
computed once and written.  A Misra-Gries summary of bounded size per task,
merged into one of the same size, names every digest that can hold more than
1/(counters + 1) of the rows; an exact count verifies them, and their winners
(at most ``counters`` rows, 256 or as many as there are shuffle partitions if that is more, so that no digest left is many times a partition's share) are broadcast, so the copies of a frequent text are
settled where they stand.  All other digests take an ordinary pre-aggregated
shuffle; by construction none of them is frequent.

Cases: null text counts as empty.  The smallest id of a group stays; of
repeated rows with that id all carry it (``kept``), in filter_documents() one of
them stays.  A null id never wins against another id; a group of null ids only
has keep_id null, and its rows are kept by exact_dedup() (none is a copy of a
named row), one by filter_documents().  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, materialize, small

COUNTERS = 256


def misra_gries(counters: dict[bytes, int], fresh: dict[bytes, int], size: int) -> dict[bytes, int]:
    """Merges exact counts into a summary of at most ``size`` counters: adds, then lowers all by the (size + 1)-th largest."""
    for k, v in fresh.items():
        counters[k] = counters.get(k, 0) + v
    if len(counters) <= size:
        return counters
    cut = sorted(counters.values(), reverse=True)[size]
    return {k: v - cut for k, v in counters.items() if v > cut}


def frequent_digests(digests: DataFrame, size: int = COUNTERS) -> DataFrame:
    """At most ``size`` rows (digest): a superset of the digests found in more than 1/(size + 1) of the rows of digests(digest)."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            fresh = dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True))
            counters = misra_gries(counters, fresh, size)
        yield pa.RecordBatch.from_arrays([pa.array(counters.keys(), pa.binary()), pa.array(counters.values(), pa.int64())], names=["digest", "n"])

    spark = digests.sparkSession
    parts = digests.select("digest").mapInArrow(summarise, "digest binary, n bigint").groupBy("digest").agg(F.sum("n").alias("n"))
    top = parts.orderBy(F.desc("n"), "digest").limit(size + 1).collect()
    cut = top[size].n if len(top) > size else 0
    return spark.createDataFrame([(r.digest,) for r in top if r.n > cut], "digest binary")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    normal = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(normal.cast("binary"), 256)).alias("digest"))


def groups(prints: DataFrame, counters: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(winners, rest) for a written table prints(id, digest).

    winners(digest, keep_id, group_size): verified frequent digests, at most
    ``counters`` rows.  rest: the same columns for all other digests with two
    rows or more.
    """
    if counters is None:
        counters = max(COUNTERS, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    count = (F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    named = F.broadcast(frequent_digests(prints, counters))
    winners = materialize(prints.join(named, "digest", "left_semi").groupBy("digest").agg(*count).where("group_size > 1"), "dedup-winners")
    rest = prints.join(F.broadcast(winners), "digest", "left_anti").groupBy("digest").agg(*count).where("group_size > 1")
    return winners, rest


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256."""
    prints = materialize(fingerprint(docs, id_col, text_col), "dedup-prints")
    winners, rest = groups(prints, counters)
    hot = prints.join(F.broadcast(winners), "digest")
    cold = (prints.join(F.broadcast(winners), "digest", "left_anti").join(rest, "digest", "left")
            .select("digest", "id", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).alias("group_size")))
    return hot.select(*cold.columns).union(cold).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def filter_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", counters: int | None = None) -> DataFrame:
    """One row of docs for each different text, with its own columns.

    Frequent texts: their rows are dropped map-side except the winners, which
    meet in a small shuffle.  The others meet by digest; a row that must travel
    does so with its text once.
    """
    digest = F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ").cast("binary"), 256))
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), digest.alias("digest"))
    prints = materialize(rows.select("id", "digest"), "dedup-prints")
    winners, rest = groups(prints, counters)
    dropped = materialize(
        prints.join(F.broadcast(winners), "digest", "left_anti").join(rest, "digest").select("digest", "keep_id").distinct(), "dedup-copies")
    hot = F.broadcast(winners.select("digest", F.col("keep_id").alias("hot_id"), F.lit(True).alias("hot")))
    cold = small(dropped.select("digest", F.col("keep_id").alias("cold_id"), F.lit(True).alias("cold")))
    marked = rows.join(hot, "digest", "left").join(cold, "digest", "left")
    winner = F.when(F.col("hot"), F.col("hot_id")).otherwise(F.col("cold_id"))
    copied = F.coalesce("hot", "cold", F.lit(False))
    first = marked.where(~copied | F.col("id").eqNullSafe(winner)).select("doc", "id", "digest", copied.alias("copied"))
    # Rows repeated under the winner's own id: one of them stays.
    twice = (prints.join(winners.select("digest", "keep_id").union(dropped), "digest").where(F.col("id").eqNullSafe(F.col("keep_id")))
             .groupBy("digest").count().where("count > 1").limit(1).count())
    if twice:
        single = first.where("copied").withColumn("k", F.row_number().over(Window.partitionBy("digest").orderBy("id"))).where("k = 1")
        first = first.where("not copied").select("doc").union(single.select("doc"))
    return first.select("doc.*")
