"""Quality classifier with hierarchical empirical Bayes (operator 10).

A logistic regression over statistics of the whole text and hashed words gives
each document's own evidence.  It is fitted here on at most ``fit_rows`` labelled rows,
taken in order of a hash (at most twice as many rows, if ids repeat).  Sites add theirs: labels are counted by host and
by (host, path), a host's good rate is a Beta posterior around the global
rate, a path's one around its host's, and the prior strengths are estimated from the
spread of the groups (method of moments).  A sparse site is thus shrunk to its host,
a sparse host to the global rate.  Here the host is the column ``source`` and the path the column ``lang``, unless named otherwise.  The score is the document's log-odds plus the
path's posterior log-odds minus the prior log-odds that the classifier already holds.

Group counts are pre-aggregated sums.  A labelled document's own label is not
taken out of its site's counts; one label moves a site by at most 1/(n + strength).

Cases: null or empty text is scored from its (zero) statistics.  A null host or path is a
value of its own.  Labels with null id or quality are ignored, of several for one
document the lowest counts.  Without labels of both kinds the classifier is constant and
the score is the site's posterior; without any labels it is 1/2.  Repeated rows are scored one by
one.  Extra columns do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, claim, key_part, materialize, small
from tessera.llm.quality_rules import measure_text

FIT_ROWS = 8_000
BUCKETS = 1 << 12
#: Documents are dropped when bad is more than four times as likely as good: dropping a good one costs four times as much as keeping a bad one.
CUTOFF = 0.2
_DENSE = 12


class _Buckets(dict):
    """Word to hashed feature, emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = _DENSE + zlib.crc32(word.lower()) % BUCKETS
        return value


_buckets = _Buckets()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of one text: twelve statistics, and words weighted by root frequency with unit length."""
    n, chars, symbols, dups, repeats, lines, upper = measure_text(text)
    w, c = max(n, 1), max(chars, 1)
    punct = len(text) - len(text.translate(None, b"!?.,;:"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    words = text.split()
    distinct = len(set(words))
    dense = [1.0, math.log1p(n) / 5, symbols / c * 5, dups / max(lines, 1), repeats / w, upper / c * 3, chars / w / 6, distinct / math.sqrt(w) / 10,
             punct / c * 5, text.count(b"!") / w, digits / c * 5, float(n < 10)]
    if not words:
        return np.arange(_DENSE), np.array(dense)
    ids, counts = np.unique(np.fromiter(map(_buckets.__getitem__, words), np.int64, n), return_counts=True)
    values = np.sqrt(counts)
    return np.concatenate([np.arange(_DENSE), ids]), np.concatenate([dense, values / np.linalg.norm(values)])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = 300, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by accelerated gradient steps; the mean is taken over rows."""
    size = _DENSE + BUCKETS
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    ids, values = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
    weight, ahead, last = np.zeros(size), np.zeros(size), 1.0
    rate = 4 / max(1e-9, float(np.bincount(at, values**2).max()))
    for _ in range(rounds):
        z = np.bincount(at, values * ahead[ids], len(rows))
        slope = np.bincount(ids, values * ((1 / (1 + np.exp(-z)) - y) / len(rows))[at], size) + ridge * ahead
        new, nxt = ahead - rate * slope, (1 + math.sqrt(1 + 4 * last * last)) / 2
        ahead, weight, last = new + (last - 1) / nxt * (new - weight), new, nxt
    return weight


def _logits(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("classifier", _buckets.clear)
        for batch in batches:
            z = [float(v @ weight[i]) for i, v in (features(t or b"") for t in batch.column("text").cast(pa.large_binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), batch.column("path"), pa.array(z, pa.float64())], names=["id", "host", "path", "logit"])

    schema = docs.select("id", "host", "path").schema.add("logit", "double")
    return docs.mapInArrow(score, schema)


def _strength(rate: Column) -> Column:
    """Prior strength of a Beta around ``rate`` by moments: from the spread of group rates beyond binomial noise, in [2, 1e6]."""
    n, m = F.col("n").cast("double"), rate * (1 - rate)
    excess = F.sum(n * F.pow(F.col("good") / n - rate, 2) - m)
    between = excess / F.greatest(F.sum(n - 1), F.lit(1.0))
    return F.when(between > 0, F.least(F.lit(1e6), F.greatest(F.lit(2.0), F.avg(m) / between - 1))).otherwise(F.lit(1e6))


def site_posteriors(labelled: DataFrame) -> DataFrame:
    """labelled(host, path, quality) to (host, path, n, posterior): path shrunk to host shrunk to global."""
    by_path = materialize(labelled.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("quality").cast("double").alias("good")), "site-counts")
    whole = by_path.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("rate"))
    rate = whole.first()["rate"]
    rate = 0.5 if rate is None else float(rate)
    hosts = by_path.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    strength = float(hosts.agg(_strength(F.lit(rate)).alias("s")).first()["s"] or 1e6)
    hosts = hosts.select("host", ((F.col("good") + strength * rate) / (F.col("n") + strength)).alias("host_rate"))
    paths = by_path.join(hosts, "host")
    inner = float(paths.agg(_strength(F.col("host_rate")).alias("s")).first()["s"] or 1e6)
    return materialize(paths.select("host", "path", "n", "host_rate", ((F.col("good") + inner * F.col("host_rate")) / (F.col("n") + inner)).alias("posterior")), "site-posteriors")


def quality_classifier(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                       path_col: str = "lang", fit_rows: int = FIT_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """Per row: id, logit (document alone), site_rate (posterior of its path), probability of good quality, kept."""
    bound_batches(docs.sparkSession)
    labels = labels.where("id is not null and quality is not null").groupBy("id").agg(F.min("quality").cast("int").alias("quality"))
    rows = docs.select(F.col(id_col).alias("id"), key_part(F.col(host_col)).alias("host"), key_part(F.col(path_col)).alias("path"), F.col(text_col).cast("string").alias("text"))
    labelled = materialize(rows.select("id", "host", "path").join(labels, "id"), "quality-labelled")
    # The sample is chosen by id before any text is read for it.
    chosen = F.broadcast(labelled.select("id", "quality").distinct().orderBy(F.xxhash64("id", F.lit(10)), "id").limit(fit_rows))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("classifier", _buckets.clear)
        for batch in batches:
            found = [features(t or b"") for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("quality"), pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()),
                                              pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], names=["id", "quality", "i", "v"])

    kind = rows.schema["id"].dataType.simpleString()
    sample = rows.join(chosen, "id").select("id", "quality", "text").mapInArrow(extract, f"id {kind}, quality int, i binary, v binary")
    # Ids may repeat; in this order reruns take the same rows and add them up alike.
    sample = sample.orderBy(F.xxhash64("id", F.lit(10)), "id", "i", "v").limit(2 * fit_rows).collect()
    y = np.array([r.quality for r in sample], float)
    if 0 < y.sum() < len(y):
        weight = fit([(np.frombuffer(r.i, "<i4").astype(np.int64), np.frombuffer(r.v, "<f4").astype(float)) for r in sample], y)
        held = math.log(y.mean() / (1 - y.mean()))
    else:
        weight, held = np.zeros(_DENSE + BUCKETS), 0.0
    sites = site_posteriors(labelled)
    whole = labelled.agg(((F.sum("quality") + 1) / (F.count("*") + 2)).alias("rate")).first()["rate"]
    whole = 0.5 if whole is None else float(whole)
    hosts = small(materialize(sites.select("host", "host_rate").distinct(), "site-hosts"))
    scored = _logits(rows, weight).join(small(sites.select("host", "path", "posterior")), ["host", "path"], "left").join(hosts, "host", "left")
    site = F.coalesce("posterior", "host_rate", F.lit(whole))
    odds = F.col("logit") + F.log(F.col("site_rate") / (1 - F.col("site_rate"))) - F.lit(held)
    return scored.withColumn("site_rate", site).withColumn("probability", 1 / (1 + F.exp(-odds))).select(
        "id", "logit", "site_rate", "probability", (F.col("probability") >= cutoff).alias("kept"))
