"""Risk-controlled quality rules (operator 1).

Every document is measured once over its whole text.  A document that fails the
base rule is rejected outright.  Beyond it, each rule compares one ratio with a
cutoff, and cutoffs are not set by hand: each rule has a fixed ladder of cutoffs
from lenient to strict, and for each stratum (language by default) a labelled
holdout of good documents says how many of them cutoffs would reject.  The
rules of a stratum are certified jointly, along one fixed chain for each rule:
its ladder, then those of the rules after it, round to the one before it, each
beside the strictest rungs of the former (so a rule that rejects good documents
at once comes last in one chain).  A step of a chain is certified when the exact binomial test P(Bin(n, alpha) <= k)
for rejection by any of its rules is at most delta / (strata * chains):
Bonferroni over strata and chains, fixed-sequence testing along a chain (it
stops at the first step that fails, so the steps need no further correction).
With probability 1 - delta, every certified step of every stratum rejects at
most alpha of the good documents, so any may be used: of them, the one that
rejects the most labelled bad documents, then the strictest, then the one that
rejects the fewest good ones.  A stratum with too few labels (at alpha 0.02 and delta 0.05, under
306 good ones with four strata) certifies nothing, and the rules reject nothing there.

Cases: null or empty text has no words and fails the base rule.  A null stratum
is a stratum of its own.  Repeated rows are measured one by one.  Labels with a
null id or quality are ignored; of several labels of a document the lowest
quality counts.  Extra columns are carried, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bound_batches, claim, key_part, materialize, release, small

ALPHA = 0.02
DELTA = 0.05

#: rule: (numerator, denominator, +1 if it rejects above the cutoff and -1 if below, ladder from lenient to strict)
RULES: dict[str, tuple[str, str, int, tuple[float, ...]]] = {
    "symbols": ("n_symbols", "word_chars", 1, (0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05)),
    "repeats": ("n_repeat_words", "n_words", 1, (0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06)),
    "dup_lines": ("n_dup_lines", "n_lines", 1, (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "long_words": ("word_chars", "n_words", 1, (30.0, 24.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
    "short_words": ("word_chars", "n_words", -1, (1.0, 1.5, 2.0, 2.4, 2.7, 3.0, 3.2, 3.4)),
    "caps": ("n_upper", "word_chars", 1, (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
}

RUNGS = 8  # of each ladder
STEPS = RUNGS * len(RULES)  # of each chain
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
_SYMBOLS, _SPACES, _UPPER = b"#*$%&|<>", b" \t\n\x0b\x0c\r", bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that stand in a window of ``width`` words found at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    windows = lambda: zip(*(islice(words, i, None) for i in range(width)))
    if len(set(windows())) == n:
        return 0
    seen, twice = set(), set()
    for w in windows():
        (twice if w in seen else seen).add(w)
    covered, end = 0, 0
    for i, w in enumerate(windows()):
        if w in twice:
            covered += i + width - max(i, end)
            end = i + width
    return covered


def measure_text(text: bytes) -> tuple[int, ...]:
    """COUNTS of one UTF-8 text.  bytes.split() splits at exactly the six ASCII spaces."""
    words = text.split()
    chars = text.translate(None, _SPACES + _CONTINUATION)  # a code point has one byte that is no continuation
    lines = [x for x in text.split(b"\n") if x.strip()]
    count = lambda drop: len(chars) - len(chars.translate(None, drop))
    return (len(words), len(chars), count(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines), count(_UPPER))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("", lambda: None)
    for batch in batches:
        row = batch.column(0)
        text = row.field("tessera_text")
        found = [measure_text(t or b"") for t in text.cast(pa.large_binary()).to_pylist()]
        counts = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * len(COUNTS))]
        yield pa.RecordBatch.from_arrays([row, *counts], names=["row", *COUNTS])
    release()


def measure(docs: DataFrame, text_col: str = "text", carry: Column | None = None) -> DataFrame:
    """carry's struct (``row``) beside the COUNTS of the text."""
    bound_batches(docs.sparkSession)
    inner = F.struct(F.col(text_col).alias("tessera_text"), (carry if carry is not None else F.struct("*")).alias("kept"))
    rows = docs.select(inner.alias("row"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return rows.mapInArrow(_measure, schema).select(F.col("row.kept").alias("row"), *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _breaks(rule: str, cutoff: Column | float) -> Column:
    top, bottom, side, _ = RULES[rule]
    value = F.col(top) / F.greatest(F.col(bottom), F.lit(1))
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    return F.coalesce(value > cutoff if side > 0 else value < cutoff, F.lit(False))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed from its terms."""
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log(i)) for i in range(k + 1)))


def certified(n: int, rejected: list[int], ladder: tuple[float, ...], risk: float, level: float) -> float | None:
    """The strictest cutoff that fixed-sequence testing certifies, None if not even the first rung passes."""
    best = None
    for k, cutoff in zip(rejected, ladder, strict=True):
        if k >= risk * n or binomial_cdf(k, n, risk) > level:
            break
        best = cutoff
    return best


def _chain(start: int) -> list[str]:
    """The rules in the order of a chain."""
    return [*RULES][start:] + [*RULES][:start]


def _first_steps() -> Column:
    """For the chain of each rule, the first step that rejects the document, STEPS if none does."""
    kept = lambda r: lambda c: ~_breaks(r, c)
    # Ladders only grow stricter, so the rungs that do not reject come first.  Each part stands once in the plan, as the driver holds it.
    first = F.array(*(F.size(F.filter(F.array(*map(F.lit, x[3])), kept(r))) for r, x in RULES.items()))
    at = {r: i for i, r in enumerate(RULES)}
    step = lambda f, k, r: F.when(f[at[r]] < RUNGS, k * RUNGS + f[at[r]])
    chains = lambda f: F.array(*(F.coalesce(*(step(f, k, r) for k, r in enumerate(_chain(c))), F.lit(STEPS)) for c in range(len(RULES))))
    return F.transform(F.array(first), chains)[0]


def cutoffs_of(chain: int, step: int) -> dict[str, float]:
    """The cutoffs of a step of a chain; rules that it has not reached have none."""
    return {r: RULES[r][3][min(step - k * RUNGS, RUNGS - 1)] for k, r in enumerate(_chain(chain)) if step >= k * RUNGS}


def chosen(found: list[tuple[int, int, int, int]], risk: float, level: float) -> dict[str, float]:
    """The cutoffs of a stratum from its counts (chain, first step that rejects, good, bad); empty if nothing is certified."""
    best, n = None, sum(g for c, _, g, _ in found if c == 0)
    for chain in range(len(RULES)):
        upto = lambda k: [sum(x[k] for x in found if x[0] == chain and x[1] <= i) for i in range(STEPS)]  # noqa: B023, E731
        good, bad = upto(2), upto(3)
        last = certified(n, good, tuple(range(STEPS)), risk, level)
        for step in range(-1 if last is None else int(last) + 1):
            rank = (bad[step], step, -good[step], -chain)
            best = max(best or (rank, chain, step), (rank, chain, step))
    return cutoffs_of(*best[1:]) if best else {}


def calibrate(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Cutoffs for each stratum of stats(id, stratum, *COUNTS): one row (stratum, cut_<rule>...), null where none is certified.

    labels(id, quality) is the holdout; only its documents that pass the base
    rule count, good ones (quality 1) for certifying and the others for choosing
    among certified steps.  The result has one row per stratum with good labels.
    """
    labels = labels.where("id is not null and quality is not null").groupBy("id").agg(F.min("quality").alias("quality"))
    passed = stats.join(labels, "id").where(~base_failed()).select("stratum", (F.col("quality") == 1).cast("long").alias("good"), _first_steps().alias("steps"))
    steps = passed.select("stratum", "good", F.posexplode("steps").alias("chain", "step"))
    counts = steps.groupBy("stratum", "chain", "step").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    found = F.sort_array(F.collect_list(F.struct("chain", "step", "good", "bad"))).alias("found")
    counts = materialize(counts.groupBy("stratum").agg(found, F.sum("good").alias("n")).where("n > 0").drop("n"), "rule-counts")
    level = delta / (max(1, counts.count()) * len(RULES))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["stratum"]].copy()
            cuts = [chosen([tuple(x[c] for c in ("chain", "step", "good", "bad")) for x in found], alpha, level) for found in batch["found"]]
            for r in RULES:
                out[f"cut_{r}"] = pd.Series([c.get(r) for c in cuts], dtype="float64", index=out.index)
            yield out

    schema = T.StructType([counts.schema["stratum"], *(T.StructField(f"cut_{r}", T.DoubleType()) for r in RULES)])
    return materialize(counts.mapInPandas(decide, schema), "rule-cutoffs")


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """measured with base_failed, rules_broken (names, sorted) and kept.  cutoffs: as from calibrate()."""
    cuts = small(cutoffs)
    broken = F.array_compact(F.array(*(F.when(_breaks(r, F.col(f"cut_{r}")), F.lit(r)) for r in sorted(RULES))))
    return (measured.join(cuts, "stratum", "left").withColumns({"base_failed": base_failed(), "rules_broken": broken})
            .withColumn("kept", ~F.col("base_failed") & (F.size("rules_broken") == 0)).drop(*(f"cut_{r}" for r in RULES)))


def _stats(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    carry = F.struct(F.col(id_col).alias("id"), key_part(F.col(stratum_col)).alias("stratum"))
    return measure(docs, text_col, carry).select("row.id", "row.stratum", *COUNTS)


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                  alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per document: id, stratum, COUNTS, base_failed, rules_broken, kept.  The text is measured once and never shuffled."""
    stats = materialize(_stats(docs, id_col, text_col, stratum_col), "rule-stats")
    return judge(stats, calibrate(stats, labels, alpha, delta))


def filter_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                     alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of docs that the rules keep, with their own columns.

    Texts are measured twice, once to calibrate and once to filter: cheaper
    than a shuffle or a second copy of all texts.
    """
    cutoffs = calibrate(_stats(docs, id_col, text_col, stratum_col), labels, alpha, delta)
    carry = F.struct(F.struct("*").alias("doc"), key_part(F.col(stratum_col)).alias("stratum"))
    measured = measure(docs, text_col, carry).select(F.col("row.doc").alias("doc"), F.col("row.stratum").alias("stratum"), *COUNTS)
    return judge(measured, cutoffs).where("kept").select("doc.*")
