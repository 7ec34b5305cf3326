"""Labels, splits and samples; macro F0.5, thresholds, candidate recall; output checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.constants import MAX_NEGATIVES, SEED
from tessera.sources.tables import parse_ids

PAIR = ["source1_entity_id", "other_entity_id"]
#: 0.05 to 0.95 by 0.02.
THRESHOLDS = [round(0.05 + 0.02 * i, 2) for i in range(46)]


def hashed(*parts: Column, seed: int = SEED) -> Column:
    """A pseudo-random order that any SQL engine can reproduce."""
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 where truth(pair) has it."""
    return pairs.join(truth.select(*PAIR, F.lit(1).alias("label")).distinct(), PAIR, "left").withColumn("label", F.coalesce("label", F.lit(0)))


def labeled_pairs(pairs: DataFrame, truth: DataFrame, max_negatives: int = MAX_NEGATIVES, seed: int = SEED) -> DataFrame:
    """All positives, and per entity at most max_negatives negatives in hash order.  Bare pairs may repeat and count once."""
    order = Window.partitionBy("source1_entity_id", "label").orderBy(hashed(*map(F.col, PAIR), seed=seed), "other_entity_id")
    if sorted(pairs.columns) == sorted(PAIR):  # one shuffle, by entity, for all that follows
        both = pairs.select(*PAIR, F.lit(0).alias("label"), F.lit(1).alias("_p")).unionByName(truth.select(*PAIR, F.lit(1).alias("label"), F.lit(0).alias("_p")))
        rows = both.repartition("source1_entity_id").groupBy(*PAIR).agg(F.max("label").alias("label"), F.max("_p").alias("_p")).where("_p = 1").drop("_p")
    else:
        rows = label(pairs, truth)
    rows = rows.withColumn("_r", F.row_number().over(order))
    return rows.where((F.col("label") == 1) | (F.col("_r") <= max_negatives)).drop("_r")


def split_entities(ids: DataFrame, val_frac: float = 0.15, seed: int = SEED) -> DataFrame:
    """Distinct source1_entity_id with is_val: exactly floor(n * val_frac) of them, lowest hash first."""
    ids = ids.select("source1_entity_id").distinct().withColumn("_h", hashed(F.col("source1_entity_id"), seed=seed))
    n_val = int(ids.count() * val_frac)
    if not n_val:
        return ids.select("source1_entity_id", F.lit(False).alias("is_val"))
    # A limit keeps n_val rows per task at most; no task sorts all ids.
    chosen = ids.orderBy("_h", "source1_entity_id").limit(n_val).select("source1_entity_id", F.lit(True).alias("is_val"))
    return ids.select("source1_entity_id").join(chosen, "source1_entity_id", "left").withColumn("is_val", F.coalesce("is_val", F.lit(False)))


def smart_sample(records: DataFrame, keep: DataFrame, cap: int, seed: int = SEED) -> DataFrame:
    """All records named in keep(entity_id), and others in hash order up to cap rows in all."""
    must = records.join(keep.select("entity_id").distinct(), "entity_id", "left_semi")
    rest = records.join(keep.select("entity_id").distinct(), "entity_id", "left_anti")
    room = max(0, cap - must.count())
    return must.unionByName(rest.orderBy(hashed(F.col("entity_id"), seed=seed), "entity_id").limit(room))


def f05(tp: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of one entity; 1 if nothing is predicted and nothing true, 0 if only one of them is empty."""
    p, r = tp / predicted, tp / true
    return (F.when((predicted == 0) & (true == 0), 1.0).when((predicted == 0) | (true == 0) | (tp == 0), 0.0)
            .otherwise(1.25 * p * r / (0.25 * p + r)))


def _per_entity(pairs: DataFrame, truth: DataFrame, ids: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """One row per id with true and sums over its pairs (column label tells hits)."""
    true = truth.select(*PAIR).distinct().groupBy("source1_entity_id").agg(F.count("*").alias("true"))
    got = label(pairs, truth).groupBy("source1_entity_id").agg(*(c.alias(n) for n, c in sums.items()))
    return ids.select("source1_entity_id").distinct().join(true, "source1_entity_id", "left").join(got, "source1_entity_id", "left").na.fill(0)


def macro_f05(pairs: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """One row (macro_f05); 0 for no ids."""
    rows = _per_entity(pairs.select(*PAIR).distinct(), truth, ids, {"tp": F.sum("label"), "predicted": F.count("*")})
    return rows.agg(F.coalesce(F.avg(f05(F.col("tp"), F.col("predicted"), F.col("true"))), F.lit(0.0)).alias("macro_f05"))


def micro_prf(pairs: DataFrame, truth: DataFrame, ids: DataFrame) -> DataFrame:
    """One row (tp, predicted, true, precision, recall, f1)."""
    rows = _per_entity(pairs.select(*PAIR).distinct(), truth, ids, {"tp": F.sum("label"), "predicted": F.count("*")})
    total = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "predicted", "true")))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    total = total.withColumns({"precision": share(F.col("tp"), F.col("predicted")), "recall": share(F.col("tp"), F.col("true"))})
    return total.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def threshold_curve(scored: DataFrame, truth: DataFrame, ids: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """(threshold, f05): macro F0.5 at each threshold, in one pass over scored(pair, score)."""
    ts = THRESHOLDS if thresholds is None else thresholds
    sums = {}
    for i, t in enumerate(ts):
        over = (F.col("score") >= t).cast("long")
        sums |= {f"p{i}": F.sum(over), f"h{i}": F.sum(over * F.col("label"))}
    rows = _per_entity(scored, truth, ids, sums)
    one = rows.agg(*(F.avg(f05(F.col(f"h{i}"), F.col(f"p{i}"), F.col("true"))).alias(f"f{i}") for i in range(len(ts))))
    return one.select(F.explode(F.array(*(F.struct(F.lit(float(t)).alias("threshold"), F.col(f"f{i}").alias("f05")) for i, t in enumerate(ts)))).alias("x")).select("x.*")


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row with the highest f05, the lowest threshold on ties."""
    return curve.orderBy(F.desc("f05"), "threshold").limit(1)


def recall_stats(pairs: DataFrame, truth: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row: how much of the truth the candidates hold.  Entities without matches are left out."""
    truth = truth.select(*PAIR).distinct()
    truth = truth if ids is None else truth.join(ids.select("source1_entity_id").distinct(), "source1_entity_id", "left_semi")
    found = truth.join(pairs.select(*PAIR, F.lit(1).alias("hit")).distinct(), PAIR, "left")
    rows = found.groupBy("source1_entity_id").agg(F.count("*").alias("true"), F.count("hit").alias("found"))
    total = rows.agg(F.coalesce(F.sum("found"), F.lit(0)).alias("found_matches"), F.coalesce(F.sum("true"), F.lit(0)).alias("total_true_matches"),
                     F.count("*").alias("entities_with_matches"), F.count_if(F.col("found") == F.col("true")).alias("entities_fully_recalled"),
                     F.count_if(F.col("found") < F.col("true")).alias("entities_with_missed"))
    total = total.join(F.broadcast(pairs.agg(F.count("*").alias("total_candidates"))))  # one row each
    return total.withColumn("candidate_recall", F.when(F.col("total_true_matches") > 0, F.col("found_matches") / F.col("total_true_matches")).otherwise(0.0))


def recall_at_k(pairs: DataFrame, score: str, truth: DataFrame, ks: tuple[int, ...] = (20, 50, 100, 200, 500)) -> DataFrame:
    """(k, candidates, found, total, recall) for each cap, k null for all candidates; one ranking serves all caps."""
    order = Window.partitionBy("source1_entity_id").orderBy(F.desc_nulls_last(score), "other_entity_id")
    ranked = label(pairs, truth).withColumn("_r", F.row_number().over(order))
    caps = [None, *sorted(ks)]
    inside = lambda k: F.lit(1) if k is None else (F.col("_r") <= k).cast("int")
    sums = [F.coalesce(F.sum(inside(k)), F.lit(0)).alias(f"n{i}") for i, k in enumerate(caps)]
    sums += [F.coalesce(F.sum(inside(k) * F.col("label")), F.lit(0)).alias(f"h{i}") for i, k in enumerate(caps)]
    one = ranked.agg(*sums).join(F.broadcast(truth.select(*PAIR).distinct().agg(F.count("*").alias("total"))))
    rows = [F.struct(F.lit(k).cast("int").alias("k"), F.col(f"n{i}").alias("candidates"), F.col(f"h{i}").alias("found"), F.col("total").alias("total"),
                     F.when(F.col("total") > 0, F.col(f"h{i}") / F.col("total")).otherwise(0.0).alias("recall")) for i, k in enumerate(caps)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def recall_by_script(pairs: DataFrame, truth: DataFrame, s1: DataFrame) -> DataFrame:
    """(has_devanagari, found, total, recall) over the truth of each kind of name."""
    kinds = s1.select(F.col("entity_id").alias("source1_entity_id"), "has_devanagari")
    found = truth.select(*PAIR).distinct().join(kinds, "source1_entity_id").join(pairs.select(*PAIR, F.lit(1).alias("hit")).distinct(), PAIR, "left")
    return found.groupBy("has_devanagari").agg(F.count("hit").alias("found"), F.count("*").alias("total")).withColumn("recall", F.col("found") / F.col("total"))


def fallback_score(pairs: DataFrame) -> DataFrame:
    """pairs with ann_score, where it is missing a hundredth of the quick score."""
    return pairs.withColumn("ann_score", F.coalesce("ann_score", F.col("_q") / 100))


def dataset_stats(s1: DataFrame, truth_lists: DataFrame) -> DataFrame:
    """(country, entities, singletons, matches) of s1 against truth_lists(source1_entity_id, matched_entity_ids)."""
    n = truth_lists.select("source1_entity_id", F.size(parse_ids(F.col("matched_entity_ids"))).alias("n"))
    rows = s1.select("country", F.col("entity_id").alias("source1_entity_id")).join(n, "source1_entity_id", "left").na.fill(0, ["n"])
    return rows.groupBy("country").agg(F.count("*").alias("entities"), F.sum((F.col("n") == 0).cast("long")).alias("singletons"), F.sum("n").alias("matches"))


def matched_stats(truth: DataFrame) -> DataFrame:
    """One row: the S1 entities that have matches, and their mean number of them (0 if none has)."""
    n = truth.select(*PAIR).distinct().groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("matched_entities"), F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_matches"))


def label_distribution(labeled: DataFrame) -> DataFrame:
    return labeled.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("label"), F.lit(0)).alias("positives"),
                       F.coalesce(F.sum(1 - F.col("label")), F.lit(0)).alias("negatives"))


def output_report(matches: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """One row on id lists (source1_entity_id, ids): mean lengths, singleton rates, ratio to the truth, and the verdicts."""
    n = lambda df: df.select(F.size(parse_ids(F.col("ids"))).alias("n"))
    mean = lambda df, name, rate: n(df).agg(F.avg("n").alias(name), F.avg((F.col("n") == 0).cast("double")).alias(rate))
    one = mean(matches, "avg_matches", "singleton_rate").join(F.broadcast(mean(candidates, "avg_candidates", "_c"))).join(F.broadcast(mean(truth, "avg_true", "true_singleton_rate")))
    ratio = F.when(F.col("avg_true") > 0, F.col("avg_matches") / F.col("avg_true"))
    return one.drop("_c").withColumns({"ratio": ratio, "verdict": F.when(ratio > 1.5, "too many").when(ratio < 0.6, "too few").otherwise("in range"),
                                       "few_singletons": F.col("singleton_rate") < 0.02})


def subset_violations(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs that are matched without being candidates."""
    return matches.select(*PAIR).join(candidates.select(*PAIR), PAIR, "left_anti")
