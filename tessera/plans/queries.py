"""Named queries, one or more for each operator of the inventory."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import address, text
from tessera.functions.constants import NAME_TOKENS
from tessera.functions.similarity import kernel_udf
from tessera.operators import blocking, capping, evaluation, features, model, retrieval
from tessera.operators.normalize import normalize
from tessera.plans import linkage
from tessera.sources import projection, tables

PAIR = evaluation.PAIR
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _sources(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three sources, normalised and written once; of the normalised columns only those named, if any is: the others are not made."""
    df = _normal(spark, sf_dir)
    df = tables.written(df.select("entity_id", "n", "country", *columns) if columns else df, "records")
    return tuple(df.where(F.col("n") == i) for i in range(3))


def _normal(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return normalize(projection.records(spark, sf_dir, whole).drop("text"))


def _both(spark: SparkSession, sf_dir: str, pairs: Callable[[DataFrame, DataFrame], DataFrame], *columns: str) -> DataFrame:
    """pairs(anchors, others) for each of the other sources, with the columns that it needs (all, if none is named)."""
    s1, s2, s3 = _sources(spark, sf_dir, *columns)
    return pairs(s1, s2).unionByName(pairs(s1, s3))


def _names(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return _normal(spark, sf_dir, whole).select("entity_id", "n", "country", "norm_name", "name_tokens")


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.truth_of(projection.records(spark, sf_dir))


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.records(spark, sf_dir).where("n = 0").select(F.col("entity_id").alias("source1_entity_id"))


def _overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-block pairs in both other sources with score: the token overlap, rounded."""
    s1, s2, s3 = _sources(spark, sf_dir)
    both = blocking.block(s1, s2, "token").unionByName(blocking.block(s1, s3, "token"))
    side = lambda df: df.select("entity_id", "name_tokens")
    pairs = features.with_sides(both, side(s1), side(s2.unionByName(s3)))
    return pairs.select(*PAIR, F.round(text.token_overlap(F.col("l.name_tokens"), F.col("r.name_tokens")), 6).alias("score"))


@query
def anchor_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: normalise, block on tokens with the guard, score by overlap, cap, and list the best per anchor record."""
    return tables.id_lists(_ids(spark, sf_dir), capping.cap_top(_overlap(spark, sf_dir), "score", 5), "candidate_entity_ids")


@query
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal(spark, sf_dir, whole=True).select("entity_id", "country", "norm_name", F.size("name_tokens").alias("n_tokens"), "has_devanagari")


@query
def normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(projection.records(spark, sf_dir)).select("entity_id", "norm_name", "norm_addr", "zip", "state", "city", "house_no")


@query
def name_tokens_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.keyed(_names(spark, sf_dir, whole=True), "token").withColumnRenamed("key", "token")


@query
def script_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = projection.records(spark, sf_dir, whole=True)
    return r.select("entity_id", text.has_devanagari(F.col("business_name")).alias("has_devanagari"), text.has_non_latin(F.col("business_name")).alias("has_non_latin"))


@query
def address_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = projection.addresses(spark, sf_dir).withColumn("clean", text.clean(F.col("address")))
    a = a.withColumn("norm_addr", address.norm_addr(F.col("clean")))
    return a.select("id", "norm_addr", address.postal(F.col("address"), F.col("country")).alias("zip"),
                    address.state(F.col("norm_addr"), F.col("country")).alias("state"), address.house_no(F.col("clean")).alias("house_no"))


@query
def address_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = projection.addresses(spark, sf_dir).withColumns({"clean": text.clean(F.col("address")), "parts": address.folded_segments(F.col("address"))})
    a = a.withColumn("state", address.state(address.norm_addr(F.col("clean")), F.col("country")))
    return a.select("id", "state", address.city(F.col("address"), F.col("parts"), F.col("state")).alias("city"))


@query
def soundex_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir, whole=True).select("entity_id", text.soundex_code(F.col("norm_name")).alias("code"))


@query
def part_name_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block statistics on part names, which repeat so often that the guard acts."""
    p = projection.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entity_id"), (F.col("p_partkey") % 2).alias("n"), F.lit("US").alias("country"),
        text.mapped_tokens(text.clean(F.col("p_name")), NAME_TOKENS).alias("name_tokens"))
    stats = blocking.block_stats(*(blocking.keyed(p.where(F.col("n") == i), "token") for i in (0, 1)))
    return stats.withColumnRenamed("key", "token").withColumn("safe", blocking.safe())


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-block statistics of the anchor source against each other one, over all words of the texts."""
    keys = tables.written(blocking.keyed(_names(spark, sf_dir, whole=True), "token"), "tokens")
    of = lambda i: keys.where(F.col("entity_id").startswith(f"S{i}-"))
    return reduce(DataFrame.unionByName, (blocking.block_stats(of(1), of(i)).withColumn("other", F.lit(f"S{i}")) for i in (2, 3)))


@query
def block_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).withColumnRenamed("key", "token")


@query
def block_guard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.guard_report(_stats(spark, sf_dir))


def _block(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _both(spark, sf_dir, lambda a, b: blocking.block(a, b, kind))


QUERIES |= {f"block_{k}": _block(k) for k in ("token", "zip", "city_first", "soundex")}


@query
def block_trigram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, blocking.block_trigram).withColumn("jaccard", F.round("jaccard", 6))


@query
def block_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, blocking.lexical_candidates)


def _token_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Token-block pairs, the anchor source and the other two together."""
    s1, s2, s3 = _sources(spark, sf_dir)
    return blocking.block(s1, s2, "token").unionByName(blocking.block(s1, s3, "token")), s1, s2.unionByName(s3)


@query
def native_pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features that are column expressions: overlaps, exact matches, n-gram cosines, phonetic match."""
    pairs, s1, others = _token_pairs(spark, sf_dir)
    df = features.with_sides(pairs, features.entity_side(s1), features.entity_side(others))
    return df.select(*PAIR, *(F.round(c, 6).alias(n) if "cosine" in n or n.endswith(("frac", "jaccard")) else c.cast("int").alias(n) for n, c in features.native_features().items()))


@query
def jaro_winkler(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, s1, others = _token_pairs(spark, sf_dir)
    score = kernel_udf("jaro_winkler")
    df = features.with_sides(pairs, s1.select("entity_id", "norm_name"), others.select("entity_id", "norm_name"))
    return df.select(*PAIR, F.round(score("l.norm_name", "r.norm_name")["jaro_winkler"], 6).alias("jaro_winkler"))


@query
def string_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratio, token-sort, token-set and partial ratio of the names."""
    names = ("ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio")
    pairs, s1, others = _token_pairs(spark, sf_dir)
    df = features.with_sides(pairs, s1.select("entity_id", "norm_name"), others.select("entity_id", "norm_name"))
    return df.withColumn("s", kernel_udf(*names)("l.norm_name", "r.norm_name")).select(*PAIR, *(F.round(f"s.{n}", 6).alias(n) for n in names))


@query
def quick_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.quick_score(*_token_pairs(spark, sf_dir)).select(*PAIR, F.round("_q", 6).alias("quick_score"))


@query
def pair_features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.pair_features(*_token_pairs(spark, sf_dir))


@query
def tfidf_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = retrieval.tfidf_vocabulary(_names(spark, sf_dir, whole=True).select(F.col("norm_name").alias("text")))
    return v.select("gram", "df", F.round("idf", 6).alias("idf"))


@query
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _names(spark, sf_dir)
    v = retrieval.tfidf_vocabulary(df.select(F.col("norm_name").alias("text")))
    return retrieval.tfidf_weights(df, v, "norm_name").withColumn("weight", F.round("weight", 6))


@query
def tfidf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1, s2, s3 = _sources(spark, sf_dir)
    pools = retrieval.tfidf_candidates(s1, [s2, s3], "norm_name")
    return pools[0].unionByName(pools[1]).withColumn("ann_score", F.round("ann_score", 6))


@query
def dual_pool_best_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and address pools, the best score of each pair."""
    s1, s2, s3 = _sources(spark, sf_dir, "norm_name", "norm_addr")
    names = retrieval.tfidf_candidates(s1, [s2, s3], "norm_name", top_k=30, min_score=0.2)
    addrs = retrieval.tfidf_candidates(s1, [s2, s3], "norm_addr", top_k=15, min_score=0.3)
    return retrieval.best_of(*names, *addrs).withColumn("ann_score", F.round("ann_score", 6))


@query
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vector whose id is divisible by 50, the nearest of all vectors of its country."""
    v = projection.vectors(spark, sf_dir)
    return retrieval.vector_top(v.where("vec_id % 50 = 0"), v, top_k=5)


@query
def embedding_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined and name retrieval with the default hashed vectors."""
    return _both(spark, sf_dir, lambda a, b: retrieval.embedding_candidates(a, b, top_k=5))


@query
def cap_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capping.cap_top(_overlap(spark, sf_dir), "score", 10)


@query
def cap_fair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical pairs by token overlap and trigram pairs by Jaccard as the second pool, with slots of their own."""
    s1, s2, s3 = _sources(spark, sf_dir)
    second = blocking.block_trigram(s1, s2).unionByName(blocking.block_trigram(s1, s3)).select(*PAIR, F.round("jaccard", 6).alias("ann_score"))
    return capping.cap_fair(_overlap(spark, sf_dir), second, "score", max_lexical=4, max_vector=2)


@query
def recall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = evaluation.recall_stats(_overlap(spark, sf_dir), _truth(spark, sf_dir))
    return r.withColumn("candidate_recall", F.round("candidate_recall", 6))


@query
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.recall_at_k(_overlap(spark, sf_dir), "score", _truth(spark, sf_dir), (1, 2, 5, 20)).withColumn("recall", F.round("recall", 6))


@query
def script_recall_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s1 = _normal(spark, sf_dir).where("n = 0")
    return evaluation.recall_by_script(_overlap(spark, sf_dir), _truth(spark, sf_dir), s1).withColumn("recall", F.round("recall", 6))


@query
def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _overlap(spark, sf_dir).where("score >= 0.5")
    return evaluation.macro_f05(pairs, _truth(spark, sf_dir), _ids(spark, sf_dir)).select(F.round("macro_f05", 6).alias("macro_f05"))


@query
def micro_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = evaluation.micro_prf(_overlap(spark, sf_dir).where("score >= 0.5"), _truth(spark, sf_dir), _ids(spark, sf_dir))
    return r.select("tp", "predicted", F.col("true").alias("true_matches"), *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = evaluation.threshold_curve(_overlap(spark, sf_dir), _truth(spark, sf_dir), _ids(spark, sf_dir))
    return curve.withColumn("f05", F.round("f05", 6))


@query
def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curve(spark, sf_dir)


@query
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.best_threshold(_curve(spark, sf_dir))


@query
def labeled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.labeled_pairs(_overlap(spark, sf_dir).select(*PAIR), _truth(spark, sf_dir), 5)


@query
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.label_distribution(labeled_pairs(spark, sf_dir))


@query
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.split_entities(_ids(spark, sf_dir))


@query
def smart_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = projection.records(spark, sf_dir).where("n = 1")
    keep = _truth(spark, sf_dir).select(F.col("other_entity_id").alias("entity_id"))
    return evaluation.smart_sample(r, keep, 60).select("entity_id", "country")


@query
def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.id_lists(_ids(spark, sf_dir), _truth(spark, sf_dir), "matched_entity_ids")


@query
def truth_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.explode_truth(truth_lists(spark, sf_dir))


@query
def id_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id lists written as TSV and read back with their lengths."""
    path = tables.scratch_path(spark, "id-lists")
    tables.write_id_lists(anchor_matches(spark, sf_dir), path)
    return tables.read_id_lists(spark, path, "candidate_entity_ids")


@query
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.dataset_stats(projection.records(spark, sf_dir).where("n = 0"), truth_lists(spark, sf_dir))


@query
def matched_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.matched_stats(_truth(spark, sf_dir)).select("matched_entities", F.round("avg_matches", 6).alias("avg_matches"))


@query
def routed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True matches by the source that their id names."""
    truth = _truth(spark, sf_dir)
    return reduce(DataFrame.unionByName, (tables.of_source(truth, i).groupBy().agg(F.lit(f"S{i}").alias("source"), F.count("*").alias("matches")) for i in (2, 3)))


@query
def recall_at_k_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall at caps of trigram and token candidates, ranked by the trigram score or, without one, a hundredth of the quick score (here 100 times the overlap)."""
    pairs = _overlap(spark, sf_dir).withColumn("_q", 100 * F.col("score")).drop("score")
    second = _both(spark, sf_dir, blocking.block_trigram).select(*PAIR, F.round("jaccard", 6).alias("ann_score"))
    scored = evaluation.fallback_score(pairs.join(second, PAIR, "left"))
    return evaluation.recall_at_k(scored, "ann_score", _truth(spark, sf_dir), (1, 2, 5, 20)).withColumn("recall", F.round("recall", 6))


@query
def output_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, ids = _overlap(spark, sf_dir), _ids(spark, sf_dir)
    lists = lambda p: tables.id_lists(ids, p, "ids")
    r = evaluation.output_report(lists(pairs.where("score >= 0.5")), lists(pairs), lists(_truth(spark, sf_dir)))
    return r.select(*(F.round(c, 6).alias(c) for c in ("avg_matches", "singleton_rate", "avg_candidates", "avg_true", "true_singleton_rate", "ratio")), "verdict", "few_singletons")


@query
def subset_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True matches that the capped candidates miss."""
    return evaluation.subset_violations(_truth(spark, sf_dir), capping.cap_top(_overlap(spark, sf_dir), "score", 1))


@query
def new_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.records(spark, sf_dir).select("country").distinct().where(~F.col("country").isin("US", "India", "UNK"))


@query
def referential_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates whose other id exists in the second source."""
    s2 = projection.records(spark, sf_dir).where("n = 1").select(F.col("entity_id").alias("other_entity_id"))
    return _overlap(spark, sf_dir).select(*PAIR).join(s2, "other_entity_id", "left_semi")


@query
def legacy_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pool of lexical and TF-IDF candidates for each other source, ranked by the cheap score."""
    def capped(a: DataFrame, b: DataFrame) -> DataFrame:
        pool = blocking.block(a, b, "token").union(retrieval.tfidf_candidates(a, [b], "norm_name")[0].select(*PAIR)).distinct()
        return capping.cap_top(features.quick_score(pool, a, b), "_q", 10)

    return _both(spark, sf_dir, capped, "norm_name", "name_tokens").select(*PAIR, F.round("_q", 6).alias("quick_score"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled features of token pairs in both sources; matches are equal texts.  Labels and negatives do not depend on features, so only the labelled pairs get them."""
    s1, s2, s3 = _sources(spark, sf_dir)
    others = s2.unionByName(s3)
    pairs = blocking.meetings(s1, s2, "token").unionByName(blocking.meetings(s1, s3, "token"))
    chosen = evaluation.labeled_pairs(pairs, _truth(spark, sf_dir)).join(evaluation.split_entities(_ids(spark, sf_dir)), "source1_entity_id")
    return tables.written(features.pair_features(tables.written(chosen, "chosen"), s1, others), "labelled")


@query
def gbdt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = _quality(spark, sf_dir)
    return model.predict(model.train(labeled, rounds=8, depth=3, validation="is_val"), labeled).select(*PAIR, "label", "score")


@query
def gbdt_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = _quality(spark, sf_dir)
    return model.importances(spark, model.train(labeled, rounds=8, depth=3))


@query
def ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = _quality(spark, sf_dir)
    models = [model.train(labeled, rounds=6, depth=3), model.train(labeled, kind="forest", rounds=10, depth=7)]
    return model.predict_mean(models, labeled).select(*PAIR, "label", "score")


@query
def end_to_end_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and inference over the three sources: one row per anchor record with its matches."""
    stages = tables.Checkpoints(spark, tables.scratch_path(spark, "linkage"))
    r = projection.records(spark, sf_dir).drop("text")
    sources = [r.where(F.col("n") == i).drop("n") for i in range(3)]
    cfg = linkage.Config(vectors=False, rounds=8, depth=3, max_lexical=10)
    models, threshold = linkage.train(spark, sources, _truth(spark, sf_dir), cfg, stages)
    return linkage.infer(sources, models, threshold, cfg, stages, trained=True)[1]
