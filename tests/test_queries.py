"""Every query against its SQL, and invariants of those without."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.plans.oracle import ORACLE
from tessera.plans.queries import QUERIES
from tessera.operators import blocking, evaluation, retrieval
from tessera.plans import linkage
from tessera.sources import projection, tables

SF = "/root/testdata/sf0.001"
TABLES = "customer documents embeddings labels part".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canon(rows):
    plain = lambda v: "" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(plain(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert canon(got.select(*columns).collect()) == canon(want)


def test_every_query_is_listed():
    rows_only = {"string_ratios", "quick_score", "pair_features_full", "embedding_candidates", "legacy_pool", "gbdt_scores", "gbdt_importances",
                 "ensemble_scores", "end_to_end_matches"}
    assert set(QUERIES) == set(ORACLE) | rows_only


def test_scores_lie_in_range(spark):
    r = QUERIES["string_ratios"](spark, SF).selectExpr("min(least(ratio, token_sort_ratio, token_set_ratio, partial_ratio))", "max(greatest(ratio, token_set_ratio))").first()
    assert 0 <= r[0] and r[1] <= 1
    full = QUERIES["pair_features_full"](spark, SF)
    assert full.columns[2:] == linkage.features.FEATURES and full.dropna().count() == full.count()


@pytest.mark.parametrize("name", ["string_ratios", "quick_score", "pair_features_full", "embedding_candidates", "legacy_pool"])
def test_both_other_sources_take_part(spark, name):
    found = QUERIES[name](spark, SF).selectExpr("substr(other_entity_id, 1, 3) AS s").distinct().collect()
    assert {r.s for r in found} == {"S2-", "S3-"}


def test_all_importances_are_listed(spark):
    assert QUERIES["gbdt_importances"](spark, SF).count() == len(linkage.features.FEATURES)


def test_linkage_end_to_end(spark, tmp_path):
    rows = projection.records(spark, SF)
    truth = projection.truth_of(rows)
    sources = [rows.where(f"n = {i}").drop("n", "text") for i in range(3)]
    cfg = linkage.Config(vectors=True, rounds=3, depth=2, max_lexical=5, max_vector=3, top_k=3, ensemble=True)
    stages = tables.Checkpoints(spark, f"file://{tmp_path}/stages")
    models, threshold = linkage.train(spark, sources, truth, cfg, stages)
    assert stages.has("train-features") and len(models) == 2 and 0 < threshold < 1
    found, matched = linkage.infer(sources, models, threshold, cfg, stages)
    assert found.count() == matched.count() == sources[0].count()
    pairs = lambda df, c: df.select("source1_entity_id", tables.parse_ids(df[c]).alias("ids"))
    both = pairs(matched, "matched_entity_ids").alias("m").join(pairs(found, "candidate_entity_ids").alias("c"), "source1_entity_id")
    assert both.where("size(array_except(m.ids, c.ids)) > 0 or size(c.ids) > 16").count() == 0
    tables.write_id_lists(matched, f"file://{tmp_path}/out")
    assert tables.read_id_lists(spark, f"file://{tmp_path}/out", "matched_entity_ids").count() == matched.count()
    again, same = linkage.train(spark, sources, truth, cfg, stages)  # every stage is found
    assert same == threshold


def test_vectors_with_nulls(spark):
    """Rows without a whole vector take no part, and do not shift the others."""
    schema = "entity_id string, country string, vector array<double>"
    a = spark.createDataFrame([("q1", "x", [1.0, 0.0]), ("q2", "x", None), ("q3", "x", []), ("q4", "y", [0.0, 1.0]), (None, "x", [1.0, 1.0]), ("q5", "x", [0.0, None])], schema)
    b = spark.createDataFrame([("n", "x", None), ("a", "x", [1.0, 0.0]), ("m", "x", []), ("b", "x", [0.0, 1.0]), ("z", "z", [1.0, 0.0])], schema).coalesce(1)
    assert sorted(map(tuple, retrieval.vector_top(a, b, top_k=3).collect())) == [("q1", "a", 1.0), ("q1", "b", 0.0)]
    assert retrieval.vector_top(a.limit(0), b).count() == 0


def test_tfidf_against_all_pairs(spark):
    """No pair is lost, at low and high scores."""
    pick = random.Random(3)
    words = [f"{pick.choice('abc')}{pick.choice('xyz')}{i % 30}" for i in range(60)]
    rows = [(f"S{1 + i % 2}-{i}", i % 2, "c" if i % 5 else "d", " ".join(pick.choice(words) for _ in range(pick.randint(0, 6)))) for i in range(120)]
    df = spark.createDataFrame(rows, "entity_id string, n int, country string, t string")
    s1, s2 = df.where("n = 0"), df.where("n = 1")
    vocabulary = retrieval.tfidf_vocabulary(df.select(df.t.alias("text")))
    w = {}
    for r in retrieval.tfidf_weights(df, vocabulary, "t").collect():
        w.setdefault((r.entity_id, r.country), {})[r.gram] = r.weight
    for least in (0.05, 0.2, 0.7):
        want = {}
        for (a, c), x in w.items():
            for (b, d), y in w.items():
                score = round(sum(v * y.get(g, 0.0) for g, v in x.items()), 9)
                if a[:2] == "S1" and b[:2] == "S2" and c == d and score >= least:
                    want[a, b] = score
        got = {(r[0], r[1]): r[2] for r in retrieval.tfidf_candidates(s1, [s2], "t", top_k=1000, min_score=least)[0].collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 2e-9 for k in got) and got


def test_embedding_hook(spark):
    """An embedding learns which side it encodes; vectors may also come from a column."""
    seen = []

    def embed(df, text, side):
        seen.append(side)
        return retrieval.hashed_vectors(df, text, side)

    schema = "entity_id string, country string, norm_name string, norm_addr string, vec array<double>"
    a, b = spark.createDataFrame([("S1-1", "x", "red fox", "", [1.0, 0.0])], schema), spark.createDataFrame([("S2-1", "x", "red fox", "", [0.6, 0.8])], schema)
    assert retrieval.embedding_candidates(a, b, embed=embed, name=False).first().ann_score == 1.0 and seen == ["query", "passage"]
    assert 0 < retrieval.embedding_candidates(a, b, embed=retrieval.prefixed(embed, retrieval.PREFIXES), name=False).first().ann_score < 1
    cfg = linkage.Config(embed="column:vec")
    assert retrieval.embedding_candidates(a, b, embed=linkage.embedding(cfg)).first().ann_score == 0.6
    assert linkage.embedding(linkage.Config(embed="tessera.operators.retrieval:hashed_vectors")) is retrieval.hashed_vectors


def test_block_guard_is_optional(spark):
    schema = "entity_id string, country string, zip string, city string, name_tokens array<string>, norm_name string"
    side = lambda n: spark.createDataFrame([(f"S{n}-{i}", "US", "00001" if i < 4 else f"{i:05d}", None, [], "") for i in range(6)], schema)
    assert blocking.block(side(1), side(2), "zip").count() == 18
    assert blocking.block(side(1), side(2), "zip", guard=True, max_pairs=9).count() == 2


def test_command_line(spark, tmp_path):
    """train and infer over files: reports, importances, models from another folder, stages by configuration."""
    rows = projection.records(spark, SF)
    for split in ("train", "test"):
        for i in range(3):
            part = rows.where(f"n = {i}").select("entity_id", "business_name", "business_address", "country").toPandas()
            part.to_csv(tmp_path / f"{split}_source{i + 1}.tsv", sep="\t", index=False)
    truth = projection.truth_of(rows).toPandas().groupby("source1_entity_id")["other_entity_id"].agg(",".join).reset_index(name="matched_entity_ids")
    truth.to_csv(tmp_path / "train_ground_truth.tsv", sep="\t", index=False)
    common = ["--data-dir", f"file://{tmp_path}", "--out-dir", f"file://{tmp_path}/out", "--rounds", "2", "--depth", "2", "--max-lexical", "4", "--min-rows", "2"]
    linkage.main(["train", *common])
    folder = next((tmp_path / "out/stages").iterdir())
    assert {"train-recall-at-k", "train-stats", "train-countries", "train-matched"} <= {p.name for p in folder.iterdir()} and (folder / "model0/_DONE").exists()
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out/importances").count() == len(linkage.features.FEATURES) + 2
    linkage.main(["infer", *common, "--threshold", "0.5"])
    assert spark.read.json(f"file://{tmp_path}/out/infer-report").first().verdict in ("too many", "too few", "in range")
    linkage.main(["infer", *common, "--threshold", "0.5", "--max-lexical", "3", "--model-dir", f"file://{folder}"])
    assert len([*(tmp_path / "out/stages").iterdir()]) == 2
    assert tables.read_id_lists(spark, f"file://{tmp_path}/out/matching_results", "matched_entity_ids").count() == rows.where("n = 0").count()


def test_sources(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA\t\tUS\nS1-2\tn\"x\ta, b\t\n")
    rows = tables.read_records(spark, f"file://{tmp_path}/a.tsv").collect()
    assert [tuple(r) for r in rows] == [("S1-1", "NA", None, "US"), ("S1-2", 'n"x', "a, b", None)]
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2,S2-1\nS1-2\t\n")
    truth = tables.read_truth(spark, f"file://{tmp_path}/t.tsv")
    assert truth.count() == 2
    assert sorted(map(tuple, tables.explode_truth(truth).collect())) == [("S1-1", "S2-1"), ("S1-1", "S3-2")]


def test_tfidf_in_chunks(spark):
    """Chunks of a few rows give the best of all, ties and copies by id, as all pairs do."""
    pick = random.Random(9)
    texts = ["".join(pick.choice("ab ") for _ in range(pick.randint(0, 12))) for _ in range(25)]
    rows = [(f"S{1 + i % 2}-{i}", i % 2, "c" if i % 7 else "d", pick.choice(texts)) for i in range(150)]
    df = spark.createDataFrame(rows, "entity_id string, n int, country string, t string")
    vocabulary = retrieval.tfidf_vocabulary(df.select(df.t.alias("text"))).withColumn("id", retrieval.F.monotonically_increasing_id()).cache()
    sides = [retrieval.packed(retrieval.tfidf_weights(df.where(f"n = {i}"), vocabulary, "t", key="id")) for i in (0, 1)]
    a, b = ([(r.entity_id, r.country, dict(zip(r.grams, r.weights, strict=True))) for r in s.collect()] for s in sides)
    want = []
    for i, c, x in a:
        found = [(-round(sum(v * y.get(g, 0.0) for g, v in x.items()), 9), j) for j, d, y in b if c == d]
        want += [(i, j) for v, j in sorted(f for f in found if -f[0] >= 0.2)[:4]]
    for chunk in (7, 1000):
        got = retrieval.tfidf_top(*sides, top_k=4, min_score=0.2, chunk=chunk).collect()
        assert len(want) > 100 and sorted((r[0], r[1]) for r in got) == sorted(want)


def test_packed_weights(spark, monkeypatch):
    """As packed(tfidf_weights()), also of ids that stand in two countries, null ids and countries, and with a vocabulary too large for a broadcast; no gram rows are shuffled otherwise."""
    pick = random.Random(5)
    rows = [(pick.choice([None, *(f"S1-{i}" for i in range(20))]), pick.choice(["c", "d", None]), pick.choice([None, "", "zz top zz", "a", "ab ba abba", "qqq"]) ) for _ in range(80)]
    df = spark.createDataFrame(rows, "entity_id string, country string, t string")
    vocabulary = tables.written(retrieval.tfidf_vocabulary(df.select(df.t.alias("text")), min_df=1, max_df=0.9).withColumn("id", retrieval.F.monotonically_increasing_id()), "v")
    flat = lambda d: sorted((str(r.entity_id), str(r.country), list(r.grams), [round(w, 9) for w in r.weights]) for r in d.collect())
    want = flat(retrieval.packed(retrieval.tfidf_weights(df, vocabulary, "t", key="id")))
    got = retrieval.packed_weights(df, vocabulary, "t")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(want) > 30 and flat(got) == want and "SortMergeJoin" not in plan
    monkeypatch.setattr(retrieval, "BROADCAST_GRAMS", 0)
    assert flat(retrieval.packed_weights(df, vocabulary, "t")) == want


def test_pool_makes_only_what_it_reads(spark, monkeypatch):
    """The pool of names parses no addresses."""
    from tessera.plans import queries

    seen, written = {}, tables.written
    monkeypatch.setattr(queries.tables, "written", lambda df, name: seen.setdefault(name, df.columns) and written(df, name))
    assert QUERIES["legacy_pool"](spark, SF).count()
    assert seen["records"] == ["entity_id", "n", "country", "norm_name", "name_tokens"]


def test_vectors_in_chunks(spark):
    """As all pairs: copies and ties by id, chunks and blocks of a few rows."""
    pick = random.Random(8)
    vectors = [[pick.choice([0.0, 0.6, 0.8, -1.0]) for _ in range(3)] for _ in range(30)]
    rows = [(f"V{i:03d}", "c" if i % 9 else "d", pick.choice(vectors)) for i in range(200)]
    df = spark.createDataFrame(rows, "entity_id string, country string, vector array<double>")
    want = []
    for i, c, x in rows[:60]:
        found = sorted((-round(sum(v * w for v, w in zip(x, y, strict=True)), 6) + 0.0, j) for j, d, y in rows if c == d)[:5]
        want += [(i, j, -v) for v, j in found]
    for chunk, block in ((11, 4), (1000, 1000)):
        got = retrieval.vector_top(df.where("entity_id < 'V060'"), df, top_k=5, chunk=chunk, block=block).collect()
        assert sorted((r[0], r[1], round(r[2] + 0.0, 6)) for r in got) == sorted((i, j, v + 0.0) for i, j, v in want)


def test_training_features_are_of_labelled_pairs(spark, monkeypatch):
    """Pairs that training leaves out get no features; those that it takes have the same as all pairs have."""
    from tessera.plans import queries

    seen, made = [], queries.features.pair_features
    monkeypatch.setattr(queries.features, "pair_features", lambda pairs, *sides: seen.append(pairs) or made(pairs, *sides))
    labelled = queries._quality(spark, SF)
    assert "label" in seen[0].columns and labelled.count() == seen[0].count()
    every = QUERIES["pair_features_full"](spark, SF)
    assert labelled.select(every.columns).exceptAll(every).count() == 0


def test_gram_features_are_the_expressions(spark):
    """The features that come from strings in tiles equal the column expressions."""
    names = {"name_char_3gram_cosine", "name_char_4gram_cosine", "addr_char_3gram_cosine", "name_trigram_jaccard"}
    columns = ["source1_entity_id", "other_entity_id", *sorted(names)]
    got, want = (QUERIES[q](spark, SF).select(columns[:2] + [retrieval.F.round(c, 6).alias(c) for c in columns[2:]]) for q in ("pair_features_full", "native_pair_features"))
    assert canon(got.collect()) == canon(want.collect())


def test_bare_pairs_are_labelled_in_one_shuffle(spark):
    """Pairs that repeat count once, and go by entity only once: not again for their labels and their order."""
    pairs = spark.createDataFrame([("S1-1", f"S2-{i % 7}") for i in range(40)] + [("S1-2", "S3-1"), ("S1-2", "S3-1")], evaluation.PAIR)
    truth = spark.createDataFrame([("S1-1", "S2-3"), ("S1-2", "S3-9")], evaluation.PAIR)
    got = evaluation.labeled_pairs(pairs, truth, 4)
    want = evaluation.labeled_pairs(pairs.distinct().withColumn("x", F.lit(1)), truth, 4).drop("x")
    assert canon(got.select(*want.columns).collect()) == canon(want.collect()) and got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_best_of_blocks_are_those_of_all_pairs(spark, monkeypatch):
    """Postal codes that many records share: the capped candidates are those of all pairs, without the pairs being made."""
    rows = projection.records(spark, SF).drop("text").withColumn("business_address", F.lit("1 Main St, Boone, NC 28607"))
    s1, s2 = (tables.written(linkage.normalize(rows.where(f"n = {i}")), "records") for i in (0, 1))
    monkeypatch.setattr(blocking, "MEETING", 7)
    best = blocking.best_of_blocks(s1, s2, "zip", 4)
    every = linkage.features.quick_score(blocking.block(s1, s2, "zip"), s1, s2)
    want = linkage.cap_top(every, "_q", 4).select(*evaluation.PAIR)
    assert canon(best.collect()) == canon(want.collect()) and best.count() < every.count()
    got = linkage.candidates(s1, s2, linkage.Config(vectors=False, max_lexical=4)).select(*evaluation.PAIR)
    pool = linkage.features.quick_score(blocking.lexical_candidates(s1, s2), s1, s2)
    assert canon(got.collect()) == canon(linkage.cap_top(pool, "_q", 4).select(*evaluation.PAIR).collect())


def test_inference_takes_what_training_made(spark, monkeypatch):
    """One run over the same sources plans and makes records and features once, each source's candidates by themselves."""
    made, put = [], tables.Checkpoints.put
    monkeypatch.setattr(tables.Checkpoints, "put", lambda self, stage, df: made.append(stage) or put(self, stage, df))
    assert QUERIES["end_to_end_matches"](spark, SF).count()
    assert {"train-candidates2", "train-candidates3", "train-features"} <= set(made) and not {"infer-source1", "infer-features"} & set(made)


def test_pair_features_need_one_worker_for_a_task(spark):
    """All scores of a pair come from one UDF; several would keep a Python worker each."""
    s1, s2 = (linkage.normalize(projection.records(spark, SF).where(f"n = {i}").drop("text")) for i in (0, 1))
    pairs = spark.createDataFrame([("S1-1", "S2-2")], "source1_entity_id string, other_entity_id string")
    plan = linkage.features.pair_features(pairs, tables.written(s1, "records"), tables.written(s2, "records"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_blockers_are_planned_one_at_a_time(spark, tmp_path, monkeypatch):
    """Candidates are made of each blocker's written pairs, the driver rests after each, and the pairs go; the candidates are those of one plan."""
    rows = projection.records(spark, SF).drop("text")
    s1, s2 = (tables.written(linkage.normalize(rows.where(f"n = {i}")), "records") for i in (0, 1))
    cfg, rested, plans, put = linkage.Config(vectors=False, max_lexical=4), [], {}, tables.Checkpoints.put
    monkeypatch.setattr(tables.Checkpoints, "put", lambda self, stage, df: plans.update({stage: df._jdf.queryExecution().executedPlan().toString().count("Exchange")}) or put(self, stage, df))
    monkeypatch.setattr(tables, "rest", lambda *a: rested.append(a[1:]))
    stages = tables.Checkpoints(spark, f"file://{tmp_path}/stages")
    linkage.featured(s1, [s2], cfg, stages, "t")
    parts = [f"t-{k}2" for k in blocking.KINDS]
    assert list(plans) == [*parts, "t-candidates2"] and len(rested) == 6 and rested[-1] == (True,)
    assert not any(map(stages.has, parts))
    whole = linkage.candidates(s1, s2, cfg)
    assert max(plans.values()) < whole._jdf.queryExecution().executedPlan().toString().count("Exchange") / 2
    assert canon(stages.get("t-candidates2").select(*evaluation.PAIR).collect()) == canon(whole.select(*evaluation.PAIR).collect())
