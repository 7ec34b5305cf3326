"""License scan by diagonal voting (operator 5).

Native: DataFrame functions only.

Words are runs of [0-9a-z] and non-ASCII characters after A-Z is lower-cased.
The hashes of all rolling word pairs of a document are joined with the places of
the same pairs in the templates (fixed phrases, notices and whole license texts, some 1,500 rows, broadcast).
A hit votes for the diagonal ``document place - template place``.  A phrase
stands where all its pairs vote for one diagonal.  For notices and texts, diagonals of at least ``MIN_VOTES``
votes at most ``MAX_DRIFT`` apart (words left out or put in) are merged.  Of a merged run, read in the
order of the document, a hit counts if its template place is beyond all before it: the hits that count are
distinct places in the template's order, and their share of its pairs must reach
``MIN_SHARE``.  Votes are made once and written.  Every span is then verified on the document's own words.

Cases: null or empty text has no words and no labels; score 0.  Rows that repeat an
id with the same text are one document, scanned once, and all of them get its result; rows that
repeat an id with other texts are scanned apart.  A null id is an id of its own.  Extra columns do not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, small
from tessera.llm.license_texts import BASE, COMMON, PHRASES, TEXTS

MAX_DRIFT, MIN_VOTES = 3, 2
MIN_SHARE = 0.6


def _template(i: int, label: str, text: str) -> tuple[int, str, list[str], bool, bool]:
    """(number, label, words, whether it must stand word for word, whether it is a base phrase)."""
    return i, label, re.findall("[0-9a-z]+", text.lower()), i < len(BASE) + len(PHRASES), i < len(BASE)


TEMPLATES = [_template(i, *x) for i, x in enumerate(BASE + PHRASES + TEXTS)]


def voting(words: list[str], exact: bool) -> list[int]:
    """The places whose pair votes."""
    return [p for p in range(len(words) - 1) if exact or not {words[p], words[p + 1]} <= COMMON]


def _of_template(f) -> Column:
    """A literal array: f(template) by the template's number."""
    return F.array(*(f(t) for t in TEMPLATES))


def template_pairs(spark: SparkSession) -> DataFrame:
    """(hash, template, place) of every voting pair."""
    words = _of_template(lambda t: F.split(F.lit(" ".join(t[2])), " "))
    places = _of_template(lambda t: F.transform(F.split(F.lit(" ".join(map(str, voting(t[2], t[3])))), " "), lambda p: p.cast("int")))
    rows = spark.range(1).select(F.posexplode(F.arrays_zip(words.alias("w"), places.alias("p"))).alias("template", "t")).select("template", F.col("t.w").alias("w"), F.explode("t.p").alias("place"))
    return rows.select(F.xxhash64(F.get("w", F.col("place")), F.get("w", F.col("place") + 1)).alias("hash"), "template", "place")


def words_of(text: Column) -> Column:
    # lower() is faster than a map of 26 letters; the two other characters that it turns into ASCII letters are set aside.
    text = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é"))
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def votes(docs: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """A written table of (id, text_key, template, diagonal, at): the word places that vote, by diagonal."""
    w = F.col("words")
    n = F.greatest(F.size(w) - 1, F.lit(0))
    hashes = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), words_of(F.col(text_col)).alias("words"))
    grams = rows.select("id", "text_key", F.posexplode(hashes).alias("at", "hash"))
    hits = grams.join(F.broadcast(template_pairs(docs.sparkSession)), "hash").select("id", "text_key", "template", (F.col("at") - F.col("place")).alias("diagonal"), "at")
    return materialize(hits.groupBy("id", "text_key", "template", "diagonal").agg(F.collect_set("at").alias("at")), "license-votes")


def spans(found: DataFrame) -> DataFrame:
    """Of votes(): id, text_key, template, start (word), stop, share of the template's pairs, and the hits (at, place) that count."""
    t = F.col("template")
    need, size, exact = _of_template(lambda x: F.lit(len(voting(x[2], x[3]))))[t], _of_template(lambda x: F.lit(len(x[2])))[t], _of_template(lambda x: F.lit(x[3]))[t]
    key = ["id", "text_key", "template"]
    hit = lambda at, place: F.struct(at.alias("at"), place.alias("place"))
    phrases = found.where(exact & (F.size("at") == need)).select(
        *key, F.col("diagonal").alias("start"), (F.col("diagonal") + size).alias("stop"), F.lit(1.0).alias("share"),
        F.transform(F.array_sort("at"), lambda a: hit(a, a - F.col("diagonal"))).alias("hits"))
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > MAX_DRIFT, F.lit(True))
    runs = found.where(~exact & (F.size("at") >= MIN_VOTES)).withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(order))
    pairs = runs.select(*key, "run", "diagonal", F.explode("at").alias("at")).withColumn("place", F.col("at") - F.col("diagonal"))
    reading = Window.partitionBy(*key, "run").orderBy("at", "place").rowsBetween(Window.unboundedPreceding, -1)
    counted = pairs.withColumn("beyond", F.coalesce(F.max("place").over(reading), F.lit(-1))).where("place > beyond")
    texts = counted.groupBy(*key, "run").agg(F.min("at").alias("start"), (F.max("at") + 2).alias("stop"), F.count("*").alias("n"), F.array_sort(F.collect_list(hit(F.col("at"), F.col("place")))).alias("hits"))
    texts = texts.withColumn("share", F.col("n") / need).where(F.col("share") >= MIN_SHARE)
    return phrases.union(texts.select(*phrases.columns))


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, hits (array of template, label, base, start, stop, share), n_base, first_word, last_word, base_labels, labels, score."""
    found = spans(votes(docs, id_col=id_col, text_col=text_col))
    span = F.struct("start", "stop", "template", "share", "hits")
    found = small(materialize(found.groupBy(F.col("id").alias("found_id"), F.col("text_key").alias("found_key")).agg(F.array_sort(F.collect_list(span)).alias("spans")), "license-spans"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), words_of(F.col(text_col)).alias("words"))
    rows = rows.join(found, rows["id"].eqNullSafe(found["found_id"]) & (rows["text_key"] == found["found_key"]), "left")
    text, label, base = _of_template(lambda t: F.split(F.lit(" ".join(t[2])), " ")), _of_template(lambda t: F.lit(t[1])), _of_template(lambda t: F.lit(t[4]))

    def stands(s: Column) -> Column:
        same = lambda at, place: F.get("words", at) == F.get(text[s["template"]], place)
        return F.forall(s["hits"], lambda h: same(h["at"], h["place"]) & same(h["at"] + 1, h["place"] + 1))

    hits = F.transform(F.filter(F.col("spans"), stands), lambda s: F.struct(
        s["template"].alias("template"), label[s["template"]].alias("label"), base[s["template"]].alias("base"),
        s["start"].alias("start"), s["stop"].alias("stop"), s["share"].alias("share")))
    none = F.array().cast("array<struct<template:int,label:string,base:boolean,start:int,stop:int,share:double>>")
    rows = rows.select("id", F.size("words").cast("long").alias("n_words"), F.when(F.col("spans").isNull(), none).otherwise(hits).alias("hits"))
    of_base = F.filter("hits", lambda h: h["base"])
    names = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    starts = F.transform(of_base, lambda h: h["start"].cast("long"))
    return rows.select("*", F.size(of_base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                       names(of_base).alias("base_labels"), names(F.col("hits")).alias("labels"),
                       F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0)).alias("score"))
