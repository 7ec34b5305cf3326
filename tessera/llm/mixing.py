"""Mixing sources to target weights by a hypergeometric splitting tree (operator 8).

Native: DataFrame functions only.

Targets: the sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1...
and share all words by weight; a target stops at ``max_repeat`` times its
source's size, and what it leaves is shared again by weight among the others
until none is above.  Each round is one sum over the sources.

Quota: a source's documents fall into hashed blocks, and each epoch has a permutation
of the blocks of its own (swap-or-not, a keyed bijection that needs no sorting).  The blocks of epoch
0, 1, ... in the order of their permutations are the source's slots; its quota is the
exact number of slots whose words reach the target.

Draw: a splitting tree halves the shards again and again; at each node the left half's
share of every source is drawn from the multivariate hypergeometric distribution, the right half
takes the remainder.  Sources are drawn in groups of ``FAN``, then within
each group, so that no row holds all sources.  A shard's quota of a source is a run of
the source's slots: the runs are disjoint and decide which shard draws a block in which epoch, and a block without a
run is not drawn.  Of the block in which the target ends, documents are drawn in hash
order up to the target.  Each shard orders its rows by hash.  All draws are hashes of ids and the
seed: reruns agree.

Cases: null text or text without words has size 0; it is drawn with its block and counts as taken 0 words.
A null source is a source, last in order.  Repeated rows are documents of their
own; rows that agree in id, source and text are drawn together or not at all.  If all
sizes are 0 the targets are 0 and nothing is drawn.  Extra columns are carried by mix().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drop_tables, key_part, materialize, small

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Shards that there are at least, and words of a shard, about: their number grows with the data, so that a task can order a shard's rows.
SHARDS, SHARD_WORDS = 32, 20_000_000
#: Words and documents of a block, about.
BLOCK_WORDS, BLOCK_DOCS = 100_000, 20_000
SEED = 20
FAN = 64
#: Rounds of the permutation for each bit of the number of blocks, and blocks that are summed up together.
ROUNDS, CHUNK = 6, 4096


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """A written table of sources with their number in code-point order, null last: counted within range partitions, then from partition to partition."""
    order = [F.col("source").isNull().alias("none"), F.col("source")]
    placed = materialize(sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "mix-order")
    part, below, start = F.shiftright("at", 33).cast("int"), 0, []
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        start += [below] * (r.part + 1 - len(start))
        below += r["count"]
    number = F.get(F.array(*map(F.lit, start or [0])), part) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("number", number.cast("long")).drop("at")


def targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sources(source, source_size) with number (in code-point order, null last), weight and target."""
    s = _numbered(sources)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int")))
    # Sizes and weights are whole numbers, so the sums are exact in any order.  The level only rises, and ends when no more sources are below it.
    total = s.agg(F.sum("source_size").alias("t")).first().t or 0
    level, full = 0.0, -1
    while True:
        under = F.col("source_size") * max_repeat < F.lit(level) * F.col("weight")
        r = s.agg(F.count_if(under).alias("n"), F.sum(F.when(under, F.col("source_size") * max_repeat)).alias("cap"), F.sum(F.when(~under, F.col("weight"))).alias("w")).first()
        if r.n == full or not r.w:
            break
        level, full = (total - (r.cap or 0)) / r.w, r.n
    cap = F.col("source_size").cast("double") * max_repeat
    return s.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight")))


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash of the parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / F.lit(float(1 << 52))


def permuted(x: Column, n: Column, rounds: Column, *key: Column) -> Column:
    """The place of x in a keyed permutation of 0 ... n - 1.

    Swap-or-not: each round pairs x with (k - x) mod n, and a hash of the larger of
    the two, which both share, decides whether they change places.
    """
    def turn(a: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, i), n) - a, n)
        return F.when(F.xxhash64(*key, i, F.greatest(a, other)) % 2 == 0, a).otherwise(other)

    return F.aggregate(F.sequence(F.lit(1), rounds), x, turn)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from ``total`` are among ``good``: the distribution inverted at u.

    Weights follow from the ratio of neighbouring terms, over a window of ten
    standard deviations around the mean, outside of which the mass is below 1e-20.
    """
    total, good, draws = (c.cast("double") for c in (total, good, draws))
    mean = F.when(total > 0, draws * good / total).otherwise(F.lit(0.0))
    spread = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - F.when(total > 0, good / total).otherwise(F.lit(0.0)))))
    lo = F.greatest(F.lit(0.0), draws + good - total, F.floor(mean - 10 * spread - 10).cast("double"))
    hi = F.greatest(lo, F.least(good, draws, F.ceil(mean + 10 * spread + 10).cast("double")))
    step = lambda x: (good - x) * (draws - x) / ((x + 1) * (total - good - draws + x + 1))
    xs = F.sequence(lo.cast("long"), hi.cast("long"))
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    mass = F.aggregate(xs, start, lambda a, x: F.struct((a["w"] * step(x.cast("double"))).alias("w"), (a["sum"] + a["w"]).alias("sum")))["sum"]
    begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), lo.cast("long").alias("x"))
    found = F.aggregate(xs, begin, lambda a, x: F.struct(
        (a["w"] * step(x.cast("double"))).alias("w"), (a["sum"] + a["w"]).alias("sum"),
        F.when(a["sum"] <= u * mass, x).otherwise(a["x"]).alias("x")))["x"]
    return F.greatest(lo.cast("long"), F.least(hi.cast("long"), found))


def _left(rows: DataFrame, sources: int, seed: int) -> DataFrame:
    """rows(lo, hi, number, n), nodes that have two halves, with got: what the left half takes of each source."""
    node, levels = ["lo", "hi"], max(1, math.ceil(math.log(max(2, sources), FAN) - 1e-9))
    half = F.floor((F.col("hi") - F.col("lo")) / 2) / (F.col("hi") - F.col("lo"))
    want = rows.groupBy(*node).agg(F.round(F.sum("n") * F.first(half)).cast("long").alias("want")).withColumn("group", F.lit(0).cast("long"))
    for level in range(levels):
        upper, lower = FAN ** (levels - level), FAN ** (levels - level - 1)
        sums = rows.groupBy(*node, F.floor(F.col("number") / lower).alias("child")).agg(F.sum("n").alias("n"))
        family = sums.groupBy(*node, F.floor(F.col("child") / (upper // lower)).alias("group")).agg(F.array_sort(F.collect_list(F.struct("child", "n"))).alias("s"))
        family = family.join(want, [*node, "group"])
        start = F.struct(F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("left"), F.col("want"), F.array().cast("array<bigint>").alias("got"))

        def draw(a: Column, x: Column) -> Column:
            g = hypergeometric(a["left"], x["n"], a["want"], _uniform(F.lit(seed), F.lit(lower), F.col("lo"), F.col("hi"), x["child"]))  # noqa: B023
            return F.struct((a["left"] - x["n"]).alias("left"), (a["want"] - g).alias("want"), F.array_append(a["got"], g).alias("got"))

        drawn = family.withColumn("got", F.aggregate("s", start, draw)["got"])  # of FAN entries at most
        pairs = F.explode(F.arrays_zip(F.col("s")["child"].alias("child"), F.col("got").alias("got"))).alias("x")
        want = drawn.select(*node, pairs).select(*node, F.col("x.child").alias("group"), F.col("x.got").alias("want"))
    return rows.join(want.withColumnsRenamed({"group": "number", "want": "got"}), [*node, "number"])


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """A written table of quotas(number, quota) among shards: rows (number, shard, n, first), first the number of slots of lower shards."""
    sources = int(quotas.agg(F.max("number")).first()[0] or 0) + 1
    rows = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "number", F.col("quota").cast("long").alias("n"))
    width = shards
    while width > 1:
        inner = F.col("hi") - F.col("lo") > 1
        split = _left(rows.where(inner), sources, seed)
        mid = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
        child = lambda lo, hi, n: F.struct(lo.alias("lo"), hi.alias("hi"), n.alias("n"))
        halves = F.explode(F.array(child(F.col("lo"), mid, F.col("got")), child(mid, F.col("hi"), F.col("n") - F.col("got")))).alias("c")
        rows = materialize(split.select("number", halves).select("c.lo", "c.hi", "number", "c.n").unionByName(rows.where(~inner)), "mix-tree")
        width = (width + 1) // 2
    below = Window.partitionBy("number").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(rows.select("number", F.col("lo").alias("shard"), "n", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("first")), "mix-quotas")


def sizes(docs: DataFrame, *, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Per row: id, source, size, and text_key, a hash of the text."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("text_key"))


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeat: int = MAX_REPEAT, shards: int | None = None,
         block_words: int = BLOCK_WORDS, block_docs: int = BLOCK_DOCS, seed: int = SEED) -> DataFrame:
    """Per row: id, source, size, text_key, source_size, target, block, and draws: a struct (epoch, shard, place) for each time it is taken, place ordering the rows of a shard."""
    sized = materialize(sizes(docs, id_col=id_col, text_col=text_col, source_col=source_col).withColumn("source_key", key_part(F.col("source"))), "mix-sizes")
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), max_repeat)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(share + F.lit(1e-9)).cast("long")
    per_source = per_source.select(
        key_part(F.col("source")).alias("source_key"), "number", "source_size", "target", whole.alias("whole"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words), F.ceil(F.col("docs") / block_docs)).cast("long").alias("blocks"),
        F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size") - F.lit(1e-6)).alias("rest"))
    per_source = materialize(per_source.withColumn("rounds", F.lit(ROUNDS) * F.ceil(F.log2(F.col("blocks") + 1)).cast("int")), "mix-sources")
    placed = sized.join(small(per_source), "source_key").withColumn("block", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")))

    # Blocks with their place in the permutation of each epoch, and what lies before them in the last one.
    kept = ["number", "whole", "blocks", "rest", "rounds"]
    blocks = placed.groupBy("source_key", "block").agg(F.sum("size").alias("block_size"), *(F.first(c).alias(c) for c in kept))
    place = lambda e: permuted(F.col("block"), F.col("blocks"), F.col("rounds"), F.lit(seed), F.col("source_key"), e)
    blocks = materialize(blocks.withColumn("places", F.transform(F.sequence(F.lit(0).cast("long"), F.col("whole")), place))
                         .withColumn("rank", F.element_at("places", -1)).withColumn("chunk", F.floor(F.col("rank") / CHUNK)), "mix-places")
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    chunks = blocks.groupBy("number", "chunk").agg(F.sum("block_size").alias("size")).select(
        "number", "chunk", F.coalesce(F.sum("size").over(earlier("number", "chunk")), F.lit(0)).alias("base"))
    before = F.col("base") + F.coalesce(F.sum("block_size").over(earlier("number", "chunk", "rank")), F.lit(0))
    blocks = materialize(blocks.join(chunks, ["number", "chunk"]).withColumn("before", before).drop("base", "chunk"), "mix-blocks")
    quotas = blocks.groupBy("number").agg((F.first("whole") * F.first("blocks") + F.coalesce(F.max(F.when(F.col("before") < F.col("rest"), F.col("rank") + 1)), F.lit(0))).alias("quota"))

    # The shards' runs of slots say which blocks are drawn, and where.
    if shards is None:
        shards = max(SHARDS, math.ceil((per_source.agg(F.sum("source_size")).first()[0] or 0) / SHARD_WORDS))
    cut = split_quotas(quotas, shards, seed)
    runs = materialize(cut.where("n > 0").groupBy("number").agg(F.array_sort(F.collect_list(F.struct("first", "shard", "n"))).alias("runs")), "mix-runs")
    slot = lambda p, e: e * F.col("blocks") + p
    run = lambda s: F.element_at(F.filter("runs", lambda r: r["first"] <= s), -1)
    drawn = F.transform("places", lambda p, e: F.struct(e.cast("long").alias("epoch"), run(slot(p, e)).alias("run"), slot(p, e).alias("slot")))
    taken = F.filter(drawn, lambda d: d["slot"] < d["run"]["first"] + d["run"]["n"])
    blocks = blocks.join(small(runs), "number").withColumn("taken", F.transform(taken, lambda d: F.struct(d["epoch"].alias("epoch"), d["run"]["shard"].alias("shard"))))
    ends = F.when((F.col("before") < F.col("rest")) & (F.col("before") + F.col("block_size") > F.col("rest")), F.col("rest") - F.col("before"))
    blocks = materialize(blocks.where(F.size("taken") > 0).select("source_key", "block", "taken", ends.alias("ends")), "mix-drawn")

    # Of the block in which a target ends, rows that agree in all but their text's place are one, in hash order.
    same = ["source_key", "block", "id", "size", "text_key"]
    last = placed.join(small(blocks.where("ends is not null").select("source_key", "block", "ends")), ["source_key", "block"]).groupBy(*same).agg(
        F.first("ends").alias("ends"), F.sum("size").alias("all"))
    upto = Window.partitionBy("source_key", "block").orderBy(F.xxhash64("id", F.lit(seed + 1)), "id", "size", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    out = materialize(last.withColumn("upto", F.sum("all").over(upto)).where(F.col("upto") - F.col("all") / 2 > F.col("ends")).select(*same, F.lit(True).alias("is")), "mix-out")
    rows = placed.join(small(blocks), ["source_key", "block"], "left")
    left_out = small(out.drop("block").withColumnsRenamed({c: f"out_{c}" for c in out.columns}))
    is_out = [rows[c].eqNullSafe(left_out[f"out_{c}"]) for c in same if c != "block"]  # an id has one block in its source
    rows = rows.join(left_out, is_out, "left")
    draws = F.transform(F.filter(F.coalesce("taken", F.array().cast("array<struct<epoch:bigint,shard:int>>")), lambda d: F.col("out_is").isNull() | (d["epoch"] < F.col("whole"))),
                        lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"), F.xxhash64("id", d["epoch"], F.lit(seed + 2)).alias("place")))
    drop_tables(cut)
    return rows.select("id", "source", "size", "text_key", "source_size", "target", "block", draws.alias("draws"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options: int) -> DataFrame:
    """Rows of docs as often as the mix takes them: the struct ``doc`` with epoch, shard and place; each shard's rows together, in order of place.

    The plan meets the rows by id, source, size and text; rows that agree in
    these are drawn alike, so they meet as one.
    """
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col}
    keys = ["id", "source", "size", "text_key"]
    planned = plan(docs, **names, **options).groupBy(*keys).agg(F.first("draws").alias("draws"))
    planned = materialize(planned.where(F.size("draws") > 0).select(*(F.col(k).alias(f"of_{k}") for k in keys), "draws"), "mix-draws")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("text_key"))
    met = rows.join(small(planned), [rows[k].eqNullSafe(planned[f"of_{k}"]) for k in keys]).select("doc", F.explode("draws").alias("d")).select("doc", "d.epoch", "d.shard", "d.place")
    return met.repartition("shard").sortWithinPartitions("shard", "place")
