"""Near-duplicate detection by an LSH forest of sorted signature orders (operator 4).

A document's set holds the hashes (64 bits) of its distinct word shingles.
Equal sets are collapsed to the smallest id first.  Of the rest, a signature of 128
minima is read in 32 rotated orders.  Each order is a sorted list over all
documents: rows are range-partitioned by (tree, signature prefix, id), so any
region, however many documents share it, is spread over as many tasks as its size asks for, and a
task streams through its rows with the last few of them in memory.  Rows at the
borders of partitions are scanned once more, each border by itself.

Candidates are neighbours in such an order.  A region is a run of rows with a common prefix; its
depth grows from ``MIN_DEPTH`` until it has at most ``REGION`` rows, and all its pairs
are candidates, as is each row with the next one, its longest-common-prefix neighbour.  Rows carry two bits of each
minimum; candidates below ``SKETCH_MATCHES`` of 128 equal fields are left out (a pair of similarity 0.8 is
left out with probability 3e-5, one of 0.9 never in practice).

Components are wanted, not pairs, so pairs are made in rounds.  A scan gives each row its best few
partners in each order; each row's best is confirmed on the full sets, rebuilt from the texts, then
those of the others that are not yet connected.  Rows that have more candidates are scanned
again, with their components beside them: partners in their own component no longer count, and
more partners are given, in the last round all.  So a row in a family that is
connected at once never gives more than its best, and no candidate is left untested.

A run that is denser than ``REGION`` at depth ``SURE`` is crowded: deeper regions may part its similar
rows.  Crowded runs that share rows form a cluster.  In a cluster of one component, the
usual case, nothing is left to do.  In others the rows outside the main component are
compared with all rows of the cluster on the full sets, in blocks of bounded size: one side's
inverted index in memory, the other side streamed past it.  That work is (rows outside) x (rows of the cluster) over blocks,
and only links leave it.  A pair at similarity 0.8
misses all 32 orders with probability below 1e-5 at depth ``SURE``, five; one that shares so long a
prefix is either in a region or in a crowded run, however crowded its neighbourhood is.

Cases: null text, or text without words, has an empty set and is linked with
nothing; with fewer words than a shingle the whole sequence is one.  Rows that repeat an id are
one node: if any of its texts is linked, it is.  A row with a null id is
kept, in a component of its own (null).  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, bound_batches, claim, components, drop_tables, materialize, release, small

WIDTH = 5
PERCENT = 80
HASHES, TREES, DEPTH = 128, 32, 16
MIN_DEPTH, REGION = 2, 64
SURE = 5
#: Partners that a row gives in each order, round by round; None: all.
PARTNERS: tuple[int | None, ...] = (4, 32, None)
#: Times that rows of the first round give their best partner in another component before the others are looked at.
BEST_ROUNDS = 2
#: Rows of a range partition, of a chunk that a task looks at together, and shingles of a block of sets.
PART_ROWS, CHUNK_ROWS, BLOCK = 50_000, 8_192, 1 << 18
#: A key: the tree, the high bytes of the first MIN_DEPTH minima, then the low bytes of DEPTH minima.
KEY = 1 + MIN_DEPTH + DEPTH
SKETCH_MATCHES = 92
_ODD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(4)
_A = _rng.integers(1 << 62, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


class _Words(dict):
    """Word to 64-bit hash, emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    take = min(width, n)
    out = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        out = _mix(out * _ODD + h[i : n - take + 1 + i])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, HASHES) minima as big-endian 32-bit values; sets must not be empty."""
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    x = np.concatenate(sets)
    out = np.empty((len(sets), HASHES), ">u4")
    tmp = np.empty_like(x)
    for k in range(HASHES):
        np.multiply(x, _A[k], out=tmp)
        np.add(tmp, _B[k], out=tmp)
        out[:, k] = np.minimum.reduceat(tmp, starts) >> np.uint64(32)
    return out


def sketches(sig: np.ndarray) -> np.ndarray:
    """Two bits of each minimum: (documents, 4) of 64 bits."""
    low = (sig.astype(np.uint64) & np.uint64(3)).reshape(len(sig), 4, HASHES // 4)
    return np.bitwise_or.reduce(low << (2 * np.arange(HASHES // 4, dtype=np.uint64)), axis=2)


def matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return HASHES - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1).astype(np.int32)


def _signed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    def flush(ids: list, sets: list) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        lows, highs, key, sketch = ([None] * len(sets) for _ in range(4))
        if full:
            made = signatures([sets[i] for i in full])
            bits, low, high = sketches(made), (made & np.uint32(255)).astype(np.uint8), (made >> np.uint32(8) & np.uint32(255)).astype(np.uint8)
            for row, i in enumerate(full):
                lows[i], highs[i] = low[row].tobytes() + low[row, :DEPTH].tobytes(), high[row].tobytes() + high[row, :MIN_DEPTH].tobytes()  # wrap round
                key[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                sketch[i] = bits[row].tobytes()
        n = pa.array([len(s) for s in sets], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), n, *(pa.array(x, pa.binary()) for x in (key, lows, highs, sketch))], names=["id", "n_shingles", "set_key", "low", "high", "sketch"])

    claim("minhash", _words.clear)
    for batch in batches:
        ids, sets, size = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
            ids.append(i)
            sets.append(shingles(t.as_py() or b"", width))
            size += len(sets[-1])
            if size > 1 << 16:
                yield flush(ids, sets)
                ids, sets, size = [], [], 0
        if ids:
            yield flush(ids, sets)
    _words.clear()
    release()


def sign(docs: DataFrame, width: int = WIDTH, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, set_key, low and high bytes of the minima, sketch (the last four null for an empty set)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _signed(b, width), "id bigint, n_shingles bigint, set_key binary, low binary, high binary, sketch binary")


def neighbours(keys: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, matches, inside) of the candidates among sorted rows, inside telling pairs of one crowded run, and the rows of crowded runs."""
    n = len(keys)
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none, none, none.astype(bool), none
    same = np.cumprod(keys[1:] == keys[:-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64) - (KEY - DEPTH)  # depth shared with the next row
    # The depth of each row's region: the least at which its run has at most REGION rows, DEPTH + 1 if none.
    depth = np.full(n, DEPTH + 1)
    for d in range(DEPTH, MIN_DEPTH - 1, -1):
        edge = np.flatnonzero(np.concatenate(([True], same < d)))
        length = np.diff(np.append(edge, n))
        depth[np.repeat(length, length) <= REGION] = d
    crowded = depth > min(SURE, DEPTH)
    found_i, found_j, inside, lcp = [], [], [], np.full(n, DEPTH)
    for s in range(1, min(REGION, n)):
        lcp = np.minimum(lcp[: n - s], same[s - 1 :])  # of rows i and i + s
        need = depth[: n - s] if s > 1 else np.minimum(depth[: n - 1], MIN_DEPTH)
        i = np.flatnonzero(lcp >= need)
        found_i.append(i), found_j.append(i + s), inside.append(crowded[i] & (lcp[i] >= SURE))
    i, j, inside = np.concatenate(found_i), np.concatenate(found_j), np.concatenate(inside)
    m = matches(sketch[i], sketch[j])
    near = m >= SKETCH_MATCHES
    return i[near], j[near], m[near], inside[near], np.flatnonzero(crowded)


def partners(i: np.ndarray, j: np.ndarray, m: np.ndarray, inside: np.ndarray, ids: np.ndarray, most: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, partner, matches) of each row's best ``most`` partners, one of them at most inside a crowded run; and the ids that have more."""
    row, other = np.concatenate((i, j)), np.concatenate((j, i))
    m, inside = np.concatenate((m, m)), np.concatenate((inside, inside))
    order = np.lexsort((ids[other], -m, row))
    row, other, m, inside = row[order], other[order], m[order], inside[order]
    begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.empty(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
    given = (rank == 0) | ~inside & (rank < (len(row) if most is None else most))
    return ids[row[given]], ids[other[given]], m[given], np.unique(ids[row[~given & ~inside]])


#: What a scan gives: pairs (id, other, matches), ids with more partners, rows of crowded runs (key, id), and rows at the border after partition ``border``.
_PAIR, _MORE, _CROWDED, _BORDER = range(4)
_FOUND = "kind int, id bigint, other bigint, matches int, key binary, sketch binary, of bigint, cluster bigint, border int"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, sketch, id, of, cluster, border) of CHUNK_ROWS rows or more at a time; a null cluster is -1."""
    def arrays(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        t = pa.Table.from_batches(parts)
        fixed = lambda c, kind, w: np.frombuffer(b"".join(t[c].to_pylist()), kind).reshape(len(t), w)
        number = lambda c, none: t[c].fill_null(none).to_numpy()
        return fixed("key", np.uint8, KEY), fixed("sketch", "<u8", 4), number("id", 0), number("of", 0), number("cluster", -1), number("border", -1)

    held, size = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            size += len(batch)
        if size >= CHUNK_ROWS:
            yield arrays(held)
            held, size = [], 0
    if held:
        yield arrays(held)


def _scan(batches: Iterator[pa.RecordBatch], most: int | None, edges: bool) -> Iterator[pa.RecordBatch]:
    """Reads rows sorted by (border, key, id); with edges, also gives the rows at both ends of the partition."""
    names = [x.split()[0] for x in _FOUND.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]

    def out(kind: int, n: int, **columns: object) -> pa.RecordBatch:
        made = {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()}
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind), pa.int32()), *(made[c].cast(k) if c in made else pa.nulls(n, k) for c, k in zip(names[1:], kinds[1:], strict=True))], names=names)

    def rows_of(rows: tuple[np.ndarray, ...], border: int) -> pa.RecordBatch:
        key, sketch, ids, of, cluster = rows[:5]
        raw = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
        return out(_BORDER, len(ids), id=ids, key=raw(key), sketch=raw(sketch), of=of, cluster=pa.array(cluster, mask=cluster < 0), border=np.full(len(ids), border))

    def found(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        key, sketch, ids, of, cluster = rows[:5]
        i, j, m, inside, crowded = neighbours(key, sketch)
        apart = (of[i] != of[j]) & ((cluster[i] != cluster[j]) | (cluster[i] < 0)) & (ids[i] != ids[j])
        a, b, m, more = partners(i[apart], j[apart], m[apart], inside[apart], ids, most)
        if len(a):
            yield out(_PAIR, len(a), id=a, other=b, matches=m)
        if len(more):
            yield out(_MORE, len(more), id=more)
        if len(crowded):
            yield out(_CROWDED, len(crowded), id=ids[crowded], key=pa.array([k.tobytes() for k in key[crowded, : KEY - DEPTH + SURE]], pa.binary()))

    here, held, first = TaskContext.get().partitionId(), None, True
    for chunk in _chunks(batches):
        if edges and first:
            yield rows_of(tuple(x[:REGION] for x in chunk), here - 1)
        first = False
        # A border's rows stand by themselves; without borders all rows are one list.
        cuts = [0, *(np.flatnonzero(np.diff(chunk[5])) + 1).tolist(), len(chunk[2])]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            rows = tuple(x[begin:end] for x in chunk)
            if held is not None and held[5][-1] == rows[5][0]:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            yield from found(rows)
            held = tuple(x[-REGION:] for x in rows)
    if edges and held is not None:
        yield rows_of(held, here)


def scan(rows: DataFrame, most: int | None) -> list[DataFrame]:
    """Written tables of what the forest over rows(id, low, high, sketch, of, cluster) gives, by kind."""
    at = F.col("tree") * (HASHES // TREES) + 1
    trees = F.posexplode(F.array(*(F.lit(bytes([t])) for t in range(TREES)))).alias("tree", "name")
    key = F.concat("name", F.substr("high", at, F.lit(MIN_DEPTH)), F.substr("low", at, F.lit(DEPTH)))
    forest = rows.select("id", "sketch", "of", "cluster", "high", "low", trees).select(key.alias("key"), "sketch", "id", "of", "cluster", F.lit(-1).alias("border"))
    parts = max(1, rows.count() * TREES // PART_ROWS)
    found = materialize(forest.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id").mapInArrow(lambda b: _scan(b, most, True), _FOUND), "forest-scan")
    # The last rows of a partition meet the first of the next one; the last partition's have none to meet.  Should
    # another border have fewer rows than regions on both sides may have, as partitions are short or empty, all borders are one list.
    ends = found.where(F.col("kind") == _BORDER)
    sizes = ends.where("border >= 0").groupBy("border").agg(F.count("*").alias("n"))
    r = sizes.agg(F.count("*").alias("borders"), F.count_if(F.col("n") < 2 * REGION).alias("few"), F.max_by("n", "border").alias("last")).first()
    if r.borders < 2:
        return [found]
    if r.few > (r.last < 2 * REGION):
        ends = ends.drop("border").distinct().withColumn("border", F.lit(0)).coalesce(1)
    else:
        ends = ends.where("border >= 0").repartition("border")
    ends = ends.select("key", "sketch", "id", "of", "cluster", "border").sortWithinPartitions("border", "key", "id")
    return [found, materialize(ends.mapInArrow(lambda b: _scan(b, most, False), _FOUND), "forest-crossing")]


def confirm(docs: DataFrame, pairs: DataFrame, width: int = WIDTH, percent: int = PERCENT, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of a written table pairs(a, b), the ones whose full sets are similar enough.

    A text travels once for each of its pairs, which the rounds bound; texts without pairs do not
    travel while the table of pairs is small enough to broadcast.
    """
    bound_batches(docs.sparkSession)
    sides = pairs.select(F.explode(F.array("a", "b")).alias("id"), "a", "b")
    sides = F.broadcast(sides) if pairs.count() <= BROADCAST_ROWS // 4 else sides
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    met = texts.join(sides, "id").select("a", "b", "id", "text").repartition("a", "b").sortWithinPartitions("a", "b", "id")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash", _words.clear)
        pair, left, linked = None, [], False
        for batch in batches:
            out = []
            for a, b, i, t in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3).cast(pa.large_binary()), strict=True):
                if (a, b) != pair:
                    pair, left, linked = (a, b), [], False
                own = shingles(t.as_py(), width)
                if i == a:
                    left.append(own)
                elif not linked:
                    for other in left:
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        linked = linked or 0 < both and 100 * both >= percent * (len(own) + len(other) - both)
                    if linked:
                        out.append(pair)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        _words.clear()
        release()

    return met.mapInArrow(check, "a bigint, b bigint")


def _clusters(crowded: DataFrame) -> DataFrame:
    """crowded(key, id) to (id, cluster): runs that share rows are one cluster."""
    first = crowded.groupBy("key").agg(F.min("id").alias("first"))
    return components(crowded.join(first, "key").select(F.col("id").alias("a"), F.col("first").alias("b"))).select(F.col("node").alias("id"), F.col("component").alias("cluster"))


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between rows of side 0 and rows of side 1 of each block, sorted by (block, side, id); one for each row of side 0 and component."""
    block, ids, of, sets, index, seen = None, [], [], [], None, set()
    for batch in batches:
        out = []
        names = batch.select(["cluster", "x", "y", "side", "id", "of"]).to_pylist()
        for r, raw in zip(names, batch.column("set").cast(pa.large_binary()), strict=True):
            own, now = np.frombuffer(raw.as_py(), "<u8"), (r["cluster"], r["x"], r["y"])
            if now != block:
                block, ids, of, sets, index, seen = now, [], [], [], None, set()
            if not r["side"]:
                ids.append(r["id"]), of.append(r["of"]), sets.append(own)
                continue
            if not sets:
                continue
            if index is None:
                tokens, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
                order = np.argsort(tokens, kind="stable")
                index = tokens[order], np.repeat(np.arange(len(sets)), sizes)[order], sizes
                sets = [()]
            tokens, owner, sizes = index
            begin, end = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            hit = end > begin
            begin, width = begin[hit], (end - begin)[hit]
            at = np.repeat(begin - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum()) if hit.any() else np.empty(0, np.int64)
            both = np.bincount(owner[at], minlength=len(sizes))
            for k in np.flatnonzero((both > 0) & (100 * both >= percent * (sizes + len(own) - both))).tolist():
                if of[k] != r["of"] and (ids[k], r["of"]) not in seen:
                    seen.add((ids[k], r["of"]))
                    out.append((ids[k], r["id"]))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
    release()


def settle(docs: DataFrame, clusters: DataFrame, joined: DataFrame, width: int = WIDTH, percent: int = PERCENT, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """Links (a, b) of clusters(id, cluster) that joined(node, component) leaves apart, None if every cluster is in one component.

    Rows outside the main component of a cluster meet all its rows, in blocks
    of about BLOCK shingles on each side.
    """
    bound_batches(docs.sparkSession)
    rows = clusters.join(joined.select(F.col("node").alias("id"), F.col("component").alias("of")), "id", "left").withColumn("of", F.coalesce("of", "id"))
    sizes = rows.groupBy("cluster", "of").agg(F.count("*").alias("n"))
    main = sizes.groupBy("cluster").agg(F.max_by("of", F.struct("n", "of")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("cluster", "main")
    main = small(materialize(main, "forest-main"))  # a cluster may hold any share of the rows: they should not meet by it
    rows = materialize(rows.join(main, "cluster").withColumn("out", F.col("of") != F.col("main")).drop("main"), "forest-contested")
    if not rows.limit(1).count():
        drop_tables(rows)
        return None

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("minhash", _words.clear)
        for batch in batches:
            made = [shingles(t.as_py() or b"", width).astype("<u8").tobytes() for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.large_binary()).cast(pa.binary())], names=["id", "set"])
        _words.clear()
        release()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(small(rows.select("id")), "id", "left_semi")
    full = materialize(rows.join(texts.mapInArrow(sets, "id bigint, set binary"), "id"), "forest-sets")
    amount = F.octet_length("set").cast("long")
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(c / (8 * BLOCK))).cast("int")
    grid = full.groupBy("cluster").agg(blocks(F.coalesce(F.sum(F.when(F.col("out"), amount)), F.lit(0))).alias("xs"), blocks(F.sum(amount)).alias("ys"))
    dealt = full.join(small(materialize(grid, "forest-grid")), "cluster")
    number = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outer = dealt.where("out").select("cluster", number("xs").alias("x"), every("ys").alias("y"), F.lit(0).alias("side"), "id", "of", "set")
    inner = dealt.select("cluster", every("xs").alias("x"), number("ys").alias("y"), F.lit(1).alias("side"), "id", "of", "set")
    met = outer.unionByName(inner).repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y", "side", "id")
    links = materialize(met.mapInArrow(lambda b: _compare(b, percent), "a bigint, b bigint"), "forest-settled")
    drop_tables(rows, full)
    return links


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id of its near-duplicates), kept (it is that one)."""
    names = {"id_col": id_col, "text_col": text_col}
    signed = materialize(sign(docs, width, **names), "forest-signed")
    rows = materialize(signed.select("id", "n_shingles", "set_key"), "forest-rows")
    least = F.min_by(F.struct("low", "high", "sketch"), "id").alias("s")
    reps = signed.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("rep"), least)
    classes = materialize(reps.select("set_key", "rep", "s.*"), "forest-classes")
    drop_tables(signed, clean=True)

    joined, tested, clusters, active = None, [], None, classes.withColumnRenamed("rep", "id")
    for most in PARTNERS:
        parts = scan(_labelled(active, joined, clusters), most)
        found = reduce(DataFrame.union, parts)
        pairs = found.where(F.col("kind") == _PAIR).select("id", "other", "matches")
        if joined is None:
            # Each row's best partner; then, as long as rows give links, the best in another component.
            for _ in range(BEST_ROUNDS):
                untested = pairs if joined is None else _untested(pairs, _labels(joined, None), tested)
                best = untested.groupBy("id").agg(F.max(F.struct("matches", (-F.col("other")).alias("other"))).alias("m")).select("id", (-F.col("m.other")).alias("other"))
                best = materialize(best.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct(), "forest-best")
                tested.append(best)
                links = materialize(confirm(docs, best, width, percent, **names), "forest-links")
                drop_tables(clean=True)
                joined = components(links) if joined is None else _extended(joined, links)
                if not links.limit(1).count():
                    break
            crowded = found.where(F.col("kind") == _CROWDED).select("key", "id").distinct()
            if crowded.limit(1).count():
                clusters = _clusters(crowded)
                links = settle(docs, clusters, joined, width, percent, **names)
                joined = joined if links is None else _extended(joined, links)
        rest = _untested(pairs, _labels(joined, clusters), tested).select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
        rest = materialize(rest, "forest-rest")
        tested.append(rest)
        if rest.limit(1).count():
            joined = _extended(joined, confirm(docs, rest, width, percent, **names))
        if most is None:
            break
        more = found.where(F.col("kind") == _MORE).select("id").distinct()
        active = materialize(active.join(more, "id", "left_semi").select("id", "low", "high", "sketch"), "forest-more")
        drop_tables(*parts, clean=True)
        if not active.limit(1).count():
            break
    # Equal ids with several texts put several sets under one node.
    final = joined.withColumnRenamed("node", "rep")
    of_set = materialize(classes.select("set_key", "rep").join(final, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id")), "forest-sets-of")
    drop_tables(classes, *tested, clean=True)
    return rows.join(of_set, "set_key", "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _extended(joined: DataFrame, links: DataFrame) -> DataFrame:
    """joined(node, component) after further links(a, b)."""
    return components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links.select("a", "b")))


def _labels(joined: DataFrame, clusters: DataFrame | None) -> DataFrame:
    """(id, of, cluster): the component of joined(node, component) and the cluster of clusters(id, cluster), null where there is none; broadcast if small."""
    rows = joined.select(F.col("node").alias("id"), F.col("component").alias("of"))
    if clusters is None:
        return small(materialize(rows.withColumn("cluster", F.lit(None).cast("long")), "forest-labels"))
    return small(materialize(rows.join(clusters, "id", "full"), "forest-labels"))


def _labelled(rows: DataFrame, joined: DataFrame | None, clusters: DataFrame | None) -> DataFrame:
    """rows(id, low, high, sketch) with of, the row's component, and cluster; written if that takes a join."""
    rows = rows.select("id", "low", "high", "sketch")
    if joined is None:
        return rows.withColumns({"of": F.col("id"), "cluster": F.lit(None).cast("long")})
    return materialize(rows.join(_labels(joined, clusters), "id", "left").withColumn("of", F.coalesce("of", "id")), "forest-active")


def _untested(pairs: DataFrame, labels: DataFrame, tested: list[DataFrame]) -> DataFrame:
    """pairs(id, other, matches) without those that are connected, of one cluster, or in a table of tested(a, b)."""
    for side in ("id", "other"):
        pairs = pairs.join(labels.select(F.col("id").alias(side), F.col("of").alias(f"of_{side}"), F.col("cluster").alias(f"cluster_{side}")), side, "left")
    apart = F.coalesce("of_id", "id") != F.coalesce("of_other", "other")
    pairs = pairs.where(apart & ~F.coalesce(F.col("cluster_id") == F.col("cluster_other"), F.lit(False)))
    pairs = pairs.select("id", "other", "matches", F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    return pairs.join(reduce(DataFrame.union, tested), ["a", "b"], "left_anti").select("id", "other", "matches")


def filter_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: one document of each group of near-duplicates."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, width=width, percent=percent)
    gone = materialize(found.where("not kept").select(F.col("id").alias("tessera_gone")).distinct(), "forest-gone")
    return docs.join(small(gone), F.col(id_col).cast("long") == F.col("tessera_gone"), "left_anti")
