"""The training-data operators against brute force, on small tables with nulls, repeats and odd texts."""

import collections
import gzip
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import chat, exact_dedup, license_scan, line_dedup, minhash, mixing, packing, quality_classifier, quality_rules, registry, warc
from tessera.llm.common import components, drop_tables, rest
from tessera.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [None, "", " \n\t", "one", "One", "a b c", "a  b\nc", "a b c", " a b c", "x y z. " * 40, "#$%& *** <tag> | ok\nline\nline\n\nline", "über İstanbul K ß", LONG, LONG + " more",
         "Apache License; under the GNU General Public License, version 3. MIT\nLicense CC-BY-SA", "<|endoftext|> 's \\### </turn> ½ 中文 \x1c z"]
EXTRA = "doc_id long, text string, lang string, source string, n_words long, row string, kept string, id long, target string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else f"l{i % 2}", None if i % 4 == 0 else f"s{i % 3}", 7, "r", "k", -1, "t") for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "a b c", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(16)] + [(None, 1), (3, None), (5, 0)], "id long, quality int")


def empty(df):
    return df.where("false")


def words(t):
    return WORDS.findall(t or "")


def test_rules_measure(docs, labels):
    def brute(t):
        w, t = words(t), t or ""
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        twice = {x for x, n in collections.Counter(windows).items() if n > 1}
        covered = {j for i, x in enumerate(windows) if x in twice for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if words(x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)

    got = quality_rules.quality_rules(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.id is not None:
            want = brute(TEXTS[r.id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept == (not r.base_failed)
    assert quality_rules.quality_rules(empty(docs), empty(labels)).count() == 0
    kept = quality_rules.filter_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_rules_are_certified(spark):
    exact = lambda k, n, p: sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert abs(quality_rules.binomial_cdf(3, 40, 0.1) - exact(3, 40, 0.1)) < 1e-12
    assert quality_rules.certified(1000, [0, 1, 9, 0], (4, 3, 2, 1), 0.01, 1e-2) == 3
    assert quality_rules.certified(10, [0], (4,), 0.01, 1e-2) is None
    rows = [(i, "word " * 3 + " ".join(f"a{i}b{j}" for j in range(20)) + (" ###" * 9 if i % 10 == 0 else ""), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(4000)], "id long, quality int")
    got = quality_rules.quality_rules(docs, labels)
    assert got.where("not kept").count() == 400 == got.where("array_contains(rules_broken, 'symbols')").count()


def test_rules_are_certified_jointly(spark):
    row = lambda i, lang, symbols=0, repeats=0: (i, lang, 100, 600, symbols, 0, repeats, 1, 0)
    # In a, 306 good documents reject nothing; bad ones have symbols.  In b, one more good document is rejected from the third rung of repeats on.
    # In c, 305 labels are too few for four strata.  In d, repeats would reject many good documents, but symbols none.
    rows = [row(i, "a") for i in range(306)] + [row(1000 + i, "b", 0, 17 if i == 0 else 0) for i in range(306)] + [row(2000 + i, "c") for i in range(305)]
    rows += [row(3000 + i, "d", 0, 20 if i % 20 == 0 else 0) for i in range(400)]
    bad = [row(5000 + k, lang, 80) for k, lang in enumerate("abcd")]
    stats = spark.createDataFrame(rows + bad, "id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long")
    labels = spark.createDataFrame([(r[0], 1) for r in rows] + [(r[0], 0) for r in bad], "id long, quality int")
    cuts = quality_rules.calibrate(stats, labels)
    got = {r.stratum: (r.cut_symbols, r.cut_repeats, r.cut_caps) for r in cuts.collect()}
    assert got == {"a": (0.05, 0.06, 0.2), "b": (0.05, 0.18, 0.2), "c": (None, None, None), "d": (0.05, 0.2, 0.2)}
    judged = quality_rules.judge(stats, cuts).where("not kept")
    assert sorted(r.id for r in judged.select("id").collect()) == [5000, 5001, 5003]
    # The first step that rejects a document, against the cutoffs of every step.
    first = {r.id: r.steps for r in stats.where("id in (1000, 3000, 3001, 5000)").select("id", quality_rules._first_steps().alias("steps")).collect()}
    for i, symbols, repeats in ((1000, 0, 0.17), (3000, 0, 0.2), (3001, 0, 0), (5000, 80 / 600, 0)):
        for chain in range(6):
            cuts = [quality_rules.cutoffs_of(chain, step) for step in range(quality_rules.STEPS)]
            rejects = [symbols > c.get("symbols", 1) or repeats > c.get("repeats", 1) for c in cuts]
            assert first[i][chain] == (rejects.index(True) if True in rejects else quality_rules.STEPS)


def test_exact_dedup(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[norm(r.text)].append(r.doc_id)
    for counters in (1, 256):
        got = exact_dedup.exact_dedup(docs, counters=counters).collect()
        assert len(got) == docs.count()
        for r in got:
            key = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
            ids = [i for i in groups[key] if i is not None]
            assert r.group_size == len(groups[key]) and r.keep_id == (min(ids) if ids else None) and r.kept == (r.id == r.keep_id)
        kept = exact_dedup.filter_documents(docs, counters=counters)
        assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(empty(docs)).count() == 0


def test_misra_gries_keeps_frequent():
    pick, seen, summary = random.Random(1), collections.Counter(), {}
    for _ in range(50):
        part = collections.Counter(pick.choice([b"hot", pick.randbytes(2)]) for _ in range(40))
        seen += part
        summary = exact_dedup.misra_gries(summary, dict(part), 8)
        assert len(summary) <= 8
    assert b"hot" in summary


def test_warc(spark, tmp_path):
    big = "payload " * 40
    rows = [(1, "http://a/\r\n", big), (2, None, big), (3, "http://b", "small"), (4, "http://c", "small"), (5, "http://d", None), (None, "x", big), (1, "again", big), (6, "u", LONG), (7, "v", "é" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    files = warc.write_warc(pages, f"file://{tmp_path}/w")
    for split in (331, 1 << 20):
        got = warc.read_warc(files, split_bytes=split).collect()
        assert sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got) == sorted(
            (i or 0, "revisit" if h == big and i != 1 else "response", 1 if h == big and i != 1 else None, len((h or "").encode())) for i, _, h in rows)
        assert all(r.payload is None if r.record_type == "revisit" else hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got)
    assert warc.list_archives(spark, f"file://{tmp_path}/w").agg(F.sum("bytes")).first()[0] == files.agg(F.sum("bytes")).first()[0]
    assert warc.round_trip(empty(pages)).count() == 0
    # However short the ranges, each record is read once.
    path = files.orderBy(F.desc("records")).first().path
    size = len(open(path.removeprefix("file://"), "rb").read())
    everything = [*warc.records_in(path, 0, size)]
    assert len(everything) == len(rows) and [r for a in range(0, size, 7) for r in warc.records_in(path, a, a + 7)] == everything
    # Bytes between members and a false magic are scanned over.
    raw = b"junk" + warc.record(1, "u", b"abc", None, "") + b"\x1f\x8b\x08broken" + warc.record(2, "u", b"d", None, "") + b"\x1f\x8b"
    (tmp_path / "x.warc.gz").write_bytes(raw)
    found = [warc.parse(r, True)["page_id"] for a in range(0, len(raw), 5) for r in warc.records_in(f"file://{tmp_path}/x.warc.gz", a, a + 5)]
    assert found == [1, 2]


def member(head, block):
    return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_foreign_warc(spark, tmp_path):
    """Records that other writers make: other types and ids, header case and folding, no digest, wrong lengths, a member cut off."""
    http = b"HTTP/1.1 200 OK\r\ncontent-type: text/html\r\n\r\nhello"
    uuid = "<urn:uuid:92283950-ef2f-4d72-b224-f54c6ec90bb0>"
    whole = [
        member("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\nContent-Length: 9", b"a: b\r\nc: "),
        member(f"WARC/1.0\r\nwarc-type:response\r\nwarc-record-id:{uuid}\r\nwarc-target-uri: http://a/\r\n b\r\ncontent-type: Application/HTTP; msgtype=response\r\ncontent-length:{len(http)}", http),
        member("WARC/1.0\r\nWARC-Type: request\r\nContent-Type: application/http;msgtype=request\r\nContent-Length: 14", b"GET / HTTP/1.1"),
        member(f"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Refers-To: {uuid}\r\nContent-Type: application/http\r\nContent-Length: 19", b"HTTP/1.1 200 OK\r\n\r\n"),
        member("WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Payload-Digest: sha1:ABC\r\nContent-Length: 0", b""),
        member("WARC/1.0\r\nWARC-Type: response\r\nContent-Length: many", b"x"), member("WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99", b"x"),
        member("WARC/1.0\r\nno colon\r\nContent-Length: 1", b"x"), gzip.compress(b"not a record"), warc.record(5, "u", b"own", None, "")]
    raw = b"".join(whole) + member("WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 40000", bytes(random.Random(1).randbytes(40_000)))[:-100]
    (tmp_path / "f.warc.gz").write_bytes(raw)
    files = warc.list_archives(spark, f"file://{tmp_path}")
    for split in (1009, 1 << 20):
        got = warc.read_warc(files, split_bytes=split).collect()
        assert sorted((r.record_type, r.page_id or 0, r.record_id or "", r.refers_to_id or "", r.payload_digest or "", bytes(r.payload or b"")) for r in got) == sorted([
            ("response", 0, uuid[1:-1], "", hashlib.sha256(b"hello").hexdigest(), b"hello"), ("revisit", 0, "", uuid[1:-1], "", b""), ("revisit", 0, "", "", "sha1:ABC", b""),
            ("response", 5, "urn:tessera:page:5", "", hashlib.sha256(b"own").hexdigest(), b"own")])
        assert next(r.url for r in got if r.record_id == uuid[1:-1]) == "http://a/ b"
        everything = collections.Counter(r.record_type for r in warc.read_warc(files, split_bytes=split, types=None).collect())
        assert everything == {"warcinfo": 1, "request": 1, "response": 2, "revisit": 2, "malformed": 4}


def shingle_set(t, k):
    w = tuple((t or "").encode().lower().split())
    return frozenset(w[i : i + k] for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i, _ in sets}, {i: len(s) for i, s in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, docs, k):
    pick = random.Random(k)
    vocab = [f"v{i}" for i in range(400)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for g in range(12):
        base = [pick.choice(vocab) for _ in range(pick.choice((6, 40, 200)))]
        for c in range(pick.choice((1, 3, 30))):
            own = [pick.choice(vocab) if pick.random() < 0.03 else w for w in base]
            rows.append((1000 + 100 * g + c, " ".join(own)))
    want, sizes = brute_components(rows, k)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), width=k).collect()
    assert {r.id: r.component_id for r in got} == want and {r.id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.id == r.component_id) for r in got)
    assert minhash.near_duplicates(empty(docs), width=k).count() == 0
    odd = minhash.near_duplicates(docs, width=k).collect()
    assert len(odd) == docs.count() and all(r.kept and r.component_id is None for r in odd if r.id is None)
    assert minhash.filter_documents(docs).columns == docs.columns


def forest_keys(*minima):
    """Sorted keys of one tree whose low bytes begin as given."""
    keys = np.zeros((len(minima), minhash.KEY), np.uint8)
    for row, m in zip(keys, minima):
        row[minhash.KEY - minhash.DEPTH :][: len(m)] = m
    return keys


def test_dense_regions(monkeypatch):
    """Rows of a region with more than REGION rows at full depth are told, and linked with the next one only."""
    monkeypatch.setattr(minhash, "REGION", 3)
    keys = forest_keys(*[[1] * 16] * 5, [2, 1], [2, 1, 5])
    i, j, m, inside, crowded = minhash.neighbours(keys, np.zeros((7, 4), np.uint64))
    pairs = dict(zip(zip(i.tolist(), j.tolist()), inside.tolist()))
    assert crowded.tolist() == [0, 1, 2, 3, 4] and (0, 2) not in pairs and set(m.tolist()) == {minhash.HASHES}
    assert all(pairs[k, k + 1] for k in range(4)) and pairs[5, 6] is False and (4, 5) not in pairs


def test_crowded_runs(monkeypatch):
    """Rows that deeper regions part, as their run is denser than REGION at depth SURE, are told too."""
    monkeypatch.setattr(minhash, "REGION", 3)
    monkeypatch.setattr(minhash, "SURE", 2)
    i, j, _, inside, crowded = minhash.neighbours(forest_keys(*[[1, 1, 1]] * 3, *[[1, 1, 2]] * 3, *[[2, 1, 1]] * 2), np.zeros((8, 4), np.uint64))
    pairs = dict(zip(zip(i.tolist(), j.tolist()), inside.tolist()))
    assert pairs[0, 2] and (0, 4) not in pairs and not pairs[6, 7] and crowded.tolist() == [0, 1, 2, 3, 4, 5]


def test_partners():
    """The best of each row; pairs inside a crowded run count only as the best one, and are not waited for."""
    i, j = np.array([0, 0, 0, 1]), np.array([1, 2, 3, 2])
    m, ids, no = np.array([100, 120, 110, 99]), np.array([10, 11, 12, 13]), np.zeros(4, bool)

    def give(inside, most):
        a, b, _, more = minhash.partners(i, j, m, inside, ids, most)
        return [sorted(zip(a.tolist(), b.tolist())), more.tolist()]

    assert give(no, 1) == [[(10, 12), (11, 10), (12, 10), (13, 10)], [10, 11, 12]]
    assert give(no, 2) == [[(10, 12), (10, 13), (11, 10), (11, 12), (12, 10), (12, 11), (13, 10)], [10]]
    assert give(no, None)[1] == [] and len(give(no, None)[0]) == 8
    assert give(~no, 2) == [[(10, 12), (11, 10), (12, 10), (13, 10)], []]


def test_settle(spark, monkeypatch):
    """Rows outside a cluster's main component meet all its rows, across blocks; a cluster of one component gives nothing."""
    monkeypatch.setattr(minhash, "BLOCK", 64)
    texts = [" ".join(f"a{k}" for k in range(i, i + 60)) for i in range(0, 40, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, "other words that nobody shares")], "doc_id long, text string")
    clusters = spark.createDataFrame([(i, 0) for i in [*range(20), 99]], "id long, cluster long")
    joined = spark.createDataFrame([(i, 0) for i in range(10)] + [(i, 15) for i in range(15, 20)], "node long, component long")
    of = {i: 0 if i < 10 else 15 if 15 <= i < 20 else i for i in [*range(20), 99]}
    sets = {i: shingle_set(t, 2) for i, t in enumerate(texts)} | {99: shingle_set("other words that nobody shares", 2)}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    want = {(a, of[b]) for a in sets for b in sets if of[a] != 0 and of[a] != of[b] and linked(a, b)}
    got = minhash.settle(docs, clusters, joined, 2).collect()
    assert {(r.a, of[r.b]) for r in got} == want and all(linked(r.a, r.b) for r in got) and want
    assert minhash.settle(docs, clusters.where("id < 10"), joined, 2) is None


def test_borders(spark, monkeypatch):
    """Neighbours on both sides of a partition's border are found, however many partitions there are."""
    rows = [(i, " ".join(f"w{(i // 2) * 50 + k + (i % 2)}" for k in range(40))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (2_000, 60):  # in the second case partitions have fewer rows than a region may have
        monkeypatch.setattr(minhash, "PART_ROWS", size)
        got = minhash.near_duplicates(docs).collect()
        assert all(r.component_id == r.id // 2 * 2 for r in got)


@pytest.mark.parametrize("k", [2, 5])
def test_families(spark, k):
    """Families whose members lie around the threshold: crowded runs, several components, rows that are linked with nobody."""
    pick, rows = random.Random(10 + k), []
    for g, (n, rate) in enumerate(((260, 0.06 / k), (200, 0.12 / k), (150, 0.3 / k))):
        base = [f"f{g}x{pick.randrange(400)}" for _ in range(160)]
        for c in range(n):
            rows.append((1000 * g + c, " ".join(f"own{pick.randrange(10**6)}" if pick.random() < rate else w for w in base)))
    want, _ = brute_components(rows, k)
    got = {r.id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=k).collect()}
    assert len(set(want.values())) > 3 and got == want


def test_near_duplicates_on_a_whole_table(spark):
    """Against an exact join of all documents by their sets."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, n_shingles, component_id FROM ({ORACLE['op4_minhash']})").fetchall())
    assert sorted(tuple(r)[:3] for r in minhash.near_duplicates(docs, width=2).collect()) == want


def test_sketch_agrees_with_signature():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    sig = minhash.signatures([a, np.sort(a[:270])])
    same = int((sig[0] == sig[1]).sum())
    assert minhash.matches(minhash.sketches(sig)[:1], minhash.sketches(sig)[1:])[0] >= same > 95


def test_components(spark):
    pick = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000 + pick.randrange(60), 5000 + pick.randrange(60)) for _ in range(40)] + [(None, 3)]
    got, stars = ({r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), one_task=n).collect()} for n in (10**6, 0))
    parent = {}
    for a, b in edges:
        if a is not None and a != b:
            x, y = (a, b)
            for v in (x, y):
                parent.setdefault(v, {v})
            both = parent[x] | parent[y]
            for v in both:
                parent[v] = both
    assert got == stars == {v: min(s) for v, s in parent.items()}
    assert all(components(spark.createDataFrame([], "a long, b long"), one_task=n).count() == 0 for n in (10**6, -1))


def test_executors_rest(spark, docs, monkeypatch):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    before = sum(b.getCollectionCount() for b in beans)
    assert rest(spark) == spark.sparkContext.defaultParallelism
    assert sum(b.getCollectionCount() for b in beans) > before
    seen = []
    monkeypatch.setattr("tessera.llm.common.rest", seen.append)
    monkeypatch.setattr("corpus_pipeline.rest", seen.append)
    drop_tables(clean=True)
    assert len(seen) == 1
    assert corpus_pipeline.near(spark, docs, "").count() and len(seen) >= 3


def test_license_scan(docs, spark):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in license_scan.license_scan(docs).collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (TEXTS[r.id] or "").translate(lower)) if r.id is not None else None
        if w is not None:
            at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None)
            assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    notice = "x " * 9 + "Permission is hereby granted, free of charge, to ANY person getting hold of a copy of this software and associated documentation files"
    rows = [(1, notice), (1, notice), (2, "permission is hereby refused"), (3, "mit license " * 50)]
    got = {r.id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].n_base, got[1].base_labels) == ("mit", 0, "") and 0.6 <= got[1].score < 1
    assert (got[2].labels, got[2].score, got[3].n_base, got[3].last_word) == ("", 0.0, 50, 98)
    assert license_scan.license_scan(empty(docs)).count() == 0


def test_license_texts(spark):
    """Whole texts with words changed, left out and put in are found; the same words in another order are not."""
    pick, rows, texts = random.Random(5), [], [t for t in license_scan.TEMPLATES if not t[3] and len(t[2]) > 60]
    for n, (i, label, w, _, _) in enumerate(texts):
        changed = [x for k, x in enumerate(w) if k % 19 != 7]
        changed = [y for k, x in enumerate(changed) for y in ((x, "really") if k % 23 == 3 else ("other",) if k % 29 == 11 else (x,))]
        shuffled = w[:]
        pick.shuffle(shuffled)
        halves = w[len(w) // 2 :] + w[: len(w) // 2]
        rows += [(10 * n, "so: " + ". ".join(changed).upper() + " end"), (10 * n + 1, " ".join(shuffled)), (10 * n + 2, " ".join(f"{x} x" for x in w)), (10 * n + 3, " ".join(w + ["gap"] * 9 + w)),
                 (10 * n + 4, " ".join(halves))]
    got = {r.id: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, (i, label, w, _, _) in enumerate(texts):
        own = lambda k: [h for h in got[10 * n + k].hits if h.template == i]  # noqa: B023, E731
        assert len(own(0)) == 1 and 0.6 <= own(0)[0].share < 1 and own(0)[0].start >= 1 and label in got[10 * n].labels.split(",")
        assert not own(1) and not own(2) and got[10 * n + 1].score == got[10 * n + 2].score == 0.0
        assert [h.share for h in own(3)] == [1.0, 1.0] and own(3)[1].start == len(w) + 9
        assert all(h.share < 1 for h in own(4))
    # Only A-Z is folded: two other capitals whose lower case is ASCII do not make a phrase.
    odd = license_scan.license_scan(spark.createDataFrame([(1, "M\u0130T license"), (2, "cc0 1 0 \u212a"), (3, "MIT  LICENSE")], "doc_id long, text string")).collect()
    assert [(r.id, r.labels, r.n_words) for r in sorted(odd)] == [(1, "", 2), (2, "cc0", 4), (3, "mit", 2)]


def test_line_dedup(spark):
    rows = [(i, f"https://u@Site.org:80/{i}?q", f"<nav>Home</nav><script>x='<p>'</script><p>own {i}</p><!-- c --><p>Home <b>bold</b>&amp;</p><div></div>") for i in range(10)]
    rows += [(90, None, None), (91, "no host", "<p>Home</p>"), (92, "http://other/", "<nav>Home</nav>"), (None, "http://site.org/", "<p>Home</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.id: r for r in line_dedup.line_dedup(pages).collect()}
    assert len(got) == 14 and all(got[i].text == f"own {i}" and (got[i].n_lines, got[i].n_dropped) == (3, 2) for i in range(10))
    assert (got[91].text, got[92].text, got[90].n_lines, got[None].text, got[90].host) == ("Home", "Home", 0, "", "")
    assert line_dedup.line_dedup(empty(pages)).count() == 0


def test_packing(docs):
    path = registry.tokenizer_path()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, capacity=64, ids=True)
    rows = got.collect()
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        own = sorted((r for r in rows if r.id == i), key=lambda r: r.piece)
        for r in own:
            part = np.array(ids[r.start : r.start + 64], "<u4").tobytes()
            assert r.length == len(part) // 4 and r.ids_crc32 == zlib.crc32(part) and r.ids == part
        if i != 5:  # a repeated row
            assert sum(r.length for r in own) == len(ids) and [r.piece for r in own] == list(range(-(-len(ids) // 64)))
    for s in {r.sequence_id for r in rows}:
        end = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 64
    assert len({r.sequence_id for r in rows}) <= -(-sum(r.length for r in rows) // 64) + 2
    assert packing.sequences(got).agg(F.sum("n_tokens")).first()[0] == sum(r.length for r in rows)
    assert packing.pack_documents(empty(docs), path).count() == 0


def test_best_fit_bound():
    pick, packer, used = random.Random(4), packing.BestFit(100, 5), collections.Counter()
    for _ in range(3000):
        n = pick.randint(1, 100)
        s, offset = packer.place(n)
        assert used[s] == offset
        used[s] += n
        assert used[s] <= 100 and packer.open <= 5


def test_mixing(docs, spark):
    rows = [(i, "w " * (1 + i % 37), f"s{0 if i % 3 == 0 else i % 7}") for i in range(3000)]
    big = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for df in (docs, big):
        size = collections.Counter()
        for r in df.collect():
            size[r.source] += len(words(r.text))
        order = sorted(size, key=lambda s: (s is None, s or ""))
        target, free, total = {}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, sum(size.values())
        while True:
            share = {s: (total - sum(target.values())) * w / sum(free.values()) for s, w in free.items()}
            full = [s for s in share if share[s] > 3 * size[s]]
            if not full:
                target |= share
                break
            target |= {s: 3 * size[s] for s in full}
            free = {s: w for s, w in free.items() if s not in full}
        planned = mixing.plan(df, block_words=500, shards=4).collect()
        assert len(planned) == df.count()
        taken = collections.Counter()
        for r in planned:
            assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target) and len(r.draws) <= 3
            assert len({d.epoch for d in r.draws}) == len(r.draws) and all(0 <= d.shard < 4 for d in r.draws)
            taken[r.source] += r.size * len(r.draws)
        if df is big:
            assert all(abs(taken[s] - target[s]) <= 40 for s in order)
            # A block lies in one shard in each epoch, and epochs come in different orders.
            shard = collections.defaultdict(set)
            for r in planned:
                for d in r.draws:
                    shard[r.source, r.block, d.epoch].add(d.shard)
            assert all(len(x) == 1 for x in shard.values()) and len({min(x) for x in shard.values()}) == 4
    mixed = mixing.mix(big, shards=4, block_words=500)
    place = [(r.shard, r.place) for r in mixed.select("shard", "place").collect()]
    assert len(set(place)) == len(place) and all(a < b or a[0] != b[0] for a, b in zip(place, place[1:]))
    mixed = mixed.collect()
    assert sum(len(words(r.doc.text)) for r in mixed) == sum(taken.values())
    assert sorted(map(str, mixed)) == sorted(map(str, mixing.mix(big, shards=4, block_words=500).collect()))
    assert mixing.mix(empty(docs)).count() == 0 and mixing.mix(docs).where("doc.doc_id = 12").count() <= 3
    assert mixing.plan(docs.where("doc_id < 3")).selectExpr("sum(size * size(draws))").first()[0] == 0  # all sizes are 0


def test_mixing_targets_against_sql(spark):
    """Sizes, source sizes and targets of a whole table, with the reshare as a fixed number of SQL rounds."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rounds = "".join(f""", l{k + 1} AS (SELECT s.*, CASE WHEN 3 * s.source_size < v * w THEN 3.0 * s.source_size END AS "full", v FROM s, (SELECT
        ((SELECT sum(source_size) FROM s) - coalesce(sum("full"), 0)) / sum(CASE WHEN "full" IS NULL THEN w END) AS v FROM l{k}))""" for k in range(8))
    want = con.execute(rf"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
        l0 AS (SELECT s.*, CAST(NULL AS DOUBLE) AS "full", 0.0 AS v FROM s) {rounds}
        SELECT doc_id, size, source_size, least(3.0 * source_size, v * w) AS target FROM d JOIN l8 USING (source)""").fetchall()
    got = {r.doc_id: r for r in registry.queries()["op8_mixing"](spark, SF).collect()}
    assert len(got) == len(want)
    for doc, size, of, target in want:
        assert (got[doc].size, got[doc].source_size) == (size, of) and abs(got[doc].target - target) < 1e-6 * target


def test_split_quotas(spark):
    quotas = [101, 36, 3, 0] + [7] * 96
    for shards in (1, 4, 5):
        cut = mixing.split_quotas(spark.createDataFrame(list(enumerate(quotas)), "number long, quota long"), shards).collect()
        per, by = collections.Counter(), collections.defaultdict(list)
        for r in cut:
            per[r.shard] += r.n
            by[r.number].append((r.shard, r.first, r.n))
        assert [sum(n for *_, n in by[i]) for i in range(100)] == quotas and all(n >= 0 for x in by.values() for *_, n in x)
        assert len(per) == shards and max(per.values()) - min(per.values()) <= 2
        for x in by.values():  # runs without gaps
            at = 0
            for _, first, n in sorted(x):
                assert first == at
                at += n
    # Counts of a source in the first of two shards follow the hypergeometric distribution.
    seen = [mixing.split_quotas(spark.createDataFrame([(0, 6), (1, 10)], "number long, quota long"), 2, seed).where("number = 0 and shard = 0").first().n for seed in range(4)]
    assert 1 < sum(seen) / 4 < 5


def test_permutation(spark):
    for n in (1, 2, 7, 64, 1000):
        got = spark.range(n).select(*(mixing.permuted(F.col("id"), F.lit(n), F.lit(24), F.lit(seed), F.lit("s")).alias(f"p{seed}") for seed in (1, 2))).collect()
        assert all(sorted(r[k] for r in got) == list(range(n)) for k in (0, 1)) and (n < 10 or [r.p1 for r in got] != [r.p2 for r in got])


def test_hypergeometric(spark):
    u = spark.range(4000).select(mixing.hypergeometric(F.lit(50), F.lit(20), F.lit(10), (F.col("id") + 0.5) / 4000).alias("x"))
    got = collections.Counter(r.x for r in u.collect())
    for k in range(11):
        assert abs(got[k] / 4000 - math.comb(20, k) * math.comb(30, 10 - k) / math.comb(50, 10)) < 1e-3


def test_chat(spark):
    hard = "\\### x\\n</turn>\n\\\\"
    nodes = [("c", 1, None, "user", hard, 0.0), ("c", 2, 1, "assistant", hard, 1.0), ("c", 3, 1, "assistant", "b", 5.0), ("c", 4, 2, "us\ner\\n", None, 9.0), ("c", 4, 2, "z", "late", 0.0),
             ("d", 7, 99, None, "root", None), ("e", 1, 2, "user", "cycle", 0.0), ("e", 2, 1, "user", "cycle", 0.0), ("f", None, None, "user", "no id", 0.0), (None, 1, None, "assistant", "n", 1.0)]
    nodes += [("long", i, i - 1 if i else None, ("user", "assistant")[i % 2], f"t{i}", 0.0) for i in range(37)]
    df = spark.createDataFrame(nodes, "conv string, node long, parent long, role string, text string, score double")
    got = chat.format_chats(df, branches=2).withColumns({"turns": chat.read_turns(F.col("formatted")), "under": chat.loss_text(F.col("formatted"), F.col("loss"))}).collect()
    by = {(r.conv, r.rank): r for r in got}
    assert set(by) == {("c", 1), ("c", 2), ("d", 1), (None, 1), ("long", 1)}
    turns = lambda k: [tuple(t) for t in by[k].turns]
    assert turns(("c", 1)) == [("user", hard), ("assistant", "b")]
    assert turns(("c", 2)) == [("user", hard), ("assistant", hard), ("us\ner\\n", "")] and by["c", 2].under == hard
    assert turns(("d", 1)) == [("", "root")] and [t[1] for t in turns(("long", 1))] == [f"t{i}" for i in range(37)]
    assert by["long", 1].under == "".join(f"t{i}" for i in range(1, 37, 2)) and by["long", 1].n_turns == 37
    assert chat.format_chats(empty(df)).count() == 0


def test_classifier(spark, docs, labels):
    pick = random.Random(6)
    vocab = [f"v{i}" for i in range(200)]
    rows, quality = [], []
    for i in range(1200):
        good = pick.random() < 0.7
        w = [pick.choice(vocab) for _ in range(30)]
        rows.append((i, " ".join(w if good else [x.upper() + "!!" for x in w]), f"h{i % 5}", "p"))
        quality.append((i, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    fitted = quality_classifier.quality_classifier(df, spark.createDataFrame(quality[:600], "id long, quality int")).collect()
    truth = dict(quality)
    assert sum(r.kept == truth[r.id] for r in fitted if r.id >= 600) / 600 > 0.97
    got = quality_classifier.quality_classifier(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.probability <= 1 for r in got)
    assert all(r.probability == 0.5 for r in quality_classifier.quality_classifier(docs, empty(labels)).collect())
    assert quality_classifier.quality_classifier(empty(docs), labels).count() == 0
    site = {r.host.value: r.posterior for r in quality_classifier.site_posteriors(spark.createDataFrame(
        [("big", "p", 1)] * 200 + [("big2", "p", 0)] * 200 + [("one", "p", 0)], "h string, p string, quality int").selectExpr(
        "struct(false as none, h as value) host", "struct(false as none, p as value) path", "quality")).collect()}
    assert site["big"] > 0.95 > 0.05 > site["big2"] and site["big2"] < site["one"] < site["big"]


def test_classifier_against_brute_force(spark):
    """Logits against the optimum of the same ridge regression found by Newton steps, posteriors and probabilities against sums by hand."""
    pick = random.Random(8)
    rows, truth = [], {}
    for i in range(500):
        good = pick.random() < 0.6
        words = [pick.choice("alpha beta gamma delta".split() if pick.random() < (0.8 if good else 0.3) else "zip zap zop!".split()) for _ in range(pick.randint(5, 30))]
        rows.append((i, " ".join(words), f"h{i % 7}" if i % 11 else None, f"p{i % 3}"))
        truth[i] = int(good)
    labelled = [i for i in range(500) if i % 5 and i % 7 != 6]  # a host without labels
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.id: r for r in quality_classifier.quality_classifier(docs, spark.createDataFrame([(i, truth[i]) for i in labelled], "id long, quality int")).collect()}
    # The regression, on columns that occur.
    made = [quality_classifier.features(t.encode()) for _, t, _, _ in rows]
    used = sorted({int(c) for i, _ in made for c in i})
    x = np.zeros((500, len(used)))
    for k, (i, v) in enumerate(made):
        x[k, [used.index(int(c)) for c in i]] = v
    fit, y, w = x[labelled], np.array([truth[i] for i in labelled], float), np.zeros(len(used))
    for _ in range(50):
        p = 1 / (1 + np.exp(-fit @ w))
        w -= np.linalg.solve(fit.T @ (fit * (p * (1 - p))[:, None]) / len(y) + 1e-3 * np.eye(len(used)), fit.T @ (p - y) / len(y) + 1e-3 * w)
    assert max(abs(got[i].logit - x[i] @ w) for i in range(500)) < 0.1  # the operator's steps stop near the optimum
    # Hosts around the global rate, paths around their host, strengths by moments.
    host, path = lambda i: rows[i][2], lambda i: (rows[i][2], rows[i][3])
    count = lambda key: {k: ([truth[i] for i in labelled if key(i) == k]) for k in {key(i) for i in labelled}}
    rate = (sum(truth[i] for i in labelled) + 1) / (len(labelled) + 2)

    def strength(groups, prior):
        m = [prior(k) * (1 - prior(k)) for k in groups]
        between = sum(len(g) * (sum(g) / len(g) - prior(k)) ** 2 - v for (k, g), v in zip(groups.items(), m)) / max(1, sum(len(g) - 1 for g in groups.values()))
        return min(1e6, max(2.0, sum(m) / len(m) / between - 1)) if between > 0 else 1e6

    hosts, paths = count(host), count(path)
    a = strength(hosts, lambda k: rate)
    of_host = {k: (sum(g) + a * rate) / (len(g) + a) for k, g in hosts.items()}
    b = strength(paths, lambda k: of_host[k[0]])
    of_path = {k: (sum(g) + b * of_host[k[0]]) / (len(g) + b) for k, g in paths.items()}
    held = math.log(y.mean() / (1 - y.mean()))
    for i in range(500):
        site = of_path.get(path(i), of_host.get(host(i), rate))
        assert abs(got[i].site_rate - site) < 1e-9
        assert abs(got[i].probability - 1 / (1 + math.exp(-(got[i].logit + math.log(site / (1 - site)) - held)))) < 1e-9 and got[i].kept == (got[i].probability >= 0.2)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    canon = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert canon(got.select(*columns).collect()) == canon(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    read, columns = docs, docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        read = corpus_pipeline.materialize(stage(spark, read, SF), "test")
        assert read.columns == columns
        kept.append(read.select("doc_id", "text").collect())
    assert len(kept[0]) == quality_rules.quality_rules(docs, registry._labels(spark, SF)).where("kept").count()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    first = {}
    for r in sorted(kept[0], key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert sorted(r.doc_id for r in kept[1]) == sorted(first.values())
    comp, _ = brute_components([(r.doc_id, r.text) for r in kept[1]], 5)
    assert sorted(r.doc_id for r in kept[2]) == sorted(set(comp.values()))
    assert {r.doc_id for r in kept[3]} <= {r.doc_id for r in kept[2]}
    out = corpus_pipeline.STAGES[-1][1](spark, read, SF)
    assert out.where("piece = 0").count() == len(kept[3]) and corpus_pipeline.run(spark, SF).count() == out.count()


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns, and empty tables."""
    long = " ".join(f"long{i} text{i % 13}" for i in range(9_000))
    prose = [f"the {i} quick brown fox number {i * 7} jumps over some lazy dog {i % 3} near river {i}" for i in range(12)]
    rows = [(i, t, None if i % 4 == 1 else "en", None if i % 5 == 2 else f"s{i % 2}", 1, "x") for i, t in enumerate([None, "", " \n", *prose, long, long + " end"])]
    rows += [rows[4], rows[4], (None, prose[5], None, None, None, None), (None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, size long, draws string"
    labels = "doc_id long, quality long, toxic long"
    for name, data, marks in (("odd", rows, [(i, i % 2, 0) for i in range(8)] + [(None, 1, 0), (3, None, 0)]), ("none", [], [])):
        folder = f"file://{tmp_path}/{name}"
        spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(marks, labels).write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.materialize(f(spark, docs, folder), "odd")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            if stage == "near dedup":
                # The long texts are near copies; of equal texts one row stays, whatever its id.
                assert sorted(r.text for r in docs.collect()) == (sorted([*prose, long]) if data else [])
        out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert out.where("piece = 0").count() == docs.count()
