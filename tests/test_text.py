import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity, text
from tessera.functions.similarity import KERNELS, LONGEST, jaro_winkler, lcs, partial_ratio, ratio, scores, token_set_ratio, token_sort_ratio
from tessera.operators.normalize import normalize

ROWS = [
    ("a", "The Quill Corp.", "ASHEVILLE, NC, 27 1/2 PEBBLE WALK", "US"), ("b", "", "3310 Juniper Drive, Cedar Falls, SD", "US"),
    ("c", "Oakum Inc LLC", "88 Mill St, Fairview, OR 97024", "US"), ("d", "नमक", "H-7/204, LOTUS ENCLAVE, NAGPUR, Maharashtra", "India"),
    ("e", "Crème Brûlée", "PLOT NO. -31/9, NEW DELHI, SOUTH DELHI, Delhi, 110031", "India"), ("f", "Straßburg Köln", "640 Larch Drive, Unit APARTMENT C, Rockville, MD", "US"),
    ("g", None, "", "US"), ("h", "Maison du Lin", "9 Quai du Vieux Moulin, 31000, Toulouse", "France"), ("i", "x", None, None),
    ("j", "w", "5 Elm Ave, Beckley, West Virginia", "US"),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(ROWS, "entity_id string, business_name string, business_address string, country string")
    return {r.entity_id: r for r in normalize(df).collect()}


def test_names(rows):
    assert rows["a"].norm_name == "quill corporation" and rows["a"].name_tokens == ["quill", "corporation"]
    assert (rows["b"].norm_name, rows["b"].name_tokens) == ("", [])
    assert rows["c"].norm_name == "oakum incorporated llc"
    assert rows["d"].norm_name == "nmk" and rows["d"].has_devanagari
    assert rows["e"].norm_name == "creme brulee" and rows["f"].norm_name == "straburg koln" and rows["h"].norm_name == "maison du lin"
    assert rows["g"].norm_name == "" and rows["i"].country == "UNK"


def test_addresses(rows):
    assert (rows["a"].city, rows["a"].state) == ("asheville", "NC")
    assert (rows["b"].city, rows["b"].state, rows["b"].house_no) == ("cedar falls", "SD", "3310")
    assert (rows["c"].zip, rows["c"].state, rows["c"].city) == ("97024", "OR", "fairview")
    assert (rows["d"].city, rows["d"].state) == ("nagpur", "maharashtra")
    assert rows["e"].zip == "110031" and rows["f"].state == "MD" and rows["f"].house_no == "640"
    assert (rows["g"].norm_addr, rows["g"].zip, rows["g"].city) == ("", None, None)
    assert rows["h"].zip == "31000" and rows["h"].state is None
    assert rows["i"].norm_addr == "" and rows["j"].state == "WV"
    assert "street" in rows["c"].norm_addr


def soundex(name):
    """Runs of equal digits, of which the first one is the first letter's: what is left after the zeros go."""
    from itertools import groupby

    letters = re.sub(r"\s", "", name.lower())
    digits = "".join(next((d for d, group in (("1", "bfpv"), ("2", "cgjkqsxz"), ("3", "dt"), ("4", "l"), ("5", "mn"), ("6", "r")) if ch in group), "0") for ch in letters)
    runs = [d for d, _ in groupby(digits)]
    return letters[:1].upper() + "".join(d for d in runs[1:] if d != "0")[:3].ljust(3, "0") if letters else ""


def test_soundex(spark):
    pick = random.Random(1)
    names = ["", "ashcraft", "3m company", "mcdonald", "macdonald"] + ["".join(pick.choice("abcdehkmpstvwyz 19") for _ in range(pick.randint(1, 12))).strip() for _ in range(300)]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", text.soundex_code(F.col("n")).alias("c")).collect()
    assert all(r.c == soundex(r.n) for r in got)


def test_soundex_by_hand(spark):
    want = {"tulip": "T410", "pfister": "P236", "quay": "Q000", "banana bread": "B551", "5 mills": "5542"}
    rows = spark.createDataFrame([(k,) for k in want], "n string").select("n", text.soundex_code(F.col("n")).alias("c")).collect()
    assert {r.n: r.c for r in rows} == want


def test_gram_cosine(spark):
    """Against counts of grams, with grams that repeat on both sides."""
    pick = random.Random(4)
    rows = [("", "abc"), ("ab", "ab"), ("aaaaaa", "aaaa"), ("banana band", "bananas ban")]
    rows += [tuple("".join(pick.choice("ab c1") for _ in range(pick.randint(0, 25))) for _ in range(2)) for _ in range(200)]
    for n in (3, 4):
        vector = lambda c: text.gram_vector(text.gram_codes(F.col(c), n))  # noqa: B023, E731
        got = spark.createDataFrame(rows, "a string, b string").select("a", "b", text.gram_cosine(vector("a"), vector("b")).alias("x")).collect()
        for r in got:
            x, y = (Counter(t[i : i + n] for i in range(len(t) - n + 1)) for t in (r.a, r.b))
            norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
            assert abs(r.x - (sum(v * y[k] for k, v in x.items()) / norm if norm else 0.0)) < 1e-12


def test_scripts(spark):
    rows = spark.createDataFrame([("مرحبا",), ("Hello",), ("कंपनी",), (None,), ("naïve — ok 1",)], "n string")
    assert [r.x for r in rows.select(text.has_non_latin(F.col("n")).alias("x")).collect()] == [True, False, False, False, False]


def dp_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_kernels():
    pick = random.Random(2)
    word = lambda n: "".join(pick.choice("abc d") for _ in range(pick.randint(0, n)))
    for _ in range(500):
        a, b = word(14), word(14)
        assert lcs(a, b) == dp_lcs(a, b)
        short, long = sorted((a, b), key=len)
        cuts = {long[i:j] for i in range(len(long)) for j in range(i + 1, len(long) + 1) if j - i == len(short) or (j - i < len(short) and (i == 0 or j == len(long)))}
        if short and len(a) != len(b):
            assert abs(partial_ratio(a, b) - max(2 * dp_lcs(short, c) / (len(short) + len(c)) for c in cuts)) < 1e-12
    assert ratio("", "") == 1.0 and token_sort_ratio("b a", "a b") == 1.0 and token_set_ratio("a b", "a b c") == 1.0 and token_set_ratio("", "") == 0.0
    assert round(jaro_winkler("martha", "marhta"), 4) == 0.9611 and jaro_winkler("", "a") == 0.0 and jaro_winkler("a", "a") == 1.0


def test_kernels_in_tiles():
    """Tiles give what the functions of one pair give: other letters, pairs as long, copies, texts too long for a tile."""
    pick = random.Random(5)
    word = lambda n, letters: "".join(pick.choice(letters) for _ in range(pick.randint(0, n)))
    pairs = [("", ""), ("", "a"), (" ", "a b"), ("a b", "b a")]
    for most, letters, count in ((12, "abc d", 1500), (70, "abcdefgh  ij", 400), (140, "abcdefghijklmnopq  rs", 100), (LONGEST + 50, "ab cdef", 12), (6, "äकb 漢", 200)):
        pairs += [(word(most, letters), word(most, letters)) for _ in range(count)]
    for text_ in [word(60, "abcdef gh") for _ in range(100)]:
        mixed = "".join(pick.sample(text_, len(text_)))
        pairs += [(text_, mixed), (text_, text_), (text_, text_[5:30]), (text_, mixed)]
    pairs += [(chr(300 + i), chr(300 + i) + "x") for i in range(300)]  # more letters than a byte holds
    got = scores(tuple(KERNELS), [p[0] for p in pairs], [p[1] for p in pairs])
    for name, one in KERNELS.items():
        assert got[name].tolist() == [one(*p) for p in pairs], name


def test_records_take_ten_words(spark, tmp_path):
    """However a text begins and whatever comes after its words."""
    from tessera.sources import projection

    texts = ["", "  ", " a b", "a b c d e f g h i j", "\n1 2 3 4 5 6 7 8 9 10 11 12 13", "1 2 3 4 5 6 7 8 9 10 ", None, "x " * 40]
    spark.createDataFrame([(10 * i, t, "en", "src0") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.text: (r.business_name, r.business_address) for r in projection.records(spark, f"file://{tmp_path}").collect()}
    for i, t in enumerate(texts):
        w = None if t is None else re.findall(r"[^ \n\t\r]+", t)
        assert got[t] == ((None, None) if w is None else (" ".join(w[:8]), f"{10 * i} Main St, {' '.join(w[8:10])}, NC {10 * i % 97:05d}"))


def test_best_token_sets(monkeypatch):
    """As all pairs scored one by one: ties by place, empty texts, contained ones, many rounds."""
    pick = random.Random(3)
    words = ["".join(pick.choice("abcdehtn") for _ in range(pick.randint(1, 6))) for _ in range(60)]
    made = lambda n: [" ".join(pick.choice(words) for _ in range(pick.choice([0, 1, 2, 5, 8, 9, 40]))) for _ in range(n)]
    for most in (1 << 18, 50):
        monkeypatch.setattr(similarity, "MEET", most)
        for n, m, k in ((40, 60, 10), (5, 3, 10), (1, 200, 3), (60, 60, 1), (0, 5, 3), (4, 0, 2)):
            a, b = made(n), made(m)
            want = [(i, j) for i, s in enumerate(a) for _, j in sorted((-100 * token_set_ratio(s, t), j) for j, t in enumerate(b))[:k]]
            i, j = similarity.best_token_sets(a, b, k)
            assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(want)
