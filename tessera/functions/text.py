"""Name normalisation, n-grams and the phonetic code, as column expressions.

Only Unicode folding leaves the JVM: an Arrow UDF that touches no more than the
values with non-ASCII characters.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.constants import DEVANAGARI, NAME_STOPWORDS, NAME_TOKENS, SOUNDEX_DIGITS

_DEVANAGARI = str.maketrans(DEVANAGARI)


def fold(text: str) -> str:
    """Compatibility form, Devanagari by table, then base letters; other non-ASCII characters are dropped."""
    text = unicodedata.normalize("NFKC", text).translate(_DEVANAGARI)
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


@F.pandas_udf(T.StringType())
def fold_unicode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or t.isascii() else fold(t))


def clean(text: Column) -> Column:
    """Folded, lower case, [a-z0-9] words with single spaces; null becomes ''."""
    lower = F.lower(fold_unicode(F.coalesce(text, F.lit(""))))
    return F.trim(F.regexp_replace(F.regexp_replace(lower, r"[^a-z0-9\s]", " "), r"\s+", " "))


def string_map(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def mapped_tokens(cleaned: Column, table: dict[str, str]) -> Column:
    """Words of a cleaned text, each replaced by the table; those replaced by '' go."""
    names = string_map(table)
    words = F.transform(F.split(cleaned, " "), lambda t: F.coalesce(F.try_element_at(names, t), t))
    return F.filter(words, lambda t: t != "")


def blocking_tokens(tokens: Column) -> Column:
    """Distinct tokens of three letters or more that are not stopwords."""
    return F.array_distinct(F.filter(tokens, lambda t: (F.length(t) >= 3) & ~t.isin(NAME_STOPWORDS)))


def has_devanagari(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[\x{0900}-\x{097F}]"), F.lit(False))


def has_non_latin(text: Column) -> Column:
    """Whether a character is beyond Latin and Devanagari, and no space, digit or punctuation."""
    return F.coalesce(text.rlike(r"[^\x{0000}-\x{024F}\x{0900}-\x{097F}\p{P}\p{Nd}\p{Z}]"), F.lit(False))


def soundex_code(name: Column) -> Column:
    """First letter, then up to three digits; a digit repeats only after another one, vowels included.  '' for ''."""
    joined = F.regexp_replace(F.lower(name), r"\s+", "")
    digits = F.translate(F.regexp_replace(joined, "[^a-z]", "a"), "abcdefghijklmnopqrstuvwxyz", SOUNDEX_DIGITS)
    runs = F.regexp_replace(digits, r"(.)\1+", "$1")
    code = F.regexp_replace(F.substr(runs, F.lit(2)), "0", "")
    return F.when(joined == "", F.lit("")).otherwise(F.concat(F.upper(F.left(joined, F.lit(1))), F.rpad(F.left(code, F.lit(3)), 3, "0")))


def ngrams(text: Column, n: int) -> Column:
    """All n-grams in order, with repeats; none if the text is shorter."""
    size = F.length(text)
    return F.when(size >= n, F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def trigram_set(text: Column) -> Column:
    """Distinct trigrams; of a text shorter than three, its characters."""
    return F.array_distinct(F.when(F.length(text) >= 3, ngrams(text, 3)).otherwise(ngrams(text, 1)))


def token_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets, 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def set_overlap(a: Column, b: Column) -> Column:
    """token_overlap() of arrays without repeats: one pass over both."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def gram_vector(grams: Column) -> Column:
    """What a text brings to its cosines: its distinct grams, those that repeat (n - 1 times each), and the norm of the counts.

    Names and addresses repeat few grams, so products over the repeats are short.
    """
    def made(g: Column) -> Column:
        ordered = F.array_sort(g)
        return F.struct(F.array_distinct(g).alias("once"), F.filter(ordered, lambda x, i: (i > 0) & (x == F.get(ordered, i - 1))).alias("again"))

    def normed(v: Column) -> Column:
        return F.struct(v["once"].alias("once"), v["again"].alias("again"), F.sqrt((F.size(v["once"]) + 2 * F.size(v["again"]) + _matches(v["again"], v["again"])).cast("double")).alias("norm"))

    # Inside transform() each part is evaluated once.
    return F.transform(F.transform(F.array(grams), made), normed)[0]


def _matches(a: Column, b: Column) -> Column:
    """The number of pairs of equal elements, one from each array."""
    return F.aggregate(a, F.lit(0), lambda n, x: n + F.size(F.filter(b, lambda y: y == x)))


def gram_cosine(a: Column, b: Column) -> Column:
    """Cosine of two gram_vector()s, 0 if either text has no grams.

    With counts 1 + r the sum of products is the number of common grams, plus
    the repeats of either side that the other side has, plus products of repeats.
    """
    inside = lambda many, once: F.size(F.filter(many, lambda x: F.array_contains(once, x)))
    dot = F.size(F.array_intersect(a["once"], b["once"])) + inside(a["again"], b["once"]) + inside(b["again"], a["once"]) + _matches(a["again"], b["again"])
    return F.when((F.size(a["once"]) > 0) & (F.size(b["once"]) > 0), dot / (a["norm"] * b["norm"])).otherwise(F.lit(0.0))


def gram_codes(text: Column, n: int) -> Column:
    """ngrams() of an ASCII text as whole numbers, a byte for each character (n up to 7)."""
    return F.transform(ngrams(text, n), lambda g: F.conv(F.hex(g), 16, 10).cast("long"))
