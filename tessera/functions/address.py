"""Address parsing as column expressions: postal code, state, city and house number.

Where two states match, the longer name wins, then the alphabetically first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.constants import ADDRESS_TOKENS, INDIAN_STATES, US_STATES
from tessera.functions.text import fold_unicode, mapped_tokens


def _none(text: Column) -> Column:
    return F.when(text != "", text)


def norm_addr(cleaned: Column) -> Column:
    return F.array_join(mapped_tokens(cleaned, ADDRESS_TOKENS), " ")


def postal(raw: Column, country: Column) -> Column:
    """The first run of five digits (six in India) that stands alone."""
    digits = lambda n: _none(F.regexp_extract(F.coalesce(raw, F.lit("")), rf"(?U)\b(\d{{{n}}})\b", 1))
    return F.when(country == "India", digits(6)).otherwise(digits(5))


def by_length(names: list[str]) -> list[str]:
    return sorted(names, key=lambda s: (-len(s), s))


def state(addr: Column, country: Column) -> Column:
    """Abbreviation in the US, name in India, null elsewhere.  addr is normalised."""
    padded = F.concat(F.lit(" "), addr, F.lit(" "))
    whole = lambda words: F.contains(padded, F.lit(f" {words} "))
    us = F.coalesce(*(F.when(whole(s), F.lit(US_STATES[s])) for s in by_length(list(US_STATES))),
                    *(F.when(whole(a.lower()), F.lit(a)) for a in sorted(US_STATES.values())))
    india = F.coalesce(*(F.when(whole(s), F.lit(s)) for s in by_length(INDIAN_STATES)))
    return F.when(country == "US", us).when(country == "India", india)


def house_no(cleaned: Column) -> Column:
    return _none(F.regexp_extract(cleaned, r"^\s*(\d+[a-z]?(?:[\s/-]\d+)?)\b", 1))


def city(raw: Column, folded: Column, st: Column) -> Column:
    """The comma segment just before the state, else the last city-like one before it, else the last after the first segment, else the first.

    folded: the cleaned segments of raw, in order.
    """
    parts = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda s: F.trim(s)), lambda s: s != "")
    want = F.lower(F.coalesce(st, F.lit("")))
    rows = F.transform(parts, lambda s, i: F.struct(i.alias("i"), F.lower(s).alias("low"), s.alias("raw"), F.get(folded, i).alias("c")))
    rows = F.transform(rows, lambda r: F.struct(r["i"].alias("i"), r["c"].alias("c"), ((want != "") & F.contains(r["low"], want)).alias("is_state"), r["raw"].alias("raw")))
    digits, letters = (lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))), (lambda c: F.length(F.regexp_replace(c, "[^a-z]", "")))
    likely = F.filter(rows, lambda r: ~r["is_state"] & (r["c"] != "") & ~((want != "") & F.contains(r["c"], want))
                      & ~r["raw"].rlike(r"^(\d{5}(-\d{4})?|\d{6})$") & ~r["c"].rlike(r"^\d") & (letters(r["c"]) > 0) & (digits(r["c"]) <= letters(r["c"])))
    at = F.coalesce(F.array_max(F.transform(F.filter(rows, lambda r: r["is_state"]), lambda r: r["i"])), F.lit(-1))
    first = lambda a: F.get(a, F.lit(0))["c"]
    last = lambda a: F.try_element_at(a, F.lit(-1))["c"]
    before = F.filter(likely, lambda r: r["i"] < at)
    return F.coalesce(
        F.when(at > 0, first(F.filter(likely, lambda r: r["i"] == at - 1))), last(before),
        F.when(F.size(likely) > 1, last(F.filter(likely, lambda r: r["i"] > 0))), first(likely))


def folded_segments(raw: Column) -> Column:
    """Cleaned comma segments, folded in one pass: commas survive the fold as line breaks do not occur inside a segment."""
    trimmed = F.array_join(F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda s: F.regexp_replace(F.trim(s), r"\s+", " ")), lambda s: s != ""), "\n")
    each = F.split(F.lower(fold_unicode(trimmed)), "\n")
    return F.transform(each, lambda s: F.trim(F.regexp_replace(F.regexp_replace(s, "[^a-z0-9 ]", " "), " +", " ")))
