"""Site-relative line deduplication (operator 6).

Native: DataFrame functions only.

A page's lines are the visible text between block tags.  Grouped by host, the pages that
contain a line are divided by the host's pages; a line whose ratio exceeds
``max_ratio`` on a host with at least ``min_pages`` pages, and which stands on at
least ``min_copies`` of them, is boilerplate there and is dropped from all its pages.

Lines count once per page by a distinct of (host, line hash, page), pre-aggregated;
a host with a third of all pages is spread over its lines.  A host's boilerplate is at most (lines per page) /
``max_ratio`` hashes; pages themselves are not shuffled while the table of hosts
with boilerplate is small enough to broadcast.

Cases: null html has no lines; a null url, or one without a host, belongs to the host ''.
Empty lines are dropped before counting.  Repeated rows with one id count as one page.
Lines are compared after runs of white space became one space; case and digits count.
A null id counts as one page of its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import key_part, materialize, small

MAX_RATIO = 0.3
MIN_PAGES = 5
MIN_COPIES = 3
_BLOCK = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|nav|article|section|header|footer|table|tr|td|th|br|title|body|head|html|main|aside|blockquote|pre)\b[^>]*>"


def host_of(url: Column) -> Column:
    """Lower-cased host without port or user, '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def lines_of(html: Column) -> Column:
    """Visible lines, trimmed, inner white space as one space, none empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCK, "\n"), r"<[^>]*>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "), r" ?\n[ \n]*", "\n")
    return F.array_remove(F.split(F.trim(text), "\n"), "")


def boilerplate(lines: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, min_copies: int = MIN_COPIES) -> DataFrame:
    """lines(host, page, hashes) to (host, hashes of its boilerplate); hosts without any are left out."""
    per_page = lines.select("host", key_part(F.col("page")).alias("page"), F.explode(F.array_distinct("hashes")).alias("hash")).distinct()
    pages = lines.groupBy("host", key_part(F.col("page")).alias("page")).agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("pages"))
    counts = per_page.groupBy("host", "hash").agg(F.count("*").alias("copies")).where(F.col("copies") >= min_copies)
    bad = counts.join(pages, "host").where((F.col("pages") >= min_pages) & (F.col("copies") > max_ratio * F.col("pages")))
    return materialize(bad.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("boilerplate")), "line-boilerplate")


def line_dedup(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_ratio: float = MAX_RATIO,
               min_pages: int = MIN_PAGES, min_copies: int = MIN_COPIES) -> DataFrame:
    """Per row: id, host, n_lines, n_dropped, text (the lines that stay, joined by \\n)."""
    rows = pages.select(F.col(id_col).alias("page"), host_of(F.col(url_col)).alias("host"), lines_of(F.col(html_col)).alias("lines"))
    # Lines are taken from the html once, and written.
    rows = materialize(rows.withColumn("hashes", F.transform("lines", lambda x: F.xxhash64(x))), "line-pages")
    bad = small(boilerplate(rows, max_ratio, min_pages, min_copies), 100_000)
    kept = F.when(F.col("boilerplate").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~F.array_contains("boilerplate", F.get("hashes", i))))
    return rows.join(bad, "host", "left").withColumn("kept", kept).select(
        F.col("page").alias("id"), "host", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"))
