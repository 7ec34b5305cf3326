"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tessera.llm.license_scan import MAX_DRIFT, MIN_SHARE, MIN_VOTES, TEMPLATES
from tessera.llm.license_texts import COMMON
from tessera.llm.quality_rules import ALPHA, DELTA, RULES, RUNGS

#: Runs of the six ASCII white-space characters.
_WS = r"[\x20\x09-\x0D]+"

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rung(rule: str) -> str:
    """The first rung of a rule that rejects, RUNGS if none does."""
    top, bottom, side, ladder = RULES[rule]
    cases = " ".join(f"WHEN {top} / greatest({bottom}, 1) {'>' if side > 0 else '<'} {c}::DOUBLE THEN {i}" for i, c in enumerate(ladder))
    return f"CASE {cases} ELSE {RUNGS} END"


def _chain(start: int) -> str:
    """The first step of a chain that rejects: its rules one after another, from number ``start`` on."""
    n = len(RULES)
    cases = " ".join(f"WHEN f[{(start + k) % n + 1}] < {RUNGS} THEN {k * RUNGS} + f[{(start + k) % n + 1}]" for k in range(n))
    return f"CASE {cases} ELSE {n * RUNGS} END"


_RULES = rf"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
    rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win), range(5) x(o) WHERE c > 1 GROUP BY doc_id),
    m AS (SELECT doc_id, lang, len(w) AS n_words, array_to_string(w, '') AS j,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id)),
    c AS (SELECT *, length(j) AS word_chars, length(regexp_replace(j, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
        length(regexp_replace(j, '[^A-Z]', '', 'g')) AS n_upper, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
    f AS (SELECT *, [{', '.join(map(_rung, RULES))}] AS f FROM c),
    s AS (SELECT *, [{', '.join(map(_chain, range(len(RULES))))}] AS steps FROM f),
    y AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
    e AS (SELECT lang, x AS chain, steps[x] AS step, CAST(quality = 1 AS INTEGER) AS good FROM s JOIN y USING (doc_id), range(1, {len(RULES) + 1}) r(x) WHERE NOT base_failed),
    n AS (SELECT lang, sum(good) AS n FROM e WHERE chain = 1 GROUP BY lang HAVING sum(good) > 0),
    u AS (SELECT n.lang, n.n, c AS chain, i AS step, coalesce(sum(good) FILTER (e.step <= i), 0) AS good, coalesce(sum(1 - good) FILTER (e.step <= i), 0) AS bad
        FROM n, range(1, {len(RULES) + 1}) a(c), range({len(RULES) * RUNGS}) b(i) JOIN e ON e.lang IS NOT DISTINCT FROM n.lang AND e.chain = c GROUP BY ALL),
    b AS (SELECT *, good < {ALPHA}::DOUBLE * n AND list_sum(list_transform(range(0, CAST(good + 1 AS BIGINT)), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
        + i * ln({ALPHA}::DOUBLE) + (n - i) * ln(1 - {ALPHA}::DOUBLE)))) <= {DELTA}::DOUBLE / ((SELECT count(*) FROM n) * {len(RULES)}) AS ok FROM u),
    g AS (SELECT *, bool_and(ok) OVER (PARTITION BY lang, chain ORDER BY step) AS certified FROM b),
    p AS (SELECT lang, chain AS best, step AS upto FROM g WHERE certified QUALIFY row_number() OVER (PARTITION BY lang ORDER BY bad DESC, step DESC, good, chain) = 1)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(steps[best] > upto, true) AS kept
    FROM s LEFT JOIN p ON p.lang IS NOT DISTINCT FROM s.lang"""

_LICENSES = rf"""
    WITH t AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{label}', {words}, {exact}, {base})" for i, label, words, exact, base in TEMPLATES)}) v(template, label, tw, exact, base)),
    tp AS (SELECT template, p AS place, tw[p + 1] AS a, tw[p + 2] AS b FROM (SELECT *, unnest(range(len(tw) - 1)) AS p FROM t)
        WHERE exact OR tw[p + 1] NOT IN {tuple(sorted(COMMON))} OR tw[p + 2] NOT IN {tuple(sorted(COMMON))}),
    need AS (SELECT template, count(*) AS need FROM tp GROUP BY template),
    d AS (SELECT doc_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    g AS (SELECT doc_id, i AS pos, w[i + 1] AS a, w[i + 2] AS b FROM (SELECT *, unnest(range(len(w) - 1)) AS i FROM d)),
    h AS (SELECT doc_id, template, place, pos, pos - place AS diagonal, count(*) OVER (PARTITION BY doc_id, template, pos - place) AS votes FROM g JOIN tp USING (a, b)),
    ph AS (SELECT doc_id, template, diagonal AS start, 1.0::DOUBLE AS share FROM h JOIN need USING (template) JOIN t USING (template) WHERE exact AND votes = need GROUP BY ALL),
    dg AS (SELECT doc_id, template, diagonal, coalesce(diagonal - lag(diagonal) OVER o > {MAX_DRIFT}, true) AS apart
        FROM (SELECT DISTINCT doc_id, template, diagonal FROM h JOIN t USING (template) WHERE NOT exact AND votes >= {MIN_VOTES}) WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
    rn AS (SELECT *, sum(CAST(apart AS INTEGER)) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM dg),
    bk AS (SELECT doc_id, template, run, pos, place, coalesce(max(place) OVER (PARTITION BY doc_id, template, run ORDER BY pos, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS beyond
        FROM h JOIN rn USING (doc_id, template, diagonal)),
    tx AS (SELECT doc_id, template, min(pos) AS start, count(*) / any_value(need)::DOUBLE AS share FROM bk JOIN need USING (template) WHERE place > beyond GROUP BY doc_id, template, run),
    sp AS (SELECT * FROM ph UNION ALL SELECT * FROM tx WHERE share >= {MIN_SHARE}::DOUBLE),
    r AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
        list_sort(list_distinct(list(label) FILTER (base))) AS bl, list_sort(list_distinct(list(label))) AS al, max(share) AS score FROM sp JOIN t USING (template) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(bl, ','), '') AS base_labels,
        coalesce(array_to_string(al, ','), '') AS labels, coalesce(score, 0.0::DOUBLE) AS score FROM d LEFT JOIN r USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": _RULES,
    "op5_license_scan": _LICENSES,
    "op2_exact_dedup": rf"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g') AS t FROM documents),
        h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM h WINDOW w AS (PARTITION BY text_sha256)""",
    "op3_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM h)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op4_minhash": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                     ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM d),
        u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
        l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
        SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
        FROM s JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) ON x = doc_id""",
    "op6_line_dedup": r"""
        WITH h AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
            regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g') AS t FROM pages),
        b AS (SELECT page_id, host, regexp_replace(regexp_replace(t, '(?i)</?(?:p|div|li|ul|ol|h[1-6]|nav|article|section|header|footer|table|tr|td|th|br|title|body|head|html|main|aside|blockquote|pre)\b[^>]*>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS t FROM h),
        l AS (SELECT page_id, host, list_filter(string_split(trim(regexp_replace(regexp_replace(t, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g')), chr(10)), lambda x: x <> '') AS lines FROM b),
        u AS (SELECT DISTINCT host, page_id, unnest(lines) AS line FROM l),
        n AS (SELECT host, count(DISTINCT page_id) AS pages FROM l GROUP BY host),
        bad AS (SELECT host, list(line) AS x FROM (SELECT host, line, count(*) AS c FROM u GROUP BY ALL) JOIN n USING (host) WHERE pages >= 5 AND c >= 3 AND c > 0.3 * pages GROUP BY host),
        k AS (SELECT page_id, host, lines, CASE WHEN x IS NULL THEN lines ELSE list_filter(lines, lambda y: NOT list_contains(x, y)) END AS kept FROM l LEFT JOIN bad USING (host))
        SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, array_to_string(kept, chr(10)) AS text FROM k""",
    "op9_chat": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        f AS (SELECT *, replace(replace(replace(role, '\', '\\'), '###', '#\##'), '</turn>', '<\/turn>') AS r,
              replace(replace(replace(text, '\', '\\'), '###', '#\##'), '</turn>', '<\/turn>') AS t FROM c),
        g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS s,
              coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS l,
              sum(length('### ' || replace(r, chr(10), '\n') || chr(10) || t || '</turn>' || chr(10))) AS k FROM f GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(s) AS turns_sha256, length(l) AS loss_chars, sha256(l) AS loss_sha256, CAST(k AS BIGINT) AS formatted_chars FROM g""",
}
