"""DuckDB SQL of the queries.  The plans are its own; the fixed tables, and the order in which states are tried, are the engine's."""

from __future__ import annotations

from tessera.functions.address import by_length
from tessera.functions.constants import ADDRESS_TOKENS, INDIAN_STATES, NAME_STOPWORDS, NAME_TOKENS, SOUNDEX_DIGITS, US_STATES


def _fold(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))")


def _mapped(x: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"list_filter(list_transform(string_split({x}, ' '), lambda t: CASE t {cases} ELSE t END), lambda t: t <> '')"


_STOP = ", ".join(f"'{w}'" for w in NAME_STOPWORDS)
_TRI = """CASE WHEN norm_name = '' THEN [] WHEN length(norm_name) >= 3 THEN list_distinct(list_transform(range(1, length(norm_name) - 1), lambda i: substr(norm_name, i, 3)))
          ELSE list_distinct(string_split(norm_name, '')) END"""


def _grams(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) >= {n} THEN list_transform(range(1, length({x}) - {n} + 2), lambda i: substr({x}, i, {n})) ELSE [] END"


_WORD = "\\b"
#: The state by country, from norm_addr.
_STATE = f"""CASE country WHEN 'US' THEN CASE {' '.join(f"WHEN regexp_matches(norm_addr, '{_WORD}{s}{_WORD}') THEN '{US_STATES[s]}'" for s in by_length(list(US_STATES)))}
   {' '.join(f"WHEN regexp_matches(norm_addr, '{_WORD}{s.lower()}{_WORD}') THEN '{s}'" for s in sorted(US_STATES.values()))} END
   WHEN 'India' THEN CASE {' '.join(f"WHEN regexp_matches(norm_addr, '{_WORD}{s}{_WORD}') THEN '{s}'" for s in by_length(INDIAN_STATES))} END END"""


def _city(source: str, key: str, raw: str) -> str:
    """CTEs up to ct(key, city), from source(key, raw address, state)."""
    return f"""
sg AS (SELECT {key}, state, list_filter(list_transform(string_split({raw}, ','), lambda s: trim(s)), lambda s: s <> '') AS p FROM {source}),
un AS (SELECT {key}, state, unnest(p) AS s, generate_subscripts(p, 1) AS i FROM sg),
cc AS (SELECT {key}, state, i, s, {_fold('s')} AS c, state IS NOT NULL AND contains(lower(s), lower(state)) AS is_state FROM un),
lk AS (SELECT *, NOT is_state AND c <> '' AND NOT (state IS NOT NULL AND contains(c, lower(state))) AND NOT regexp_matches(s, '^(\\d{{5}}(-\\d{{4}})?|\\d{{6}})$')
    AND NOT regexp_matches(c, '^\\d') AND length(regexp_replace(c, '[^a-z]', '', 'g')) > 0
    AND length(regexp_replace(c, '[^0-9]', '', 'g')) <= length(regexp_replace(c, '[^a-z]', '', 'g')) AS ok FROM cc),
sp AS (SELECT {key}, coalesce(max(i) FILTER (is_state), 0) AS pos FROM lk GROUP BY 1),
ct AS (SELECT {key}, coalesce(max(c) FILTER (ok AND i = pos - 1 AND pos > 1), arg_max(c, i) FILTER (ok AND i < pos),
    CASE WHEN count(*) FILTER (ok) > 1 THEN arg_max(c, i) FILTER (ok AND i > 1) END, arg_min(c, i) FILTER (ok)) AS city FROM lk JOIN sp USING ({key}) GROUP BY {key})"""


_ZIP_OF = "nullif(CASE country WHEN 'India' THEN regexp_extract({0}, '\\b(\\d{{6}})\\b', 1) ELSE regexp_extract({0}, '\\b(\\d{{5}})\\b', 1) END, '')"

#: The Devanagari word that begins every tenth name reads knpni in Latin letters.
_ENT = f"""
raw AS (SELECT doc_id, lang, text, coalesce(CAST(substr(source, 4) AS INTEGER) % 3, 0) AS n, doc_id % 10 = 3 AS deva,
               list_filter(regexp_split_to_array(text, '[ \\n\\t\\r]+'), lambda w: w <> '') AS w FROM documents),
rec AS (SELECT 'S' || (n + 1) || '-' || doc_id AS entity_id, n, CASE lang WHEN 'en' THEN 'US' WHEN 'de' THEN 'India' ELSE lang END AS country, text, deva, array_to_string(w[1:8], ' ') AS body,
               CASE WHEN deva THEN 'कंपनी ' ELSE '' END || array_to_string(w[1:8], ' ') AS business_name,
               doc_id || ' Main St, ' || replace(array_to_string(w[9:10], ' '), ',', '') || CASE WHEN lang = 'de' THEN ', Maharashtra, ' || lpad(CAST(doc_id % 97 AS VARCHAR), 6, '4')
               ELSE ', NC ' || lpad(CAST(doc_id % 97 AS VARCHAR), 5, '0') END AS business_address FROM raw),
cl AS (SELECT *, {_fold("(CASE WHEN deva THEN 'knpni ' ELSE '' END || body)")} AS cname, {_fold('business_address')} AS caddr FROM rec),
tk AS (SELECT *, {_mapped('cname', NAME_TOKENS)} AS toks, array_to_string({_mapped('caddr', ADDRESS_TOKENS)}, ' ') AS norm_addr FROM cl),
st AS (SELECT *, {_STATE} AS state FROM tk),{_city('st', 'entity_id', 'business_address')},
ent AS (SELECT entity_id, n, country, text, business_name, toks, array_to_string(toks, ' ') AS norm_name, norm_addr, state, city,
               {_ZIP_OF.format('business_address')} AS zip, nullif(regexp_extract(caddr, '^\\s*(\\d+[a-z]?(?:[\\s/-]\\d+)?)\\b', 1), '') AS house_no FROM st LEFT JOIN ct USING (entity_id)),
tokn AS (SELECT DISTINCT entity_id, n, country, token FROM (SELECT entity_id, n, country, unnest(toks) AS token FROM ent) WHERE length(token) >= 3 AND token NOT IN ({_STOP})),
sx0 AS (SELECT entity_id, n, country, norm_name, regexp_replace(norm_name, '\\s+', '', 'g') AS j FROM ent),
sx1 AS (SELECT *, string_split(translate(regexp_replace(j, '[^a-z]', 'a', 'g'), 'abcdefghijklmnopqrstuvwxyz', '{SOUNDEX_DIGITS}'), '') AS d FROM sx0),
sdx AS (SELECT entity_id, n, country, CASE WHEN j = '' THEN '' ELSE upper(j[1]) || rpad(array_to_string(list_filter(d, lambda x, i: i > 1 AND x <> d[i - 1] AND x <> '0'), '')[1:3], 3, '0') END AS code FROM sx1),
tri AS (SELECT entity_id, n, country, {_TRI} AS t FROM ent),
truth AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id FROM rec a JOIN rec b ON a.text = b.text WHERE a.n = 0 AND b.n > 0)"""

#: The same with all words of a text as the name.
_WHOLE = _ENT.replace("array_to_string(w[1:8], ' ')", "array_to_string(w, ' ')")

_GUARD = "s1_count * other_count <= 8000 AND s1_count <= 2000 AND other_count <= 2000"


def _stats(rows: str, other: str = "n = 1") -> str:
    """Block statistics of (entity_id, n, country, key)."""
    return f"""SELECT * FROM (SELECT country, key, count(DISTINCT entity_id) FILTER (n = 0) AS s1_count, count(DISTINCT entity_id) FILTER ({other}) AS other_count
               FROM ({rows}) GROUP BY country, key) WHERE s1_count > 0 AND other_count > 0"""


def _pairs(rows: str, guard: bool, other: int = 1) -> str:
    ok = f"JOIN (SELECT country, key FROM ({_stats(rows, f'n = {other}')}) WHERE {_GUARD}) g ON a.country = g.country AND a.key = g.key" if guard else ""
    return f"""SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id FROM ({rows}) a {ok}
               JOIN ({rows}) b ON a.country = b.country AND a.key = b.key WHERE a.n = 0 AND b.n = {other}"""


_TOKEN = "SELECT entity_id, n, country, token AS key FROM tokn"
_STATS = f"SELECT 'S2' AS other, * FROM ({_stats(_TOKEN)}) UNION ALL SELECT 'S3' AS other, * FROM ({_stats(_TOKEN, 'n = 2')})"
_SDX = "SELECT entity_id, n, country, code AS key FROM sdx WHERE code NOT IN ('', '0000')"
_ZIP = "SELECT entity_id, n, country, zip AS key FROM ent WHERE zip IS NOT NULL"
_CITY = "SELECT entity_id, n, country, city || '|' || toks[1] AS key FROM ent WHERE city IS NOT NULL AND len(toks) > 0"
_TRIGRAM = "SELECT entity_id, n, country, unnest(t) AS key FROM tri"


def _both(rows: str, guard: bool) -> str:
    return f"{_pairs(rows, guard)} UNION ALL {_pairs(rows, guard, 2)}"


def _trigram(other: int = 1) -> str:
    return f"""SELECT source1_entity_id, other_entity_id, j AS jaccard FROM (
        SELECT s.source1_entity_id, s.other_entity_id, s.shared / greatest(len(a.t) + len(b.t) - s.shared, 1) AS j FROM (
          SELECT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id, count(*) AS shared FROM ({_TRIGRAM}) a
          JOIN (SELECT country, key FROM ({_stats(_TRIGRAM, f'n = {other}')}) WHERE {_GUARD}) g ON a.country = g.country AND a.key = g.key
          JOIN ({_TRIGRAM}) b ON a.country = b.country AND a.key = b.key WHERE a.n = 0 AND b.n = {other} GROUP BY ALL) s
        JOIN tri a ON a.entity_id = s.source1_entity_id JOIN tri b ON b.entity_id = s.other_entity_id) WHERE j >= 0.3"""


_OVER = f"""
tp AS ({_pairs(_TOKEN, True)} UNION ALL {_pairs(_TOKEN, True, 2)}),
ov AS (SELECT source1_entity_id, other_entity_id, round(CASE WHEN len(a.toks) = 0 OR len(b.toks) = 0 THEN 0.0
         ELSE len(list_intersect(a.toks, b.toks)) / len(list_distinct(list_concat(a.toks, b.toks))) END, 6) AS score
       FROM tp JOIN ent a ON a.entity_id = source1_entity_id JOIN ent b ON b.entity_id = other_entity_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, other_entity_id) AS r FROM ov),
lb AS (SELECT ov.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label FROM ov LEFT JOIN (SELECT DISTINCT * FROM truth) t USING (source1_entity_id, other_entity_id)),
ids AS (SELECT entity_id AS source1_entity_id FROM rec WHERE n = 0),
tc AS (SELECT source1_entity_id, count(*) AS nt FROM (SELECT DISTINCT * FROM truth) GROUP BY 1)"""


def _f05(tp: str, p: str, t: str) -> str:
    return (f"CASE WHEN {p} = 0 AND {t} = 0 THEN 1.0 WHEN {p} = 0 OR {t} = 0 OR {tp} = 0 THEN 0.0 "
            f"ELSE 1.25 * ({tp} / {p}) * ({tp} / {t}) / (0.25 * ({tp} / {p}) + {tp} / {t}) END")


_CURVE = f"""
th AS (SELECT round(0.05 + 0.02 * i, 2) AS threshold FROM range(46) x(i)),
pe AS (SELECT source1_entity_id, threshold, count(*) AS p, sum(label) AS h FROM lb JOIN th ON score >= threshold GROUP BY ALL),
cv AS (SELECT threshold, round(avg({_f05('coalesce(h, 0)', 'coalesce(p, 0)', 'coalesce(nt, 0)')}), 6) AS f05
       FROM ids CROSS JOIN th LEFT JOIN tc USING (source1_entity_id) LEFT JOIN pe USING (source1_entity_id, threshold) GROUP BY threshold)"""

_PE = """pe AS (SELECT source1_entity_id, count(*) AS p, sum(label) AS h FROM lb WHERE score >= 0.5 GROUP BY 1),
al AS (SELECT coalesce(h, 0) AS h, coalesce(p, 0) AS p, coalesce(nt, 0) AS t FROM ids LEFT JOIN tc USING (source1_entity_id) LEFT JOIN pe USING (source1_entity_id))"""


def _list(pairs: str, name: str) -> str:
    return f"""SELECT source1_entity_id, coalesce(l, '') AS {name} FROM ids LEFT JOIN
        (SELECT source1_entity_id, array_to_string(list_sort(list_distinct(list(other_entity_id))), ',') AS l FROM ({pairs}) GROUP BY 1) USING (source1_entity_id)"""


def _tfidf(col: str, sources: str, tag: str = "") -> str:
    """Weights w<tag>(entity_id, n, country, gram, weight), fitted on the sources that match."""
    p = "(' ' || w || ' ')"
    grams = f"CASE WHEN length(w) + 2 <= 3 THEN [{p}] ELSE list_concat({_grams(p, 3)}, {_grams(p, 4)}) END"
    words = lambda src, cols: f"SELECT {cols}, unnest({grams}) AS gram FROM (SELECT {cols}, unnest(list_filter(regexp_split_to_array(lower({col}), '\\s+'), lambda x: x <> '')) AS w FROM {src})"
    return f"""
    dt{tag} AS (SELECT DISTINCT {col} FROM ent WHERE {sources}),
    vo{tag} AS (SELECT gram, count(DISTINCT {col}) AS df FROM ({words(f'dt{tag}', col)}) GROUP BY gram),
    voc{tag} AS (SELECT gram, df, ln((1 + nn) / (1 + df)) + 1 AS idf FROM vo{tag}, (SELECT count(*) AS nn FROM dt{tag}) WHERE df >= 2 AND df <= 0.5 * nn),
    tf{tag} AS (SELECT entity_id, n, country, gram, count(*) AS tf FROM ({words('ent', f'entity_id, n, country')}) GROUP BY ALL) ,
    rw{tag} AS (SELECT entity_id, n, country, gram, tf * idf AS x FROM tf{tag} JOIN voc{tag} USING (gram)),
    w{tag} AS (SELECT entity_id, n, country, gram, x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) AS weight FROM rw{tag})"""


def _top(tag: str, other: int, k: int, least: float) -> str:
    return f"""SELECT source1_entity_id, other_entity_id, s AS ann_score FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY s DESC, other_entity_id) AS r FROM (
        SELECT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id, round(sum(a.weight * b.weight), 9) AS s
        FROM w{tag} a JOIN w{tag} b ON a.country = b.country AND a.gram = b.gram WHERE a.n = 0 AND b.n = {other} GROUP BY ALL) WHERE s >= {least}) WHERE r <= {k}"""


_ADDR = f"""
ad AS (SELECT c_custkey AS id, c_custkey % 4 AS st, CAST(c_custkey AS VARCHAR) AS k FROM customer),
aa AS (SELECT id, CASE WHEN st < 2 THEN 'US' WHEN st = 2 THEN 'India' ELSE 'France' END AS country,
   CASE st WHEN 0 THEN 'ASHEVILLE, NC, ' || k || ' 1/2 PEBBLE WALK' WHEN 1 THEN k || ' Juniper Dr, Cedar Falls, South Dakota ' || lpad(k, 5, '2')
   WHEN 2 THEN 'H-' || k || ', LOTUS ENCLAVE, NAGPUR, Maharashtra, ' || lpad(k, 6, '4') ELSE k || 'b Quai du Vieux Moulin, 31000, Toulouse' END AS a FROM ad),
ac AS (SELECT *, {_fold('a')} AS c FROM aa),
an AS (SELECT *, array_to_string({_mapped('c', ADDRESS_TOKENS)}, ' ') AS norm_addr FROM ac),
sa AS (SELECT *, {_STATE} AS state FROM an)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + " "


_COS = "".join(f"""
{tag}c AS (SELECT entity_id, g, count(*) AS k FROM (SELECT entity_id, unnest({_grams(col, n)}) AS g FROM ent) GROUP BY ALL),
{tag}n AS (SELECT entity_id, sqrt(sum(k * k)) AS z FROM {tag}c GROUP BY 1),
{tag}d AS (SELECT source1_entity_id, other_entity_id, sum(a.k * b.k) / (any_value(x.z) * any_value(y.z)) AS v FROM pr JOIN {tag}c a ON a.entity_id = source1_entity_id
   JOIN {tag}c b ON b.entity_id = other_entity_id AND a.g = b.g JOIN {tag}n x ON x.entity_id = source1_entity_id JOIN {tag}n y ON y.entity_id = other_entity_id GROUP BY 1, 2),"""
    for tag, col, n in (("g3", "norm_name", 3), ("g4", "norm_name", 4), ("ga", "norm_addr", 3))).rstrip(",")

ORACLE: dict[str, str] = {
    "anchor_matches": _with(_ENT, _OVER) + _list("SELECT * FROM rk WHERE r <= 5", "candidate_entity_ids"),
    "normalize_names": _with(_WHOLE) + "SELECT entity_id, country, norm_name, len(toks) AS n_tokens, regexp_matches(business_name, '[\\x{0900}-\\x{097F}]') AS has_devanagari FROM ent",
    "normalize_records": _with(_ENT) + "SELECT entity_id, norm_name, norm_addr, zip, state, city, house_no FROM ent",
    "name_tokens_explode": _with(_WHOLE) + "SELECT entity_id, country, token FROM tokn",
    "script_flags": _with(_WHOLE) + "SELECT entity_id, regexp_matches(business_name, '[\\x{0900}-\\x{097F}]') AS has_devanagari, regexp_matches(business_name, '[^\\x{0000}-\\x{024F}\\x{0900}-\\x{097F}\\pP\\p{Nd}\\pZ]') AS has_non_latin FROM ent",
    "address_parse": _with(_ADDR) + f"""SELECT id, norm_addr, {_ZIP_OF.format('a')} AS zip, state, nullif(regexp_extract(c, '^\\s*(\\d+[a-z]?(?:[\\s/-]\\d+)?)\\b', 1), '') AS house_no FROM sa""",
    "address_city": _with(_ADDR, _city("sa", "id", "a")) + "SELECT id, state, city FROM sa JOIN ct USING (id)",
    "soundex_codes": _with(_WHOLE) + "SELECT entity_id, code FROM sdx",
    "part_name_blocks": _with(f"""p AS (SELECT p_partkey AS entity_id, p_partkey % 2 AS n, 'US' AS country, {_mapped(_fold('p_name'), NAME_TOKENS)} AS toks FROM part),
        k AS (SELECT DISTINCT * FROM (SELECT entity_id, n, country, unnest(toks) AS key FROM p) WHERE length(key) >= 3 AND key NOT IN ({_STOP}))""")
        + f"SELECT country, key AS token, s1_count, other_count, s1_count * other_count AS est_pairs, {_GUARD} AS safe FROM ({_stats('SELECT * FROM k')})",
    "block_stats": _with(_WHOLE) + f"SELECT other, country, key AS token, s1_count, other_count, s1_count * other_count AS est_pairs FROM ({_STATS})",
    "block_guard_report": _with(_WHOLE, f"b AS (SELECT *, s1_count * other_count AS e, {_GUARD} AS ok FROM ({_STATS}))") + """SELECT count(*) AS blocks, count(*) FILTER (NOT ok) AS skipped,
        CAST(coalesce(sum(e) FILTER (NOT ok), 0) AS BIGINT) AS avoided_pairs, CAST(coalesce(sum(e) FILTER (ok), 0) AS BIGINT) AS kept_pairs FROM b""",
    "block_token": _with(_ENT) + _both(_TOKEN, True),
    "block_zip": _with(_ENT) + _both(_ZIP, False),
    "block_city_first": _with(_ENT) + _both(_CITY, False),
    "block_soundex": _with(_ENT) + _both(_SDX, True),
    "block_trigram_jaccard": _with(_ENT) + f"SELECT source1_entity_id, other_entity_id, round(jaccard, 6) AS jaccard FROM ({_trigram()} UNION ALL {_trigram(2)})",
    "block_union_distinct": _with(_ENT) + " UNION ".join([*(_pairs(r, g, o) for r, g in ((_TOKEN, True), (_ZIP, False), (_CITY, False), (_SDX, True)) for o in (1, 2)),
                                                          *(f"SELECT source1_entity_id, other_entity_id FROM ({_trigram(o)})" for o in (1, 2))]),
    "native_pair_features": _with(_ENT, f"pr AS ({_both(_TOKEN, True)})", _COS) + """
        SELECT source1_entity_id, other_entity_id, abs(length(a.norm_name) - length(b.norm_name)) AS name_len_diff,
          round(CASE WHEN len(a.toks) = 0 OR len(b.toks) = 0 THEN 0.0 ELSE len(list_intersect(a.toks, b.toks)) / len(list_distinct(list_concat(a.toks, b.toks))) END, 6) AS name_common_token_frac,
          CAST(coalesce(a.toks[1] = b.toks[1], false) AS INTEGER) AS name_first_token_match, CAST(coalesce(a.city = b.city, false) AS INTEGER) AS city_exact_match,
          CAST(coalesce(a.state = b.state, false) AS INTEGER) AS state_exact_match, CAST(coalesce(a.zip = b.zip, false) AS INTEGER) AS zip_exact_match, CAST(a.zip IS NOT NULL AND b.zip IS NOT NULL AS INTEGER) AS zip_present_both,
          CAST(coalesce(a.house_no = b.house_no, false) AS INTEGER) AS house_no_exact_match, CAST(a.country = b.country AS INTEGER) AS country_match,
          round(coalesce(x.v, 0), 6) AS name_char_3gram_cosine, round(coalesce(y.v, 0), 6) AS name_char_4gram_cosine, round(coalesce(z.v, 0), 6) AS addr_char_3gram_cosine,
          round(len(list_intersect(p.t, q.t)) / len(list_distinct(list_concat(p.t, q.t))), 6) AS name_trigram_jaccard, CAST(s.code = u.code AND s.code <> '' AS INTEGER) AS name_soundex_match
        FROM pr JOIN ent a ON a.entity_id = source1_entity_id JOIN ent b ON b.entity_id = other_entity_id JOIN tri p ON p.entity_id = source1_entity_id JOIN tri q ON q.entity_id = other_entity_id
        JOIN sdx s ON s.entity_id = source1_entity_id JOIN sdx u ON u.entity_id = other_entity_id
        LEFT JOIN g3d x USING (source1_entity_id, other_entity_id) LEFT JOIN g4d y USING (source1_entity_id, other_entity_id) LEFT JOIN gad z USING (source1_entity_id, other_entity_id)""",
    "jaro_winkler": _with(_ENT, f"pr AS ({_both(_TOKEN, True)})") + """SELECT source1_entity_id, other_entity_id, round(jaro_winkler_similarity(a.norm_name, b.norm_name), 6) AS jaro_winkler
        FROM pr JOIN ent a ON a.entity_id = source1_entity_id JOIN ent b ON b.entity_id = other_entity_id""",
    "tfidf_vocabulary": _with(_WHOLE, _tfidf("norm_name", "true")) + "SELECT gram, df, round(idf, 6) AS idf FROM voc",
    "tfidf_weights": _with(_ENT, _tfidf("norm_name", "true")) + "SELECT entity_id, country, gram, round(weight, 6) AS weight FROM w",
    "tfidf_topk": _with(_ENT, _tfidf("norm_name", "true")) + f"SELECT source1_entity_id, other_entity_id, round(ann_score, 6) AS ann_score FROM ({_top('', 1, 20, 0.2)} UNION ALL {_top('', 2, 20, 0.2)})",
    "dual_pool_best_score": _with(_ENT, _tfidf("norm_name", "true", "a"), _tfidf("norm_addr", "true", "b")) + "SELECT source1_entity_id, other_entity_id, round(max(ann_score), 6) AS ann_score FROM ("
        + " UNION ALL ".join(_top(*x) for o in (1, 2) for x in (("a", o, 30, 0.2), ("b", o, 15, 0.3))) + ") GROUP BY 1, 2",
    "vector_topk": """WITH v AS (SELECT vec_id, printf('V%08d', vec_id) AS entity_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        d AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS other_entity_id, round(list_inner_product(a.e, b.e), 6) AS ann_score FROM v a JOIN v b USING (label) WHERE a.vec_id % 50 = 0)
        SELECT source1_entity_id, other_entity_id, ann_score FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY ann_score DESC, other_entity_id) AS r FROM d) WHERE r <= 5""",
    "cap_top_n": _with(_ENT, _OVER) + "SELECT source1_entity_id, other_entity_id, score FROM rk WHERE r <= 10",
    "cap_fair": _with(_ENT, _OVER, f"""tg AS (SELECT source1_entity_id, other_entity_id, round(jaccard, 6) AS ann_score FROM ({_trigram()} UNION ALL {_trigram(2)})),
        tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY ann_score DESC, other_entity_id) AS q FROM tg) WHERE q <= 2),
        lx AS (SELECT * FROM rk WHERE r <= 4)""") + """SELECT source1_entity_id, other_entity_id, CAST(r IS NOT NULL AS INTEGER) AS from_token_block, CAST(q IS NOT NULL AS INTEGER) AS from_ann, score, ann_score
        FROM lx FULL JOIN tr USING (source1_entity_id, other_entity_id)""",
    "recall_stats": _with(_ENT, _OVER, """e AS (SELECT t.source1_entity_id, count(*) AS t, count(o.score) AS f FROM (SELECT DISTINCT * FROM truth) t LEFT JOIN ov o USING (source1_entity_id, other_entity_id) GROUP BY 1)""")
        + """SELECT CAST(coalesce(sum(f), 0) AS BIGINT) AS found_matches, CAST(coalesce(sum(t), 0) AS BIGINT) AS total_true_matches, count(*) AS entities_with_matches, count(*) FILTER (f = t) AS entities_fully_recalled,
        count(*) FILTER (f < t) AS entities_with_missed, (SELECT count(*) FROM ov) AS total_candidates, round(coalesce(sum(f) / sum(t), 0), 6) AS candidate_recall FROM e""",
    "recall_at_k": _with(_ENT, _OVER, """rl AS (SELECT rk.r, lb.label FROM rk JOIN lb USING (source1_entity_id, other_entity_id)),
        ks AS (SELECT unnest([NULL, 1, 2, 5, 20]) AS k), tt AS (SELECT count(*) AS total FROM (SELECT DISTINCT * FROM truth))""")
        + """SELECT k, count(*) AS candidates, CAST(sum(label) AS BIGINT) AS found, any_value(total) AS total, round(sum(label) / any_value(total), 6) AS recall FROM ks JOIN rl ON k IS NULL OR r <= k, tt GROUP BY k""",
    "script_recall_split": _with(_ENT, _OVER) + """SELECT regexp_matches(e.business_name, '[\\x{0900}-\\x{097F}]') AS has_devanagari, count(o.score) AS found, count(*) AS total, round(count(o.score) / count(*), 6) AS recall
        FROM (SELECT DISTINCT * FROM truth) t JOIN ent e ON e.entity_id = t.source1_entity_id LEFT JOIN ov o USING (source1_entity_id, other_entity_id) GROUP BY 1""",
    "macro_f05": _with(_ENT, _OVER, _PE) + f"SELECT round(avg({_f05('h', 'p', 't')}), 6) AS macro_f05 FROM al",
    "micro_prf": _with(_ENT, _OVER, _PE, "s AS (SELECT sum(h) AS h, sum(p) AS p, sum(t) AS t FROM al)") + """SELECT CAST(h AS BIGINT) AS tp, CAST(p AS BIGINT) AS predicted, CAST(t AS BIGINT) AS true_matches, round(CASE WHEN p > 0 THEN h / p ELSE 0 END, 6) AS precision,
        round(CASE WHEN t > 0 THEN h / t ELSE 0 END, 6) AS recall, round(CASE WHEN h > 0 THEN 2 * (h / p) * (h / t) / (h / p + h / t) ELSE 0 END, 6) AS f1 FROM s""",
    "threshold_curve": _with(_ENT, _OVER, _CURVE) + "SELECT threshold, f05 FROM cv",
    "best_threshold": _with(_ENT, _OVER, _CURVE) + "SELECT threshold, f05 FROM cv ORDER BY f05 DESC, threshold LIMIT 1",
    "labeled_pairs": _with(_ENT, _OVER, """ng AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, label ORDER BY md5(source1_entity_id || '|' || other_entity_id || '|42'), other_entity_id) AS q FROM lb)""")
        + "SELECT source1_entity_id, other_entity_id, label FROM ng WHERE label = 1 OR q <= 5",
    "label_distribution": _with(_ENT, _OVER, """ng AS (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, label ORDER BY md5(source1_entity_id || '|' || other_entity_id || '|42'), other_entity_id) AS q FROM lb)""")
        + "SELECT count(*) AS pairs, CAST(coalesce(sum(label), 0) AS BIGINT) AS positives, CAST(coalesce(sum(1 - label), 0) AS BIGINT) AS negatives FROM ng WHERE label = 1 OR q <= 5",
    "group_split": _with(_ENT, _OVER) + "SELECT source1_entity_id, row_number() OVER (ORDER BY md5(source1_entity_id || '|42'), source1_entity_id) <= floor((SELECT count(*) FROM ids) * 0.15) AS is_val FROM ids",
    "smart_sample": _with(_ENT, """m AS (SELECT entity_id, country, entity_id IN (SELECT other_entity_id FROM truth) AS keep FROM rec WHERE n = 1),
        o AS (SELECT *, row_number() OVER (PARTITION BY keep ORDER BY md5(entity_id || '|42'), entity_id) AS r FROM m)""")
        + "SELECT entity_id, country FROM o WHERE keep OR r <= greatest(0, 60 - (SELECT count(*) FROM m WHERE keep))",
    "truth_lists": _with(_ENT, _OVER) + _list("SELECT * FROM truth", "matched_entity_ids"),
    "truth_explode": _with(_ENT) + "SELECT DISTINCT * FROM truth",
    "id_list_round_trip": _with(_ENT, _OVER, "x AS (" + _list("SELECT * FROM rk WHERE r <= 5", "candidate_entity_ids") + ")")
        + "SELECT *, CASE WHEN candidate_entity_ids = '' THEN 0 ELSE len(string_split(candidate_entity_ids, ',')) END AS n FROM x",
    "dataset_stats": _with(_ENT, _OVER) + "SELECT country, count(*) AS entities, count(*) FILTER (nt IS NULL) AS singletons, CAST(coalesce(sum(nt), 0) AS BIGINT) AS matches FROM rec LEFT JOIN tc ON source1_entity_id = entity_id WHERE n = 0 GROUP BY 1",
    "matched_stats": _with(_ENT, _OVER) + "SELECT count(*) AS matched_entities, round(coalesce(avg(nt), 0), 6) AS avg_matches FROM tc",
    "routed_matches": _with(_ENT) + "SELECT s AS source, (SELECT count(*) FROM truth WHERE substr(other_entity_id, 1, 2) = s) AS matches FROM (VALUES ('S2'), ('S3')) v(s)",
    "recall_at_k_with_fallback": _with(_ENT, _OVER, f"""tg AS (SELECT source1_entity_id, other_entity_id, round(jaccard, 6) AS j FROM ({_trigram()} UNION ALL {_trigram(2)})),
        rl AS (SELECT label, row_number() OVER (PARTITION BY source1_entity_id ORDER BY coalesce(j, score) DESC, other_entity_id) AS r FROM lb LEFT JOIN tg USING (source1_entity_id, other_entity_id)),
        ks AS (SELECT unnest([NULL, 1, 2, 5, 20]) AS k), tt AS (SELECT count(*) AS total FROM (SELECT DISTINCT * FROM truth))""")
        + """SELECT k, count(*) AS candidates, CAST(sum(label) AS BIGINT) AS found, any_value(total) AS total, round(sum(label) / any_value(total), 6) AS recall FROM ks JOIN rl ON k IS NULL OR r <= k, tt GROUP BY k""",
    "output_report": _with(_ENT, _OVER, """m AS (SELECT count(DISTINCT other_entity_id) AS c FROM ids LEFT JOIN (SELECT * FROM ov WHERE score >= 0.5) USING (source1_entity_id) GROUP BY source1_entity_id),
        c AS (SELECT count(DISTINCT other_entity_id) AS c FROM ids LEFT JOIN ov USING (source1_entity_id) GROUP BY source1_entity_id), t AS (SELECT coalesce(nt, 0) AS c FROM ids LEFT JOIN tc USING (source1_entity_id)),
        a AS (SELECT (SELECT avg(c) FROM m) AS avg_matches, (SELECT avg(CAST(c = 0 AS INTEGER)) FROM m) AS singleton_rate, (SELECT avg(c) FROM c) AS avg_candidates, (SELECT avg(c) FROM t) AS avg_true, (SELECT avg(CAST(c = 0 AS INTEGER)) FROM t) AS true_singleton_rate)""")
        + """SELECT round(avg_matches, 6) AS avg_matches, round(singleton_rate, 6) AS singleton_rate, round(avg_candidates, 6) AS avg_candidates, round(avg_true, 6) AS avg_true, round(true_singleton_rate, 6) AS true_singleton_rate,
        round(avg_matches / avg_true, 6) AS ratio, CASE WHEN avg_matches / avg_true > 1.5 THEN 'too many' WHEN avg_matches / avg_true < 0.6 THEN 'too few' ELSE 'in range' END AS verdict, singleton_rate < 0.02 AS few_singletons FROM a""",
    "subset_violations": _with(_ENT, _OVER) + "SELECT source1_entity_id, other_entity_id FROM truth ANTI JOIN (SELECT * FROM rk WHERE r <= 1) USING (source1_entity_id, other_entity_id)",
    "new_countries": "SELECT DISTINCT lang AS country FROM documents WHERE lang NOT IN ('en', 'de')",
    "referential_filter": _with(_ENT, _OVER) + "SELECT source1_entity_id, other_entity_id FROM ov WHERE other_entity_id IN (SELECT entity_id FROM rec WHERE n = 1)",
}
