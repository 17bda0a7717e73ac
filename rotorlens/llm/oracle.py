"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from rotorlens.llm.quality_rules import DIGITS, FENCE, LEAST_SPREAD

_COUNTS = r"""
docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
listed AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS tokens,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
token AS (SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM listed),
windowed AS (SELECT doc_id, pos, string_agg(word, ' ') OVER w AS win, count(*) OVER w AS width FROM token
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
again AS (SELECT doc_id, pos, CASE WHEN width = 8 AND count(*) OVER (PARTITION BY doc_id, win) > 1 THEN 1 ELSE 0 END
    AS dup FROM windowed),
covered AS (SELECT doc_id, sum(c) AS n FROM (SELECT doc_id, max(dup) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c FROM again) GROUP BY doc_id),
counts AS (SELECT l.doc_id, lang, source, len(tokens)::BIGINT AS n_words,
    length(array_to_string(tokens, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper
    FROM listed l LEFT JOIN covered USING (doc_id))
"""


def _quality_rules() -> str:
    rates = {
        "symbol_rate": "1000 * n_symbols // greatest(n_words, 1)", "upper_rate": "1000 * n_upper // greatest(n_words, 1)",
        "dup_line_rate": "1000 * n_dup_lines // greatest(n_lines, 1)",
        "repeat_rate": "1000 * n_repeat_words // greatest(n_words, 1)", "length_rate": "1000 * word_chars // greatest(n_words, 1)"}
    rated = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{k}' AS rate, {v} AS v, {LEAST_SPREAD[k]} AS spread FROM counts"
        for k, v in rates.items())
    return f"""WITH {_COUNTS},
rated AS ({rated}),
cut AS (SELECT *, greatest(length(bin(v)) - {DIGITS}, 0) AS s FROM rated),
sketch AS (SELECT lang, source, rate, spread, (v >> s) << s AS bucket, count(*) AS n FROM cut GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, rate ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY lang, source, rate) AS total FROM sketch),
fences AS (SELECT lang, source, rate, min(bucket) FILTER (upto * 4 >= total) AS q1,
    min(bucket) FILTER (upto * 4 >= total * 3) AS q3, any_value(spread) AS spread FROM ranked GROUP BY ALL),
high AS (SELECT doc_id, max(CASE WHEN v > q3 + {FENCE} * greatest(q3 - q1, r.spread) THEN 1 ELSE 0 END) AS high
    FROM rated r JOIN fences f ON r.rate = f.rate AND r.lang IS NOT DISTINCT FROM f.lang
    AND r.source IS NOT DISTINCT FROM f.source GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
    NOT failed AND high = 0 AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed FROM counts) JOIN high USING (doc_id)"""


LINE_DEDUP = r"""
lined AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lined),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key
    HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.doc_id, k.line, k.pos, c.key IS NOT NULL AND k.doc_id < c.keeper AS dropped
    FROM keyed k LEFT JOIN common c ON k.key = c.key),
rebuilt AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS text FROM marked GROUP BY doc_id)
"""

URL_FILTERS = r"""WITH hosted AS (SELECT page_id, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS fetched_at,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.?(?::\d*)?(?:[/?#]|$)', 1)) AS host,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/*([^?#]*)', 1), '/'),
        lambda x: x <> '') AS parts FROM pages),
seen AS (SELECT DISTINCT host, CASE WHEN len(parts) > 0 THEN host || '/' || parts[1] ELSE host END AS part FROM hosted WHERE host <> ''),
numbered AS (SELECT kind, key, ('0x' || substr(md5(key), 1, 6))::BIGINT AS n FROM (
    SELECT DISTINCT 'h' AS kind, host AS key FROM seen
    UNION SELECT 'd', array_to_string(list_slice(string_split(host, '.'), -2, len(string_split(host, '.'))), '.') FROM seen
    UNION SELECT 'p', part FROM seen WHERE part <> host)),
entries AS (
    SELECT key, DATE '2024-01-01' + CAST(n % 300 AS INTEGER) AS since, n % 3 = 0 AS blocked FROM numbered WHERE kind = 'h'
    UNION ALL SELECT key, DATE '2024-01-01' + CAST(n % 300 + 90 AS INTEGER), false FROM numbered WHERE kind = 'h' AND n % 3 = 0
    UNION ALL SELECT key, DATE '2024-01-01' + CAST(n % 200 AS INTEGER), n % 4 = 0 FROM numbered WHERE kind = 'd'
    UNION ALL SELECT key, DATE '2024-01-01' + CAST(n % 330 AS INTEGER), n % 2 = 0 FROM numbered WHERE kind = 'p' AND n % 5 = 0),
once AS (SELECT key, since, max(blocked) AS blocked FROM entries GROUP BY key, since),
changes AS (SELECT key, since, blocked FROM (SELECT *, lag(blocked) OVER (PARTITION BY key ORDER BY since) AS before FROM once)
    WHERE blocked IS DISTINCT FROM before),
asked AS (SELECT page_id, fetched_at, unnest(list_distinct(list_concat(
    list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda k: array_to_string(list_slice(labels, k, len(labels)), '.')),
    list_transform(range(1, least(len(parts), 3) + 1), lambda k: host || '/' || array_to_string(list_slice(parts, 1, k), '/'))))) AS key
    FROM (SELECT *, string_split(host, '.') AS labels FROM hosted WHERE host <> '')),
active AS (SELECT a.page_id, a.key, c.since, c.blocked FROM asked a ASOF JOIN changes c ON a.key = c.key AND a.fetched_at >= c.since),
best AS (SELECT * FROM active QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(key) DESC, key DESC) = 1)
SELECT h.page_id, h.fetched_at, b.key, b.since AS valid_from, coalesce(b.blocked, false) AS blocked
FROM hosted h LEFT JOIN best b USING (page_id)"""

SUBSTRINGS = r"""WITH token AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
    generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) - 1 AS pos FROM documents),
windowed AS (SELECT doc_id, pos, md5(string_agg(word, ' ') OVER w) AS win, count(*) OVER w AS width FROM token
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
shared AS (SELECT win, min(doc_id) AS least FROM windowed WHERE width = 50 GROUP BY win HAVING min(doc_id) < max(doc_id)),
held AS (SELECT doc_id, pos, least FROM windowed JOIN shared USING (win)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM (SELECT *,
    CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) <= 50 THEN 0 ELSE 1 END AS fresh FROM held))
SELECT doc_id, min(pos)::BIGINT AS first_word, (max(pos) - min(pos) + 50)::BIGINT AS n_words, min(least) AS first_doc_id,
    doc_id = min(least) AS is_first FROM runs GROUP BY doc_id, run"""

LEXICAL_SEARCH = r"""WITH term AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
held AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM term GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
sized AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM lengths, total),
weighed AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, total
    WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN sized USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20"""

ORACLE = {
    "op11_lexical_search": LEXICAL_SEARCH,
    "op2_url_filters": URL_FILTERS,
    "op6_substring_dedup": SUBSTRINGS,
    "op1_quality_rules": _quality_rules(),
    "op4_line_dedup": f"""WITH docs AS (SELECT doc_id, text FROM documents), {LINE_DEDUP}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM rebuilt""",
}
