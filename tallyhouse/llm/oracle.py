"""The queries that SQL can express, as DuckDB statements over the same tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

# The line rules with the values of quality.LineRules, written on their own.
_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{_WORD}') AS w FROM d),
grams AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM again) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
counted AS (SELECT r, line, len(regexp_extract_all(line, '{_WORD}')) AS words, length(line) AS chars,
    length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) AS symbols, length(regexp_replace(line, '[^|]+', '', 'g')) AS bars,
    length(regexp_replace(line, '[^A-Z]+', '', 'g')) AS capitals, length(regexp_replace(line, '[^A-Za-z]+', '', 'g')) AS letters,
    length(regexp_replace(line, '[^!]+', '', 'g')) AS bangs,
    length(regexp_replace(line, '[^.,;:!?"'')\]\x{{2000}}-\x{{3FFF}}]+', '', 'g')) AS marks FROM lines),
judged AS (SELECT r, line, words, chars, words > 0 AND (
    symbols > CAST(0.1 AS DOUBLE) * chars
    OR (bars >= 3 AND bars >= CAST(0.2 AS DOUBLE) * words)
    OR (capitals > CAST(0.6 AS DOUBLE) * greatest(letters, 1) AND bangs >= greatest(2, CAST(0.25 AS DOUBLE) * words))
    OR (words >= 10 AND marks = 0)
    OR (words <= 20 AND (regexp_matches(lower(line), '\b(?:click here|cookie policy|privacy policy|terms of (?:use|service)|sign up for|log in to|subscribe to our|enable javascript|all rights reserved|back to top|skip to content|read more|share this)\b')
        OR regexp_full_match(lower(line), '\s*(?:home|menu|login|log in|sign in|sign up|register|search|next|previous|back|contact|about|sitemap)\s*')))) AS failed
    FROM counted),
by_line AS (SELECT r, count(*) FILTER (WHERE words > 0) - count(DISTINCT line) FILTER (WHERE words > 0) AS dup,
    count(*) FILTER (WHERE failed) AS n_failed, coalesce(sum(chars) FILTER (WHERE failed), 0) AS lost FROM judged GROUP BY r),
measures AS (SELECT d.doc_id, len(w.w) AS n_words, CAST(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(d.t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, l.dup AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    l.n_failed AS n_lines_failed, CAST(l.lost AS BIGINT) AS chars_lost, length(d.t) AS chars
    FROM d JOIN w ON d.r = w.r JOIN by_line l ON d.r = l.r LEFT JOIN covered c ON d.r = c.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_failed, chars_lost,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND chars_lost <= CAST(0.3 AS DOUBLE) * chars AS kept
FROM measures"""

_WARC = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS g FROM pages),
f AS (SELECT g, max(page_id) AS first FROM d WHERE n >= 1000 GROUP BY g)
SELECT d.page_id, d.n AS payload_bytes, d.g AS payload_digest,
    CASE WHEN f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.g = f.g"""

_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _QUALITY.strip(), "op2_warc_chains": _WARC.strip(), "op10_pivot_top_k": _TOP_K.strip()}
