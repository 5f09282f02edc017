"""DuckDB SQL for the operators that SQL can express, from their contracts."""

from __future__ import annotations

from scorecard.llm import quality_rules

OP8 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


# The archive of ``pages`` as the query derives it: a response for each page, a
# visit 129,600 seconds later, and the latest response before it by canonical URL.
OP7 = r"""
WITH bare AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^https?://', '', 'i') AS u
  FROM pages),
parts AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)),
                        '^www\d*\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(
             string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
             lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid|ref)='))), '&') AS q
  FROM bare),
keyed AS (
  SELECT page_id, host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url_key,
         'response-' || page_id AS response_id, 1700000000 + page_id AS t0,
         '"' || md5(coalesce(html, '')) || '"' AS tag, strlen(coalesce(html, '')) AS size
  FROM parts),
found AS (
  SELECT v.page_id, v.url_key, v.t0, v.tag AS own_tag, r.*
  FROM keyed v LEFT JOIN LATERAL (
    SELECT k.response_id AS r_id, k.tag AS r_tag, k.t0 AS r_at, k.size AS r_size FROM keyed k
    WHERE k.url_key = v.url_key AND k.t0 <= v.t0 + 129600
    ORDER BY k.t0 DESC, k.response_id DESC LIMIT 1) r ON true),
judged AS (
  SELECT *, CASE
    WHEN r_id IS NULL THEN 'no response'
    WHEN page_id % 5 <> 0 THEN
      CASE WHEN page_id % 7 <> 0 AND own_tag = r_tag THEN 'etag' ELSE 'mismatch' END
    WHEN t0 = r_at THEN 'last-modified' ELSE 'mismatch' END AS outcome
  FROM found)
SELECT 'revisit-' || page_id AS record_id, url_key,
       CASE WHEN outcome IN ('etag', 'last-modified') THEN r_id END AS refers_to, outcome,
       CASE WHEN outcome IN ('etag', 'last-modified') THEN sha256(
         'cache-control: max-age=60' || chr(10) || 'content-length: ' || r_size || chr(10)
         || 'content-type: text/html; charset=utf-8' || chr(10)
         || 'date: ' || strftime(to_timestamp(t0 + 129600) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') || chr(10)
         || 'etag: ' || CASE WHEN page_id % 5 <> 0 THEN 'W/' || own_tag ELSE r_tag END || chr(10)
         || 'last-modified: '
         || strftime(to_timestamp(t0 - 3600) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')) END AS headers_sha256
FROM judged
"""


_BOUNDS = {
    "low": "{over}::DOUBLE >= {bound} * {under}::DOUBLE",
    "high": "{over}::DOUBLE <= {bound} * {under}::DOUBLE",
}


def _op4() -> str:
    """The measures from their definitions; bounds and stop words are the query's own."""
    stop = ", ".join(f"'{w}'" for s in quality_rules.STOP_WORDS for w in (s, s.capitalize()))
    rules = " AND ".join(
        _BOUNDS[side].format(over=t.over, under=t.under, bound=bound)
        for t in quality_rules.THRESHOLDS
        for side, bound in (("low", t.low), ("high", t.high))
        if bound is not None
    )
    white, count = r"[\x20\x09-\x0D]", "length(t) - length(regexp_replace(t, '{}', '', 'g'))".format
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '{white}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split)),
twice AS (SELECT r, s FROM windows GROUP BY r, s HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT j) AS n
  FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM windows JOIN twice USING (r, s)) GROUP BY r),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{white}', '', 'g')) AS word_chars,
         {count("[#*$%&|<>]")} AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(l) AS n_lines, {count("!")} AS n_exclamations,
         {count(chr(92) + "p" + "{Lu}")} AS n_upper, {count(chr(92) + "p" + "{L}")} AS n_letters,
         len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_stutters,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…){white}*$'))) AS n_ellipsis_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^{white}*(•|[*-] .*[^\x20\x09-\x0D])')))
             AS n_bullet_lines
  FROM split LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {rules} AS kept
FROM judged
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_quality_rules": _op4(), "op7_warc_revisits": OP7, "op8_exact_dedup": OP8}
