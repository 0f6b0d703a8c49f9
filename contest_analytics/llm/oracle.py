"""SQL twins of the queries whose results SQL can state; DuckDB runs them on the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from contest_analytics.llm import licenses, resampling

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORDS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def resampled() -> str:
    """Bucket gains, weights, noise and ranks; the CRC-32 of a word goes byte by byte through its table."""
    b, least, (part, whole), seed = resampling.BUCKETS, resampling.LEAST_WORDS, resampling.SHARE, resampling.SEED
    return f"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), lookup AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
doc_words AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
doc_features AS (SELECT r, unnest(ws) AS w FROM doc_words),
item_features AS (SELECT unnest({WORDS}) AS w FROM benchmark),
coded AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM doc_features UNION SELECT w FROM item_features)
), buckets AS (
  SELECT w, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT)),
    lambda c, byte: xor(c >> 8, t[(xor(c, byte) & 255) + 1])), 4294967295::BIGINT) % {b} AS bucket
  FROM coded, lookup
), s AS (SELECT bucket, count(*) AS s FROM doc_features JOIN buckets USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM item_features JOIN buckets USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM doc_features) AS s_all, (SELECT count(*) FROM item_features) AS t_all),
gains AS (
  SELECT s.bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + {b})::DOUBLE)
    / ((s + 1)::DOUBLE * (t_all + {b})::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), totals
), weights AS (
  SELECT r, sum(gain)::BIGINT AS weight FROM doc_features JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000.0 * ln(-ln(
      (('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (r)
), placed AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE n_features >= {least}
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) FROM placed) * {part} // {whole} THEN place END::BIGINT AS rank
FROM placed
UNION ALL
SELECT doc_id, n_features, weight, score, NULL::BIGINT FROM scored WHERE n_features < {least}
"""


def licensed() -> str:
    """Phrases by word position; templates by counting their shingles in every block, without filters."""
    phrases = ", ".join(f"({_quoted(label)}, string_split({_quoted(phrase)}, ' '))" for phrase, label in licenses.PHRASES.items())
    templates = ", ".join(f"({i}, {_quoted(label)}, {_quoted(text)})" for i, (label, text) in enumerate(licenses.TEMPLATES))
    shingled = "CASE WHEN len(ws) >= 5 THEN list_transform(range(len(ws) - 4), lambda i: ws[i::INT + 1 : i::INT + 5]) WHEN len(ws) > 0 THEN [ws] ELSE [] END"
    return f"""
WITH phrases(label, p) AS (VALUES {phrases}),
templates(t, label, text) AS (VALUES {templates}),
rows AS (SELECT row_number() OVER () AS r, doc_id, text, {WORDS} AS ws FROM documents),
places AS (
  SELECT r, label, i::BIGINT AS place
  FROM (SELECT r, ws, unnest(range(len(ws))) AS i FROM rows), phrases
  WHERE ws[i::INT + 1] = p[1] AND ws[i::INT + 1 : i::INT + len(p)::INT] = p
), based AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base FROM places GROUP BY r
), tokens AS (
  SELECT t, label, unnest(list_distinct({shingled})) AS x FROM (SELECT t, label, {WORDS} AS ws FROM templates)
), sizes AS (SELECT t, count(*) AS n FROM tokens GROUP BY t),
blocks AS (
  SELECT r, row_number() OVER () AS b, {WORDS} AS ws
  FROM (SELECT r, unnest(regexp_split_to_array(coalesce(text, ''), '\\n[\\x20\\x09\\x0D]*\\n')) AS text FROM rows)
), held AS (SELECT r, b, unnest({shingled}) AS x FROM blocks),
shared AS (
  SELECT r, b, t, label, count(DISTINCT x) AS c FROM held JOIN tokens USING (x) GROUP BY r, b, t, label
), found AS (
  SELECT r, list(DISTINCT label) AS more, max(c / n) AS score
  FROM shared JOIN sizes USING (t) WHERE c * 100 >= n * {licenses.PER_CENT} GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM rows LEFT JOIN based USING (r) LEFT JOIN found USING (r)
"""


def _host(url: str) -> str:
    return f"translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _path(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _address(url: str) -> str:
    rest = f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1)"
    return f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || coalesce(nullif({rest}, ''), '/') END"


def filtered(rules: Sequence[tuple[str, str, str]]) -> str:
    """Rules by host suffix and path start; links of the pages closed to groups by recursion."""
    listed = ", ".join(f"({_quoted(v)}, {_quoted(h)}, {_quoted(p)})" for v, h, p in rules)
    quote = "[\"'']?"
    return f"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (VALUES {listed}),
parsed AS (SELECT page_id, html, {_host('url')} AS host, {_path('url')} AS path, {_address('url')} AS node FROM pages),
tags AS (
  SELECT node, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag
  FROM parsed WHERE regexp_matches(html, '(?i)canonical|http-equiv')
), links AS (
  SELECT node, host, path, CASE
    WHEN regexp_matches(tag, '(?is)^<link\\b.*\\brel\\s*=\\s*{quote}canonical\\b')
      THEN regexp_extract(tag, '(?is)\\bhref\\s*=\\s*{quote}\\s*([^"''\\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*{quote}refresh\\b')
      THEN regexp_extract(tag, '(?is)\\burl\\s*=\\s*{quote}\\s*([^"''\\s>]+)', 1) ELSE '' END AS link
  FROM tags
), targets AS (
  SELECT node AS a, CASE WHEN contains(link, '://') THEN link WHEN starts_with(link, '//') THEN 'http:' || link
    WHEN starts_with(link, '/') THEN 'http://' || host || link
    ELSE 'http://' || host || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || link END AS target
  FROM links WHERE link <> ''
), edges AS (SELECT a, b FROM (SELECT a, {_address('target')} AS b FROM targets) WHERE a IS NOT NULL AND b IS NOT NULL),
near AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached(node, other) AS (
  SELECT a, a FROM near UNION SELECT reached.node, near.b FROM reached JOIN near ON reached.other = near.a
), groups AS (SELECT node, min(other) AS component FROM reached GROUP BY node),
aliases AS (SELECT component, {_host("'http://' || node")} AS host, {_path("'http://' || node")} AS path FROM groups),
spots AS (SELECT host, path FROM parsed UNION SELECT host, path FROM aliases),
fits AS (
  SELECT host, path, rule_host || rule_path AS rule, verdict, row_number() OVER (
    PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, verdict = 'allow' DESC, rule_host || rule_path DESC) AS place
  FROM spots JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), best AS (SELECT host, path, rule, verdict FROM fits WHERE place = 1),
blocked AS (SELECT DISTINCT component FROM aliases JOIN best USING (host, path) WHERE verdict = 'block'),
hit AS (SELECT node FROM groups JOIN blocked USING (component))
SELECT page_id, parsed.host, parsed.path, rule,
  coalesce(best.verdict, CASE WHEN hit.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN best ON parsed.host = best.host AND parsed.path = best.path LEFT JOIN hit ON parsed.node = hit.node
"""


def statements(url_rules: Sequence[tuple[str, str, str]]) -> dict[str, str]:
    return {"op4_url_filters": filtered(url_rules), "op12_resampling": resampled(), "op13_licenses": licensed()}
