"""DuckDB SQL for the operator queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Words are the pieces between ASCII white space; windows are five words
# joined by blanks, which no word holds.
ORACLE["op5_quality_rules"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT rid, doc_id, source, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM texts),
windows AS (
  SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM words WHERE len(ws) >= 5),
grams AS (
  SELECT rid, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM windows),
doubled AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM doubled, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
base AS (
  SELECT w.rid, doc_id, source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM words w LEFT JOIN covered c ON w.rid = c.rid),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base),
hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT avg(f::DOUBLE / n) AS m, var_samp(f::DOUBLE / n) AS v FROM hosts),
prior AS (
  SELECT CASE WHEN v > 0 AND v < m * (1 - m) THEN (m * (1 - m) / v - 1) * m ELSE 1.0 END AS a,
         CASE WHEN v > 0 AND v < m * (1 - m) THEN (m * (1 - m) / v - 1) * (1 - m) ELSE 1.0 END AS b
  FROM moments),
rejected AS (
  SELECT source FROM hosts, prior WHERE (f + a) / (n + a + b) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(source IN (SELECT source FROM rejected), FALSE) AS kept
FROM judged
"""

ORACLE["op9_warc_round_trip"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
groups AS (
  SELECT page_id, p, strlen(p) AS n, max(page_id) OVER (PARTITION BY p) AS top, count(*) OVER (PARTITION BY p) AS c
  FROM payloads),
judged AS (
  SELECT *, n >= 1000 AND c > 1 AND top IS NOT NULL AND page_id IS DISTINCT FROM top AS revisit FROM groups)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p) AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN top END AS refers_to
FROM judged
"""

# The capped sources are a prefix of the sources by words per weight: the
# shortest one beyond which no share is over its cap.
ORACLE["op13_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         sum(source_size) OVER () AS total FROM sources),
prefixes AS (
  SELECT *, total - 3 * sum(source_size) OVER before AS free_with,
         sum(weight) OVER () - sum(weight) OVER before AS weight_with,
         row_number() OVER before AS k
  FROM weighed WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
shares AS (
  SELECT source, source_size, weight, k, (free_with + 3 * source_size)::DOUBLE AS free, weight_with + weight AS open_weight
  FROM prefixes),
level AS (
  SELECT free, open_weight, k FROM shares WHERE NOT free * weight / open_weight > 3.0 * source_size ORDER BY k LIMIT 1),
goal AS (
  SELECT s.source, s.source_size,
         CASE WHEN l.k IS NULL OR s.k < l.k THEN 3.0::DOUBLE * s.source_size ELSE l.free * s.weight / l.open_weight END AS target,
         l.k IS NULL OR s.k < l.k AS held
  FROM shares s LEFT JOIN level l ON TRUE),
rated AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0.0::DOUBLE WHEN held THEN 3.0::DOUBLE
                 ELSE least(target / source_size, 3.0::DOUBLE) END AS rate
  FROM goal)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE
                                        / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source
"""
