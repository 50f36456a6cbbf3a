"""What the queries return, as SQL, where SQL can say it over whole tables."""

from __future__ import annotations

from touchline.llm.queries import MARKS_AS_TEXT, ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"
PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLES["op3_near_dedup"] = f"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), {SPACED}) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM worded)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) LEFT JOIN sizes USING (doc_id)"""

ORACLES["op5_decontaminate"] = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(coalesce({LOWER}, ''), {PLAIN}) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS words FROM (
    SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
worded AS (SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), {PLAIN}) AS w FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM worded CROSS JOIN (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, i, p.n, item FROM places p JOIN windows v ON v.n = p.n AND v.words = p.words),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM worded LEFT JOIN covered c USING (doc_id) LEFT JOIN named m USING (doc_id)"""

ORACLES["op7_substring_dedup"] = f"""
WITH worded AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM worded)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS place FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM ranked WHERE place > 1),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

ORACLES["op10_chat_format"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKS_AS_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{MARKS_AS_TEXT}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + length(text) + length('<|im_end|>') + 2
    + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
