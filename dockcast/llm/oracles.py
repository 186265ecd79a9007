"""SQL for operators whose contracts DuckDB can state directly; it shares nothing with their methods.

Rows are told apart by ``rid``, as doc_ids may be null or repeated.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_TERMS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, lower: bool) -> str:
    text = f"translate(text, '{_UPPER}', '{_LOWER}')" if lower else "text"
    return f"coalesce(regexp_extract_all({text}, '{pattern}'), [])"


# every benchmark window (13 words, or a shorter item whole) against every run of as many document words
CONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_words(_TERMS, True)} AS ws FROM documents
), b AS (
  SELECT item_id, {_words(_TERMS, True)} AS ws FROM benchmark WHERE item_id IS NOT NULL
), asked AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS size, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0) x
), runs AS (
  SELECT rid, size, i, array_to_string(ws[i:i + size - 1], ' ') AS phrase
  FROM (SELECT rid, size, ws, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM asked) s) x
), found AS (
  SELECT rid, i, size, item_id FROM runs JOIN asked USING (size, phrase)
), hit AS (
  SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS j FROM found) x GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found) x GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

# all pairs that share a shingle, counted; components by repeated joining
NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_words(_SPACED, True)} AS ws FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0) x
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), linked AS (
  SELECT a.rid AS a, b.rid AS b FROM (
    SELECT x.rid AS a, y.rid AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.rid <> y.rid GROUP BY x.rid, y.rid) p
  JOIN n a ON a.rid = p.a JOIN n b ON b.rid = p.b WHERE 100 * shared >= 75 * (a.n + b.n - shared)
), reach AS (
  SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN linked l ON l.a = r.b
), c AS (
  SELECT r.a AS rid, min(o.doc_id) AS component_id FROM reach r JOIN d o ON o.rid = r.b GROUP BY r.a
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)
"""

# every window of 35 words, counted by its text
REPEATED_WINDOWS = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_words(_SPACED, False)} AS ws FROM documents
), win AS (
  SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d) x
), repeated AS (
  SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j FROM repeated
), w AS (
  SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM d
), k AS (
  SELECT w.rid, string_agg(word, ' ' ORDER BY w.j) FILTER (gone.j IS NULL) AS kept, count(gone.j) AS n
  FROM w LEFT JOIN gone ON gone.rid = w.rid AND gone.j = w.j GROUP BY w.rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""
