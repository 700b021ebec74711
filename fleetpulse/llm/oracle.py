"""SQL with the same results as registered queries, for DuckDB, where SQL can express them."""

from __future__ import annotations

_CAPITALS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(pattern: str) -> str:
    return f"regexp_extract_all({_CAPITALS}, '{pattern}')"


_PLAIN_WORDS = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SPACED_WORDS = _words(r"[^\x20\x09-\x0D]+")

# Every phrase and every run of document words is spelled out and joined.
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
phrases AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) AS x
),
runs AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d CROSS JOIN (SELECT DISTINCT n FROM phrases) AS l WHERE len(w) >= n
  ) AS x
),
hits AS (SELECT doc_id, n, i, item_id FROM runs JOIN phrases USING (n, p)),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) AS x GROUP BY 1
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM hits) AS x GROUP BY 1
)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)"""

# All pairs that share a shingle, and all that can be reached from a document.
NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED_WORDS} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0) AS x
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
),
reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM groups LEFT JOIN sizes USING (doc_id)"""

# Tokens as a list, cut by ranks and put together again.
FILL_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256(concat('1:', cast(doc_id AS varchar))) AS h
  FROM documents
),
drawn AS (
  SELECT *, cast(len(w) AS bigint) AS n, cast(concat('0x', h[1:8]) AS bigint) AS h1, cast(concat('0x', h[9:16]) AS bigint) AS h2,
         cast(concat('0x', h[17:24]) AS bigint) AS h3, cast(concat('0x', h[25:32]) AS bigint) AS h4
  FROM cut
),
ranked AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(w[1:lo], ''), '') AS a, coalesce(array_to_string(w[lo + 1:hi], ''), '') AS b,
         coalesce(array_to_string(w[hi + 1:n], ''), '') AS c,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM ranked
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN cast(length(a) AS bigint) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN cast(length(b) AS bigint) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', a, '<S>', c, '<M>', b)
                        ELSE concat('<S>', c, '<P>', a, '<M>', b) END) AS output_sha256,
       sha256(concat(a, b, c)) AS restored_sha256
FROM parts"""

ORACLE_SQL = {
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op6_decontamination": DECONTAMINATION,
    "op11_fill_middle": FILL_MIDDLE,
}
