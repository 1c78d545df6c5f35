"""DuckDB SQL of the queries that SQL can express on whole tables.

The other queries have none: trained models, tokenizers and 64-bit hashes
of Spark's are not within DuckDB's SQL; ``tests/llm`` holds them against
brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) END) AS g
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * held >= 90 * (x.n + y.n - held)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
  least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id,
  (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
FROM documents LEFT JOIN sizes USING (doc_id)
"""

OP11 = rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM documents
), counts AS (
  SELECT r, doc_id, t, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
  SELECT r, sum(tf)::BIGINT AS n FROM counts GROUP BY r
), whole AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), held AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, whole GROUP BY t, n_docs
), items AS (
  SELECT DISTINCT item_id,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), scores AS (
  SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN counts USING (t) JOIN held USING (t) JOIN sizes USING (r), whole
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r))::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

OP13 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k : k + 4], ' '))) END) AS g
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * held >= 85 * (x.n + y.n - held)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), named AS (
  SELECT doc_id, coalesce(n, 0) AS n_shingles,
    least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
  FROM documents LEFT JOIN sizes USING (doc_id)
)
SELECT *, doc_id = component_id AS kept FROM named
"""

ORACLE_SQL: dict[str, str] = {"op4_jaccard_join": OP4, "op11_ranked_search": OP11, "op13_minhash": OP13}
