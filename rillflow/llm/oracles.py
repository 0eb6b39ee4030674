"""DuckDB SQL of the training-data queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# crc32 byte by byte: the table of its 256 remainders, then a fold over a run's bytes
_CRC = """
bits(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
  FROM bits WHERE k < 8
),
remainders AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8)
"""

# the smallest id that links (a, b), both ways, lead to
_REACH = """
reach(id, now_at) AS (
  SELECT id, id FROM nodes
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.now_at = l.a
),
low AS (SELECT id, min(now_at) AS component_id FROM reach GROUP BY id)
"""

# vectors without null or non-finite components
_FINE = """embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""

ORACLES["op7_embedding_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE {_FINE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.id <> b.id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH},
degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT low.id AS vec_id, coalesce(n, 0) AS n_links, component_id, low.id = component_id AS kept
FROM low LEFT JOIN degree ON low.id = degree.id
"""

ORACLES["op9_ngram_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                      lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM w
),
shingles AS (SELECT id, len(s) AS n, unnest(s) AS s FROM sets),
links AS (
  SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
nodes AS (SELECT id FROM sets), {_REACH},
degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT sets.id AS doc_id, len(s) AS n_shingles, component_id, coalesce(degree.n, 0) AS n_links
FROM sets JOIN low ON sets.id = low.id LEFT JOIN degree ON sets.id = degree.id
"""

ORACLES["op11_spelling_variants"] = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
hashed AS (
  SELECT run, xor(list_reduce(
           list_transform(range(octet_length(b) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295
             ELSE CAST('0x' || hex(b)[2 * i - 1 : 2 * i] AS BIGINT) END),
           lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)])), 4294967295) AS h
  FROM (SELECT run, encode(CAST(doc_id AS VARCHAR) || ':' || run) AS b FROM runs
        WHERE length(run) >= 7), remainders
),
words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS BIGINT))
                || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
),
holes AS (
  SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM holes a JOIN holes b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM holes a JOIN words b ON a.rest = b.word
),
best AS (
  SELECT w.word, w.n, count(*) AS n_near, arg_min(x.word, (-x.n, encode(x.word))) AS form,
         max(x.n) AS form_n
  FROM words w JOIN pairs p ON w.word = p.a JOIN words x ON p.b = x.word GROUP BY w.word, w.n
),
near AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 10 * words.n THEN form END AS form,
         CASE WHEN form_n >= 10 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word
),
chain(word, now_at) AS (
  SELECT word, word FROM near
  UNION ALL SELECT c.word, f.form FROM chain c JOIN near f ON c.now_at = f.word
  WHERE f.form IS NOT NULL
)
SELECT near.word, near.form, ends.now_at AS root, near.n, near.n_near, near.form_n
FROM near JOIN (SELECT c.word, c.now_at FROM chain c JOIN near f ON c.now_at = f.word
                WHERE f.form IS NULL) ends ON near.word = ends.word
"""

ORACLES["op12_hard_negatives"] = f"""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND {_FINE}
),
s AS (
  SELECT a.id AS anchor, b.id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)
),
pos AS (SELECT * FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN s n ON p.anchor = n.anchor AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) <= 5
"""

ORACLES["op13_nearest_neighbours"] = f"""
WITH v AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE {_FINE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v),
s AS (
  SELECT a.id AS query_id, b.id AS vec_id,
         list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) / (a.size * b.size)
           AS score
  FROM l a JOIN l b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
       vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
