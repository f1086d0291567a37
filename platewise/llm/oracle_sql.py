"""DuckDB SQL for the rows of queries that SQL can express (see also ``quality_rules.oracle``, ``chat.oracle``)."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# (doc, root): the smallest id that links reach
_REACH = """
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS id, b AS seen FROM ways UNION SELECT reach.id, ways.b FROM reach JOIN ways ON reach.seen = ways.a),
roots AS (SELECT id, least(id, min(seen)) AS root FROM reach GROUP BY id)"""


def near_duplicates(k: int = 3, percent: int = 85) -> str:
    window = " || ' ' || ".join(f"ws[i + {j}]" for j in range(k))
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=LOWER)} AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) >= {k} THEN list_distinct(list_transform(range(1, len(ws) - {k - 2}), lambda i: {window}))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s
  FROM w),
flat AS (SELECT doc_id, unnest(s) AS x, len(s) AS n FROM sets),
links AS (
  SELECT f.doc_id AS a, g.doc_id AS b
  FROM flat f JOIN flat g ON f.x = g.x AND f.doc_id < g.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= {percent} * (any_value(f.n) + any_value(g.n) - count(*))),{_REACH}
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM sets LEFT JOIN roots ON doc_id = id"""


def linked_vectors(threshold: float = 0.93) -> str:
    return f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM sound x JOIN sound y ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id < y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= {threshold}),{_REACH},
counts AS (SELECT a, count(*) AS n FROM ways GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN roots ON vec_id = id"""


def removed_repeats(window: int = 35) -> str:
    return f"""
WITH w AS (SELECT doc_id, {WORDS.format(text='text')} AS ws FROM documents),
marks AS (
  SELECT doc_id, CASE WHEN len(ws) >= {window}
                      THEN list_transform(range(1, len(ws) - {window - 2}), lambda i: md5(array_to_string(ws[i:i + {window - 1}], ' ')))
                      ELSE [] END AS m
  FROM w),
starts AS (SELECT doc_id, unnest(m) AS h, generate_subscripts(m, 1) AS i FROM marks),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM starts) s WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM twice, range({window}) r(o)),
each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""
