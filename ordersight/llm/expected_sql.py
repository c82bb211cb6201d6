"""SQL of the operators whose results SQL can express, written from the definition of the result.

No blocks, samples or indexes: all windows, all pairs that share a shingle, all pairs of vectors.
"""

from __future__ import annotations

from ordersight.llm.capture_index import OP12_SQL
from ordersight.llm.decontamination import OP7_SQL
from ordersight.llm.source_divergence import OP11_SQL

# All 50-byte strings as hexadecimal text, with the smallest document each starts in.
OP4_SQL = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, place, substring(h, 2 * place - 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(1, greatest(n - 49, 0) + 1)) AS place FROM docs)),
firsts AS (SELECT s, min(doc_id) AS first_doc FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, place FROM windows JOIN firsts USING (s) WHERE doc_id > first_doc),
runs AS (
  SELECT doc_id, min(place) AS a, max(place) + 50 AS z
  FROM (SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run
        FROM (SELECT doc_id, place,
                CASE WHEN place > lag(place) OVER (PARTITION BY doc_id ORDER BY place) + 50 THEN 1 ELSE 0 END AS fresh FROM hits))
  GROUP BY doc_id, run),
before AS (SELECT doc_id, a, z, lag(z, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM runs),
kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * p - 1, 2 * (a - p)), '' ORDER BY a) || substring(any_value(h), 2 * max(z) - 1) AS left_over,
         CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans
  FROM before JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(left_over, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, array_to_string(w[place:place + 4], ' ') AS s, count(*) AS times
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS place FROM words WHERE len(w) > 0) GROUP BY ALL),
spread AS (SELECT s, count(*) AS df FROM shingles GROUP BY s),
total AS (SELECT count(*) AS n FROM documents),
weighted AS (
  SELECT doc_id, s, times * CASE WHEN df >= greatest(2, ceil(n / 200.0)) THEN ln(1 + n / df) ELSE ln(201) END AS weight
  FROM shingles JOIN spread USING (s), total),
sums AS (SELECT doc_id, sum(weight) AS whole FROM weighted GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.weight, b.weight)) AS common
  FROM weighted a JOIN weighted b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sums p ON p.doc_id = x JOIN sums q ON q.doc_id = y WHERE common / (p.whole + q.whole - common) >= 0.8
  UNION SELECT a.doc_id, b.doc_id FROM documents a JOIN documents b ON coalesce(a.text, '') = coalesce(b.text, '') AND a.doc_id < b.doc_id),
reach AS (
  SELECT doc_id AS start, doc_id AS here FROM documents
  UNION SELECT start, other FROM reach JOIN (SELECT x, y AS other FROM links UNION SELECT y, x FROM links) n ON n.x = here)
SELECT start AS doc_id, min(here) AS class_id, min(here) = start AS kept FROM reach GROUP BY start
"""

OP8_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS start, vec_id AS here FROM embeddings UNION SELECT start, y FROM reach JOIN links ON x = here),
found AS (SELECT start, min(here) AS component_id FROM reach GROUP BY start)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN found ON start = vec_id
"""

EXPECTED_SQL = {
    "op4_suffix_repeats": OP4_SQL,
    "op6_near_duplicates": OP6_SQL,
    "op7_decontamination": OP7_SQL,
    "op8_embedding_links": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
    "op12_capture_index": OP12_SQL,
}
