"""DuckDB SQL of the corpus queries that SQL can express: it holds them against plain definitions, without their methods."""

from __future__ import annotations

OP1_CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *,
    replace(replace(replace(replace(replace(r, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS er,
    replace(replace(replace(replace(replace(t, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS et
  FROM turns
), segments AS (SELECT *, '[INST]' || er || '[/INST]' || et || '</s>' AS segment, CASE WHEN role = 'assistant' THEN t ELSE '' END AS loss FROM escaped)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, segment)) AS turns_sha256,
  CAST(sum(length(loss)) AS BIGINT) AS loss_chars,
  sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, segment)) AS loss_sha256,
  CAST(3 + sum(length(segment)) AS BIGINT) AS formatted_chars
FROM segments GROUP BY conv_id
"""

# a digest of 160 bits is eight runs of 20 bits, each five hex digits and four characters of base32
OP3_WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
), named AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS original,
    array_to_string(list_transform(range(32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(digest, 1 + CAST(i // 4 AS INT) * 5, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS base32
  FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, base32 AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM named
"""

# sums run from the first component to the last, as the operator's do
OP6_NEAREST = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), products AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda x, y: x + y) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM products)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# nodes are distinct sets of 5-grams; only sets that share a gram are compared, on whole sets
OP8_JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS grams
  FROM words WHERE len(w) > 0
), nodes AS (SELECT grams, min(doc_id) AS node, count(*) AS copies, len(grams) AS size FROM sets GROUP BY grams),
entries AS (SELECT node, size, unnest(grams) AS gram FROM nodes),
shared AS (
  SELECT a.node AS a, b.node AS b, a.size + b.size AS sizes, count(*) AS joint
  FROM entries a JOIN entries b ON a.gram = b.gram AND a.node <> b.node AND b.size >= 0.8 * a.size - 1e-9 AND a.size >= 0.8 * b.size - 1e-9 GROUP BY 1, 2, 3
), links AS (SELECT a, b FROM shared WHERE joint >= 0.8 * (sizes - joint) - 1e-9),
reach(node, other) AS (SELECT a, a FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
classes AS (SELECT node, min(other) AS class_id FROM reach GROUP BY node),
counts AS (SELECT l.a AS node, sum(n.copies) AS links FROM links l JOIN nodes n ON l.b = n.node GROUP BY 1),
info AS (
  SELECT n.grams, coalesce(c.class_id, n.node) AS class_id, CAST(coalesce(k.links, 0) + n.copies - 1 AS BIGINT) AS n_links
  FROM nodes n LEFT JOIN classes c USING (node) LEFT JOIN counts k USING (node)
)
SELECT s.doc_id, i.class_id, i.n_links FROM sets s JOIN info i USING (grams)
UNION ALL SELECT doc_id, doc_id, 0 FROM words WHERE len(w) = 0
UNION ALL SELECT doc_id, doc_id, 0 FROM documents WHERE doc_id IS NULL OR text IS NULL
"""

# smallest windows of 25 words, forward from each line and backward from it; a window that occurs earlier loses its lines
OP9_LINE_DEDUP = r"""
WITH docs AS (SELECT row_number() OVER () AS uid, doc_id, text, string_split(text, chr(10)) AS bodies FROM documents),
lines AS (SELECT uid, doc_id, unnest(bodies) AS body, unnest(range(len(bodies))) AS line FROM docs),
counted AS (SELECT *, len(list_filter(regexp_split_to_array(body, '[ \t\r\f]+'), lambda w: w <> '')) AS words FROM lines),
summed AS (SELECT uid, line, CAST(sum(words) OVER (PARTITION BY uid ORDER BY line) AS BIGINT) AS upto, CAST(sum(words) OVER (PARTITION BY uid ORDER BY line) AS BIGINT) - words AS before FROM counted),
ends AS (SELECT uid, upto, min(line) AS line FROM summed GROUP BY ALL),
starts AS (SELECT uid, before, max(line) AS line FROM summed GROUP BY ALL),
cut AS (
  SELECT s.uid, s.line AS first, e.line AS last FROM summed s ASOF JOIN ends e ON s.uid = e.uid AND s.before + 25 <= e.upto
  UNION SELECT s.uid, b.line, s.line FROM summed s ASOF JOIN starts b ON s.uid = b.uid AND s.upto - 25 >= b.before
), named AS (SELECT c.uid, c.first, c.last, d.doc_id, d.bodies[c.first + 1:c.last + 1] AS content FROM cut c JOIN docs d USING (uid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS FIRST, uid, first) AS place FROM named),
gone AS (SELECT DISTINCT uid, unnest(range(first, last + 1)) AS line FROM placed WHERE place > 1),
kept AS (
  SELECT l.uid, string_agg(l.body, chr(10) ORDER BY l.line) FILTER (g.uid IS NULL) AS text, count(*) AS n_lines, count(g.uid) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.uid = g.uid AND l.line = g.line GROUP BY l.uid
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM docs d LEFT JOIN kept k USING (uid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": OP1_CHAT_FORMAT, "op3_warc": OP3_WARC, "op6_nearest": OP6_NEAREST, "op8_jaccard_join": OP8_JACCARD_JOIN, "op9_line_dedup": OP9_LINE_DEDUP}
