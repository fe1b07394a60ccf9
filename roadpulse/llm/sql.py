"""SQL twins of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

EMBEDDINGS = """
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sound AS (
  SELECT * FROM vectors WHERE len(v) > 0 AND len([x FOR x IN v IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x FOR x IN v IF x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS src, b.vec_id AS dst FROM sound a JOIN sound b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reach AS (
  SELECT vec_id AS src, vec_id AS dst FROM vectors UNION SELECT r.src, l.dst FROM reach r JOIN links l ON r.dst = l.src
),
named AS (SELECT src AS vec_id, min(dst) AS component_id FROM reach GROUP BY src),
counted AS (SELECT src AS vec_id, count(*) AS n FROM links GROUP BY src)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""

PERSPECTIVES = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations
),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
shaped AS (
  SELECT t.*, s.perspective,
    CASE WHEN t.speaker = s.perspective THEN 'assistant' WHEN t.speaker = 'system' THEN t.speaker ELSE 'user' END AS role,
    CASE WHEN t.speaker <> s.perspective AND t.speaker <> 'system' THEN t.speaker END AS name
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
),
headed AS (
  SELECT *, '<|' || role || coalesce(' name=' || replace(replace(name, '%', '%25'), '|', '%7C'), '') || chr(124) || '>' || chr(10) AS head
  FROM shaped
),
segmented AS (SELECT *, head || replace(text, '<|', '<||') || '<|end|>' || chr(10) AS segment FROM headed),
placed AS (
  SELECT *, row_number() OVER o AS turn_no,
    sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING) - length(segment) AS segment_start
  FROM segmented WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, text)
)
SELECT conv_id, perspective, turn_no, turn, role, name, segment, CAST(segment_start AS BIGINT) AS segment_start,
  CAST(segment_start + CASE WHEN role = 'assistant' THEN length(head) ELSE 0 END AS BIGINT) AS mask_start,
  CAST(segment_start + CASE WHEN role = 'assistant' THEN length(segment) - 1 ELSE 0 END AS BIGINT) AS mask_end
FROM placed
"""

WEIGHTED_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS text_md5,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, text_md5) AS copy FROM sized),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows_ GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sums),
weighed AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    source_size * 3.0::DOUBLE AS cap
  FROM ranked
),
filled AS (
  SELECT *, cap / weight AS own_level, sum(source_size) OVER () AS total,
    coalesce(sum(cap) OVER b, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open
  FROM weighed WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
leveled AS (
  SELECT *, max(CASE WHEN (total - capped) / open <= own_level THEN (total - capped) / open END) OVER () AS level FROM filled
),
aims AS (SELECT source, source_size, rank, least(weight * coalesce(level, own_level), cap) AS target FROM leveled),
drawn AS (
  SELECT r.*, a.source_size, a.target, a.rank, CAST(greatest(1, floor(a.target / 256)) AS BIGINT) AS packet,
    CAST(sum(size) OVER (
      PARTITION BY r.source ORDER BY md5(concat_ws(':', doc_id::VARCHAR, text_md5, copy::VARCHAR, '0')), doc_id
      ROWS UNBOUNDED PRECEDING
    ) - size AS BIGINT) AS start
  FROM rows_ r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source
),
sent AS (
  SELECT *, start + pass * source_size AS began FROM drawn, (SELECT unnest([0, 1, 2]) AS pass)
  WHERE size > 0 AND start + pass * source_size < 2 * target
),
places AS (SELECT *, unnest(range(0, size, packet)) AS place FROM sent),
packets AS (
  SELECT *, least(packet, size - place) AS words, CAST(began + place + least(packet, size - place) AS DOUBLE) / target AS finish FROM places
),
served AS (SELECT *, sum(words) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) - words AS before FROM packets),
budget AS (SELECT sum(floor(target)) AS words FROM aims),
taken AS (
  SELECT doc_id, source, text_md5, copy, CAST(sum(greatest(0, least(s.words, b.words - before))) AS BIGINT) AS taken
  FROM served s, budget b GROUP BY ALL
)
SELECT d.doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM drawn d LEFT JOIN taken t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.source IS NOT DISTINCT FROM t.source
  AND d.text_md5 IS NOT DISTINCT FROM t.text_md5 AND d.copy = t.copy
"""

SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k FROM places),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE first < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM hits),
each_word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
  FROM each_word ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

INFILL = r"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM drawn
),
placed AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
  FROM cut
),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

HARD_NEGATIVES = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM sound a JOIN sound c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
found AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_embeddings": EMBEDDINGS, "op2_perspectives": PERSPECTIVES, "op3_weighted_mix": WEIGHTED_MIX, "op4_substrings": SUBSTRINGS,
        "op11_infill": INFILL, "op13_hard_negatives": HARD_NEGATIVES,
    }
