"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
),
prior AS (
  SELECT *, sum(words) OVER () AS all_words,
         sum(words) OVER () - coalesce(sum(3 * words) OVER w, 0) AS room,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights
  FROM ranked
  WINDOW w AS (ORDER BY words / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
  SELECT any_value(all_words) - coalesce(sum(3 * words) FILTER (weight * room > 3 * words * weights), 0) AS room,
         sum(weight) FILTER (NOT weight * room > 3 * words * weights) AS weights
  FROM prior
),
targets AS (
  SELECT p.source, p.words,
         CASE WHEN p.weight * p.room > 3 * p.words * p.weights THEN CAST(3 * p.words AS DOUBLE)
              ELSE CAST(p.weight * l.room AS DOUBLE) / CAST(l.weights AS DOUBLE) END AS target
  FROM prior p CROSS JOIN level l
),
pass0 AS (
  SELECT s.*, t.words, t.target,
         CASE WHEN t.words > 0 THEN CAST(floor(t.target / t.words) AS BIGINT) ELSE 0 END AS whole,
         t.target - CASE WHEN t.words > 0 THEN floor(t.target / t.words) ELSE 0 END * t.words AS room,
         false AS extra
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id, size) AS pos FROM pass0
),
-- a source walks its documents in order and takes each that fits what is left
walk(source, pos, room, took) AS (
  SELECT DISTINCT source, CAST(0 AS BIGINT), room, false FROM pass0
  UNION ALL
  SELECT o.source, o.pos, w.room - CASE WHEN o.size <= w.room THEN o.size ELSE 0 END,
         o.size > 0 AND o.size <= w.room
  FROM walk w JOIN ordered o ON o.source IS NOT DISTINCT FROM w.source AND o.pos = w.pos + 1
),
ends AS (SELECT source, arg_max(room, pos) AS room FROM walk GROUP BY source),
taken AS (
  SELECT o.* EXCLUDE (room, extra), e.room, w.took AS extra
  FROM ordered o
  JOIN walk w ON o.source IS NOT DISTINCT FROM w.source AND o.pos = w.pos
  JOIN ends e ON o.source IS NOT DISTINCT FROM e.source
),
last AS (
  SELECT * EXCLUDE (extra),
         extra OR (size > 0 AND abs(size - room) < room AND
           row_number() OVER (PARTITION BY source ORDER BY extra, size = 0, abs(size - room), k, doc_id, size) = 1
         ) AS extra
  FROM taken
)
SELECT doc_id, source, size, words AS source_size, target,
       whole + CAST(extra AS BIGINT) AS copies, (whole + CAST(extra AS BIGINT)) * size AS taken
FROM last
"""

# CRC-32 by its reflected polynomial: a table of eight shifts a byte value, then
# a fold over the bytes.  The jumps of the key are a recursion.
_SHARDS = r"""
WITH RECURSIVE bits(b, c, i) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END, i + 1
  FROM bits WHERE i < 8
),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
coded AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size,
         string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\1,', 'g'), ',')[:-2] AS codes
  FROM documents
),
sized AS (
  SELECT doc_id, size,
         xor(list_reduce(list_transform(codes, lambda h: CAST(CAST('0x' || h AS INTEGER) AS BIGINT)),
                         lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1]), CAST(4294967295 AS BIGINT)),
             CAST(4294967295 AS BIGINT)) AS text_crc32
  FROM coded CROSS JOIN crc_table
),
jumps(doc_id, n, g, b, j) AS (
  SELECT doc_id, n, CAST(doc_id AS HUGEINT), -1::BIGINT, 0::BIGINT
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (8), (9)) AS counts(n)
  UNION ALL
  SELECT doc_id, n, (g * 2862933555777941757 + 1) % 18446744073709551616, j,
         CAST(floor((j + 1) * (2147483648.0::DOUBLE /
           CAST(((g * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM jumps WHERE j < n
),
shards AS (
  SELECT doc_id, CAST(max(b) FILTER (n = 8) AS INTEGER) AS shard,
         CAST(max(b) FILTER (n = 9) AS INTEGER) AS grown_shard
  FROM jumps GROUP BY doc_id
)
SELECT s.doc_id, s.size, s.text_crc32, 'key' AS law, h.shard,
       row_number() OVER (PARTITION BY h.shard ORDER BY (s.doc_id % 4096 + s.text_crc32 % 4096) % 4096,
                          s.doc_id, s.text_crc32, s.size) - 1 AS slot,
       h.grown_shard
FROM sized s JOIN shards h ON s.doc_id = h.doc_id
"""

_WARC = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
),
g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest)
                 ELSE page_id END AS last
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM g
"""

_TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_LINES = r"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
),
u AS (
  SELECT doc_id, i, parts[i] AS line,
         translate(trim(parts[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM l)
),
h AS (SELECT k, min(doc_id) AS first FROM u WHERE length(k) >= 10 GROUP BY k),
d AS (SELECT u.*, coalesce(first < doc_id, false) AS gone FROM u LEFT JOIN h ON u.k = h.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""

_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)
),
p AS (
  SELECT * FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
         s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT * FROM n WHERE rank <= 5
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM starts CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS t(k)
  WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100
),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inner_parts AS (
  SELECT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, max(c.a) AS a
  FROM c CROSS JOIN (VALUES (1), (2), (3), (4)) AS s(i) CROSS JOIN (VALUES (2), (3), (4)) AS t(m)
  WHERE m < c.k AND i + m - 1 <= c.k
  GROUP BY ALL
),
alone AS (
  SELECT c.* FROM c LEFT JOIN inner_parts p ON c.lang = p.lang AND c.phrase = p.phrase
  WHERE p.a IS NULL OR p.a < c.a
),
cuts AS (
  SELECT x.lang, x.phrase, x.a, t.cut, l.a AS l, r.a AS r, total.n,
         CAST((1000::HUGEINT * x.a * total.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM alone x
  JOIN (VALUES (1), (2), (3), (4)) AS t(cut) ON t.cut < x.k
  JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:t.cut], ' ')
  JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[t.cut + 1:x.k], ' ')
  JOIN total ON total.lang = x.lang
),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score
  FROM best
)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": _MIX,
    "op4_threshold_search": _TOP,
    "op6_warc_round_trip": _WARC,
    "op2_jump_shards": _SHARDS,
    "op11_reversible_lines": _LINES,
    "op12_annulus_negatives": _NEGATIVES,
    "op13_border_phrases": _PHRASES,
}
