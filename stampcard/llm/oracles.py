"""SQL twins, written for DuckDB over the same tables."""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

HAMMING_TOPK = r"""
WITH bits AS (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS x FROM embeddings),
codes AS (
  SELECT vec_id, bit_xor(CASE WHEN x > 0 THEN 1::UBIGINT << (i % 64) ELSE 0::UBIGINT END) AS code
  FROM bits GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INTEGER AS distance
  FROM codes q JOIN codes c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, coalesce(source, chr(1) || 'none') AS site, line, pos
  FROM documents,
       LATERAL (SELECT unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) AS pos)
  WHERE text IS NOT NULL),
spread AS (
  SELECT line FROM lines WHERE trim(line, ' ') <> ''
  GROUP BY line HAVING count(DISTINCT site) >= 8),
ranked AS (
  SELECT l.*, s.line IS NOT NULL AS hit,
         row_number() OVER (PARTITION BY l.line ORDER BY l.doc_id, l.pos) AS place
  FROM lines l LEFT JOIN spread s ON l.line = s.line)
SELECT d.doc_id,
       coalesce(count(r.pos), 0)::BIGINT AS n_lines,
       coalesce(count(*) FILTER (r.hit AND r.place > 1), 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE
         coalesce(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (NOT r.hit OR r.place = 1), '') END AS text
FROM documents d LEFT JOIN ranked r ON d.doc_id = r.doc_id
GROUP BY d.doc_id, d.text
"""

MIXING = r"""
WITH s AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS point
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM src),
weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         (2 * source_size)::DOUBLE AS lim
  FROM ranked),
levels AS (
  SELECT *, lim / weight AS full_at,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
           - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM weighed),
chosen AS (SELECT lev FROM levels WHERE lev <= full_at ORDER BY full_at, place LIMIT 1),
targets AS (
  SELECT source, source_size, least(lim, weight * (SELECT lev FROM chosen)) AS target FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS times FROM targets),
points AS (SELECT source, point, sum(size)::BIGINT AS words FROM s WHERE size > 0 GROUP BY source, point),
running AS (
  SELECT p.*, b.target - b.times * b.source_size AS rest,
         sum(words) OVER (PARTITION BY p.source ORDER BY point) AS upto
  FROM points p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source),
extra AS (
  SELECT source, point FROM running
  WHERE upto <= rest OR (upto - words <= rest AND upto - rest < rest - (upto - words)))
SELECT s.doc_id, s.size, b.source_size, b.target,
       (s.size * (b.times + CASE WHEN e.point IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN extra e ON s.source IS NOT DISTINCT FROM e.source AND s.point = e.point
"""

FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
facts AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
         len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d,
         coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY body), false) AS e
  FROM words t LEFT JOIN facts ON t.doc_id = facts.doc_id),
masks AS (
  SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS o
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE q.x <> p.x AND r.x NOT IN (p.x, q.x) AND s.x NOT IN (p.x, q.x, r.x) AND t.x NOT IN (p.x, q.x, r.x, s.x)),
steps AS (
  SELECT part, o, n, good, bad, a, b, c, d, e,
         least(CASE WHEN a THEN strpos(o, 'A') ELSE 6 END, CASE WHEN b THEN strpos(o, 'B') ELSE 6 END,
               CASE WHEN c THEN strpos(o, 'C') ELSE 6 END, CASE WHEN d THEN strpos(o, 'D') ELSE 6 END,
               CASE WHEN e THEN strpos(o, 'E') ELSE 6 END) AS gone
  FROM masks, orders),
cells AS (
  SELECT part, o, k, o[k] AS f, n, good, bad, gone, a::INT + b::INT + c::INT + d::INT + e::INT AS fails,
         CASE o[k] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS hit
  FROM steps, range(1, 6) AS r(k)),
counted AS (
  SELECT part, o, k, f,
         coalesce(sum(n) FILTER (gone > k), 0) AS kept, coalesce(sum(n) FILTER (gone = k), 0) AS removed,
         coalesce(sum(n) FILTER (hit AND gone < k), 0) AS redundant,
         coalesce(sum(n) FILTER (hit AND fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (gone = k), 0) AS good_lost, coalesce(sum(bad) FILTER (gone = k), 0) AS toxic_lost
  FROM cells GROUP BY part, o, k, f)
SELECT part, o AS filter_order, k::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""

TURN_REPAIR = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
             lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
picked AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295::UBIGINT,
             list_reduce([4294967295::UBIGINT] || list_transform(range(1, strlen(k) + 1), lambda i: ascii(substr(k, i, 1))::UBIGINT),
                         lambda c, b: xor(tab[(xor(c, b) % 256 + 1)::BIGINT], c >> 8))) % 20 AS pick
  FROM keyed, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
         CASE pick WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM picked WHERE pick <> 0
  UNION ALL
  SELECT conv_id, turn, role, text FROM picked WHERE pick = 3),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS x FROM hurt),
seen AS (
  SELECT *, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again
  FROM placed),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM seen),
inserts(p, q, extra, letters, lines) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 2, 'I', 'user:' || chr(10)), (0, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (1, 1, 0, '', ''), (1, 2, 2, 'I', 'user:' || chr(10)), (1, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  (2, 2, 0, '', ''), (2, 3, 2, 'I', 'assistant:' || chr(10)), (2, 2, 4, 'II', 'assistant:' || chr(10) || 'user:' || chr(10)),
  (3, 3, 0, '', ''), (3, 2, 2, 'I', 'user:' || chr(10)), (3, 3, 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
choices(e) AS (VALUES ('D'), ('K'), ('R')),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} AS best FROM faults
  UNION ALL
  SELECT conv_id, i, state, min(best) AS best FROM (
    SELECT w.conv_id, f.i,
           CASE e WHEN 'D' THEN n.q WHEN 'R' THEN CASE n.q WHEN 2 THEN 3 ELSE 2 END
                  ELSE CASE f.x WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS state,
           {'cost': w.best.cost + n.extra + CASE e WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                    + CASE WHEN e <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END,
            'audit': w.best.audit || n.letters || e,
            'lines': w.best.lines || n.lines ||
                     CASE e WHEN 'D' THEN '' WHEN 'R' THEN CASE n.q WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text || chr(10)
                            ELSE f.role || ':' || f.text || chr(10) END} AS best
    FROM walk w JOIN faults f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1
    JOIN inserts n ON n.p = w.state CROSS JOIN choices
    WHERE e = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (
          e = 'R' OR f.x = 's' AND n.q = 0 OR f.x = 'u' AND n.q <> 2 OR f.x = 'a' AND n.q = 2))
  GROUP BY conv_id, i, state),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND earlier || x NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
ended AS (
  SELECT c.conv_id, min({'cost': w.best.cost + CASE w.state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
                         'audit': w.best.audit || CASE w.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                         'lines': w.best.lines || CASE w.state WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10)
                                                               WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END}) AS best
  FROM counted c JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
       coalesce(e.best.audit, '') AS audit,
       sha256(coalesce(substr(e.best.lines, 1, greatest(length(e.best.lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLES = {
    "op2_warc": WARC,
    "op3_hamming_topk": HAMMING_TOPK,
    "op4_line_dedup": LINE_DEDUP,
    "op9_mixing": MIXING,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_turn_repair": TURN_REPAIR,
}
