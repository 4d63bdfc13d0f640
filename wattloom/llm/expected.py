"""DuckDB SQL for the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

from wattloom.llm.decontamination import MIN_SHARE, WINDOW

# Two classes, because DuckDB's patterns are RE2.
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len({WORDS.format("text")}), 0)::BIGINT AS size FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
),
-- One source after the other stops at its limit; as many rounds as there are sources suffice.
shares AS (
  SELECT 0 AS round, (SELECT sum(source_size) FROM sources)::DOUBLE
                     / (SELECT sum(weight) FROM sources) AS share
  UNION ALL
  SELECT round + 1,
         ((SELECT sum(source_size) FROM sources)
          - (SELECT coalesce(sum(3 * source_size), 0) FROM sources WHERE share * weight > 3 * source_size))::DOUBLE
         / nullif((SELECT sum(weight) FROM sources WHERE NOT share * weight > 3 * source_size), 0)
  FROM shares WHERE round <= (SELECT count(*) FROM sources)
),
targets AS (
  SELECT source, source_size,
         coalesce(least(weight * (SELECT arg_max(share, round) FROM shares),
                        (3 * source_size)::DOUBLE), 0.0) AS target
  FROM sources
),
rated AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, length(bin(s.size)) AS preference,
         coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::BIGINT AS copies
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
classes AS (
  SELECT source, preference, any_value(target - copies * source_size) AS open,
         sum(size)::BIGINT AS class_size
  FROM rated GROUP BY source, preference
),
factors AS (
  SELECT *,
    (open - coalesce(sum(class_size) OVER above, 0))
    / nullif(sum(preference * class_size) OVER (PARTITION BY source)
             - coalesce(sum(preference * class_size) OVER above, 0), 0) AS factor
  FROM classes
  WINDOW above AS (PARTITION BY source ORDER BY preference DESC
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
odds AS (
  SELECT source, preference, open,
         CASE WHEN coalesce(factor, 0) * preference > 1 THEN 1.0
              ELSE least(greatest(preference * (
                max_by(coalesce(factor, 0.0), preference)
                  FILTER (WHERE NOT coalesce(factor, 0) * preference > 1)
                  OVER (PARTITION BY source)), 0.0), 1.0) END::DOUBLE AS p
  FROM factors
),
drawn AS (
  SELECT r.*, o.open, o.p,
         (('0x' || substr(md5('1:' || coalesce(r.doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE)
         / 281474976710656.0::DOUBLE AS u
  FROM rated r JOIN odds o
    ON r.source IS NOT DISTINCT FROM o.source AND r.preference = o.preference
),
ranked AS (
  SELECT *, CASE WHEN p <= 0 THEN NULL WHEN p >= 1 THEN 0.0
                 ELSE (u / (1 - u)) / (p / (1 - p)) END AS q
  FROM drawn
),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id) AS upto
  FROM ranked
),
marked AS (
  SELECT *, max(CASE WHEN q IS NOT NULL AND (upto <= open OR upto - size / 2.0 <= open)
                     THEN upto END) OVER (PARTITION BY source) AS cut
  FROM summed
)
SELECT doc_id, size, source_size, target,
       ((copies + CASE WHEN q IS NOT NULL AND upto <= cut THEN 1 ELSE 0 END) * size)::BIGINT AS taken,
       source,
       copies + CASE WHEN q IS NOT NULL AND upto <= cut THEN 1 ELSE 0 END AS copies
FROM marked
"""


OP6 = rf"""
WITH docs AS (SELECT doc_id, {WORDS.format("lower(text)")} AS words FROM documents),
items AS (SELECT item_id, {WORDS.format("lower(text)")} AS words FROM benchmark),
-- Replaced words cut a window into pieces, the longest of which has so many words that are equal.
pieces AS (
  SELECT *, least({WINDOW}, len(words)) AS n, n - ceil(n * {MIN_SHARE} - 1e-9)::INTEGER AS replaced,
         ceil((n - replaced) / (replaced + 1))::INTEGER AS piece
  FROM items WHERE len(words) > 0
),
item_seeds AS (
  SELECT item_id, piece, pos, array_to_string(words[pos + 1 : pos + piece], ' ') AS seed
  FROM (SELECT *, unnest(range(len(words) - piece + 1)) AS pos FROM pieces)
),
doc_seeds AS (
  SELECT doc_id, piece, pos, array_to_string(words[pos + 1 : pos + piece], ' ') AS seed
  FROM (SELECT *, unnest(range(len(words) - piece + 1)) AS pos
        FROM docs, (SELECT DISTINCT piece FROM pieces) WHERE len(words) >= piece)
),
beside AS (
  SELECT DISTINCT doc_id, item_id, d.pos - i.pos AS start
  FROM doc_seeds d JOIN item_seeds i USING (piece, seed)
),
equal AS (
  SELECT doc_id, item_id, start, least({WINDOW}, len(i.words)) AS n_window,
         list_transform(range(len(i.words)), lambda k:
           CASE WHEN start + k >= 0 AND d.words[start + k + 1] = i.words[k + 1] THEN 1 ELSE 0 END) AS same
  FROM beside JOIN docs d USING (doc_id) JOIN items i USING (item_id)
),
windows AS (
  SELECT doc_id, item_id, start, n_window,
         list_max(list_transform(range(len(same) - n_window + 1), lambda k:
           list_sum(same[k + 1 : k + n_window]))) AS n_equal
  FROM equal
)
SELECT doc_id, item_id, arg_max(start, (n_equal, -start))::BIGINT AS start,
       max(n_equal)::INTEGER AS n_equal, any_value(n_window)::INTEGER AS n_window
FROM windows WHERE n_equal >= n_window * {MIN_SHARE}
GROUP BY doc_id, item_id
"""

OP4 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
),
stored AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS stored
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN stored IS NULL OR stored = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN stored <> page_id THEN stored END AS refers_to
FROM stored
"""

OP8 = rf"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents
),
lines AS (
  SELECT doc_id, line_no, list_sort(list_distinct({WORDS.format("lower(line)")})) AS words
  FROM split WHERE len({WORDS.format("line")}) > 0
),
sets AS (
  SELECT words, min((doc_id, line_no)) AS first, len(words) AS n, row_number() OVER () AS set
  FROM lines GROUP BY words
),
tokens AS (SELECT set, n, unnest(words) AS token FROM sets),
counts AS (SELECT token, count(*) AS held FROM tokens GROUP BY token),
ranked AS (
  SELECT set, n, token, row_number() OVER (PARTITION BY set ORDER BY held, token) AS place
  FROM tokens JOIN counts USING (token)
),
prefixes AS (SELECT set, n, token FROM ranked WHERE place <= n - ceil(n * 4 / 5) + 1),
pairs AS (
  SELECT DISTINCT a.set AS x, b.set AS y
  FROM prefixes a JOIN prefixes b ON a.token = b.token AND a.set < b.set
   AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
),
matches AS (
  SELECT a.first AS first_x, b.first AS first_y, x, y
  FROM pairs JOIN sets a ON a.set = x JOIN sets b ON b.set = y
  WHERE 9 * len(list_intersect(a.words, b.words)) >= 4 * (a.n + b.n)
),
gone AS (SELECT DISTINCT CASE WHEN first_x < first_y THEN y ELSE x END AS set FROM matches),
kept AS (SELECT first[1] AS doc_id, first[2] AS line_no FROM sets WHERE set NOT IN (SELECT set FROM gone)),
per_document AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS numbers
  FROM kept GROUP BY doc_id
),
line_counts AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_kept, 0) AS n_kept,
       md5(coalesce(numbers, '')) AS kept_md5
FROM documents LEFT JOIN line_counts USING (doc_id) LEFT JOIN per_document USING (doc_id)
"""

OP12 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

EXPECTED = {
    "op1_mixing": OP1,
    "op4_warc": OP4,
    "op6_decontamination": OP6,
    "op8_line_join": OP8,
    "op12_hard_negatives": OP12,
}
