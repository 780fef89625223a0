"""Reference SQL for the operators that SQL can express, written for DuckDB."""

# The checksum is folded over the bytes with the table of the reversed polynomial EDB88320.
SHARDS = """
WITH bits AS (
  SELECT n, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1
      THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) AS c
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n)),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits),
base AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size
  FROM documents),
texts AS (
  SELECT text, xor(4294967295, list_reduce(
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
      lambda c, b: xor(c // 256, t[1 + (xor(c, b) % 256)]), 4294967295)) AS text_crc32
  FROM (SELECT DISTINCT text FROM base), crc),
ordered AS (
  SELECT doc_id, text, size, md5(text) AS digest,
    sum(size) OVER o - size AS before, sum(size) OVER () AS total, row_number() OVER o AS place
  FROM base WINDOW o AS (ORDER BY md5(text), doc_id ROWS UNBOUNDED PRECEDING)),
grouped AS (
  SELECT *, min(before) OVER g AS group_start, sum(size) OVER g AS group_bytes
  FROM ordered WINDOW g AS (PARTITION BY digest)),
cut AS (
  SELECT *, least(39, (CASE WHEN group_bytes * 40 <= total * 0.05
      THEN 2 * group_start + group_bytes ELSE 2 * before + size END) * 40 // (2 * total)) AS shard
  FROM grouped)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law,
  CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM cut JOIN texts USING (text)
"""

# Links are found by joining all shingles and followed until nothing new is reached.
JACCARD_LINKS = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'),
    lambda x: x <> '') AS ws
  FROM documents),
grams AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS g
  FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION SELECT d, y FROM reach JOIN links ON x = r),
smallest AS (SELECT d, min(r) AS r FROM reach GROUP BY d),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, coalesce(s.n, 0) AS n_shingles, m.r AS component_id, coalesce(g.n, 0) AS n_links
FROM documents JOIN smallest m ON d = doc_id LEFT JOIN sizes s USING (doc_id)
LEFT JOIN degree g ON g.x = doc_id
"""

# Every window of 100 bytes but the first of its kind marks the bytes it covers.
REPEATED_BYTES = """
WITH data AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY md5(b[i:i + 99]) ORDER BY doc_id, i) AS nth
  FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS i FROM data)),
marked AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER o <= 100 THEN 0 ELSE 1 END AS fresh
  FROM windows WHERE nth > 1 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, min(i) AS first, max(i) + 100 AS after
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked)
  GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, first, after, lag(after, 1, 1) OVER (PARTITION BY doc_id ORDER BY first) AS begin
  FROM runs),
cut AS (
  SELECT doc_id, CAST(sum(after - first) AS BIGINT) AS n_removed, count(*) AS n_spans,
    max(after) AS tail, string_agg(hex(b[begin:first - 1]), '' ORDER BY first) AS head
  FROM gaps JOIN data USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_spans IS NULL THEN b
    ELSE unhex(head || hex(b[tail:octet_length(b)])) END) AS kept_sha256
FROM data LEFT JOIN cut USING (doc_id)
"""

_WHOLE_VECTORS = """
whole AS (
    SELECT row_number() OVER () AS r, vec_id, label,
        list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)
"""

# Scores are whole numbers well below 2^53, so doubles add them up exactly.
HIGHEST_PRODUCTS = f"""
WITH {_WHOLE_VECTORS},
queries AS (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x) AS copy FROM whole WHERE vec_id % 50 = 0
),
scored AS (
    SELECT q.vec_id AS query_id, q.copy, c.vec_id,
        CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
    FROM queries q JOIN whole c ON c.r <> q.r
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score, CAST(copy AS INTEGER) AS copy
FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id, copy ORDER BY score DESC, vec_id) AS rank FROM scored
)
WHERE rank <= 5
"""

HARD_NEGATIVES = f"""
WITH {_WHOLE_VECTORS},
labelled AS (
    SELECT r, vec_id, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM whole WHERE label IS NOT NULL
),
anchors AS (
    SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x, label) AS copy
    FROM labelled WHERE vec_id % 100 = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, a.copy, c.vec_id, c.label = a.label AS same,
        CAST(list_inner_product(CAST(a.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
    FROM anchors a JOIN labelled c ON c.r <> a.r
),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id, copy ORDER BY score DESC, vec_id) AS positive_rank
    FROM scored WHERE same
),
negatives AS (
    SELECT p.anchor_id, p.copy, p.positive_rank, p.vec_id AS positive_id, p.score AS positive_score,
        n.vec_id AS negative_id, n.score AS negative_score,
        row_number() OVER (
            PARTITION BY p.anchor_id, p.copy, p.positive_rank ORDER BY n.score DESC, n.vec_id
        ) AS rank
    FROM positives p
    JOIN scored n ON n.anchor_id = p.anchor_id AND n.copy = p.copy AND NOT n.same
        AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    WHERE p.positive_rank <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score,
    CAST(copy AS INTEGER) AS copy, CAST(positive_rank AS INTEGER) AS positive_rank
FROM negatives WHERE rank <= 10
"""
