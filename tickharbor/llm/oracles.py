"""SQL of the comparison engine for the queries that SQL can express."""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT DISTINCT a AS doc_id, a AS other FROM edges UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id, coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""

# Positions and lengths are those of hex digits: two for each byte.
REPEATS = r"""
WITH raw AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(1, length(h) - 198, 2)) AS i FROM raw WHERE length(h) >= 200),
strings AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(h, i, 200)) AS s FROM places),
again AS (SELECT doc_id, i FROM strings QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
marked AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again),
numbered AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS b, max(i) + 200 AS e FROM numbered GROUP BY ALL),
pieces AS (SELECT r.doc_id, b, e, substr(h, coalesce(lag(e) OVER w, 1), b - coalesce(lag(e) OVER w, 1)) AS kept,
  CASE WHEN lead(b) OVER w IS NULL THEN substr(h, e) ELSE '' END AS rest
  FROM runs r JOIN raw ON raw.doc_id = r.doc_id WINDOW w AS (PARTITION BY r.doc_id ORDER BY b)),
cut AS (SELECT doc_id, CAST(sum(e - b) AS BIGINT) // 2 AS n_removed, count(*) AS n_spans, string_agg(kept || rest, '' ORDER BY b) AS left_over
  FROM pieces GROUP BY doc_id)
SELECT raw.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(left_over, h))) AS kept_sha256
FROM raw LEFT JOIN cut ON cut.doc_id = raw.doc_id
"""

DIVERGENCE = r"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS MATERIALIZED (SELECT d, lang, source, term, count(*) AS n FROM (SELECT d, lang, source, unnest(w) AS term FROM texts) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, CAST(sum(n) AS BIGINT) AS total FROM words GROUP BY ALL HAVING count(*) >= 3),
langs AS (SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS n FROM kept GROUP BY lang),
counted AS MATERIALIZED (SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, CAST(sum(c) AS BIGINT) AS n FROM counted GROUP BY ALL),
sources AS MATERIALIZED (SELECT g.lang, g.source, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM texts) g
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
shares AS MATERIALIZED (SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
  CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (s.n + l.v) AS BIGINT) AS p
  FROM sources s JOIN langs l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
  LEFT JOIN counted c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
distances AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0) AS value FROM sources a
  JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
whole AS (SELECT k.lang, k.term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (k.total + 1)) // (l.n + l.v) AS BIGINT) AS q
  FROM kept k JOIN langs l ON l.lang = k.lang),
terms AS (SELECT s.lang, s.source, s.term AS item, (p - q) * (p - q) // q AS value
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms) WHERE rank <= 200
"""

NEAR_VECTORS = r"""
WITH RECURSIVE known AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM known a JOIN known b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reached AS (SELECT DISTINCT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT vec_id, min(other) AS component FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(component, v.vec_id) AS component_id, coalesce(component, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN counts c ON c.vec_id = v.vec_id LEFT JOIN least l ON l.vec_id = v.vec_id
"""

HARD_NEGATIVES = r"""
WITH known AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
  CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM known a JOIN known b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 3
"""
