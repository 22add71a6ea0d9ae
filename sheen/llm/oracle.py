"""DuckDB SQL of the passage, near-copy, vector, secret and run queries, over whole tables."""

from __future__ import annotations

SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS k
      FROM (SELECT doc_id, x, unnest(range(n - 99)) AS p FROM d WHERE n >= 100)),
again AS (SELECT doc_id, p FROM w
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
run AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, true) AS fresh FROM again),
span AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b
         FROM (SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS i FROM run) GROUP BY doc_id, i),
gap AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM span
        UNION ALL
        SELECT d.doc_id, d.n, coalesce(max(b), 0) FROM d LEFT JOIN span USING (doc_id) GROUP BY d.doc_id, d.n),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a, z) AS k FROM gap JOIN d USING (doc_id)
         GROUP BY doc_id),
s AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN s USING (doc_id)"""

MINHASH_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, md5_number_lower(s) AS s FROM (
    SELECT doc_id, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s, i, n
    FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM d))
  WHERE i <= greatest(1, n - 2)),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
h AS (SELECT g.doc_id, s, n FROM g JOIN c USING (doc_id)),
link AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM h x JOIN h y ON x.s = y.s AND x.doc_id <> y.doc_id
  WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS id, doc_id AS r FROM documents
  UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.r AS component_id, m.r = d.doc_id AS kept
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT id, min(r) AS r FROM reach GROUP BY id) m ON m.id = d.doc_id"""

EMBEDDING_DEDUP = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
reach AS (
  SELECT vec_id AS id, vec_id AS r FROM embeddings
  UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, m.r AS component_id, m.r = e.vec_id AS kept
FROM embeddings e JOIN (SELECT id, min(r) AS r FROM reach GROUP BY id) m ON m.id = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = e.vec_id"""

SECRET_SCAN = r"""
WITH rules(no, kind, part, least) AS (VALUES
  (0, 'assign', 2, 8), (1, 'access', 0, 16), (2, 'hex', 0, 32), (3, 'pem', 0, 1), (4, 'github', 0, 1)),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (
  SELECT doc_id, no, kind, least,
    CASE no
      WHEN 0 THEN string_split_regex(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+')
      WHEN 1 THEN string_split_regex(t, 'AKIA[A-Z0-9]+') WHEN 2 THEN string_split_regex(t, '[0-9a-f]+')
      WHEN 3 THEN string_split_regex(t, '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----')
      ELSE string_split_regex(t, 'gh[pousr]_[A-Za-z0-9]{36,}') END AS gap,
    CASE no
      WHEN 0 THEN regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+')
      WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+') WHEN 2 THEN regexp_extract_all(t, '[0-9a-f]+')
      WHEN 3 THEN regexp_extract_all(t, '-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----')
      ELSE regexp_extract_all(t, 'gh[pousr]_[A-Za-z0-9]{36,}') END AS hit,
    CASE WHEN no = 0 THEN regexp_extract_all(t,
      '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) END AS part
  FROM d, rules),
m AS (SELECT doc_id, no, kind, least, unnest(gap) AS gap, unnest(hit) AS hit, unnest(part) AS part, generate_subscripts(gap, 1) AS i
      FROM f WHERE len(hit) > 0),
s AS (
  SELECT doc_id, no, kind, "end" - length(hit) AS start, "end"
  FROM (SELECT *, (sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, no ORDER BY i))::BIGINT AS "end" FROM m WHERE hit IS NOT NULL)
  WHERE length(coalesce(part, hit)) >= least)
SELECT d.doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
       sha256(coalesce(string_agg(concat_ws(':', kind, start, "end"), ',' ORDER BY start, no) FILTER (no < 3), '')) AS base_sha256,
       coalesce(string_agg(concat_ws(':', kind, start, "end"), ',' ORDER BY start, no), '') AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM d),
k AS (SELECT *, CASE WHEN i + 34 <= n THEN md5(string_agg(word, ' ') OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS k FROM t),
r AS (SELECT *, k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 AS again FROM k),
c AS (SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM r)
SELECT d.doc_id, len(any_value(d.w)) AS n_words, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id"""

PERIODIC_RUNS = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda x, b: xor(x >> 8, tab[(xor(x, b) % 256) + 1])), 4294967295::BIGINT) AS h
  FROM documents, crc),
p AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made, (h // 10) % greatest(len(w), 1) AS a,
         1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS q FROM d),
t AS (
  SELECT doc_id, i, n, w[1 + CASE WHEN made AND i >= a THEN a + (i - a) % q ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM p)),
six AS (SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS s
        FROM t),
g AS (SELECT doc_id, i, hash(s) AS s FROM six WHERE i + 6 <= n),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
isle AS (SELECT doc_id, q, min(i) AS a, max(i) + 6 + q AS b
         FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pair) GROUP BY doc_id, q, k),
cand AS (SELECT * FROM isle WHERE b - a >= greatest(12, 2 * q)),
run AS (SELECT * FROM cand x WHERE NOT EXISTS (
          SELECT 1 FROM cand y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.a <= x.a AND y.b >= x.b)),
gone AS (SELECT DISTINCT doc_id, unnest(range(a + q, b)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
s AS (
  SELECT doc_id, count(*) AS n_runs, arg_min({a: a, l: b - a, q: q}, (a - b, a, q)) AS top,
         string_agg(concat(a, ',', b - a, ',', q, chr(10)), '' ORDER BY a, q) AS lines FROM run GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.a AS start, top.l AS length, top.q AS period,
       1000 * top.l // top.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(k, '')) AS collapsed_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN kept USING (doc_id)"""
