"""DuckDB SQL for the queries that SQL can express, built on the tables alone."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: white space of the contracts as a DuckDB expression
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


OP2 = f"""
WITH d AS (
  SELECT doc_id, sha256({lower("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP4 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, {lower(f"trim(line, {SPACES})")} AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.owner AS drop_it
  FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop_it) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_it), ''))
         AS kept_sha256
FROM j GROUP BY doc_id
"""

WORDS = "[^ \\t\\n\\x0b\\f\\r]+"

OP9 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({lower("coalesce(text, '')")}, '{WORDS}') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1),
                        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 85 * (na.n + nb.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, g.component_id, d.doc_id = g.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) g USING (doc_id)
"""

OP5 = f"""
WITH p AS (
  SELECT page_id, {lower("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(rule, host, path, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
f AS (
  SELECT p.*, rule, verdict AS by_rule,
         list_transform(list_filter(string_split(p.path, '/'), lambda x: x <> ''),
                        lambda x: regexp_replace(x, '[0-9]+', '{{n}}', 'g')) AS s
  FROM p LEFT JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host))
                        AND starts_with(p.path, rules.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1),
r AS (
  SELECT * EXCLUDE s, CASE WHEN len(s) <= 8 THEN s
    ELSE list_append(s[1:7], array_to_string(s[8:], '/')) END AS levels FROM f),
u AS (
  SELECT host, levels, count(*) AS n, count(*) FILTER (by_rule = 'block') AS bad,
         count(by_rule) AS labelled FROM r GROUP BY ALL),
e AS (SELECT host, levels, n, unnest(range(len(levels))) AS depth FROM u),
c AS (
  SELECT host, levels, n, depth, levels[depth + 1] AS segment,
         array_to_string(levels[1:depth], '/') AS above FROM e),
v AS (
  SELECT host, depth, above FROM c GROUP BY ALL
  HAVING count(DISTINCT segment) >= 20 AND 2 * count(DISTINCT segment) > sum(n)),
t AS (
  SELECT u.host, u.levels, u.n, u.bad, u.labelled, coalesce(w.template, []) AS template
  FROM u LEFT JOIN (
    SELECT c.host, c.levels,
           list(CASE WHEN v.host IS NULL THEN segment ELSE '*' END ORDER BY c.depth) AS template
    FROM c LEFT JOIN v ON c.host = v.host AND c.depth = v.depth AND c.above = v.above
    GROUP BY ALL) w ON u.host = w.host AND u.levels = w.levels),
b AS (
  SELECT host, template, sum(bad) AS bad, sum(labelled) AS labelled, sum(n) AS n,
         list_max(list_transform(template, lambda x, i: CASE
           WHEN x = '*' OR contains(x, '{{n}}') THEN 0 ELSE i END)) AS last
  FROM t GROUP BY host, template),
m AS (
  SELECT *, array_to_string(list_transform(template, lambda x, i: CASE
           WHEN i = last THEN '?' ELSE x END), '/') AS mask FROM b),
k AS (
  SELECT *, sum(bad) OVER g AS kb, sum(labelled) OVER g AS kn FROM m
  WINDOW g AS (PARTITION BY host, mask)),
y AS (
  SELECT *, labelled > 0 AND (bad * kn - labelled * kb) ** 2 <= 4 * labelled * kb * (kn - kb)
           AS alike FROM k WHERE kn > 0),
q AS (
  SELECT *, sum(bad) FILTER (alike) OVER g AS pb, sum(labelled) FILTER (alike) OVER g AS pl,
         sum(n) FILTER (alike) OVER g AS pn, count(*) FILTER (alike) OVER g AS nb
  FROM y WINDOW g AS (PARTITION BY host, mask)),
j AS (
  SELECT *, labelled = 0 AND nb > 0 AND (n * nb - pn) ** 2 <= 4 * nb * (n * nb + pn) AS joins
  FROM q),
h AS (SELECT host, sum(bad) / (sum(n) + 2) AS prior FROM b GROUP BY host),
z AS (
  SELECT host, template, CASE WHEN labelled > 0 THEN 'branch' ELSE 'family' END AS evidence,
         ((CASE WHEN alike OR joins THEN pb ELSE bad END) + 2 * prior)
           / ((CASE WHEN alike OR joins THEN pl ELSE labelled END) + 2) AS purity
  FROM j JOIN h USING (host) WHERE labelled > 0 OR joins)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.by_rule, CASE
         WHEN z.purity >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       array_to_string(t.template, '/') AS template,
       CASE WHEN r.by_rule IS NOT NULL THEN 'rule' ELSE coalesce(z.evidence, 'none') END AS evidence
FROM r JOIN t ON r.host = t.host AND r.levels = t.levels
LEFT JOIN z ON t.host = z.host AND t.template = z.template
"""

def _round(i: int) -> str:
    """CTEs of one round: the vectors assigned to the centroids c{i}, and c{i + 1}."""
    return f"""
d{i} AS MATERIALIZED (
  SELECT rid, cluster, distance FROM (
    SELECT rid, c AS cluster, sum((x.q - c{i}.q) * (x.q - c{i}.q))::BIGINT AS distance
    FROM x JOIN c{i} USING (pos) GROUP BY rid, c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) = 1),
s{i} AS MATERIALIZED (
  SELECT cluster, pos, sum(q)::BIGINT AS s, count(*) AS n
  FROM d{i} JOIN x USING (rid) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c, c{i}.pos, coalesce((s - ((s % n) + n) % n) // n, q) AS q
  FROM c{i} LEFT JOIN s{i} ON c = cluster AND c{i}.pos = s{i}.pos)"""


OP11 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT rid, unnest(range(64)) AS pos, unnest(q) AS q FROM v),
f AS (
  SELECT q, row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS c
  FROM v QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS pos, unnest(q) AS q FROM f),
{",".join(_round(i) for i in range(11))},
g AS (
  SELECT c, sha256(string_agg(q::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256
  FROM c10 GROUP BY c)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
       sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM v JOIN d10 USING (rid) JOIN g ON c = cluster
"""

OP12 = f"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
         xor(4294967295, list_reduce(
           list_transform(range(1, len(doc_id::VARCHAR) + 1),
                          lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT),
           lambda c, b: list_reduce(range(8)::BIGINT[],
             lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
           4294967295::BIGINT)) AS h
  FROM documents),
u AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a
  FROM t),
o AS (
  SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + (h // 10) % 8) END AS p FROM u),
i AS (
  SELECT doc_id, n, unnest(range(n)) AS i,
         unnest(list_transform(range(n), lambda i: CASE
           WHEN a IS NOT NULL AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END)) AS word
  FROM o),
e AS MATERIALIZED (
  SELECT x.doc_id, y.i - x.i AS period, x.i
  FROM i x JOIN i y ON x.doc_id = y.doc_id AND x.word = y.word
               AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (
  SELECT doc_id, period, min(i) AS start, count(*) + period AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM e)
  GROUP BY doc_id, period, island
  HAVING count(*) + period >= greatest(6, 4 * period)),
r AS MATERIALIZED (
  SELECT doc_id, start, length, min(period) AS period FROM s GROUP BY ALL),
c AS (
  SELECT i.doc_id, i.i, i.word FROM i ANTI JOIN r
    ON i.doc_id = r.doc_id AND i.i >= r.start + r.period AND i.i < r.start + r.length),
b AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_runs FROM r
  QUALIFY row_number() OVER (
    PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
f AS (
  SELECT doc_id, string_agg(start || ',' || length || ',' || period || chr(10), ''
                            ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.start, b.length, b.period,
       1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(f.runs, '')) AS runs_sha256,
       sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN k USING (doc_id)
"""

OP13 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
      UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a),
g AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n USING (vec_id) JOIN g USING (vec_id)
"""

SQL: dict[str, str] = {
    "op2_exact_dedup": OP2,
    "op4_line_dedup": OP4,
    "op5_url_filter": OP5,
    "op9_minhash_near_dedup": OP9,
    "op11_centroid_clustering": OP11,
    "op12_periodic_runs": OP12,
    "op13_embedding_near_dedup": OP13,
}
