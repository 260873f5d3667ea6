"""DuckDB SQL of the queries that SQL can express."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [md5(array_to_string(w, ' '))]
    ELSE list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i+4], ' '))) END) AS g FROM w),
c AS (SELECT min(doc_id) AS class, list_sort(g) AS g FROM s WHERE len(g) > 0 GROUP BY list_sort(g)),
e AS (SELECT class, unnest(g) AS h FROM c),
p AS (SELECT x.class AS a, y.class AS b, count(*) AS n FROM e x JOIN e y ON x.h = y.h AND x.class < y.class GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN c ca ON ca.class = a JOIN c cb ON cb.class = b
  WHERE 100 * n >= 75 * (len(ca.g) + len(cb.g) - n)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT class AS id, class AS c FROM c UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(m.c, s.doc_id) AS component_id,
  s.doc_id = coalesce(m.c, s.doc_id) AS kept
FROM s LEFT JOIN c ON list_sort(s.g) = c.g LEFT JOIN m ON m.id = c.class
"""

OP9 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda k: array_to_string(w[k:k+9], ' '))) AS g
  FROM i WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, w FROM d, ns WHERE len(w) >= n),
h AS (SELECT DISTINCT dw.doc_id, dw.k, dw.n, iw.item_id FROM (SELECT doc_id, k, n, array_to_string(w[k:k+n-1], ' ') AS g FROM dw) dw JOIN iw ON iw.g = dw.g AND iw.n = dw.n),
p AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP10 = r"""
WITH p AS MATERIALIZED (SELECT source, text, row_number() OVER () AS page FROM (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL)),
pl AS MATERIALIZED (
  SELECT source, page, line, length(line) AS size
  FROM (SELECT source, page, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')))) AS line FROM p) WHERE line <> ''),
t0 AS (SELECT source, count(*) AS n FROM p GROUP BY source),
b0 AS MATERIALIZED (
  SELECT l.source, l.line FROM (SELECT source, line, count(*) AS c FROM pl GROUP BY source, line) l
  JOIN t0 ON l.source IS NOT DISTINCT FROM t0.source WHERE c > greatest(0.05 * n, 1.5 * sqrt(n))),
m AS MATERIALIZED (SELECT pl.*, b0.line IS NOT NULL AS hit FROM pl LEFT JOIN b0 ON b0.source IS NOT DISTINCT FROM pl.source AND b0.line = pl.line),
g AS (
  SELECT page, coalesce(sum(size) FILTER (hit), 0) > 0.5 * sum(size) AS together,
    max(lpad(CAST(size AS VARCHAR), 12, '0') || substr(md5(line), 1, 16)) FILTER (hit) AS longest FROM m GROUP BY page),
w AS MATERIALIZED (SELECT p.source, p.page, CASE WHEN g.together THEN 'g' || substr(g.longest, 13) ELSE 'p' || p.page END AS vote FROM p LEFT JOIN g USING (page)),
t1 AS (SELECT source, count(DISTINCT vote) AS n FROM w GROUP BY source),
b AS MATERIALIZED (
  SELECT l.source, list(l.line) AS boiler
  FROM (SELECT m.source, m.line, count(DISTINCT w.vote) AS c FROM m JOIN w USING (page) WHERE m.hit GROUP BY m.source, m.line) l
  JOIN t1 ON l.source IS NOT DISTINCT FROM t1.source WHERE c > greatest(0.05 * n, 1.5 * sqrt(n)) GROUP BY l.source),
d AS (
  SELECT doc_id, d.source, text, string_split(coalesce(text, ''), chr(10)) AS every, coalesce(b.boiler, []) AS boiler
  FROM documents d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source),
s AS (SELECT *, list_filter(every, lambda x: trim(x, ' ') = '' OR NOT list_contains(boiler, trim(x, ' '))) AS stays FROM d),
r AS (SELECT *, len(every) - len(stays) AS lost, CASE WHEN text IS NULL OR len(every) = len(stays) THEN text ELSE array_to_string(stays, chr(10)) END AS cut FROM s)
SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(every) END AS BIGINT) AS n_lines, CAST(lost AS BIGINT) AS n_dropped,
  CAST(length(cut) AS BIGINT) AS n_chars_left, md5(coalesce(cut, '')) AS text_md5
FROM r
"""

OP4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN m ON m.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""


def _centroids(k: int = 40, rounds: int = 5) -> str:
    """Assignment and means of every round as tables of their own."""
    near = """SELECT v.row, v.vec_id, v.e, min_by(c.cluster, list_value(d, c.cluster)) AS cluster, min(d) AS distance
  FROM v, c{n} c, LATERAL (SELECT list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(v.e, c.e)])::BIGINT AS d)
  GROUP BY v.row, v.vec_id, v.e"""
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS cluster, e
  FROM v QUALIFY row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) <= {k})""",
    ]
    for n in range(rounds):
        parts.append(f"a{n} AS MATERIALIZED ({near.format(n=n)})")
        parts.append(f"""m{n} AS MATERIALIZED (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e
  FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(e) AS x, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY ALL) GROUP BY cluster)""")
        parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{n} c LEFT JOIN m{n} m USING (cluster))")
    parts.append(f"a AS MATERIALIZED ({near.format(n=rounds)})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a JOIN c{rounds} c USING (cluster)
"""


OP12 = _centroids()

OP11 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '<turn ', '<\turn '), '</turn>', '<\/turn>') AS shown,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, md5(text)) AS k FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn ' || role || '>') + 1 + length(shown) + length('</turn>') + 2) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP13 = rf"""
WITH d AS MATERIALIZED (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
    list_filter(regexp_extract_all(coalesce({LOWER}, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
t AS MATERIALIZED (SELECT lang, source, id, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY lang, source),
lt AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang),
ln AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term),
p AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(n.n, 0) + 5) // (coalesce(gt.total, 0) + 5 * v.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (ln.n + 5) // (lt.total + 5 * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) JOIN lt USING (lang) JOIN ln USING (lang, term)
  LEFT JOIN gt USING (lang, source) LEFT JOIN n USING (lang, source, term)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""
