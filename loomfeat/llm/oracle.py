"""DuckDB SQL for the operators' queries that SQL can express."""

ORACLES: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op3_decontaminate"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, iw.item_id FROM dw JOIN iw USING (n, p)),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
  coalesce(t.n_items, 0)::BIGINT AS n_items, sha256(coalesce(t.s, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

ORACLES["op4_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(rk % 3 + 1)::INT] AS wt FROM s),
f AS (SELECT *, 2.0::DOUBLE * ss AS bound, 2.0::DOUBLE * ss / wt AS fill, 1.5::DOUBLE * sum(ss) OVER () AS total FROM w),
l AS (
  SELECT *, (total - coalesce(sum(bound) OVER p, 0)) / (sum(wt) OVER () - coalesce(sum(wt) OVER p, 0)) AS lvl FROM f
  WINDOW p AS (ORDER BY fill, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, ss, least(bound, coalesce((SELECT max(lvl) FROM l WHERE lvl <= fill) * wt, bound)) AS target FROM l),
c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS st FROM d)
SELECT c.doc_id, c.size, t.ss AS source_size, t.target,
  (least(greatest(floor(t.target)::BIGINT - c.st, 0), c.size)
   + least(greatest(floor(t.target)::BIGINT - t.ss - c.st, 0), c.size))::BIGINT AS taken
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
"""

ORACLES["op7_jaccard"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.p = b.p AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * o.c >= 80 * (x.n + y.n - o.c)),
r AS (SELECT a AS doc_id, a AS c FROM (SELECT DISTINCT a FROM l) UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

ORACLES["op2_balltree"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

ORACLES["op13_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x,
    label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0
    AND len(list_filter(embedding, lambda y: y <> 0)) > 0 AS live FROM embeddings),
u AS (SELECT vec_id, label, x, sqrt(list_sum(list_transform(x, lambda y: y * y))) AS n FROM v WHERE live),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.98),
r AS (SELECT a AS vec_id, a AS c FROM (SELECT DISTINCT a FROM l) UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id),
k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, coalesce(m.c, v.vec_id) AS component_id, v.vec_id = coalesce(m.c, v.vec_id) AS kept
FROM v LEFT JOIN k USING (vec_id) LEFT JOIN m USING (vec_id)
"""

_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLES["op12_prefix_trie"] = f"""
WITH o AS (
  SELECT conv_id AS c, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(t ORDER BY p) AS w FROM o GROUP BY c),
h AS (SELECT c, w, c - c % 100 AS base, {_CRC32.format('(c::VARCHAR)')} % 6 AS h FROM l),
b AS (SELECT h.c, list_concat(coalesce(l.w[1:h.h], []), h.w[h.h + 1:]) AS w FROM h LEFT JOIN l ON l.c = h.base),
f AS (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM b),
n AS (
  SELECT d, w[1:d] AS k, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(w) = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM f GROUP BY 1, 2),
p AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS m FROM n WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT n.*, coalesce(p.m, 0) AS m, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(k[d].x) END AS saved FROM n LEFT JOIN p USING (d, k)),
a AS (SELECT a AS d, k[1:a] AS k, sum((m = 0)::INT) AS leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM v) GROUP BY 1, 2)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.m AS n_children, a.leaves::BIGINT AS n_leaves,
  a.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN a USING (d, k) LEFT JOIN n u ON u.d = v.d - 1 AND u.k = v.k[1:v.d - 1]
"""
