"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '~')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS sz, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, ((SELECT sum(sz) FROM s) - 3 * coalesce(sum(sz) OVER (ORDER BY sz / w, w, sz ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY sz / w, w, sz ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam,
         row_number() OVER (ORDER BY sz / w, w, sz) AS k
  FROM s
), l AS (
  SELECT arg_min(lam, k) AS lam FROM f WHERE lam * w <= 3 * sz
), t AS (
  SELECT source, sz, least(3 * sz, lam * w) AS target, CASE WHEN sz > 0 THEN floor(least(3 * sz, lam * w) / sz) ELSE 0 END AS copies
  FROM s, l
), g AS (
  SELECT source, h, sum(size) AS gs FROM d GROUP BY source, h
), c AS (
  SELECT source, h, gs, sum(gs) OVER (PARTITION BY source ORDER BY h) AS upto FROM g
), x AS (
  SELECT c.source, c.h,
         CASE WHEN upto <= target - copies * sz THEN 1
              WHEN upto - gs <= target - copies * sz AND gs - (target - copies * sz - (upto - gs)) < target - copies * sz - (upto - gs) THEN 1
              ELSE 0 END AS more
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
)
SELECT d.doc_id, d.size, CAST(t.sz AS BIGINT) AS source_size, round(t.target, 6) AS target,
       CAST(d.size * (t.copies + x.more) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.h = x.h
"""

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
), n AS (
  SELECT a, count(*) AS n FROM e GROUP BY a
), c(node, label) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT e.b, c.label FROM c JOIN e ON c.node = e.a
), m AS (
  SELECT node, min(label) AS label FROM c GROUP BY node
)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.label AS component_id, vec_id = m.label AS kept
FROM embeddings JOIN m ON m.node = vec_id LEFT JOIN n ON n.a = vec_id
"""

OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM d
), x AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), c(node, label) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT e.b, c.label FROM c JOIN e ON c.node = e.a
), m AS (
  SELECT node, min(label) AS label FROM c GROUP BY node
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.label AS component_id, s.doc_id = m.label AS kept
FROM s JOIN m ON m.node = s.doc_id
"""

#: Bytes as pairs of hexadecimal digits; texts in chunks of 1,000 windows, so that cutting one out is cheap.
OP5 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS (
  SELECT doc_id, b, substr(h, 2 * b + 1, 2 * 1099) AS part FROM d, unnest(range(0, greatest(1, len(h) // 2), 1000)) AS u(b)
), w AS (
  SELECT doc_id, b + i AS pos, substr(part, 2 * i + 1, 200) AS w FROM c, unnest(range(0, least(1000, len(part) // 2 - 99))) AS u(i)
), f AS (
  SELECT w, min(struct_pack(doc := doc_id, pos := pos)) AS own FROM w GROUP BY w
), g AS (
  SELECT w.doc_id, w.pos FROM w JOIN f ON w.w = f.w WHERE f.own < struct_pack(doc := w.doc_id, pos := w.pos)
), o AS (
  SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 0 ELSE 1 END AS new FROM g
), r AS (
  SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM o
), s AS (
  SELECT doc_id, run, min(pos) AS lo, max(pos) + 100 AS hi FROM r GROUP BY doc_id, run
), t AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS prev FROM s
), p AS (
  SELECT t.doc_id, string_agg(substr(h, 2 * prev + 1, 2 * (lo - prev)), '' ORDER BY lo) AS head, max(hi) AS tail, sum(hi - lo) AS n_removed, count(*) AS n_spans
  FROM t JOIN d ON t.doc_id = d.doc_id GROUP BY t.doc_id
)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(head || substr(h, 2 * tail + 1), h))) AS kept_sha256
FROM d LEFT JOIN p ON d.doc_id = p.doc_id
"""

OP6 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM v q, v x WHERE q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

#: Lines of six words and more: variants by word and place, earliest line that shares one.
LINES_SQL = r"""
docs AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM {table}
), l AS (
  SELECT doc_id, no - 1 AS no, lines[no] AS line, list_filter(regexp_split_to_array(lines[no], '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM docs, unnest(range(1, len(lines) + 1)) AS u(no)
), o AS (
  SELECT line, any_value(w) AS w, min(struct_pack(doc := doc_id, no := no)) AS own FROM l WHERE len(w) >= 6 GROUP BY line
), v AS (
  SELECT line, own, i, array_to_string(w[:i] || w[i + 2:], ' ') AS v FROM o, unnest(range(0, len(w))) AS u(i)
  UNION ALL SELECT line, own, i, array_to_string(w, ' ') FROM o, unnest(range(0, len(w) + 1)) AS u(i)
), e AS (
  SELECT v, i, min(own) AS own FROM v GROUP BY v, i
), f AS (
  SELECT v.line, min(e.own) AS own FROM v JOIN e USING (v, i) GROUP BY v.line
), g AS (
  SELECT l.doc_id, l.no FROM l JOIN f USING (line) WHERE len(l.w) >= 6 AND f.own < struct_pack(doc := l.doc_id, no := l.no)
), k AS (
  SELECT doc_id, list(no) AS gone FROM g GROUP BY doc_id
), cut AS (
  SELECT docs.doc_id, docs.text, len(lines) AS n, coalesce(len(gone), 0) AS n_removed,
         array_to_string(list_filter(lines, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10)) AS kept
  FROM docs LEFT JOIN k USING (doc_id)
)"""

OP7 = f"""
WITH {LINES_SQL.format(table="documents")}
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE n END AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(kept) AS kept_sha256
FROM cut
"""

#: Levels of the models of ``urls``, from single characters to windows of six; a and r: accepted and rejected, 1 and 2:
#: the halves of the labelled URLs, 0: both.
_M = [x + h for x in "ar" for h in "012"]


def _level(k: int) -> str:
    n = {f"{x}{h}": f"sum({x}{h})" if h != "0" else f"sum({x}1) + sum({x}2)" for x in "ar" for h in "012"}
    smooth = lambda m: f"CASE WHEN N_{m} > 0 THEN (n_{m} + U_{m} * {'b.p_' + m if k else '(1.0::DOUBLE / letters)'}) / (N_{m} + U_{m}) ELSE {'b.p_' + m if k else '(1.0::DOUBLE / letters)'} END AS p_{m}"
    return f"""
, l{k} AS (
  SELECT right(w, {k + 1}) AS g, {", ".join(f"CAST({e} AS DOUBLE) AS n_{m}" for m, e in n.items())} FROM c GROUP BY 1
), h{k} AS (
  SELECT left(g, {k}) AS h, {", ".join(f"sum(n_{m}) AS nn_{m}, CAST(count(*) FILTER (n_{m} > 0) AS DOUBLE) AS U_{m}" for m in _M)} FROM l{k} GROUP BY 1
), p{k} AS (
  SELECT l.g, {", ".join(smooth(m).replace(f"N_{m}", f"nn_{m}") for m in _M)}
  FROM l{k} l JOIN h{k} h ON h.h = left(l.g, {k}) {f"JOIN p{k - 1} b ON b.g = right(l.g, {k})" if k else ", (SELECT greatest(1, count(DISTINCT right(w, 1))) AS letters FROM c)"}
)"""


OP13 = (
    r"""
WITH u AS (
  SELECT coalesce(url, '') AS url, count(*) AS n,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages GROUP BY coalesce(url, '')
), r(rule, rh, rp, rv) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), f AS (
  SELECT url, arg_max(rule, len(rule)) AS rule, arg_max(rv, len(rule)) AS v
  FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY url
), v AS (
  SELECT u.*, f.rule, f.v, CASE WHEN substr(md5(u.url), 1, 1) < '8' THEN 1 ELSE 2 END AS half FROM u LEFT JOIN f ON f.url = u.url
), w AS (
  SELECT url, n, v, half, substr(repeat(chr(2), 5) || url || chr(3), i, 6) AS w FROM v, unnest(range(1, len(url) + 2)) AS t(i)
), c AS (
  SELECT w, """
    + ", ".join(f"coalesce(sum(n) FILTER (v = '{v}' AND half = {h}), 0) AS {x}{h}" for x, v in (("a", "allow"), ("r", "block")) for h in (1, 2))
    + " FROM w GROUP BY w\n)"
    + "".join(_level(k) for k in range(6))
    + r"""
, s AS (
  SELECT g, """
    + ", ".join(f"CAST(round((ln(p_a{h}) - ln(p_r{h})) * 1048576) AS BIGINT) AS s{h}" for h in "012")
    + r""" FROM p5
), z AS (
  SELECT url, CAST(floor(CAST(sum(CASE WHEN v IS NULL THEN s0 WHEN half = 1 THEN s2 ELSE s1 END) AS DOUBLE) / (count(*) * 1024)) AS BIGINT) AS step
  FROM w JOIN s ON s.g = w.w GROUP BY url
), b AS (
  SELECT step, coalesce(sum(n) FILTER (v = 'allow'), 0) AS a, coalesce(sum(n) FILTER (v = 'block'), 0) AS r
  FROM v JOIN z ON z.url = v.url WHERE v IS NOT NULL GROUP BY step
), t AS (
  SELECT step, lag(step) OVER (ORDER BY step) AS before, sum(a) OVER () AS na, sum(r) OVER () AS nr,
         sum(a) OVER (ORDER BY step ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS kept,
         coalesce(sum(r) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
  FROM b
), k AS (
  SELECT coalesce((SELECT CASE WHEN before IS NULL THEN step ELSE floor((step + before + 1) / 2) END
                   FROM t WHERE na > 0 AND nr > 0 ORDER BY kept * nr + gone * na DESC, step LIMIT 1), 0) AS cut
)
SELECT p.page_id, v.host, v.path, v.rule, coalesce(v.v, CASE WHEN z.step >= (SELECT cut FROM k) THEN 'allow' ELSE 'block' END) AS verdict
FROM pages p JOIN v ON v.url = coalesce(p.url, '') JOIN z ON z.url = v.url
"""
)

OP11 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS (
  SELECT lang, w[i:i + k - 1] AS w, count(*) AS f
  FROM w, unnest([1, 2, 3, 4]) AS o(k), unnest(range(1, greatest(1, len(w) - k + 2))) AS t(i)
  GROUP BY ALL HAVING count(*) >= 30
), c AS (
  SELECT lang, w, f AS a FROM f WHERE len(w) > 1
), s AS (
  SELECT c.lang, c.w, c.a, k, l.f AS l, r.f AS r, CAST(2000000 * c.a::HUGEINT // (l.f + r.f) AS BIGINT) AS score
  FROM c, unnest(range(1, len(c.w))) AS t(k)
  JOIN f l ON l.lang = c.lang AND l.w = c.w[1:k] JOIN f r ON r.lang = c.lang AND r.w = c.w[k + 1:len(c.w)]
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), g AS (
  SELECT lang, w[i:i + k - 1] AS w, max(a) AS most
  FROM c, unnest([2, 3]) AS o(k), unnest(range(1, len(w) - k + 2)) AS t(i) WHERE k < len(w) GROUP BY ALL
)
SELECT b.lang, CAST(row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.w, ' ')) AS BIGINT) AS rank,
       array_to_string(b.w, ' ') AS phrase, a, l, r, n.n, score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN g ON g.lang = b.lang AND g.w = b.w
WHERE g.most IS NULL OR 100 * g.most < 80 * a
QUALIFY row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(b.w, ' ')) <= 2000
"""


ORACLE_SQL = {
    "op1_mix_sources": OP1,
    "op2_embedding_near_dedup": OP2,
    "op4_minhash_near_dedup": OP4,
    "op5_repeated_passages": OP5,
    "op6_voronoi_top_k": OP6,
    "op7_line_dedup": OP7,
    "op11_collocations": OP11,
    "op13_url_filter": OP13,
}
