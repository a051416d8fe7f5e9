"""Queries of dispositions, tiered look-ups, totals, ledgers, appends and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import audit, cluster, ledger, remap
from attesta.operators.ordinal import ordinal
from attesta.operators.records import by_priority
from attesta.plans import textual
from attesta.plans.roles import lines, table
from attesta.plans.textual import LINES, sql_coding, sql_match, sql_norm
from attesta.sources import sinks
from attesta.streaming import incremental

QUERIES, ORACLE_SQL = {}, {}


def query(name, sql=None):
    return textual.query(name, sql, (QUERIES, ORACLE_SQL))


CODED = f"""i AS (SELECT doc_id * 1000000 + pos AS row_id, {sql_coding('line')} AS key FROM ({LINES})),
it AS (SELECT * FROM i WHERE key <> ''),
coded AS (SELECT {sql_coding('text')} AS key, arg_min(CASE WHEN turn % 3 = 0 THEN '' ELSE role END, conv_id * 1000 + turn) AS code FROM conversations WHERE {sql_coding('text')} <> '' GROUP BY 1
  UNION ALL SELECT key, min(lang) FROM (SELECT lang, {sql_coding("string_split(text, chr(10))[1]")} AS key, doc_id FROM documents) WHERE key NOT IN (SELECT {sql_coding('text')} FROM conversations) AND key <> '' GROUP BY key)"""


def _coded(spark, d):
    turns = table(spark, d, "conversations").select("text", F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("role")).alias("role"), (F.col("conv_id") * 1000 + F.col("turn")).alias("o"))
    a = remap.first_wins(turns, T.coding_norm("text"), "role", "o")
    b = table(spark, d, "documents").select(T.coding_norm(F.substring_index("text", "\n", 1)).alias("key"), "lang").where("key <> ''").groupBy("key").agg(F.min("lang").alias("code"))
    return a.unionByName(b.join(a, "key", "left_anti"))


def _items(spark, d):
    return lines(spark, d).select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("row_id"), T.coding_norm("line").alias("key")).where("key <> ''")


DISPOSED = f"""{CODED},
j AS (SELECT it.row_id, it.key, coded.key IS NOT NULL AS held, code FROM it LEFT JOIN coded ON coded.key = it.key),
p AS (SELECT *, min(row_id) OVER (PARTITION BY key, held) AS first FROM j),
dsp AS (SELECT row_id, key, CASE WHEN held THEN 'already_coded' WHEN row_id = first THEN 'new' ELSE 'internal_dup' END AS disposition, CASE WHEN held THEN code END AS inherit_final_coding,
  CASE WHEN NOT held AND row_id <> first THEN first END AS maps_to_row_id FROM p)"""


@query("disposition", f"WITH {DISPOSED} SELECT * REPLACE (coalesce(maps_to_row_id, -1) AS maps_to_row_id) FROM dsp")
def _(spark, d):
    return remap.disposition(_items(spark, d), _coded(spark, d)).na.fill(-1, ["maps_to_row_id"])


@query("disposition_counts", f"WITH {DISPOSED} SELECT disposition, count(*) AS n FROM dsp GROUP BY disposition")
def _(spark, d):
    return remap.disposition(_items(spark, d), _coded(spark, d)).groupBy("disposition").agg(F.count("*").alias("n"))


@query("coding_list", f"WITH {DISPOSED} SELECT row_id, key, '' AS final_coding FROM dsp WHERE disposition = 'new'")
def _(spark, d):
    new = remap.disposition(_items(spark, d), _coded(spark, d)).where("disposition = 'new'")
    return new.select("row_id", "key", F.lit("").alias("final_coding"))


T1, T2 = sql_match("line"), f"regexp_replace({sql_match('line')}, '[^a-z0-9]', '', 'g')"
FIRST = "string_split(text, chr(10))[1]"


@query("tiered_remap", f"""
WITH i AS (SELECT doc_id * 1000000 + pos AS row_id, {T1} AS t1, {T2} AS t2 FROM ({LINES})),
n1 AS (SELECT {sql_match(FIRST)} AS k, arg_min(lang, doc_id) AS code FROM documents WHERE doc_id % 3 <> 0 GROUP BY 1),
n2 AS (SELECT regexp_replace({sql_match(FIRST)}, '[^a-z0-9]', '', 'g') AS k, arg_min(lang, doc_id) AS code FROM documents WHERE doc_id % 3 <> 0 GROUP BY 1),
p1 AS (SELECT {sql_match(FIRST)} AS k, arg_min(source, doc_id) AS code FROM documents GROUP BY 1),
p2 AS (SELECT regexp_replace({sql_match(FIRST)}, '[^a-z0-9]', '', 'g') AS k, arg_min(source, doc_id) AS code FROM documents GROUP BY 1)
SELECT row_id, coalesce(n1.code, n2.code, p1.code, p2.code) AS code, CAST(CASE WHEN n1.code IS NOT NULL THEN 1 WHEN n2.code IS NOT NULL THEN 2 WHEN p1.code IS NOT NULL THEN 3 WHEN p2.code IS NOT NULL THEN 4 ELSE 0 END AS INTEGER) AS tier
FROM i LEFT JOIN n1 ON t1 <> '' AND n1.k = t1 LEFT JOIN n2 ON t2 <> '' AND n2.k = t2 LEFT JOIN p1 ON t1 <> '' AND p1.k = t1 LEFT JOIN p2 ON t2 <> '' AND p2.k = t2""")
def _(spark, d):
    items = lines(spark, d).select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("row_id"), T.match_norm("line").alias("t1"), T.match_aggressive("line").alias("t2"))
    docs = table(spark, d, "documents").withColumn("first", F.substring_index("text", "\n", 1))
    new = docs.where(F.col("doc_id") % 3 != 0)
    known = [
        remap.first_wins(new, T.match_norm("first"), "lang", "doc_id"), remap.first_wins(new, T.match_aggressive("first"), "lang", "doc_id"),
        remap.first_wins(docs, T.match_norm("first"), "source", "doc_id"), remap.first_wins(docs, T.match_aggressive("first"), "source", "doc_id"),
    ]
    return remap.tiered(items, known, ["t1", "t2", "t1", "t2"]).na.fill(0, ["tier"]).select("row_id", "code", "tier")


@query("twin_codes", f"""WITH {DISPOSED},
c AS (SELECT *, CASE WHEN disposition = 'new' AND row_id % 3 <> 0 THEN substr(md5(key), 1, 2) ELSE coalesce(inherit_final_coding, '') END AS code FROM dsp)
SELECT c.row_id, coalesce(nullif(t.code, ''), c.code) AS code FROM c LEFT JOIN c t ON t.row_id = c.maps_to_row_id""")
def _(spark, d):
    rows = remap.disposition(_items(spark, d), _coded(spark, d))
    own = F.when((F.col("disposition") == "new") & (F.col("row_id") % 3 != 0), F.substring(F.md5("key"), 1, 2)).otherwise(F.coalesce("inherit_final_coding", F.lit("")))
    return remap.through_twin(rows.withColumn("code", own)).select("row_id", "code")


PHASES = """x AS (SELECT 'phase1' AS phase, source || '/' || lang || doc_id % 50 || '.PDF' AS f, CAST(doc_id % 9 AS VARCHAR) || ' ' || lang AS s, n_chars > 600 AS h FROM documents WHERE doc_id % 3 <> 1
  UNION ALL SELECT 'phase2', lang || doc_id % 50 || '.pdf', upper(CAST(doc_id % 9 AS VARCHAR) || '-' || lang), n_chars > 900 FROM documents WHERE doc_id % 3 <> 2),
n AS (SELECT phase, lower(trim(string_split(f, '/')[-1])) AS f, trim(regexp_replace(lower(s), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS s, h FROM x)"""


@query("totals", f"""WITH {PHASES},
a AS (SELECT phase AS scope, f, max(h) AS h, count_if(h) AS i FROM n GROUP BY ALL), b AS (SELECT 'combined' AS scope, f, max(h) AS h, sum(i) AS i FROM a GROUP BY f),
c AS (SELECT phase AS scope, f, s, max(h) AS h FROM n GROUP BY ALL), e AS (SELECT 'combined' AS scope, f, s, max(h) AS h FROM c GROUP BY f, s),
y AS (SELECT scope, count(*) AS files, CAST(count_if(h) AS BIGINT) AS files_with_items, CAST(count_if(NOT h) AS BIGINT) AS files_without_items, CAST(sum(i) AS BIGINT) AS items FROM (FROM a UNION ALL FROM b) GROUP BY scope),
z AS (SELECT scope, CAST(count_if(h) AS BIGINT) AS scales_with_items, count(*) AS scales FROM (FROM c UNION ALL FROM e) GROUP BY scope)
SELECT * FROM y JOIN z USING (scope)""")
def _(spark, d):
    docs = table(spark, d, "documents")
    k = (F.col("doc_id") % 50).cast("string")
    nine = (F.col("doc_id") % 9).cast("string")
    one = docs.where(F.col("doc_id") % 3 != 1).select(F.lit("phase1").alias("phase"), F.concat("source", F.lit("/"), "lang", k, F.lit(".PDF")).alias("filename"), F.concat(nine, F.lit(" "), "lang").alias("scale_name"), (F.col("n_chars") > 600).alias("has_item"))
    two = docs.where(F.col("doc_id") % 3 != 2).select(F.lit("phase2").alias("phase"), F.concat("lang", k, F.lit(".pdf")).alias("filename"), F.upper(F.concat(nine, F.lit("-"), "lang")).alias("scale_name"), (F.col("n_chars") > 900).alias("has_item"))
    return ledger.database_totals(one.unionByName(two))


@query("cost_ledger", """
WITH u AS (SELECT o_orderstatus AS stage, CASE WHEN o_orderkey % 10 = 3 THEN 'failed' ELSE 'ok' END AS status, o_custkey AS i, o_orderkey % 977 AS o FROM orders),
c AS (SELECT *, round(i * 0.015 + o * 0.125) AS cost FROM u)
SELECT coalesce(stage, 'TOTAL') AS stage, CAST(count_if(status = 'ok') AS BIGINT) AS papers, CAST(sum(CASE WHEN status = 'ok' THEN i ELSE 0 END) AS BIGINT) AS in_tok, CAST(sum(CASE WHEN status = 'ok' THEN o ELSE 0 END) AS BIGINT) AS out_tok,
  round(sum(CASE WHEN status = 'ok' THEN cost ELSE 0 END), 4) AS ok_cost, round(sum(cost), 4) AS all_cost, round(sum(CASE WHEN status = 'ok' THEN cost ELSE 0 END) * 200 / count_if(status = 'ok'), 4) AS projected
FROM c GROUP BY ROLLUP (stage)""")
def _(spark, d):
    u = table(spark, d, "orders").select(F.col("o_orderstatus").alias("stage"), F.when(F.col("o_orderkey") % 10 == 3, "failed").otherwise("ok").alias("status"), F.col("o_custkey").cast("string").alias("in_tok"), (F.col("o_orderkey") % 977).cast("string").alias("out_tok"))
    # in units of 0.00001 dollars, so that sums are exact in any order
    u = u.withColumn("cost_usd", F.round(F.col("in_tok").cast("long") * F.lit(0.015) + F.col("out_tok").cast("long") * F.lit(0.125)))
    out = ledger.cost_ledger(u, projected_to=200)
    return out.select("stage", "papers", "in_tok", "out_tok", *[F.round(c, 4).alias(c) for c in ("ok_cost", "all_cost", "projected")])


@query("judge_fraction", """
WITH u AS (SELECT o_orderpriority AS coder, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT (SELECT count(*) FROM orders WHERE o_totalprice > 400000) AS disputes, max(n) AS most, round((SELECT count(*) FROM orders WHERE o_totalprice > 400000) / max(n), 6) AS fraction FROM u""")
def _(spark, d):
    o = table(spark, d, "orders")
    usage = o.select(F.col("o_orderpriority").alias("coder"), F.when(F.col("o_orderstatus") != "P", "ok").otherwise("failed").alias("status"))
    out = ledger.judge_fraction(o.where("o_totalprice > 400000").select("o_orderkey"), usage)
    return out.withColumn("fraction", F.round("fraction", 6))


@query("source_agreement", """
SELECT l_returnflag AS src, count(*) AS papers, round(avg(CASE WHEN l_linenumber <> 4 THEN CASE WHEN abs(l_discount - l_tax) <= 0.02 AND l_linenumber <> 5 THEN 1.0 ELSE 0.0 END END), 6) AS rate_agrees,
  round(avg(CASE WHEN abs(l_quantity - l_linenumber) <= 10 THEN 1.0 ELSE 0.0 END), 6) AS size_agrees FROM lineitem GROUP BY 1""")
def _(spark, d):
    n = F.col("l_linenumber")
    p = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("src"), F.when(n != 4, F.col("l_discount")).alias("final_rate"), F.when(n != 5, F.col("l_tax")).alias("rate"), F.col("l_quantity").alias("final_size"), n.cast("double").alias("size"))
    out = ledger.source_agreement(p, "src", {"rate": 0.02, "size": 10.0})
    return out.select("src", "papers", F.round("rate_agrees", 6).alias("rate_agrees"), F.round("size_agrees", 6).alias("size_agrees"))


@query("priority_merge", """
SELECT o_orderkey AS paper_id, CASE WHEN o_totalprice > 300000 THEN 'adjudicated' WHEN o_orderstatus = 'O' THEN 'auto_agreement' ELSE 'coder_only_unresolved' END AS provenance FROM orders""")
def _(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("paper_id"), "o_totalprice", "o_orderstatus")
    one = lambda df, p: df.select("paper_id", F.lit(p).alias("provenance"))
    return by_priority(one(o.where("o_totalprice > 300000"), "adjudicated"), one(o.where("o_orderstatus = 'O'"), "auto_agreement"), one(o, "coder_only_unresolved"))


@query("append_new", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 250000)""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sinks.new_only(o.where("o_orderstatus = 'P'"), o.where("o_totalprice > 250000").select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("upsert_ledger", """
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders WHERE o_orderstatus <> 'P'),
n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders WHERE o_totalprice > 250000)
SELECT o_orderkey, CASE WHEN n.pos IS NOT NULL THEN 'done' ELSE o_orderstatus END AS status, coalesce(o.pos, (SELECT max(pos) FROM o) + 1 + n.pos) AS pos
FROM orders LEFT JOIN o USING (o_orderkey) LEFT JOIN n USING (o_orderkey) WHERE o.pos IS NOT NULL OR n.pos IS NOT NULL""")
def _(spark, d):
    o = table(spark, d, "orders")
    placed = lambda df: ordinal(df, ["o_orderkey"], "pos")
    old = placed(o.where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_orderstatus").alias("status")))
    return sinks.upserted(old, placed(o.where("o_totalprice > 250000").select("o_orderkey", F.lit("done").alias("status"))), "o_orderkey", "pos")


@query("retry_queue", """
SELECT o_orderkey AS paper_id FROM orders WHERE o_orderstatus <> 'F' AND o_custkey % 4 < 2""")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("paper_id", F.col("o_orderkey"))
    before = o.select("paper_id", F.greatest(F.col("o_custkey") % 4 - 1, F.lit(0)).alias("attempts"))
    after = incremental.attempts_after(before, o.where(F.col("o_custkey") % 4 > 0))
    return incremental.to_do(o.select("paper_id"), o.where("o_orderstatus = 'F'"), after)


@query("audit", """
WITH e AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1), a AS (SELECT o_orderkey AS k, o_custkey % 7 + 1 AS n FROM orders WHERE o_orderstatus <> 'P')
SELECT coalesce(e.k, a.k) AS k, CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'orphan' ELSE 'count' END AS problem, coalesce(e.n, -1) AS expected_n, coalesce(a.n, -1) AS actual_n FROM e FULL JOIN a ON e.k = a.k WHERE e.n IS DISTINCT FROM a.n""")
def _(spark, d):
    e = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    a = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 7 + 1).alias("n"))
    return audit.reconcile(e, a, "k", ["n"]).na.fill(-1, ["expected_n", "actual_n"])


@query("audit_overlap", "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'")
def _(spark, d):
    o = table(spark, d, "orders")
    return audit.in_both(o.where("o_totalprice > 300000"), o.where("o_orderstatus = 'O'"), "o_orderkey")


STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
TOKENS = f"list_filter(list_distinct(string_split(replace({{}}, '-', ' '), ' ')), lambda w: w <> '' AND NOT list_contains([{STOP}], w))"


@query("fuzzy_pairs", f"""
WITH a AS (SELECT doc_id % 97 AS g, doc_id AS id, {sql_norm(FIRST)} AS key FROM documents WHERE lang <> 'fr'), b AS (SELECT doc_id % 97 AS g, doc_id AS id, {sql_norm(FIRST)} AS key FROM documents WHERE lang <> 'de'),
x AS (SELECT *, {TOKENS.format('key')} AS t FROM a), y AS (SELECT *, {TOKENS.format('key')} AS t FROM b),
p AS (SELECT x.g, x.id AS id_a, y.id AS id_b, CASE WHEN x.key = y.key THEN 1.0 ELSE len(list_intersect(x.t, y.t)) / least(len(x.t), len(y.t)) END AS s, CASE WHEN x.key = y.key THEN 0 ELSE 1 END AS kind
  FROM x JOIN y ON x.g = y.g WHERE x.key = y.key OR len(list_intersect(x.t, y.t)) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY g, id_a ORDER BY kind, s DESC, id_b) AS n FROM p WHERE kind = 0 OR s >= 0.6)
SELECT g, id_a, id_b, round(CAST(s AS DOUBLE), 6) AS similarity FROM r WHERE n = 1""")
def _(spark, d):
    docs = table(spark, d, "documents").withColumn("name", F.substring_index("text", "\n", 1))
    one = lambda lang: docs.where(F.col("lang") != lang).select((F.col("doc_id") % 97).alias("g"), F.col("doc_id").alias("id"), T.evidence_norm("name").alias("key"), T.name_tokens("name").alias("tokens"))
    return cluster.fuzzy_pairs(one("fr"), one("de"), "g").withColumn("similarity", F.round("similarity", 6))


@query("resolve_clusters", f"""
WITH RECURSIVE s AS (SELECT *, CASE WHEN key = '' THEN [] ELSE {TOKENS.format('key')} END AS t, row_number() OVER (PARTITION BY paper_id ORDER BY ord) AS i
  FROM (SELECT CAST(doc_id % 97 AS VARCHAR) AS paper_id, doc_id AS ord, lang, CASE WHEN doc_id % 5 = 0 THEN '' ELSE {sql_norm(FIRST)} END AS key FROM documents)),
r(paper_id, i, heads, spot) AS (
  SELECT DISTINCT paper_id, CAST(0 AS BIGINT), CAST([] AS STRUCT(k VARCHAR, t VARCHAR[])[]), CAST(0 AS BIGINT) FROM s
  UNION ALL
  SELECT x.paper_id, x.i, CASE WHEN hit IS NULL THEN list_append(heads, struct_pack(k := key, t := t)) ELSE heads END, coalesce(hit - 1, len(heads))
  FROM (SELECT s.*, r.heads,
      coalesce(CASE WHEN key <> '' THEN nullif(coalesce(list_position(list_transform(heads, lambda h: h.k), key), 0), 0) END,
        nullif(coalesce(list_position(list_transform(heads, lambda h: len(h.t) > 0 AND len(s.t) > 0 AND len(list_intersect(h.t, s.t)) >= 0.6 * least(len(h.t), len(s.t))), true), 0), 0)) AS hit
    FROM r JOIN s ON s.paper_id = r.paper_id AND s.i = r.i + 1) x),
p AS (SELECT s.*, r.spot AS cluster FROM s JOIN r USING (paper_id, i)),
l AS (SELECT CAST(doc_id % 97 AS VARCHAR) AS paper_id, doc_id AS ord, {sql_norm('line')} AS k FROM ({LINES})),
n AS (SELECT p.paper_id, cluster, count(DISTINCT k) AS n_items FROM l JOIN p USING (paper_id, ord) WHERE k <> '' GROUP BY ALL),
b AS (SELECT paper_id, cluster, arg_min(key, struct_pack(a := -len(t), b := ord)) AS base FROM p GROUP BY ALL),
u AS (SELECT paper_id, cluster, lang, min(ord) AS ord FROM p GROUP BY ALL),
g AS (SELECT paper_id, cluster, string_agg(lang, '; ' ORDER BY ord) AS subscales FROM u GROUP BY ALL)
SELECT paper_id, cluster, base, coalesce(subscales, '') AS subscales, CAST(coalesce(n_items, 0) AS INTEGER) AS n_items FROM b LEFT JOIN g USING (paper_id, cluster) LEFT JOIN n USING (paper_id, cluster)""")
def _(spark, d):
    docs = table(spark, d, "documents").withColumn("name", F.substring_index("text", "\n", 1))
    name = F.when(F.col("doc_id") % 5 == 0, "").otherwise(T.evidence_norm("name"))  # every fifth scale has no name
    named = docs.select((F.col("doc_id") % 97).cast("string").alias("paper_id"), F.col("doc_id").alias("ord"), name.alias("key"), "lang")
    scales = named.select("paper_id", "ord", "key", T.key_tokens("key").alias("tokens"), F.col("lang").alias("subscales"), F.lit(True).alias("attested"))
    items = lines(spark, d).select((F.col("doc_id") % 97).cast("string").alias("paper_id"), F.col("doc_id").alias("ord"), F.col("pos").alias("item"), T.evidence_norm("line").alias("key")).where("key <> ''")
    items = items.withColumn("key", F.unhex(F.md5("key")))  # digests stand for lines, which are only counted
    out = cluster.merged(items, cluster.clustered(scales))
    return out.select("paper_id", "cluster", "base", "subscales", F.coalesce(F.size("items"), F.lit(0)).alias("n_items"))
