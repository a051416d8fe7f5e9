"""Queries of evidence checks and agreement statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import agreement as A
from attesta.functions import text as T
from attesta.operators import evidence
from attesta.operators.ordinal import kept
from attesta.plans import textual
from attesta.plans.roles import coder, coders, lines, sources, table, texts
from attesta.plans.textual import LINES, sql_coding, sql_norm

QUERIES, ORACLE_SQL = {}, {}


def query(name, sql=None):
    return textual.query(name, sql, (QUERIES, ORACLE_SQL))


CODERS = f"""
l AS ({LINES}),
made AS (SELECT d.doc_id - 1 AS doc_id, string_split(d.text, chr(10))[1] AS line FROM documents d WHERE d.doc_id - 1 IN (SELECT doc_id FROM documents)),
a AS (SELECT doc_id, pos, line FROM l WHERE pos % 4 <> 1 UNION ALL SELECT doc_id, 1000001, line FROM made),
b AS (SELECT doc_id, pos, line FROM l WHERE pos % 4 <> 2 UNION ALL SELECT doc_id, 1000002, line FROM made),
src AS (SELECT doc_id, {sql_norm('text')} AS s FROM documents),
ka AS (SELECT DISTINCT doc_id, {sql_norm('line')} AS k FROM a),
kb AS (SELECT DISTINCT doc_id, {sql_norm('line')} AS k FROM b),
va AS (SELECT ka.* FROM ka JOIN src USING (doc_id) WHERE k <> '' AND contains(s, k)),
vb AS (SELECT kb.* FROM kb JOIN src USING (doc_id) WHERE k <> '' AND contains(s, k)),
u AS (SELECT doc_id, k, max(x) AS x, max(y) AS y FROM (SELECT doc_id, k, 1 AS x, 0 AS y FROM va UNION ALL SELECT doc_id, k, 0, 1 FROM vb) GROUP BY doc_id, k),
o AS (SELECT doc_id, sum(x) AS n_a, sum(y) AS n_b, sum(x * y) AS n_both, count(*) AS n_all FROM u GROUP BY doc_id)"""


def _verified(spark, d):
    """Both coders' verified keys (doc_id, key, in_a, in_b)."""
    tagged = coders(spark, d).select("doc_id", T.evidence_norm("line").alias("key"), "in_a", "in_b")
    return evidence.verified_keys(tagged, sources(spark, d), "doc_id", "key")


def _overlap(spark, d):
    return evidence.coder_overlap(_verified(spark, d), "doc_id")


@query("verify_items", f"WITH {CODERS} SELECT 'a' AS coder, doc_id, k AS key FROM va UNION ALL SELECT 'b', doc_id, k FROM vb")
def _(spark, d):
    who = F.array_compact(F.array(F.when(F.col("in_a"), "a"), F.when(F.col("in_b"), "b")))
    return _verified(spark, d).select(F.explode(who).alias("coder"), "doc_id", "key")


@query("jaccard_per_doc", f"WITH {CODERS} SELECT doc_id, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, CAST(n_both AS BIGINT) AS n_both, n_all, round(n_both / n_all, 6) AS jaccard FROM o")
def _(spark, d):
    return _overlap(spark, d).withColumn("jaccard", F.round("jaccard", 6))


@query("pooled_overlap", f"""WITH {CODERS}
SELECT round(sum(n_both) / sum(n_all), 6) AS overlap, round(sum(n_a) / sum(n_all), 6) AS recall_a, round(sum(n_b) / sum(n_all), 6) AS recall_b,
  round(avg(n_both / n_all), 6) AS mean_jaccard, round(avg(CASE WHEN n_both / n_all >= 0.9 THEN 1.0 ELSE 0.0 END), 6) AS share_at_90 FROM o""")
def _(spark, d):
    p = evidence.pooled(_overlap(spark, d))
    return p.select(*[F.round(c, 6).alias(c) for c in p.columns])


@query("fabricated_counts", f"""WITH {CODERS},
n AS (SELECT doc_id, sum(r) AS raw FROM (SELECT doc_id, count(*) AS r FROM a GROUP BY doc_id UNION ALL SELECT doc_id, count(*) FROM b GROUP BY doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(raw - coalesce(n_a, 0) - coalesce(n_b, 0) AS BIGINT) AS fabricated FROM n LEFT JOIN o USING (doc_id)""")
def _(spark, d):
    raw = coder(spark, d, "a").select("doc_id").unionByName(coder(spark, d, "b").select("doc_id")).groupBy("doc_id").agg(F.count("*").alias("raw"))
    met = raw.join(_overlap(spark, d), "doc_id", "left").na.fill(0, ["n_a", "n_b"])
    return met.select("doc_id", (F.col("raw") - F.col("n_a") - F.col("n_b")).alias("fabricated"))


@query("benchmark_evidence", f"""
SELECT item_id, doc_id FROM (SELECT item_id, {sql_coding('text')} AS k FROM benchmark), (SELECT doc_id, {sql_coding('text')} AS s FROM documents) WHERE k <> '' AND contains(s, k)""")
def _(spark, d):
    needles = table(spark, d, "benchmark").select("item_id", T.coding_norm("text").alias("k"))
    return evidence.evidence_pairs(needles, "k", texts(spark, d).select("doc_id", T.coding_norm("text").alias("s")), "s").select("item_id", "doc_id")


_NAMES = f"""src AS (SELECT doc_id, source, lang, {sql_norm('text')} AS s FROM documents),
nx AS (SELECT doc_id - 1 AS doc_id, {sql_norm("string_split(text, chr(10))[1]")} AS k FROM documents)"""


@query("scale_attested", f"""WITH {_NAMES}
SELECT doc_id, (length(lang) >= 3 AND contains(s, lang)) OR (length(k) >= 3 AND contains(s, k)) AS attested FROM src JOIN nx USING (doc_id)""")
def _(spark, d):
    src = table(spark, d, "documents").select("doc_id", "lang", T.evidence_norm("text").alias("s"))
    nx = table(spark, d, "documents").select((F.col("doc_id") - 1).alias("doc_id"), F.substring_index("text", "\n", 1).alias("name"))
    return src.join(nx, "doc_id").select("doc_id", evidence.attested(F.col("s"), F.col("lang"), F.col("name")).alias("attested"))


@query("kappa_pabak", """
WITH c AS (SELECT CAST(quality AS VARCHAR) AS x, CAST(toxic AS VARCHAR) AS y, count(*) AS n FROM labels GROUP BY 1, 2),
t AS (SELECT sum(n) AS n, sum(CASE WHEN x = y THEN n ELSE 0 END) / sum(n) AS po FROM c),
m AS (SELECT k, sum(na) AS na, sum(nb) AS nb FROM (SELECT x AS k, n AS na, 0 AS nb FROM c UNION ALL SELECT y, 0, n FROM c) GROUP BY k),
e AS (SELECT sum(na * nb) AS bth, count(*) AS q FROM m)
SELECT CAST(n AS BIGINT) AS n, q AS categories, round(po, 6) AS agreement, round((po - bth / (n * n)) / nullif(1 - bth / (n * n), 0), 6) AS kappa,
  round(CASE WHEN q <= 1 THEN 1.0 ELSE (q * po - 1) / (q - 1) END, 6) AS pabak,
  CASE WHEN (po - bth / (n * n)) / (1 - bth / (n * n)) >= 0.81 THEN 'almost perfect' WHEN (po - bth / (n * n)) / (1 - bth / (n * n)) >= 0.61 THEN 'substantial'
    WHEN (po - bth / (n * n)) / (1 - bth / (n * n)) >= 0.41 THEN 'moderate' WHEN (po - bth / (n * n)) / (1 - bth / (n * n)) >= 0.21 THEN 'fair'
    WHEN (po - bth / (n * n)) / (1 - bth / (n * n)) >= 0 THEN 'slight' ELSE 'poor' END AS band FROM t, e""")
def _(spark, d):
    k = A.categorical(table(spark, d, "labels"), "quality", "toxic")
    return k.select("n", "categories", *[F.round(c, 6).alias(c) for c in ("agreement", "kappa", "pabak")], "band")


@query("kappa_by_flag", """
WITH p AS (SELECT l_returnflag AS f, l_linestatus AS x, CASE WHEN l_quantity > 25 THEN 'O' ELSE 'F' END AS y FROM lineitem),
c AS (SELECT f, x, y, count(*) AS n FROM p GROUP BY ALL), t AS (SELECT f, sum(n) AS n, sum(CASE WHEN x = y THEN n ELSE 0 END) / sum(n) AS po FROM c GROUP BY f),
m AS (SELECT f, k, sum(na) AS na, sum(nb) AS nb FROM (SELECT f, x AS k, n AS na, 0 AS nb FROM c UNION ALL SELECT f, y, 0, n FROM c) GROUP BY f, k),
e AS (SELECT f, sum(na * nb) AS bth, count(*) AS q FROM m GROUP BY f)
SELECT f AS l_returnflag, CAST(n AS BIGINT) AS n, round(po, 6) AS agreement, round((po - bth / (n * n)) / nullif(1 - bth / (n * n), 0), 6) AS kappa, round(CASE WHEN q <= 1 THEN 1.0 ELSE (q * po - 1) / (q - 1) END, 6) AS pabak
FROM t JOIN e USING (f)""")
def _(spark, d):
    p = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.when(F.col("l_quantity") > 25, "O").otherwise("F").alias("y"))
    k = A.categorical(p, "l_linestatus", "y", by=["l_returnflag"])
    return k.select("l_returnflag", "n", *[F.round(c, 6).alias(c) for c in ("agreement", "kappa", "pabak")])


@query("icc_continuous", """
WITH p AS (SELECT l_returnflag AS f, l_discount AS x, l_tax AS y FROM lineitem),
g AS (SELECT f, avg((x + y) / 2) AS g, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM p GROUP BY f),
s AS (SELECT p.f, any_value(n) AS n, sum(2 * pow((x + y) / 2 - g, 2)) AS ssr, any_value(n) * (pow(any_value(mx) - any_value(g), 2) + pow(any_value(my) - any_value(g), 2)) AS ssc,
  sum(pow(x - (x + y) / 2 - mx + g, 2) + pow(y - (x + y) / 2 - my + g, 2)) AS sse FROM p JOIN g ON p.f = g.f GROUP BY p.f)
SELECT f AS l_returnflag, n, round((ssr / (n - 1) - sse / (n - 1)) / (ssr / (n - 1) + sse / (n - 1) + 2 * (ssc - sse / (n - 1)) / n), 6) AS icc FROM s""")
def _(spark, d):
    x, y = F.col("l_discount"), F.col("l_tax")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(A.icc(x, y), 6).alias("icc"))


@query("pearson_mad", """
SELECT l_returnflag, round(corr(l_discount, l_tax), 6) AS pearson, round(avg(abs(l_discount - l_tax)), 6) AS mad,
  round(sum(CASE WHEN abs(l_discount - l_tax) <= 0.025 THEN 1.0 ELSE 0.0 END) / count(*), 6) AS within FROM lineitem GROUP BY l_returnflag""")
def _(spark, d):
    x, y = F.col("l_discount"), F.col("l_tax")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(A.pearson(x, y), 6).alias("pearson"), F.round(A.mean_absolute(x, y), 6).alias("mad"), F.round(A.within(x, y, 0.025), 6).alias("within"))


@query("dup_in_scale", f"""
SELECT doc_id, key, count(*) - 1 AS surplus FROM (SELECT doc_id, {sql_norm('line')} AS key FROM ({LINES})) WHERE key <> '' GROUP BY doc_id, key HAVING count(*) > 1""")
def _(spark, d):
    from attesta.operators import audit

    return audit.duplicates_within(lines(spark, d).select("doc_id", T.evidence_norm("line").alias("key")), ["doc_id"], "key")


@query("scale_count_diff", f"""WITH {CODERS}, x AS (SELECT doc_id, length(line) % 3 AS s, count(*) AS n FROM a GROUP BY ALL), y AS (SELECT doc_id, length(line) % 3 AS s, count(*) AS n FROM b GROUP BY ALL)
SELECT coalesce(x.doc_id, y.doc_id) AS doc_id, CAST(coalesce(x.s, y.s) AS BIGINT) AS scale, coalesce(x.n, 0) AS n_a, coalesce(y.n, 0) AS n_b, coalesce(x.n, 0) <> coalesce(y.n, 0) AS differs FROM x FULL JOIN y ON x.doc_id = y.doc_id AND x.s = y.s""")
def _(spark, d):
    from attesta.operators import routing

    one = lambda w: coder(spark, d, w).select("doc_id", (F.length("line") % 3).cast("long").alias("scale"))
    return routing.scale_counts(one("a"), one("b"), ["doc_id", "scale"])


@query("routing", f"""WITH {CODERS},
i AS (SELECT doc_id FROM u WHERE x <> y GROUP BY doc_id),
z AS (SELECT d.doc_id, quality, toxic, n_chars FROM documents d LEFT JOIN labels USING (doc_id)),
f AS (SELECT z.doc_id, array_to_string(list_filter([CASE WHEN quality IS DISTINCT FROM toxic THEN 'n_samples' END, CASE WHEN abs(n_chars % 7 - n_chars % 5) > 0 THEN 'total_n' END, CASE WHEN abs(n_chars % 3 - n_chars % 2) > 0.5 THEN 'age_mean' END, CASE WHEN i.doc_id IS NOT NULL THEN 'items' END], lambda v: v IS NOT NULL), ';') AS disputes FROM z LEFT JOIN i ON z.doc_id = i.doc_id)
SELECT doc_id, disputes, CASE WHEN disputes = '' THEN 'agreement' ELSE 'dispute' END AS route FROM f""")
def _(spark, d):
    from attesta.operators import routing

    # both coders' sets of a document by one aggregate, computed once for both sides
    sets = _verified(spark, d).groupBy("doc_id").agg(*[F.collect_set(F.when(F.col(f"in_{w}"), F.col("key"))).alias(f"items_{w}") for w in "ab"])
    held = kept(table(spark, d, "documents").drop("text").join(table(spark, d, "labels"), "doc_id", "left").join(sets, "doc_id", "left"))

    def one(w, n, m, age):
        none, c = F.array().cast("array<string>"), F.col("n_chars")
        return held.select(F.col("doc_id").alias("paper_id"), F.col(n).alias("n_samples"), F.lit("both").alias("study_type"), F.lit("GOOD").alias("quality_flag"), (c % m).cast("double").alias("total_n"), (c % age).cast("double").alias("age_mean"), F.lit(None).cast("double").alias("age_sd"), F.lit(None).cast("double").alias("gender_pct_female"), F.coalesce(f"items_{w}", none).alias("items"), none.alias("scales"))

    fields = ["n_samples", *routing.CATEGORIES, *routing.TOLERANCES]
    r = routing.routed(one("a", "quality", 7, 3), one("b", "toxic", 5, 2), fields)
    return r.select(F.col("paper_id").alias("doc_id"), F.array_join("disputes", ";").alias("disputes"), "route")


@query("single_coder", """
WITH a AS (SELECT doc_id FROM documents WHERE n_chars % 10 <> 1), b AS (SELECT doc_id FROM documents WHERE n_chars % 10 <> 2)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NULL OR b.doc_id IS NULL AS single FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def _(spark, d):
    docs = table(spark, d, "documents")
    a = docs.where(F.col("n_chars") % 10 != 1).select("doc_id", F.lit(True).alias("a"))
    b = docs.where(F.col("n_chars") % 10 != 2).select("doc_id", F.lit(True).alias("b"))
    return a.join(b, "doc_id", "full").select("doc_id", (F.col("a").isNull() | F.col("b").isNull()).alias("single"))


