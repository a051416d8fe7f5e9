"""Queries of the text functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import packing
from attesta.operators.ordinal import ordinal
from attesta.plans.roles import lines, table, texts


#: Every white space of Unicode, as a class of DuckDB's regular expressions.
SPACE = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _sql_caseless(x: str) -> str:
    """NFKC and case folding in DuckDB, which has NFC and lower case: the other characters of some blocks
    one by one."""
    one, many = {}, {}
    for lo, hi in ((0x80, 0x24F), (0x370, 0x3FF), (0x2000, 0x206F), (0x2070, 0x209F), (0x2100, 0x214F), (0xFB00, 0xFB06), (0xFF01, 0xFF5E), (0x3000, 0x3000)):
        for c in map(chr, range(lo, hi + 1)):
            f = unicodedata.normalize("NFKC", c).casefold()
            if f != c.lower().replace("ß", "ss"):
                if len(f) == 1:
                    one[c] = f
                elif lo in (0x2000, 0xFB00):
                    many[c] = f
    to = "".join(one.values()).replace("'", "''")
    x = f"translate(nfc_normalize({x}), '{''.join(one)}', '{to}')"
    for c, f in many.items():
        x = f"replace({x}, '{c}', '{f}')"
    return f"replace(lower({x}), 'ß', 'ss')"


def sql_norm(x: str) -> str:
    """N1 in DuckDB."""
    smart = "'“”’‘–—' || chr(160)"
    x = f"regexp_replace(translate({_sql_caseless(x)}, {smart}, '\"\"''''-- '), '[*_`~]', '', 'g')"
    x = f"regexp_replace(translate({x}, '|', ' '), '-{SPACE}*\\n{SPACE}*', '', 'g')"
    x = f"regexp_replace({x}, '^{SPACE}*[a-z]?\\p{{Nd}}*[-.\\p{{Nd}}]*{SPACE}*[.):]{SPACE}*', '')"
    return f"coalesce(trim(regexp_replace(trim(regexp_replace({x}, '{SPACE}+', ' ', 'g')), '\\.+$', '')), '')"


def sql_coding(x: str) -> str:
    """N2."""
    return f"coalesce(trim(lower(regexp_replace(nfc_normalize({x}), '{SPACE}+', ' ', 'g'))), '')"


def sql_match(x: str) -> str:
    """N4."""
    smart = "'“”’‘–—' || chr(160)"
    x = f"translate(regexp_replace({x}, '_x[0-9A-Fa-f]{{4}}_', ' ', 'g'), {smart}, '\"\"''''-- ')"
    return f"trim({sql_coding(x)}, ' .:;,-\"''()[]')"


LINES = "SELECT doc_id, no - 1 AS pos, ls[no] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS u(no)"

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None, into=(QUERIES, ORACLE_SQL)):
    def add(f):
        into[0][name] = f
        if sql:
            into[1][name] = sql
        return f

    return add


@query("norm_documents", f"SELECT doc_id, md5({sql_norm('text')}) AS norm_md5, CAST(length({sql_norm('text')}) AS BIGINT) AS norm_length FROM documents")
def _(spark, d):
    docs = texts(spark, d).withColumn("n", T.evidence_norm("text"))
    return docs.select("doc_id", F.md5("n").alias("norm_md5"), F.length("n").cast("long").alias("norm_length"))


def _disguised(text):
    """The text as a PDF prints it: ligatures, full-width letters, accents apart, thin spaces."""
    for old, new in (("fi", "ﬁ"), ("A", "Ａ"), ("é", "é"), (", ", ", ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


@query("norm_caseless", f"SELECT doc_id, md5({sql_norm('text')}) AS norm_md5 FROM documents")
def _(spark, d):
    """The SQL reads the plain text: the disguise must not show."""
    return texts(spark, d).select("doc_id", F.md5(T.evidence_norm(_disguised(F.col("text")))).alias("norm_md5"))


@query("coding_composed", f"SELECT doc_id, md5({sql_coding('text')}) AS norm_md5 FROM documents")
def _(spark, d):
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("é")), F.lit(" "), F.lit(" "))
    return texts(spark, d).select("doc_id", F.md5(T.coding_norm(apart)).alias("norm_md5"))


@query("call_cost", """
WITH c AS (SELECT event_id, user_id * 15 + event_id * 125 AS u FROM events)
SELECT event_id, (u // 1000 + CASE WHEN u % 1000 > 500 OR (u % 1000 = 500 AND u // 1000 % 2 = 1) THEN 1 ELSE 0 END) / 100000.0::DOUBLE AS cost FROM c""")
def _(spark, d):
    return table(spark, d, "events").select("event_id", T.cost(F.col("user_id"), F.col("event_id"), 0.15, 1.25).alias("cost"))


@query("label_shares", """
SELECT lang, round(100.0 * count_if(toxic = 1) / nullif(count(toxic), 0), 1) AS toxic_pct, CAST(NULL AS DOUBLE) AS none_pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def _(spark, d):
    m = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").groupBy("lang")
    return m.agg(T.percent(F.count_if(F.col("toxic") == 1), F.count("toxic")).alias("toxic_pct"), T.percent(F.count("*"), F.lit(0)).alias("none_pct"))


@query("ordinals", "SELECT doc_id, row_number() OVER (ORDER BY source NULLS FIRST, n_chars NULLS FIRST, doc_id) AS row_id FROM documents")
def _(spark, d):
    return ordinal(table(spark, d, "documents").select("doc_id", "source", "n_chars"), ["source", "n_chars", "doc_id"], "row_id", 1).select("doc_id", "row_id")


@query("norm_lines", f"SELECT doc_id, pos, {sql_norm('line')} AS norm FROM ({LINES})")
def _(spark, d):
    return lines(spark, d).select("doc_id", F.col("pos").cast("long").alias("pos"), T.evidence_norm("line").alias("norm"))


@query("key_dedup_lines", f"""
WITH l AS (SELECT doc_id * 1000000 + pos AS row_id, {sql_coding('line')} AS key FROM ({LINES}))
SELECT row_id, key, min(row_id) OVER (PARTITION BY key) AS first_row_id, count(*) OVER (PARTITION BY key) AS copies FROM l WHERE key <> ''""")
def _(spark, d):
    rows = lines(spark, d).select((F.col("doc_id") * 1_000_000 + F.col("pos")).alias("row_id"), T.coding_norm("line").alias("key")).where("key <> ''")
    first = rows.groupBy("key").agg(F.min("row_id").alias("first_row_id"), F.count("*").alias("copies"))
    return rows.join(first, "key").select("row_id", "key", "first_row_id", "copies")


@query("match_keys", f"""
SELECT doc_id, pos, {sql_match('line')} AS t1, regexp_replace({sql_match('line')}, '[^a-z0-9]', '', 'g') AS t2 FROM ({LINES})""")
def _(spark, d):
    return lines(spark, d).select("doc_id", F.col("pos").cast("long").alias("pos"), T.match_norm("line").alias("t1"), T.match_aggressive("line").alias("t2"))


@query("fold_names", """
SELECT DISTINCT trim(regexp_replace(lower(strip_accents(translate(string_split(text, chr(10))[1], 'ıİşğçöü', 'iisgcou'))), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS folded FROM documents""")
def _(spark, d):
    return table(spark, d, "documents").select(T.folded(F.substring_index("text", "\n", 1)).alias("folded")).distinct()


@query("paper_ids", "SELECT doc_id, substr(md5(CAST(doc_id AS VARCHAR) || '.pdf'), 1, 12) AS paper_id FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", T.paper_id(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("paper_id"))


@query("num_parse", """
WITH x AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) || ',' || '250' WHEN 1 THEN ' ' || CAST(event_id AS VARCHAR) || ' ' WHEN 2 THEN event_type ELSE '' END AS t FROM events)
SELECT event_id, TRY_CAST(replace(trim(t), ',', '') AS DOUBLE) AS number, CAST(coalesce(floor(TRY_CAST(replace(t, ',', '.') AS DOUBLE)), 0) AS BIGINT) AS safe FROM x""")
def _(spark, d):
    e, k = table(spark, d, "events"), F.col("event_id") % 4
    t = F.when(k == 0, F.concat(F.col("user_id").cast("string"), F.lit(",250"))).when(k == 1, F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" "))).when(k == 2, F.col("event_type")).otherwise("")
    x = e.select("event_id", t.alias("t"))
    return x.select("event_id", T.number("t").alias("number"), T.safe_int(F.replace("t", F.lit(","), F.lit("."))).alias("safe"))


_NAMES = "CASE doc_id % 5 WHEN 0 THEN 'a/' || source || '_10.1186@@@s' || doc_id || '.pdf' WHEN 1 THEN '10.1000_' || source || '@' || doc_id || '.pdf' WHEN 2 THEN 'x_10.5' || '_' || doc_id || '_1.pdf' WHEN 3 THEN source || '.pdf' END"


@query("doi_parse", f"""
WITH f AS (SELECT doc_id, {_NAMES} AS name FROM documents),
s AS (SELECT doc_id, regexp_replace(string_split(name, '/')[-1], '(.)\\.[^.]*$', '\\1') AS stem FROM f),
c AS (SELECT doc_id, CASE WHEN contains(stem, '_') THEN substr(stem, instr(stem, '_') + 1) ELSE stem END AS cand FROM s),
x AS (SELECT doc_id, cand, replace(replace(cand, '@@@', '/'), '@', '/') AS y FROM c),
z AS (SELECT doc_id, CASE WHEN starts_with(cand, '10.') THEN CASE WHEN contains(y, '/') THEN y ELSE regexp_replace(y, '^([^_]*)_', '\\1/') END ELSE '' END AS doi FROM x)
SELECT doc_id, coalesce(doi, '') AS doi, CASE WHEN coalesce(doi, '') = '' THEN '' ELSE 'https://doi.org/' || doi END AS url FROM z""")
def _(spark, d):
    i, s = F.col("doc_id").cast("string"), F.col("source")
    k = F.col("doc_id") % 5
    name = F.when(k == 0, F.concat(F.lit("a/"), s, F.lit("_10.1186@@@s"), i, F.lit(".pdf"))).when(k == 1, F.concat(F.lit("10.1000_"), s, F.lit("@"), i, F.lit(".pdf"))).when(k == 2, F.concat(F.lit("x_10.5_"), i, F.lit("_1.pdf"))).when(k == 3, F.concat(s, F.lit(".pdf")))
    x = table(spark, d, "documents").select("doc_id", name.alias("name"))
    return x.select("doc_id", T.doi("name").alias("doi"), T.doi_url("name").alias("url"))


@query("trim_refs", """
WITH t AS (SELECT page_id, html || chr(10) || CASE WHEN page_id % 3 > 0 THEN '## References' || chr(10) || url || chr(10) ELSE '' END || CASE WHEN page_id % 3 = 2 THEN 'Appendix A' || chr(10) || 'kept' ELSE '' END AS t FROM pages),
a AS (SELECT page_id, t, regexp_extract(t, '(?im)^#{0,3}\\s*(references|bibliography|literatur|références)\\s*$') AS m FROM t),
b AS (SELECT page_id, t, CASE WHEN m = '' THEN NULL ELSE instr(t, m) END AS i FROM a),
c AS (SELECT page_id, t, i, substr(t, i) AS tail, regexp_extract(substr(t, i), '(?im)^#{0,3}\\s*(appendix|annex|supplementary)') AS m2 FROM b)
SELECT page_id, md5(CASE WHEN i IS NULL THEN t WHEN m2 = '' THEN substr(t, 1, i - 1) ELSE substr(t, 1, i - 1) || substr(tail, instr(tail, m2)) END) AS kept_md5 FROM c""")
def _(spark, d):
    k = F.col("page_id") % 3
    t = F.concat(F.col("html"), F.lit("\n"), F.when(k > 0, F.concat(F.lit("## References\n"), F.col("url"), F.lit("\n"))).otherwise(""), F.when(k == 2, "Appendix A\nkept").otherwise(""))
    x = table(spark, d, "pages").select("page_id", t.alias("t"))
    return x.select("page_id", F.md5(T.without_references("t")).alias("kept_md5"))


@query("canonical_enum", """
WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN upper(role) ELSE role END AS raw FROM conversations)
SELECT conv_id, turn, raw, CASE lower(raw) WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'assistant' ELSE raw END AS role FROM r""")
def _(spark, d):
    r = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.upper("role")).otherwise(F.col("role")).alias("raw"))
    return r.withColumn("role", T.canonical(F.col("raw"), ["User", "assistant"]))


@query("merge_lists", """
WITH p AS (SELECT conv_id, turn, trim(x) AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS n
  FROM (SELECT conv_id, turn, unnest(string_split(role || '; ' || upper(role) || ';;' || CAST(turn % 3 AS VARCHAR), ';')) AS x, generate_subscripts(string_split(role || '; ' || upper(role) || ';;' || CAST(turn % 3 AS VARCHAR), ';'), 1) AS i FROM conversations)),
f AS (SELECT conv_id, x, n, row_number() OVER (PARTITION BY conv_id, lower(x) ORDER BY n) AS k FROM p WHERE x <> '')
SELECT conv_id, string_agg(x, '; ' ORDER BY n) AS merged FROM f WHERE k = 1 GROUP BY conv_id""")
def _(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.col("role"), F.lit("; "), F.upper("role"), F.lit(";;"), (F.col("turn") % 3).cast("string")).alias("x"))
    return c.groupBy("conv_id").agg(T.merged_list(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "x"))), lambda s: s["x"]), ";")).alias("merged"))


@query("json_fields", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("json_repair", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(spark, d):
    broken = F.concat(F.lit("Here it is:\n```json\n"), F.regexp_replace("props", r"\}", ", }"), F.lit("\n```"))
    x = table(spark, d, "events").select("event_id", T.repaired_json(broken).alias("j"))
    return x.select("event_id", F.from_json("j", "k bigint")["k"].alias("k"))


@query("triage", r"""
SELECT doc_id, CASE WHEN length(text) < 2000 THEN 'thin' WHEN NOT regexp_matches(text, '\d') THEN 'odd' ELSE 'eligible' END AS triage,
  CASE WHEN coalesce(text, '') = '' THEN 'error' WHEN length(text) > 500 THEN 'ok' ELSE 'poor' END AS ocr_status,
  CAST(floor(length(text) / 4) AS BIGINT) AS tokens, CAST(floor(length(text) / 3) + 600 AS BIGINT) AS packing_tokens FROM documents""")
def _(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.triage(t).alias("triage"), T.ocr_status(t).alias("ocr_status"), packing.estimated_tokens(t).cast("long").alias("tokens"), packing.estimated_tokens(t, True).cast("long").alias("packing_tokens"))


@query("composite_ids", "SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'NA') || '_' || coalesce(CAST(quality AS VARCHAR), 'NA') || '_' || coalesce(CAST(toxic AS VARCHAR), 'NA') AS id FROM documents LEFT JOIN labels USING (doc_id)")
def _(spark, d):
    m = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return m.select("doc_id", T.na_text(F.col("doc_id"), F.col("quality"), F.col("toxic")).alias("id"))


@query("terciles", """
WITH n AS (SELECT greatest(1, count(*) // 3) AS k FROM documents), r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS rn FROM documents)
SELECT doc_id, least(rn // k, 2) AS tercile FROM r, n""")
def _(spark, d):
    return packing.terciles(table(spark, d, "documents").select("doc_id", "n_chars"), ["n_chars"], "doc_id").select("doc_id", "tercile")


@query("stratified_sample", """
WITH n AS (SELECT greatest(1, count(*) // 3) AS k FROM documents), r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS rn FROM documents),
t AS (SELECT doc_id, least(rn // k, 2) AS tercile FROM r, n),
s AS (SELECT *, row_number() OVER (PARTITION BY tercile ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) AS p FROM t)
SELECT doc_id, tercile FROM s WHERE p <= CASE WHEN tercile = 2 THEN 50 - 2 * (50 // 3) ELSE 50 // 3 END""")
def _(spark, d):
    t = packing.terciles(table(spark, d, "documents").select("doc_id", "n_chars"), ["n_chars"], "doc_id")
    return packing.stratified(t, "tercile", "doc_id", 50, 42).select("doc_id", "tercile")


@query("pack_prefix", """
WITH w AS (SELECT source, doc_id, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS run, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)
SELECT source, doc_id, n_chars FROM w WHERE n <= 100 AND (n = 1 OR run <= 60000)""")
def _(spark, d):
    return packing.prefix_within(table(spark, d, "documents").select("source", "doc_id", "n_chars"), "n_chars", ["doc_id"], 60_000, 100, by=["source"])


@query("pack_batches", """
WITH RECURSIVE q AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
b(source, doc_id, rn, used, held, batch) AS (
  SELECT source, doc_id, rn, n_chars, 1, 0 FROM q WHERE rn = 1
  UNION ALL
  SELECT q.source, q.doc_id, q.rn, CASE WHEN b.used + q.n_chars > 60000 OR b.held >= 20 THEN q.n_chars ELSE b.used + q.n_chars END,
    CASE WHEN b.used + q.n_chars > 60000 OR b.held >= 20 THEN 1 ELSE b.held + 1 END,
    CASE WHEN b.used + q.n_chars > 60000 OR b.held >= 20 THEN b.batch + 1 ELSE b.batch END
  FROM b JOIN q ON q.source = b.source AND q.rn = b.rn + 1)
SELECT source, doc_id, CAST(batch AS BIGINT) AS batch FROM b""")
def _(spark, d):
    rows = table(spark, d, "documents").select("source", "doc_id", "n_chars")
    return packing.batches(rows, "n_chars", ["doc_id"], 60_000, 20, by="source").select("source", "doc_id", "batch")
