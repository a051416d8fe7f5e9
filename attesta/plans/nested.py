"""Queries of the nested-record operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import schema as S
from attesta.operators import audit, phase1, records, routing
from attesta.plans import roles, textual
from attesta.plans.textual import sql_norm

QUERIES, ORACLE_SQL = {}, {}


def query(name, sql=None):
    return textual.query(name, sql, (QUERIES, ORACLE_SQL))


BASE = f"""t AS (SELECT conv_id, turn, role, text, {sql_norm('text')} AS k FROM conversations),
pr AS (SELECT conv_id, coalesce(min(CASE WHEN role = 'user' AND turn % 4 = 2 THEN turn END), min(CASE WHEN role = 'user' THEN turn END)) AS label FROM t GROUP BY conv_id),
src AS (SELECT conv_id, string_agg(k, ' ' ORDER BY turn) AS s FROM t WHERE turn % 3 <> 1 GROUP BY conv_id),
sc AS (SELECT conv_id, role, count(*) AS n FROM t GROUP BY ALL),
it AS (SELECT conv_id, role, turn, text, k FROM t WHERE role <> 'system'),
ver AS (SELECT it.*, row_number() OVER (PARTITION BY it.conv_id, role, k ORDER BY turn) AS first FROM it JOIN src USING (conv_id) WHERE k <> '' AND contains(s, k)),
ok AS (SELECT * FROM ver WHERE first = 1)"""


def _columns(names, kinds, **values):
    """A select list of the columns in their order: those named by their SQL, all others null."""
    sql = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    return ", ".join(f"CAST({values.get(c, 'NULL')} AS {sql[kinds.get(c, 'string')]}) AS {c}" for c in names)


_KINDS = {f.name: f.dataType.simpleString() for part in (S.PAPER, S.PDF_QUALITY, S.SAMPLE, S.SCALE.replace("items items, ", ""), S.ITEM, S.META) for f in S._struct(part).fields} | {"item_both_coders": "boolean"}
_PAPER = {"paper_id": "conv_id", "filename": "'x_10.1000@' || conv_id || '.pdf'", "provenance": "'auto_agreement'", "doi": "'10.1000/' || conv_id", "url": "'https://doi.org/10.1000/' || conv_id", "title": "'Conversation ' || conv_id", "study_type": "'Both'"}
_SCALE = {"scale_name": "role", "scale_abbreviation": "upper(substr(role, 1, 2))", "items_coverage": "'FULL'"}
_SAMPLE = {"sample_label": "u.turn", "is_primary": "u.turn % 4 = 2", "total_n": "length(u.text)", "age_format": "CASE WHEN u.turn IS NOT NULL THEN 'Mean_SD' END"}
_ITEM = {"item_number": "it.turn", "item_text_original": "it.text", "reverse_scored": "it.turn % 2 = 1"}


@query("flat_records", f"""WITH {BASE}
SELECT {_columns(S.FLAT_COLUMNS, _KINDS, quality_flag="'good'", extraction_confidence="'HIGH'", item_both_coders="CASE WHEN it.turn IS NOT NULL THEN false END", **_PAPER, **_SCALE, **_SAMPLE, **_ITEM)}
FROM sc LEFT JOIN it USING (conv_id, role) JOIN pr USING (conv_id) LEFT JOIN (SELECT conv_id, turn, text FROM t WHERE role = 'user') u USING (conv_id) WHERE u.turn IS NOT DISTINCT FROM label""")
def _(spark, d):
    return records.flattened(roles.records(spark, d))


_OF_SAMPLES = ["paper_id", "filename", "provenance", "title", "study_type", *S.SAMPLE_COLUMNS]


@query("samples_table", f"""WITH {BASE}
SELECT {_columns(_OF_SAMPLES, _KINDS, **_PAPER, **_SAMPLE)} FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN (SELECT * FROM t WHERE role = 'user') u USING (conv_id)""")
def _(spark, d):
    return records.samples_table(roles.records(spark, d))


_OF_SCALES = ["paper_id", "filename", "provenance", "title", *S.SCALE_COLUMNS]


@query("scales_table", f"""WITH {BASE}
SELECT {_columns(_OF_SCALES, _KINDS, items_extracted_count="CASE WHEN role = 'system' THEN 0 ELSE n END", **_PAPER, **_SCALE)} FROM sc""")
def _(spark, d):
    return records.scales_table(records.counted(roles.records(spark, d)))


@query("consensus_flag", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, role AS scale_name, CAST(turn AS VARCHAR) AS item_number, k IN (SELECT k FROM ok WHERE ok.conv_id = it.conv_id AND ok.turn % 2 = 0) AS item_both_coders FROM it""")
def _(spark, d):
    r = roles.records(spark, d)
    even = F.transform("scales", lambda s: s.withField("items", F.filter(s["items"], lambda i: i["item_number"].cast("int") % 2 == 0)))
    both = records.item_keys_of(records.pruned(r.withColumn("scales", F.transform("scales", lambda s: s)))).select("paper_id", "keys")
    other = records.item_keys_of(records.pruned(r).withColumn("scales", even)).select("paper_id", F.col("keys").alias("keys2"))
    met = r.join(both, "paper_id").join(other, "paper_id").withColumn("both", F.array_intersect("keys", "keys2"))
    return records.items_table(met, "both").select("paper_id", "scale_name", "item_number", "item_both_coders")


@query("prune_records", f"""WITH {BASE}
SELECT CAST(sc.conv_id AS VARCHAR) AS paper_id, sc.role AS scale_name, count(ok.turn) AS items_extracted_count, CASE WHEN count(ok.turn) = 0 THEN 'none' ELSE 'FULL' END AS items_coverage,
  coalesce(any_value(length(sc.role) >= 3 AND contains(s, sc.role)), false) AS scale_name_verified
FROM sc LEFT JOIN src ON src.conv_id = sc.conv_id LEFT JOIN ok ON ok.conv_id = sc.conv_id AND ok.role = sc.role GROUP BY sc.conv_id, sc.role""")
def _(spark, d):
    return records.scales_table(records.pruned(roles.records(spark, d))).select("paper_id", "scale_name", "items_extracted_count", "items_coverage", "scale_name_verified")


@query("record_counts", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, count(*) AS total_scales_found, CAST(sum(CASE WHEN role = 'system' THEN 0 ELSE n END) AS BIGINT) AS total_items_extracted FROM sc GROUP BY conv_id""")
def _(spark, d):
    return records.counted(roles.records(spark, d)).select("paper_id", "extraction_meta.total_scales_found", "extraction_meta.total_items_extracted")


_SMALL = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("age_mean", "age_sd", "gender_pct_female"))


@query("scalar_vector", f"""WITH {BASE},
u AS (SELECT conv_id, count(*) FILTER (role = 'user') AS n FROM t GROUP BY conv_id)
SELECT CAST(pr.conv_id AS VARCHAR) AS paper_id, 'Both' AS study_type, CASE WHEN label IS NOT NULL THEN 'Mean_SD' END AS age_format, CAST(NULL AS VARCHAR) AS gender_format, 'good' AS quality_flag,
  length(t.text) AS total_n, {_SMALL}, CAST(n AS INTEGER) AS n_samples
FROM pr JOIN u USING (conv_id) LEFT JOIN t ON t.conv_id = pr.conv_id AND t.turn = label AND t.role = 'user'""")
def _(spark, d):
    return records.scalars(roles.records(spark, d))


@query("rater_zip", f"""WITH {BASE}, u AS (SELECT conv_id, CAST(count(*) FILTER (role = 'user') AS INTEGER) AS n FROM t GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS paper_id, 'good' AS quality_flag_a, 'good' AS quality_flag_b, n AS n_samples_a, CASE WHEN conv_id % 3 = 0 THEN 0 ELSE n END AS n_samples_b
FROM u WHERE conv_id % 4 <> 1 AND conv_id % 4 <> 2""")
def _(spark, d):
    one = roles.records(spark, d).withColumn("__c", F.col("paper_id").cast("long"))
    a = records.scalars(one.where("__c % 4 <> 1"))
    b = records.scalars(one.where("__c % 4 <> 2").withColumn("samples", F.when(F.col("__c") % 3 != 0, F.col("samples"))))
    return routing.aligned(a, b, ["quality_flag", "n_samples"])


@query("unresolved_record", f"""WITH {BASE}, n AS (SELECT conv_id, count(*) AS n FROM sc GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS paper_id, 'coder_only_unresolved' AS provenance, 'both' AS study_type, CASE WHEN conv_id % 4 <> 1 THEN 'from A | ' ELSE '' END || 'NOT adjudicated: exported from coder output.' AS notes,
  true AS review, CAST(CASE WHEN conv_id % 5 = 0 THEN 0 ELSE n END AS INTEGER) AS n_scales
FROM n WHERE conv_id % 4 <> 1 OR conv_id % 3 <> 1""")
def _(spark, d):
    one = roles.records(spark, d).drop("source_norm").withColumn("__c", F.col("paper_id").cast("long"))
    noted = F.col("extraction_meta").withField("extraction_notes", F.lit("from A"))
    a, b = one.where("__c % 4 <> 1").withColumn("extraction_meta", noted).drop("__c"), one.where("__c % 3 <> 1").drop("__c")
    r = records.unresolved(a, b, one.where("__c % 5 <> 0").select("paper_id", "scales"))
    return r.select("paper_id", "provenance", "paper.study_type", F.col("extraction_meta.extraction_notes").alias("notes"), F.col("extraction_meta.needs_human_review").alias("review"), F.size("scales").alias("n_scales"))


@query("file_names", "SELECT DISTINCT CAST(conv_id AS VARCHAR) AS paper_id, CASE WHEN conv_id % 3 <> 0 THEN conv_id || '.pdf' ELSE '' END AS filename FROM conversations")
def _(spark, d):
    one = roles.records(spark, d)
    log = one.where(F.col("paper_id").cast("long") % 3 != 0).select("paper_id", F.concat("paper_id", F.lit(".pdf")).alias("filename"))
    return records.with_filename(one, log).select("paper_id", "filename")


@query("invalid_records", """
SELECT DISTINCT CAST(conv_id AS VARCHAR) AS paper_id, CASE WHEN conv_id % 4 = 0 THEN 'no scales array' WHEN conv_id % 4 = 1 THEN 'no samples array' ELSE 'a scale without an items array' END AS reason
FROM conversations WHERE conv_id % 4 < 3""")
def _(spark, d):
    c = F.col("paper_id").cast("long") % 4
    one = roles.records(spark, d)
    scale = S.RECORD["scales"].dataType.elementType
    bare = F.transform("scales", lambda s: F.struct(*[(F.lit(None).cast(f.dataType) if f.name == "items" else s[f.name]).alias(f.name) for f in scale.fields]))
    broken = one.withColumns({"scales": F.when(c == 2, bare).when(c != 0, F.col("scales")), "samples": F.when(c != 1, F.col("samples"))})
    return records.invalid(broken).select("paper_id", "reason")


@query("expected_rows", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, CAST(sum(CASE WHEN role = 'system' THEN 1 ELSE n END) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN role = 'system' THEN 0 ELSE n END) AS BIGINT) AS n_items FROM sc GROUP BY conv_id""")
def _(spark, d):
    return audit.expected_rows(roles.records(spark, d))


@query("canonical_record", f"""WITH {BASE}
SELECT DISTINCT CAST(conv_id AS VARCHAR) AS paper_id, 'both' AS study_type, 'GOOD' AS quality_flag, 'high' AS extraction_confidence, 'full' AS items_coverage, CASE WHEN label IS NULL THEN NULL ELSE 'mean_sd' END AS age_format FROM pr""")
def _(spark, d):
    r = records.canonicalised(roles.records(spark, d))
    return r.select("paper_id", "paper.study_type", "pdf_quality.quality_flag", "extraction_meta.extraction_confidence", F.get("scales", F.lit(0))["items_coverage"].alias("items_coverage"), F.get("samples", F.lit(0))["age_format"].alias("age_format"))


@query("restore_sections", f"""WITH {BASE}, n AS (SELECT conv_id, count(*) FILTER (role = 'user') AS u FROM t GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS paper_id, CASE WHEN conv_id % 2 = 0 OR u = 0 THEN u ELSE u END AS n_samples, conv_id % 2 = 0 AND u > 0 AS needs_human_review,
  CASE WHEN conv_id % 2 = 0 AND u > 0 THEN 'samples restored from coder' END AS notes FROM n""")
def _(spark, d):
    r = roles.records(spark, d).drop("source_norm")
    judged = r.withColumn("samples", F.when(F.col("paper_id").cast("long") % 2 == 0, F.filter("samples", lambda s: F.lit(False))).otherwise(F.col("samples")))
    coders = r.select("paper_id", "samples", F.lit("A").alias("coder")).unionByName(r.select("paper_id", F.slice("samples", 1, 1).alias("samples"), F.lit("B").alias("coder")))
    out = records.restored(judged, coders)
    return out.select("paper_id", F.size("samples").cast("long").alias("n_samples"), F.coalesce("extraction_meta.needs_human_review", F.lit(False)).alias("needs_human_review"), F.col("extraction_meta.extraction_notes").alias("notes"))


@query("auto_record", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, 'auto_agreement' AS provenance, CASE WHEN count(*) - CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END >= count(*) - 1 + conv_id % 2 THEN 'A' ELSE 'B' END AS base, count(*) AS n_scales FROM sc GROUP BY conv_id""")
def _(spark, d):
    r = roles.records(spark, d).drop("source_norm")
    even = F.col("paper_id").cast("long") % 2 == 0
    short = F.slice("scales", F.lit(2), F.greatest(F.size("scales") - 1, F.lit(0)))
    a = r.withColumn("scales", F.when(even, short).otherwise(F.col("scales"))).withColumn("filename", F.lit("A"))
    b = r.withColumn("scales", F.when(even, short).otherwise(F.col("scales"))).withColumn("filename", F.lit("B"))
    out = records.automatic(a, b, r.select("paper_id", "scales"))
    return out.select("paper_id", "provenance", F.col("filename").alias("base"), F.size("scales").cast("long").alias("n_scales"))


@query("json_salvage", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, CASE conv_id % 3 WHEN 2 THEN 1 ELSE count(*) END AS n_scales, CASE conv_id % 3 WHEN 2 THEN 'Extracted scale' ELSE min(role) END AS first_scale FROM sc GROUP BY conv_id""")
def _(spark, d):
    r = roles.records(spark, d).drop("source_norm")
    whole = F.to_json(F.struct(*r.columns))
    k = F.col("paper_id").cast("long") % 3
    text = F.when(k == 0, whole).when(k == 1, F.concat(F.lit("```json\n"), F.regexp_replace(whole, r"\}\z", ",}"), F.lit("\n```"))).otherwise('{"scales": oops, "items": [{"item_number": "1"}] and more')
    out = records.parsed(r.select("paper_id", text.alias("value")))
    return out.select("paper_id", F.size("record.scales").cast("long").alias("n_scales"), F.get("record.scales", F.lit(0))["scale_name"].alias("first_scale"))


@query("coerced_meta", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, CASE conv_id % 3 WHEN 0 THEN 'spoken freely' WHEN 1 THEN 'fine' END AS notes, CASE WHEN conv_id % 3 = 1 THEN 'low' ELSE 'medium' END AS confidence, conv_id % 3 <> 1 AS review,
  CASE WHEN conv_id % 3 = 2 THEN 0 ELSE count(*) END AS n_scales FROM sc GROUP BY conv_id""")
def _(spark, d):
    r = roles.records(spark, d)
    k = F.col("paper_id").cast("long") % 3
    meta = F.when(k == 0, '"spoken freely"').when(k == 1, '{"extraction_notes": "fine", "extraction_confidence": "low", "needs_human_review": false}').otherwise("[]")
    scales = F.when(k == 2, '"none"').otherwise(F.to_json("scales"))
    text = F.concat(F.lit('{"extraction_meta": '), meta, F.lit(', "scales": '), scales, F.lit("}"))
    out = records.coerced(r.select("paper_id", text.alias("value")))
    return out.select("paper_id", F.col("extraction_meta.extraction_notes").alias("notes"), F.col("extraction_meta.extraction_confidence").alias("confidence"), F.col("extraction_meta.needs_human_review").alias("review"), F.size("scales").cast("long").alias("n_scales"))


_RECORD = """'{"title":"Conversation ' || conv_id || '","study_type":"Both"}'"""


@query("dispute_brief", f"""WITH {BASE}
SELECT CAST(conv_id AS VARCHAR) AS paper_id, md5('PAPER ' || conv_id || chr(10) || chr(10) || 'DISPUTES: items; scales' || chr(10) || chr(10) || 'CODER A:' || chr(10) || {_RECORD} || chr(10) || chr(10)
  || 'CODER B:' || chr(10) || {_RECORD} || chr(10) || chr(10) || 'SOURCE:' || chr(10) || substr(s, 1, 1000)) AS brief_md5, CAST(least(length(s), 1000) AS BIGINT) AS source_length FROM src WHERE s <> ''""")
def _(spark, d):
    r = roles.records(spark, d).where("source_norm <> ''")
    text = routing.brief(F.col("paper_id"), F.array(F.lit("items"), F.lit("scales")), F.col("paper"), F.col("paper"), F.col("source_norm"), 1000)
    return r.select("paper_id", F.md5(text).alias("brief_md5"), F.length(F.substring_index(text, "SOURCE:\n", -1)).cast("long").alias("source_length"))


@query("judged_fallback", f"""WITH {BASE}, n AS (SELECT conv_id, count(*) AS u FROM sc GROUP BY conv_id)
SELECT CAST(conv_id AS VARCHAR) AS paper_id, CASE WHEN conv_id % 4 = 2 THEN 1 ELSE u END AS n_scales, conv_id % 4 IN (0, 1) AS review, CASE WHEN conv_id % 4 = 1 THEN 'judge cut off: items from the verified union' ELSE '' END AS notes FROM n""")
def _(spark, d):
    r = roles.records(spark, d).drop("source_norm")
    k = F.col("paper_id").cast("long") % 4
    none = F.filter("scales", lambda s: F.lit(False))
    judged = r.withColumn("truncated", k == 1).withColumn("scales", F.when(k == 0, none).when(k == 2, F.slice("scales", 1, 1)).otherwise(F.col("scales")))
    out = records.settled(judged, r.select("paper_id", "scales"))
    return out.select("paper_id", F.size("scales").cast("long").alias("n_scales"), F.coalesce("extraction_meta.needs_human_review", F.lit(False)).alias("review"), F.coalesce("extraction_meta.extraction_notes", F.lit("")).alias("notes"))


def _phase1(filename, status, scale_name, needs_review, subscales="''", item_number="''", was_administered="''"):
    """All 47 columns: texts absent as '', but the counts and needs_review."""
    held = {"filename": filename, "extraction_status": status, "scale_name": scale_name, "subscales": subscales, "item_number": item_number, "was_administered": was_administered}
    own = {"total_scales_found": "CAST(1 AS BIGINT)", "total_items_extracted": "CAST(5 AS BIGINT)", "needs_review": needs_review}
    return ", ".join(f"{own[c]} AS {c}" if c in own else f"coalesce(CAST({held.get(c, 'NULL')} AS VARCHAR), '') AS {c}" for c in phase1.COLUMNS)


@query("phase1_rows", f"""
WITH t AS (SELECT * FROM conversations), c AS (SELECT DISTINCT conv_id, conv_id % 7 <> 3 AS ok FROM t),
s AS (SELECT DISTINCT conv_id, role FROM t WHERE role <> 'system'), z AS (SELECT c.conv_id, ok, ok AND EXISTS (SELECT 1 FROM s WHERE s.conv_id = c.conv_id) AS held FROM c),
i AS (SELECT conv_id, role, turn FROM t WHERE role <> 'system' AND turn % 5 <> 1)
SELECT {_phase1(filename="z.conv_id", status="CASE WHEN ok THEN 'success' ELSE 'failed' END", scale_name="s.role", subscales="CASE WHEN s.role IS NOT NULL THEN 'a; b' END", item_number="i.turn", needs_review="NOT ok OR NOT held OR i.turn IS NULL OR z.conv_id % 5 = 0")}
FROM z LEFT JOIN s ON held AND s.conv_id = z.conv_id LEFT JOIN i ON i.conv_id = s.conv_id AND i.role = s.role
UNION ALL
SELECT {_phase1(filename="conv_id", status="'success'", scale_name="'mentioned ' || role", was_administered="'True'", needs_review="true")} FROM (SELECT DISTINCT conv_id, role FROM t JOIN z USING (conv_id) WHERE held AND role = 'system' AND (conv_id % 3 = 0 OR conv_id % 2 = 0))""")
def _(spark, d):
    turns = roles.table(spark, d, "conversations")
    item = [F.lit(None).cast("string").alias(c) for c in phase1.ITEM if c != "item_notes"]
    one = turns.groupBy("conv_id", "role").agg(F.sort_array(F.collect_list(F.when(F.col("turn") % 5 != 1, F.col("turn")))).alias("t"))
    items = F.transform("t", lambda x: F.struct(x.cast("string").alias("item_number"), *[c for c in item[1:]], F.lit(None).cast("string").alias("notes")))
    null = lambda c: F.lit(None).cast("string").alias(c)
    scale = F.struct(F.col("role").alias("scale_name"), *[null(c) for c in ("scale_abbreviation", "scale_citation", "scale_purpose", "item_source", "total_items_in_scale", "items_extracted", "response_format")], F.array(F.lit("a"), F.lit("b")).alias("subscales"), items.alias("items"))
    k = F.col("conv_id")
    extra = F.struct(F.concat(F.lit("mentioned "), F.col("role")).alias("scale_name"), *[null(c) for c in ("scale_abbreviation", "original_citation", "num_items_reported", "connection_type", "reason_not_extracted")], F.when(k % 3 != 0, k % 2 == 0).alias("was_administered"))
    system = F.col("role") == "system"
    held = one.groupBy("conv_id").agg(F.collect_list(F.when(~system, scale)).alias("scales_extracted"), F.collect_list(F.when(system, extra)).alias("scales_mentioned_not_extracted"))
    summary = F.struct(F.lit(1).cast("long").alias("total_scales_found"), F.lit(5).cast("long").alias("total_items_extracted"), F.when(k % 5 == 0, "Low").otherwise("high").alias("overall_confidence"), F.lit(False).alias("needs_review"), null("review_reason"))
    results = held.select(k.cast("string").alias("filename"), F.when(k % 7 != 3, "success").otherwise("failed").alias("extraction_status"), F.struct(*[null(c) for c in phase1.META]).alias("article_metadata"), F.struct(*[null(c) for c in phase1.POPULATION]).alias("population_info"), summary.alias("extraction_summary"), "scales_extracted", "scales_mentioned_not_extracted")
    return phase1.rows(results)


@query("pending_papers", """
SELECT o_orderkey AS paper_id FROM orders WHERE o_orderkey % 9 NOT IN (0, 1, 2, 3) AND (o_custkey % 11 = 5 OR o_custkey % 200 <= 120)""")
def _(spark, d):
    from attesta.operators import queue

    o = roles.table(spark, d, "orders").withColumn("paper_id", F.col("o_orderkey"))
    papers = o.select("paper_id", F.when(F.col("o_custkey") % 11 != 5, F.col("o_custkey") % 200).alias("pages"))
    status = F.get(F.array(*map(F.lit, [*queue.TERMINAL, "poor"])), F.least(F.col("o_orderkey") % 9, F.lit(4)).cast("int"))
    return queue.pending(papers, o.select("paper_id", status.alias("status")), "pages").select("paper_id")


@query("corpus_profile", "SELECT median(n_chars // 4) AS median_tokens, count(DISTINCT (source, lang)) AS pairs FROM documents")
def _(spark, d):
    from attesta.operators import queue

    docs = roles.table(spark, d, "documents").withColumn("tokens", F.floor(F.col("n_chars") / 4).cast("long"))
    return queue.profile(docs, "tokens", "source", "lang")


@query("first_offenders", "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey ELSE -1 END AS c FROM orders ORDER BY CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END DESC NULLS LAST, o_orderkey LIMIT 20")
def _(spark, d):
    from attesta.operators import queue

    o = roles.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("c"))
    return queue.first_offenders(o, "-c", "o_orderkey").na.fill(-1, ["c"])
