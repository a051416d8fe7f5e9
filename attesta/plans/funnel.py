"""Queries of the cleaning funnel and its mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import audit, dedup, remap
from attesta.plans import roles, textual
from attesta.sources import scratch

QUERIES, ORACLE_SQL = {}, {}


def query(name, sql=None):
    return textual.query(name, sql, (QUERIES, ORACLE_SQL))


ROWS = """r AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS row_id, p_brand AS scale_name, p_brand || '|' || l_orderkey AS occ,
    CASE WHEN l_linestatus = 'O' THEN p_name WHEN l_returnflag <> 'A' THEN p_name END AS english,
    CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'N' THEN 0 END AS needs_review, CASE WHEN l_linenumber < 7 THEN 'success' ELSE 'failed' END AS status,
    CASE WHEN p_size > 25 THEN 'YES' WHEN p_size > 10 THEN 'NO' END AS social, l_orderkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
CLEAN = "c AS (SELECT *, lower(scale_name) AS sc FROM r WHERE needs_review = 0 AND status = 'success' AND english IS NOT NULL)"
SCALES = f"""{ROWS}, {CLEAN},
o AS (SELECT sc, occ, count(*) AS scale_size FROM c GROUP BY sc, occ),
k AS (SELECT *, count(*) OVER (PARTITION BY sc) AS scale_occurrences, dense_rank() OVER (PARTITION BY sc ORDER BY scale_size DESC) = 1 AS keep_scale FROM o),
s AS (SELECT c.*, scale_size, scale_occurrences, keep_scale FROM c JOIN k USING (sc, occ))"""
ITEMS = f"""{SCALES},
i AS (SELECT *, trim(lower(english)) AS item_clean FROM s WHERE keep_scale),
d AS (SELECT *, count(*) OVER (PARTITION BY item_clean) AS item_dup_count, row_number() OVER (PARTITION BY item_clean ORDER BY scale_size DESC, row_id) = 1 AS keep_item FROM i)"""


def _scales(spark, d):
    return dedup.scale_occurrences(dedup.usable(roles.funnel(spark, d)))


def _items(spark, d):
    return dedup.item_duplicates(_scales(spark, d).where("keep_scale"))


@query("step1_keep", f"WITH {ROWS} SELECT row_id, scale_name, english AS item_text_english FROM r WHERE needs_review = 0 AND status = 'success' AND english IS NOT NULL")
def _(spark, d):
    return dedup.usable(roles.funnel(spark, d)).select("row_id", "scale_name", "item_text_english")


@query("step1_removed", f"WITH {ROWS} SELECT row_id FROM r WHERE needs_review <> 0 OR status <> 'success' OR english IS NULL")
def _(spark, d):
    return dedup.unusable(roles.funnel(spark, d)).select("row_id")


@query("step1_unaccounted", f"WITH {ROWS} SELECT row_id FROM r WHERE needs_review IS NULL AND status = 'success' AND english IS NOT NULL")
def _(spark, d):
    return dedup.unaccounted(roles.funnel(spark, d)).select("row_id")


@query("scale_dedup", f"WITH {SCALES} SELECT row_id, occ AS scale_occurrence_id, scale_size, scale_occurrences, keep_scale FROM s")
def _(spark, d):
    return _scales(spark, d).select("row_id", "scale_occurrence_id", "scale_size", "scale_occurrences", "keep_scale")


@query("scale_mapping", f"WITH {SCALES} SELECT DISTINCT scale_name, occ AS scale_occurrence_id, scale_size, scale_occurrences, keep_scale FROM s WHERE scale_occurrences > 1")
def _(spark, d):
    return dedup.mapping(_scales(spark, d), "scale_occurrences", ["scale_name", "scale_occurrence_id", "scale_size", "scale_occurrences", "keep_scale"])


@query("item_dedup", f"WITH {ITEMS} SELECT row_id, item_clean, item_dup_count, keep_item FROM d")
def _(spark, d):
    return _items(spark, d).select("row_id", "item_clean", "item_dup_count", "keep_item")


@query("item_mapping", f"WITH {ITEMS} SELECT DISTINCT row_id, scale_name, english AS item_text_english, keep_item, item_dup_count FROM d WHERE item_dup_count > 1")
def _(spark, d):
    return dedup.mapping(_items(spark, d), "item_dup_count", ["row_id", "scale_name", "item_text_english", "keep_item", "item_dup_count"])


@query("group_ids", f"WITH {ITEMS} SELECT row_id, CAST(dense_rank() OVER (ORDER BY item_clean) AS BIGINT) AS item_dup_group FROM d")
def _(spark, d):
    return dedup.group_labels(_items(spark, d), "item_clean", "item_dup_group").select("row_id", F.col("item_dup_group").cast("long").alias("item_dup_group"))


@query("step3_relevant", f"WITH {ITEMS} SELECT row_id, coalesce(social = 'YES', false) AS relevant FROM d WHERE keep_item")
def _(spark, d):
    kept = _items(spark, d).where("keep_item")
    one = lambda df, v: df.select("row_id", F.lit(v).alias("relevant"))
    return one(dedup.relevant(kept), True).unionByName(one(dedup.irrelevant(kept), False))


@query("funnel_counts", f"""WITH {ITEMS}
SELECT 'raw' AS step, count(*) AS n FROM r UNION ALL SELECT 'step1', count(*) FROM c UNION ALL SELECT 'step2a', count(*) FROM i
UNION ALL SELECT 'step2b', count(*) FROM d WHERE keep_item UNION ALL SELECT 'step3', count(*) FROM d WHERE keep_item AND social = 'YES'""")
def _(spark, d):
    # the steps' conditions are counted together, in one pass over the rows before and one after the ranks
    first = roles.funnel(spark, d).agg(F.count("*").alias("raw"), F.count_if(F.expr(dedup.USABLE)).alias("step1"))
    items = _items(spark, d).agg(F.count("*").alias("step2a"), F.count_if("keep_item").alias("step2b"), F.count_if(F.col("keep_item") & (F.col("measures_social_connection") == "YES")).alias("step3"))
    both = first.crossJoin(items)  # a row each
    return both.unpivot([], ["raw", "step1", "step2a", "step2b", "step3"], "step", "n")


@query("step4_columns", f"""WITH {ITEMS},
g AS (SELECT *, dense_rank() OVER (ORDER BY item_clean) AS item_dup_group, dense_rank() OVER (ORDER BY sc) AS scale_dup_group FROM d)
SELECT row_id, md5(row_id) AS origin_id, occ AS scale_occurrence_id, CAST(scale_dup_group AS BIGINT) AS scale_dup_group, CAST(item_dup_group AS BIGINT) AS item_dup_group, CAST(l_orderkey AS VARCHAR) AS title,
  'XX' AS country_study, scale_name, CAST(NULL AS VARCHAR) AS subscale, english AS item_text_original, english AS item_text_english FROM g WHERE keep_item AND social = 'YES'""")
def _(spark, d):
    items = dedup.group_labels(dedup.group_labels(_items(spark, d), "item_clean", "item_dup_group"), "scale_clean", "scale_dup_group")
    kept = dedup.relevant(items.where("keep_item"))
    own = {"origin_id": F.md5("row_id"), "title": F.col("order_key").cast("string"), "country_study": F.lit("XX"), "subscale": F.lit(None).cast("string"), "item_text_original": F.col("item_text_english")}
    return dedup.final_columns(kept.withColumns(own)).withColumns({c: F.col(c).cast("long") for c in ("scale_dup_group", "item_dup_group")})


@query("batch_summary", f"""WITH {ROWS}
SELECT l_orderkey % 7 AS source_batch, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_files, count(DISTINCT (l_orderkey, scale_name)) AS n_scales, count(english) AS n_items,
  CAST(count_if(coalesce(needs_review = 1, false)) AS BIGINT) AS n_review, count(DISTINCT CASE WHEN needs_review = 1 THEN l_orderkey END) AS n_files_review FROM r GROUP BY 1""")
def _(spark, d):
    rows = roles.funnel(spark, d).withColumn("source_batch", F.col("order_key") % 7).withColumn("filename", F.col("order_key").cast("string"))
    return dedup.batch_summary(rows)


@query("remap_duplicates", f"""WITH {ITEMS},
kept AS (SELECT row_id, item_clean, substr(md5(item_clean), 1, 1) AS code FROM d WHERE keep_item)
SELECT row_id, code, 'kept_item' AS status FROM kept
UNION ALL SELECT d.row_id, k.code, 'duplicate_item' FROM d LEFT JOIN kept k ON k.item_clean = d.item_clean WHERE NOT d.keep_item
UNION ALL SELECT s.row_id, k.code, 'duplicate_scale' FROM s LEFT JOIN kept k ON k.item_clean = trim(lower(s.english)) WHERE NOT s.keep_scale""")
def _(spark, d):
    scales = _scales(spark, d)
    items = dedup.group_labels(dedup.item_duplicates(scales.where("keep_scale")), "item_clean", "item_dup_group")
    kept = items.where("keep_item").withColumn("code", F.substring(F.md5("item_clean"), 1, 1))
    removed = scales.where("not keep_scale").withColumn("item_clean", T.clean_key("item_text_english"))
    return remap.carried_back(kept, items, removed)


@query("funnel_audit", f"""WITH {ITEMS}
SELECT step, input, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(unaccounted AS BIGINT) AS unaccounted FROM (
SELECT 'step1' AS step, count(*) AS input, count_if(needs_review = 0 AND status = 'success' AND english IS NOT NULL) AS kept, count_if(coalesce(needs_review <> 0, false) OR coalesce(status <> 'success', false) OR english IS NULL) AS removed,
  count_if(needs_review IS NULL AND status = 'success' AND english IS NOT NULL) AS unaccounted FROM r
UNION ALL SELECT 'step2a', count(*), count_if(keep_scale), count_if(NOT keep_scale), 0 FROM s
UNION ALL SELECT 'step2b', count(*), count_if(keep_item), count_if(NOT keep_item), 0 FROM d
UNION ALL SELECT 'step3', count(*), count_if(coalesce(social = 'YES', false)), count_if(NOT coalesce(social = 'YES', false)), 0 FROM d WHERE keep_item)""")
def _(spark, d):
    at, out = scratch.folder(spark), []
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), "kept").otherwise("removed")
    first = F.when(F.expr(dedup.USABLE), "kept").when(F.expr(dedup.UNUSABLE), "removed")
    rows = roles.funnel(spark, d)
    for step, made, outcome in (
        ("step1", lambda x: x, first),
        ("step2a", dedup.scale_occurrences, flag(F.col("keep_scale"))),
        ("step2b", dedup.item_duplicates, flag(F.col("keep_item"))),
        ("step3", lambda x: x, flag(F.col("measures_social_connection") == "YES")),
    ):
        rows, counts = audit.split(made(rows), outcome, f"{at}/{step}")
        out.append((step, *[counts[c] for c in ("input", "kept", "removed", "unaccounted")]))
    return spark.createDataFrame(out, "step string, input long, kept long, removed long, unaccounted long")
