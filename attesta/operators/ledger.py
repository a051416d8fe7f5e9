"""Costs, totals and agreement per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as T


def cost_ledger(usage: DataFrame, stage: str = "stage", ok: str = "ok", projected_to: int | None = None) -> DataFrame:
    """Tokens and dollars per stage with a TOTAL row; billed rows that are not ``ok`` are counted
    apart (all_cost), and the ok cost is projected to a corpus size."""
    good = F.col("status") == ok
    rolled = usage.rollup(stage).agg(
        F.count_if(good).alias("papers"),
        F.coalesce(F.sum(F.when(good, T.safe_int(F.col("in_tok")))), F.lit(0)).alias("in_tok"),
        F.coalesce(F.sum(F.when(good, T.safe_int(F.col("out_tok")))), F.lit(0)).alias("out_tok"),
        F.coalesce(F.sum(F.when(good, F.col("cost_usd"))), F.lit(0.0)).alias("ok_cost"),
        F.sum("cost_usd").alias("all_cost"),
        F.grouping(stage).alias("__total"),
    )
    out = rolled.withColumn(stage, F.when(F.col("__total") == 1, "TOTAL").otherwise(F.col(stage))).drop("__total")
    if projected_to:
        out = out.withColumn("projected", F.try_divide(F.col("ok_cost") * projected_to, F.col("papers")))
    return out


def judge_fraction(disputes: DataFrame, usage: DataFrame, coder: str = "coder") -> DataFrame:
    """Papers in dispute as a share of the papers of the coder that finished most."""
    most = usage.where("status = 'ok'").groupBy(coder).count().agg(F.max("count").alias("most"))
    return disputes.agg(F.count("*").alias("disputes")).crossJoin(most).select("disputes", "most", F.try_divide(F.col("disputes").cast("double"), F.col("most")).alias("fraction"))


def database_totals(rows: DataFrame) -> DataFrame:
    """Rows (phase, filename, scale_name, has_item) -> files, files with and without items, scales
    with items and in all, and items, for each phase and combined. Items are summed, all else is
    distinct: a file counts once though both phases ran it. One expansion, one aggregate."""
    keyed = rows.select("phase", T.base_name("filename").alias("f"), T.folded("scale_name").alias("s"), "has_item")
    files = keyed.groupBy("phase", "f").agg(F.max("has_item").alias("with_item"), F.sum(F.col("has_item").cast("int")).alias("items"))
    scales = keyed.where("s <> ''").groupBy("phase", "f", "s").agg(F.max("has_item").alias("with_item"))

    def per(df, keys, aggs):
        one = df.groupBy(F.col("phase").cast("string").alias("scope")).agg(*aggs)
        both = df.groupBy(*keys).agg(F.max("with_item").alias("with_item"), *([F.sum("items").alias("items")] if "items" in df.columns else []))
        return one.unionByName(both.agg(*aggs).withColumn("scope", F.lit("combined")))

    f = per(files, ["f"], [F.count("*").alias("files"), F.count_if("with_item").alias("files_with_items"), F.count_if(~F.col("with_item")).alias("files_without_items"), F.coalesce(F.sum("items"), F.lit(0)).alias("items")])
    s = per(scales, ["f", "s"], [F.count_if("with_item").alias("scales_with_items"), F.count("*").alias("scales")])
    return f.join(s, "scope", "left").na.fill(0, ["scales_with_items", "scales"])


def source_agreement(pairs: DataFrame, by: str, tolerance: dict[str, float]) -> DataFrame:
    """Final and source values (final_<field>, <field>) in long form per source: the share of papers
    whose value is within the field's tolerance. A final null isn't counted; a source null is a miss."""
    aggs = []
    for field, tol in tolerance.items():
        final, own = F.col(f"final_{field}"), F.col(field)
        aggs.append(F.avg(F.when(final.isNotNull(), F.coalesce((F.abs(final - own) <= tol).cast("double"), F.lit(0.0)))).alias(f"{field}_agrees"))
    return pairs.groupBy(by).agg(F.count("*").alias("papers"), *aggs)


def record_recall(final: DataFrame, given: DataFrame, ran: DataFrame, by: str, paper: str) -> DataFrame:
    """How much of the final records each source had: (by, papers, scales_recall, items_recall), means over the
    papers that it ran on and whose final record has any; null where there are none. ``final`` (paper, kind, key) and
    ``given`` (by, paper, kind, key) hold the keys of both kinds, scales and items, where repeats and blanks don't
    count; ``ran`` (by, paper) says what each source ran on, also where it gave nothing."""
    held = final.where("key <> ''").select(paper, "kind", "key").distinct()
    sizes = held.groupBy(paper, "kind").agg(F.count("*").alias("n"))
    hits = given.select(by, paper, "kind", "key").distinct().join(held, [paper, "kind", "key"]).groupBy(by, paper, "kind").agg(F.count("*").alias("hits"))
    ran = ran.select(by, paper).distinct()
    each = ran.join(sizes, paper).join(hits, [by, paper, "kind"], "left").withColumn("share", F.coalesce("hits", F.lit(0)) / F.col("n"))
    means = each.groupBy(by).agg(*[F.avg(F.when(F.col("kind") == k, F.col("share"))).alias(f"{k}_recall") for k in ("scales", "items")])
    return ran.groupBy(by).agg(F.count("*").alias("papers")).join(means, by, "left")
