"""The cleaning funnel: filters, rank-based deduplication of scales and items, audit mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators.ordinal import ordinal

# Scale names that name no scale; they are never deduplicated.
GENERIC_SCALES = [
    "demographics", "demographic questions", "demographic items",
    "contextual variables", "contextual items", "contextual questions",
    "background variables", "background questions",
    "single items", "single item measures",
]


USABLE = "needs_review = 0 and extraction_status = 'success' and item_text_english is not null"
UNUSABLE = "needs_review <> 0 or extraction_status <> 'success' or item_text_english is null"


def usable(rows: DataFrame) -> DataFrame:
    """P1."""
    return rows.where(USABLE)


def unusable(rows: DataFrame) -> DataFrame:
    """The negation spelled as alternatives. Under nulls it is not the complement of P1, and rows
    in neither are what ``unaccounted`` reports."""
    return rows.where(UNUSABLE)


def unaccounted(rows: DataFrame) -> DataFrame:
    kept, gone = (F.coalesce(F.expr(x), F.lit(False)) for x in (USABLE, UNUSABLE))
    return rows.where(~kept & ~gone)


def scale_occurrences(rows: DataFrame, ties: bool = True) -> DataFrame:
    """With the size of each scale occurrence, the number of occurrences of its name, and
    keep_scale: the largest occurrence (all tied ones, unless ``ties`` is false) or a generic name.

    Sizes come from one aggregate over (name, occurrence); ranks are over occurrences, not rows.
    Needs scale_name and scale_occurrence_id."""
    named = rows.withColumn("scale_clean", T.clean_key("scale_name"))
    occ = named.groupBy("scale_clean", "scale_occurrence_id").agg(F.count("*").alias("scale_size"))
    # the best occurrence of a name by an aggregate, so that a frequent name is no window of its own
    best = occ.groupBy(F.col("scale_clean").alias("__name")).agg(
        F.count("*").alias("scale_occurrences"), F.max("scale_size").alias("__most"), F.min(F.struct(-F.col("scale_size"), "scale_occurrence_id")).alias("__best")
    )
    occ = occ.join(best, occ["scale_clean"].eqNullSafe(F.col("__name")))
    largest = F.col("scale_size") == F.col("__most")
    if not ties:
        largest &= F.col("scale_occurrence_id").eqNullSafe(F.col("__best.scale_occurrence_id"))
    generic = F.coalesce(F.col("scale_clean").isin(GENERIC_SCALES), F.lit(False))
    occ = occ.select("scale_clean", "scale_occurrence_id", "scale_size", "scale_occurrences", (largest | generic).alias("keep_scale"))
    same = named["scale_clean"].eqNullSafe(occ["scale_clean"]) & named["scale_occurrence_id"].eqNullSafe(occ["scale_occurrence_id"])
    return named.join(occ, same).select(named["*"], "scale_size", "scale_occurrences", "keep_scale")


def group_labels(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The number of each key from 1, in the order of keys, null last: ordinals of the distinct keys, which are
    dealt out by range, so no beginning that many keys share is one task."""
    keys = rows.select(F.col(key).alias("__k")).distinct().withColumn("__none", F.col("__k").isNull())
    label = ordinal(keys, ["__none", "__k"], name, 1).drop("__none")
    return rows.join(label, rows[key].eqNullSafe(F.col("__k"))).drop("__k")


def item_duplicates(rows: DataFrame) -> DataFrame:
    """item_clean, item_dup_count, and keep_item: the row of the largest scale, then the least
    row_id, for each item text. Needs item_text_english, scale_size and row_id, which names one row."""
    item = rows.withColumn("item_clean", T.clean_key("item_text_english"))
    size = F.coalesce("scale_size", F.lit(0))
    # nulls last: a row_id that is null comes after all others
    place = F.struct((-size).alias("size"), F.col("row_id").isNull().alias("none"), F.col("row_id").alias("row_id"))
    best = item.groupBy(F.col("item_clean").alias("__item")).agg(F.count("*").alias("item_dup_count"), F.min(place).alias("__best"))
    met = item.join(best, item["item_clean"].eqNullSafe(F.col("__item")))
    return met.select(item["*"], "item_dup_count", place.eqNullSafe(F.col("__best")).alias("keep_item"))


def mapping(rows: DataFrame, count: str, columns: list[str]) -> DataFrame:
    """What happened to every row that has duplicates."""
    return rows.where(F.col(count) > 1).select(*columns).distinct()


def relevant(rows: DataFrame) -> DataFrame:
    """P3."""
    return rows.where("measures_social_connection = 'YES'")


def irrelevant(rows: DataFrame) -> DataFrame:
    """P3's true complement: a null is irrelevant."""
    return rows.where("measures_social_connection <> 'YES' or measures_social_connection is null")


# The columns of the cleaned table.
FINAL_COLUMNS = ["row_id", "origin_id", "scale_occurrence_id", "scale_dup_group", "item_dup_group", "title", "country_study", "scale_name", "subscale", "item_text_original", "item_text_english"]


def final_columns(rows: DataFrame) -> DataFrame:
    """P4."""
    return rows.select(*FINAL_COLUMNS)


def batch_summary(rows: DataFrame, batch: str = "source_batch") -> DataFrame:
    """A3 with A1 and A2: per batch the rows, distinct files and scales, rows with text, rows to review,
    and files flagged for review (distinct pairs first, A4)."""
    flagged = T.truthy(F.col("needs_review"))
    return rows.groupBy(batch).agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("filename").alias("n_files"),
        F.count_distinct("filename", "scale_name").alias("n_scales"),
        F.count_if(F.col("item_text_english").isNotNull()).alias("n_items"),
        F.count_if(flagged).alias("n_review"),
        F.count_distinct(F.when(flagged, F.col("filename"))).alias("n_files_review"),
    )
