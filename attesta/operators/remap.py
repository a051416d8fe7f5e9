"""Disposition of items against coded sets, tiered look-ups and carrying codes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as T


def first_wins(rows: DataFrame, key: Column, value: str, ordinal: str) -> DataFrame:
    """(key, code) with the value of the first row of each key that isn't empty."""
    held = rows.select(key.alias("key"), F.col(value).alias("code"), F.col(ordinal).alias("__o")).where("key <> ''")
    return held.groupBy("key").agg(F.min_by("code", "__o").alias("code"))


def disposition(items: DataFrame, coded: DataFrame) -> DataFrame:
    """Items (row_id, key) against coded (key, code) -> disposition: already_coded with the code
    it inherits (which may be blank), internal_dup with the first row of its key, else new."""
    met = items.join(coded.withColumn("__held", F.lit(True)), "key", "left").withColumn("__held", F.coalesce("__held", F.lit(False)))
    # the first row of a key by an aggregate, so that a frequent key is no window of its own
    first = met.where("not __held").groupBy(F.col("key").alias("__key")).agg(F.min("row_id").alias("__first"))
    met = met.join(first, met["key"].eqNullSafe(F.col("__key")), "left")
    held, later = F.col("__held"), F.col("row_id") != F.col("__first")
    what = F.when(held, "already_coded").when(later, "internal_dup").otherwise("new")
    return met.select("row_id", "key", what.alias("disposition"), F.when(held, F.col("code")).alias("inherit_final_coding"), F.when(~held & later, F.col("__first")).alias("maps_to_row_id"))


def tiered(items: DataFrame, tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Tables of (key, code) and the item columns to look up in each, in order of priority; the
    first code that isn't blank wins. One look-up on (priority, key) instead of a join per tier.

    Tables that are asked by one column meet first, and keys go as digests of 128 bits, as they may be long: an item is
    one narrow row for each column, however many tables it asks. items needs row_id; adds code and tier (1 for the
    first, null if none)."""
    digest = lambda c: F.unhex(F.md5(F.col(c)))
    slots = list(dict.fromkeys(keys))
    asked = items.select("row_id", F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.when(F.col(k) != "", digest(k)).alias("key")) for i, k in enumerate(slots)])).alias("x")).select("row_id", "x.slot", "x.key").where("key is not null")
    known = None
    for i, (table, k) in enumerate(zip(tables, keys, strict=True), 1):
        one = table.where("code <> ''").select(F.lit(slots.index(k)).alias("slot"), digest("key").alias("key"), F.lit(i).alias("tier"), "code")
        known = one if known is None else known.unionByName(one)
    first = known.groupBy("slot", "key").agg(F.min_by("code", "tier").alias("code"), F.min("tier").alias("tier"))
    best = asked.join(first, ["slot", "key"]).groupBy("row_id").agg(F.min_by("code", "tier").alias("code"), F.min("tier").alias("tier"))
    return items.join(best, "row_id", "left")


def fallback(items: DataFrame, new: tuple[DataFrame, DataFrame], old: tuple[DataFrame, DataFrame], original: str, english: str) -> DataFrame:
    """The code of an item by eight look-ups in this order: among the new codes the exact keys of the original and
    of the English wording, then the loose keys of both; then the same among the old codes. items (row_id,
    original, english); ``new`` and ``old``: tables (key, code) by exact and by loose keys (``item_keys``). Adds
    code and tier, 1 to 8, both null where nothing has one."""
    kinds = (T.match_norm, T.match_aggressive)
    keyed = items.select("row_id", *[f(c).alias(f"{k}{i}") for i, f in enumerate(kinds) for k, c in (("o", original), ("e", english))])
    tables = [t for pair in (new, old) for t in pair for _ in range(2)]
    found = tiered(keyed, tables, ["o0", "e0", "o1", "e1"] * 2)
    return items.join(found.select("row_id", "code", "tier"), "row_id", "left")


def through_twin(rows: DataFrame) -> DataFrame:
    """A row without a code takes that of the row it points to (maps_to_row_id, one step deep)."""
    twin = rows.select(F.col("row_id").alias("maps_to_row_id"), F.col("code").alias("__twin"))
    met = rows.where("maps_to_row_id is not null").join(twin, "maps_to_row_id", "left")
    met = met.withColumn("code", F.coalesce(F.nullif("__twin", F.lit("")), "code")).drop("__twin")
    # most rows point nowhere: they stay out of the join, where null would be one hot key
    return met.unionByName(rows.where("maps_to_row_id is null"))


def carried_back(kept: DataFrame, item_map: DataFrame, removed_scales: DataFrame) -> DataFrame:
    """Codes of the kept rows (row_id, item_dup_group, item_clean, code) on every duplicate:
    the kept rows, duplicate items by their group, and items of removed scales by their text, each with
    its status. A text without a kept row has no code."""
    by_group = kept.select("item_dup_group", "code").distinct()
    by_text = kept.groupBy("item_clean").agg(F.min_by("code", "row_id").alias("code"))
    a = kept.select("row_id", "code", F.lit("kept_item").alias("status"))
    b = item_map.where(~F.col("keep_item")).join(by_group, "item_dup_group", "left").select("row_id", "code", F.lit("duplicate_item").alias("status"))
    text = by_text.withColumnRenamed("item_clean", "__t")
    c = removed_scales.join(text, removed_scales["item_clean"].eqNullSafe(F.col("__t")), "left").select("row_id", "code", F.lit("duplicate_scale").alias("status"))
    return a.unionByName(b).unionByName(c)


def item_keys(rows: DataFrame, original: str, english: str) -> DataFrame:
    """The four look-up keys of J10: match and aggressive forms of both texts."""
    return rows.withColumns({
        "t1_original": T.match_norm(original), "t1_english": T.match_norm(english),
        "t2_original": T.match_aggressive(original), "t2_english": T.match_aggressive(english),
    })
