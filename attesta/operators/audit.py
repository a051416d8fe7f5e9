"""The integrity audit: one row for each problem; an empty result is a clean export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def reconcile(expected: DataFrame, actual: DataFrame, key: str, counts: list[str]) -> DataFrame:
    """Per key the expected and actual counts where they differ, a side that lacks the key included."""
    e = expected.select(F.col(key).alias("__e"), *[F.col(c).alias(f"expected_{c}") for c in counts])
    a = actual.select(F.col(key).alias("__a"), *[F.col(c).alias(f"actual_{c}") for c in counts])
    met = e.join(a, F.col("__e") == F.col("__a"), "full")
    problem = F.when(F.col("__a").isNull(), "missing").when(F.col("__e").isNull(), "orphan")
    differ = F.lit(False)
    for c in counts:
        differ = differ | ~F.col(f"expected_{c}").eqNullSafe(F.col(f"actual_{c}"))
    return met.where(differ).select(F.coalesce("__e", "__a").alias(key), F.coalesce(problem, F.lit("count")).alias("problem"), *[x for c in counts for x in (f"expected_{c}", f"actual_{c}")])


def duplicates_within(items: DataFrame, by: list[str], key: str) -> DataFrame:
    """Surplus copies of a key within its group."""
    return items.where(F.col(key) != "").groupBy(*by, key).agg((F.count("*") - 1).alias("surplus")).where("surplus > 0")


def in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys resolved twice."""
    return a.select(key).intersect(b.select(key))


def expected_rows(records: DataFrame) -> DataFrame:
    """Rows and items that a record flattens to, straight from its arrays: a scale without items
    is one row, a record without scales is one row."""
    scales = F.col("scales")
    per = F.transform(scales, lambda s: F.greatest(F.coalesce(F.size(s["items"]), F.lit(0)), F.lit(1)))
    n = F.aggregate(per, F.lit(0), lambda total, x: total + x)
    text = lambda i: (F.coalesce(F.trim(i["item_text_original"]), F.lit("")) != "") | (F.coalesce(F.trim(i["item_text_english"]), F.lit("")) != "")
    with_text = F.aggregate(F.transform(scales, lambda s: F.size(F.filter(s["items"], text))), F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))
    empty = F.coalesce(F.size(scales), F.lit(0)) < 1
    return records.select("paper_id", F.when(empty, 1).otherwise(n).cast("long").alias("n_rows"), F.when(empty, 0).otherwise(with_text).cast("long").alias("n_items"))


def split(rows: DataFrame, outcome: Column, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Writes the rows by their outcome, kept, removed or unaccounted, and counts them in the same pass, by metrics
    of the write, so that input = kept + removed + unaccounted is what was really written. Returns the kept
    rows, read again, and the counts. A null outcome is unaccounted."""
    seen = Observation()
    tagged = rows.withColumn("__outcome", F.coalesce(outcome, F.lit("unaccounted")))
    is_ = lambda o: F.count_if(F.col("__outcome") == o).alias(o)
    tagged.observe(seen, F.count(F.lit(1)).alias("input"), is_("kept"), is_("removed"), is_("unaccounted")).write.partitionBy("__outcome").parquet(path)
    written = rows.sparkSession.read.schema(tagged.schema).parquet(path)
    return written.where("__outcome = 'kept'").drop("__outcome"), dict(seen.get)
