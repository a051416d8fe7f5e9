"""Which papers two coders agree on, and which go to a judge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tolerances of numeric fields.
TOLERANCES = {"total_n": 0.0, "age_mean": 0.5, "age_sd": 0.5, "gender_pct_female": 2.0}
CATEGORIES = ["study_type", "quality_flag"]


def scalar_disputes(a: str, b: str) -> Column:
    """Names of the fields in dispute between the structs a and b: n_samples, categories as text,
    and numbers that both give, beyond their tolerance. A missing number abstains."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    found = [F.when(~F.col(f"{a}.n_samples").eqNullSafe(F.col(f"{b}.n_samples")), "n_samples")]
    found += [F.when(text(f"{a}.{c}") != text(f"{b}.{c}"), c) for c in CATEGORIES]
    found += [F.when(F.abs(F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) > tol, c) for c, tol in TOLERANCES.items()]
    return F.array_compact(F.array(*found))


def content_disputes(items_a: Column, items_b: Column, scales_a: Column, scales_b: Column) -> Column:
    """E14: 'items' and 'scales' where the coders' key sets differ."""
    differ = lambda x, y: F.array_sort(F.array_distinct(x)) != F.array_sort(F.array_distinct(y))
    return F.array_compact(F.array(F.when(differ(items_a, items_b), "items"), F.when(differ(scales_a, scales_b), "scales")))


def routed(a: DataFrame, b: DataFrame, fields: list[str], locked: DataFrame | None = None) -> DataFrame:
    """(paper_id, route, disputes) over both coders' rows (paper_id, fields..., items, scales):
    agreement, dispute, or single_coder; papers in ``locked`` are left out."""
    pack = lambda df, name: df.select("paper_id", F.struct(*fields, "items", "scales").alias(name))
    met = pack(a, "a").join(pack(b, "b"), "paper_id", "full")
    if locked is not None:
        met = met.join(locked.select("paper_id"), "paper_id", "left_anti")
    one = F.col("a").isNull() | F.col("b").isNull()
    disputes = F.when(one, F.array(F.lit("single_coder"))).otherwise(F.concat(scalar_disputes("a", "b"), content_disputes(F.col("a.items"), F.col("b.items"), F.col("a.scales"), F.col("b.scales"))))
    return met.select("paper_id", disputes.alias("disputes")).withColumn("route", F.when(F.array_contains("disputes", "single_coder"), "single_coder").when(F.size("disputes") > 0, "dispute").otherwise("agreement"))


def aligned(a: DataFrame, b: DataFrame, fields: list[str], key: str = "paper_id") -> DataFrame:
    """The two raters' values side by side, <field>_a and <field>_b, of the papers that both rated."""
    side = lambda df, end: df.select(key, *[F.col(f).alias(f"{f}_{end}") for f in fields])
    return side(a, "a").join(side(b, "b"), key)


def scale_counts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Items per scale of either coder, with a marker where they differ."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    met = count(a, "n_a").join(count(b, "n_b"), keys, "full").na.fill(0, ["n_a", "n_b"])
    return met.withColumn("differs", F.col("n_a") != F.col("n_b"))


def brief(paper: Column, disputes: Column, a: Column, b: Column, source: Column, limit: int = 100_000) -> Column:
    """The judge's message: what is in dispute, both records, and the source up to a limit."""
    return F.concat_ws("\n\n", F.concat(F.lit("PAPER "), paper), F.concat(F.lit("DISPUTES: "), F.array_join(disputes, "; ")), F.concat(F.lit("CODER A:\n"), F.to_json(a)), F.concat(F.lit("CODER B:\n"), F.to_json(b)), F.concat(F.lit("SOURCE:\n"), F.substring(source, 1, limit)))
