"""Statistics of agreement between two raters, each in one pass over the pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions.text import kappa_band


def categorical(pairs: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Percent agreement, Cohen's kappa and PABAK of two ratings, as text, null a category of its own.

    The pairs shrink to their crosstab before anything else, so the rest is over categories.
    kappa is null if chance agreement is 1; PABAK is 1 with fewer than two categories."""
    by = by or []
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    cells = pairs.groupBy(*by, text(a).alias("__a"), text(b).alias("__b")).agg(F.count("*").alias("__n"))
    sides = cells.select(*by, F.explode(F.array(F.struct(F.col("__a").alias("k"), F.col("__n").alias("na"), F.lit(0).cast("long").alias("nb")), F.struct(F.col("__b").alias("k"), F.lit(0).cast("long").alias("na"), F.col("__n").alias("nb")))).alias("s"))
    margins = sides.groupBy(*by, "s.k").agg(F.sum("s.na").alias("na"), F.sum("s.nb").alias("nb"))
    chance = margins.groupBy(*by).agg(F.sum(F.col("na") * F.col("nb")).alias("__both"), F.count("*").alias("categories"))
    raw = cells.groupBy(*by).agg(F.sum("__n").alias("n"), F.sum(F.when(F.col("__a") == F.col("__b"), F.col("__n")).otherwise(0)).alias("__same"))
    met = raw.join(chance, by) if by else raw.crossJoin(chance)  # one row each
    po = F.col("__same") / F.col("n")
    pe = F.col("__both") / (F.col("n") * F.col("n")).cast("double")
    q = F.col("categories")
    kappa = F.when(F.col("__both") != F.col("n") * F.col("n"), (po - pe) / (1 - pe))
    out = met.select(*by, "n", "categories", po.alias("agreement"), kappa.alias("kappa"), F.when(q <= 1, 1.0).otherwise((q * po - 1) / F.nullif(q - 1, F.lit(0))).alias("pabak"))
    return out.withColumn("band", kappa_band(F.col("kappa")))


def icc(x: Column, y: Column) -> Column:
    """ICC(A,1) of two raters from moments about a common shift; null for fewer than two pairs."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    n = F.count(x)
    sx, sy = F.avg(x), F.avg(y)
    varx, vary, cov = F.var_pop(x) * n, F.var_pop(y) * n, F.covar_pop(x, y) * n
    # sums of squares about the grand mean, through those about each rater's mean
    ssc = n * (sx - sy) * (sx - sy) / 2
    ssr = (varx + vary + 2 * cov) / 2
    sse = (varx + vary - 2 * cov) / 2
    msr, msc, mse = F.try_divide(ssr, n - 1), ssc, F.try_divide(sse, n - 1)
    below = msr + mse + 2 * (msc - mse) / F.nullif(n, F.lit(0))
    return F.when(n < 2, None).when(below == 0, F.when(msr == mse, 1.0)).otherwise(F.try_divide(msr - mse, below))


def pearson(x: Column, y: Column) -> Column:
    """Null for fewer than two pairs or a constant side."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.when(F.count(x) >= 2, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def mean_absolute(x: Column, y: Column) -> Column:
    return F.avg(F.abs(x - y))


def within(x: Column, y: Column, tolerance: float) -> Column:
    """Share of pairs within the tolerance: of rows where either is there, those where both are."""
    hit = F.count_if(F.abs(x - y) <= tolerance)
    return F.try_divide(hit.cast("double"), F.count_if(x.isNotNull() | y.isNotNull()))


def jaccard(a: Column, b: Column) -> Column:
    """Of two key arrays; null if both are empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)))
