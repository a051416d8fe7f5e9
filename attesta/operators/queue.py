"""What may still be worked on, and in which order it leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses that end a paper's way.
TERMINAL = ["ok", "not_pdf", "error", "too_long"]


def within_pages(pages: Column, most: int = 120) -> Column:
    """An unknown number of pages passes."""
    return F.coalesce(pages <= most, F.lit(True))


def pending(papers: DataFrame, log: DataFrame, pages: str, most: int = 120) -> DataFrame:
    """Papers without a terminal status and within the page limit."""
    done = log.where(F.col("status").isin(TERMINAL)).select("paper_id")
    return papers.join(done, "paper_id", "left_anti").where(within_pages(F.col(pages), most))


def has_item(english: Column, original: Column) -> Column:
    """P7."""
    return (F.coalesce(F.trim(english), F.lit("")) != "") | (F.coalesce(F.trim(original), F.lit("")) != "")


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """O1: by the keys, a leading '-' for descending; nulls last either way."""
    return df.orderBy(*[F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys])


def first_offenders(problems: DataFrame, *keys: str, n: int = 20) -> DataFrame:
    """O3, O4."""
    return ordered(problems, *keys).limit(n)


def nth(values: DataFrame, column: str, n: int, buckets: int = 1024):
    """The value at place ``n`` from 0 in the order of a numeric column without nulls, exactly. Each pass counts the values
    by equal buckets of the range that still holds the place, and goes on with its bucket's least and greatest
    value, so no task or sort holds the values, and a few numbers a bucket reach the driver. Whole numbers too near each
    other to differ as doubles are buckets of their own: at most some hundred."""
    v, left = F.col(column), values.select(column)
    low, high = left.agg(F.min(v), F.max(v)).first()
    while low != high:
        held, width = left.where(v.between(low, high)), float(high) / 2 - float(low) / 2  # halves, so that it stays a number
        bucket = F.least(F.floor((v / 2 - F.lit(float(low) / 2)) / width * buckets), F.lit(buckets - 1)) if width > 0 else v
        for r in held.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).orderBy("b").collect():
            if n < r["n"]:
                low, high = r["low"], r["high"]
                break
            n -= r["n"]
    return low


def median(rows: DataFrame, column: str) -> float | None:
    """The exact median without nulls, by selection instead of a sort: the mean of both middle values of an even number."""
    held = rows.where(F.col(column).isNotNull()).select(column)
    n = held.count()
    if not n:
        return None
    low = nth(held, column, (n - 1) // 2)
    return float(low) if n % 2 else (float(low) + float(nth(held, column, n // 2))) / 2


def profile(rows: DataFrame, tokens: str, *pair: str) -> DataFrame:
    """The exact median of the tokens, and distinct pairs without nulls."""
    return rows.agg(F.lit(median(rows, tokens)).cast("double").alias("median_tokens"), F.count_distinct(*pair).alias("pairs"))
