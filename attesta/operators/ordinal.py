"""Ordinals that stay: the place of each row in an order over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.sources.scratch import shared


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, by ``checkpoint()`` in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def ordinal(rows: DataFrame, order: list[str], name: str, first: int = 0) -> DataFrame:
    """Adds ``name``, the row's place from ``first`` in the order of the columns, nulls first. It is computed
    once, so later steps see the same numbers whatever they read. Rows equal in all columns of ``order``
    take places in any order.

    Rows are dealt out by range and counted within their partition; one number for each partition
    reaches the driver."""
    keys = [F.col(c) for c in order]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id())
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)).cast("long")
    held = kept(dealt.withColumn("__within", within))
    sums = held.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect()
    before, at = [0] * (max((r[0] for r in sums), default=0) + 1), first - 1
    for part, n in sums:
        before[part], at = at, at + n
    starts = F.array(*[F.lit(x).cast("long") for x in before])
    return held.withColumn(name, F.get(starts, F.col("__part")) + F.col("__within")).drop("__part", "__within")
