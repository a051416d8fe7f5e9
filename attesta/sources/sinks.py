"""Sinks: delimited and JSON files, append-only and keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def once(columns: list[str]) -> list[str]:
    """K2: each column once, in order."""
    return list(dict.fromkeys(columns))


def csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """K1: the columns in their order, others left out, missing ones and nulls as ''; outer blanks stay."""
    have = [(F.col(c) if c in df.columns else F.lit("")).cast("string").alias(c) for c in once(columns)]
    df.select(*have).na.fill("").write.mode(mode).csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def json_per_key(df: DataFrame, path: str, key: str = "paper_id") -> None:
    """K4."""
    df.write.mode("overwrite").partitionBy(key).json(path)


def requests(df: DataFrame, body: Column, path: str, key: str = "paper_id", prefix: str = "paper-") -> None:
    """K8: one request line per row."""
    df.select(F.to_json(F.struct(F.concat(F.lit(prefix), F.col(key)).alias("key"), body.alias("request"))).alias("value")).write.mode("overwrite").text(path)


def new_only(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows whose key the table lacks, in the table's columns."""
    fresh = new.join(old.select(key).distinct(), key, "left_anti")
    return fresh.select(*[(F.col(c) if c in fresh.columns else F.lit(None).cast(dict(old.dtypes)[c])).alias(c) for c in old.columns])


def append_new(spark: SparkSession, new: DataFrame, path: str, key: str, delta: str | None = None) -> int:
    """K5: appends them, old rows are never rewritten; the delta goes to a path of its own. Doing it again
    appends nothing. The delta is written first and appended from there, so both hold the same rows."""
    fresh = new_only(new, spark.read.parquet(path), key)
    at = delta or f"{path}_delta"
    fresh.write.mode("overwrite").parquet(at)
    rows = spark.read.schema(fresh.schema).parquet(at)
    n = rows.count()
    if n:
        rows.write.mode("append").parquet(path)
    return n


def upserted(old: DataFrame, new: DataFrame, key: str, ordinal: str) -> DataFrame:
    """K6: one row per key, the new one if there is one, with the column ``ordinal``: keys keep the table's
    order, new ones follow in theirs. Both tables bring their own ``ordinal`` (W1); of several new rows of one
    key the last wins. The best row is picked by an aggregate, so a frequent key is no window of its own."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (key, "__new")]
    top = both.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct("__new", ordinal)).alias("__r"), F.min(F.struct("__new", ordinal)).alias("__place"))
    most = F.coalesce(F.max(F.when(F.col("__new") == 0, F.col(ordinal))), F.lit(-1))
    met = top.crossJoin(F.broadcast(both.agg(most.alias("__most"))))  # a single row
    place = F.when(F.col("__place.__new") == 0, F.col(f"__place.{ordinal}")).otherwise(F.col("__most") + 1 + F.col(f"__place.{ordinal}"))
    return met.select(*[(F.col(key) if c == key else place if c == ordinal else F.col(f"__r.{c}")).alias(c) for c in both.columns if c != "__new"])


def rebuild(df: DataFrame, path: str, locked: DataFrame, key: str = "paper_id") -> None:
    """Overwrites the automatic results, without keys that a judge has settled."""
    df.join(locked.select(key), key, "left_anti").write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """K13."""
    df.write.mode("append").parquet(path)


def summary(metrics: DataFrame, title: str) -> str:
    """A few metrics as text."""
    rows = metrics.collect()
    lines = [title, "=" * len(title)]
    for r in rows:
        lines += [f"{k}: {f'{v:,}' if isinstance(v, int) and not isinstance(v, bool) else f'{v:.3f}' if isinstance(v, float) else v}" for k, v in r.asDict().items()]
    return "\n".join(lines) + "\n"


def spreadsheet(df: DataFrame, path: str, most: int = 1_000_000, writer=None) -> None:
    """K3: one sheet with a frozen header, for lists that people work on: bounded by what a sheet holds.

    Written on the driver by pandas, whose engine may not be installed, or by ``writer`` (frame, path)."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: write Parquet or CSV")
    frame = df.toPandas()
    if writer:
        writer(frame, path)
    else:
        frame.to_excel(path, index=False, freeze_panes=(1, 0))
