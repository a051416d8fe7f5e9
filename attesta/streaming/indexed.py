"""Appending by an index of keys: a micro-batch opens only the files that may hold its keys.

A table is a folder with ``rows``, in folders by batch, and ``keys``: the keys alone, in folders by a digest of the key
(its hash in ``buckets``) and by batch. A batch looks up its keys in the folders of their digests, never in the rows. It
writes its rows, then their keys, each in folders of its own number, which a run that comes again replaces; so a
batch that died half-way, or is told twice, ends as if it had run once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _folders(spark: SparkSession, path: str, found: list[int]) -> list[str]:
    """The folders of these digests that are there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/keys")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    held = {s.getPath().getName() for s in fs.listStatus(at)}
    return [f"{path}/keys/bucket={b}" for b in found if f"bucket={b}" in held]


def known(spark: SparkSession, keys: DataFrame, key: str, path: str, batch: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(key): what the table holds of the digests of these keys, but for what ``batch`` has written."""
    found = sorted(r[0] for r in keys.select(_bucket(key, buckets)).distinct().collect())  # at most so many numbers
    folders = _folders(spark, path, found)
    if not folders:
        return keys.select(key).limit(0)
    held = spark.read.option("basePath", f"{path}/keys").schema(f"{key} {dict(keys.dtypes)[key]}, bucket int, batch long").parquet(*folders)
    return (held if batch is None else held.where(F.col("batch") != batch)).select(key)


def append(rows: DataFrame, batch: int, path: str, key: str, buckets: int = BUCKETS) -> int:
    """K5, K7: adds the rows whose key the table lacks, one of each key, as batch number ``batch``; returns how many. Rows
    without a key are left out."""
    spark = rows.sparkSession
    new = rows.where(F.col(key).isNotNull()).dropDuplicates([key])
    fresh = new.join(known(spark, new, key, path, batch, buckets), key, "left_anti").select(*rows.columns)
    at = f"{path}/rows/batch={batch}"
    fresh.write.mode("overwrite").parquet(at)
    held = spark.read.schema(rows.schema).parquet(at).select(key)
    own = held.withColumns({"bucket": _bucket(key, buckets), "batch": F.lit(batch).cast("long")})
    own.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{path}/keys")
    return held.count()


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table's rows."""
    return spark.read.schema(schema).parquet(f"{path}/rows").drop("batch")


def append_stream(spark: SparkSession, source: str, schema, path: str, checkpoint: str, key: str = "paper_id", flatten: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS):
    """T4: takes the files that have arrived in ``source`` and appends the papers that the table lacks; ends once all are
    taken. Batches are numbered by the checkpoint, which belongs to the table."""

    def each(batch: DataFrame, number: int) -> None:
        append(flatten(batch) if flatten else batch, number, path, key, buckets)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
