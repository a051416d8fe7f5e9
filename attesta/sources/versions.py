"""Tables that change as a whole: each version in a folder of its own, and a manifest that says which holds.

A new version is written beside the old one and then swapped in by its manifest entry, one small file that is
made only if it is not there. So a reader sees the old rows or the new ones, never parts; a run that dies before
the swap leaves the old version, and what it wrote is nobody's; of two writers of one version, one fails."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from attesta.sources import sinks

_ENTRIES, _DATA = "_manifest", "data"


class Conflict(RuntimeError):
    """Another writer has made this version."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm


def _entries(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, folder) of the manifest, oldest first; an entry whose writer died while making it is none."""
    fs, at, jvm = _files(spark, f"{path}/{_ENTRIES}")
    if not fs.exists(at):
        return []
    out = []
    for s in fs.listStatus(at):
        if s.isFile() and s.getLen():
            stream = fs.open(s.getPath())
            try:
                out.append((int(s.getPath().getName()), stream.readUTF()))
            finally:
                stream.close()
    return sorted(out)


def version(spark: SparkSession, path: str) -> int:
    """The number of the version that holds, 0 if there is none."""
    return max((n for n, _ in _entries(spark, path)), default=0)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the version that holds."""
    held = _entries(spark, path)
    if not held:
        raise FileNotFoundError(f"no version in {path}")
    return spark.read.parquet(f"{path}/{held[-1][1]}")


def stage(df: DataFrame, path: str) -> str:
    """Writes rows that no version has yet; returns the folder, for ``swap``."""
    folder = f"{_DATA}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return folder


def swap(spark: SparkSession, path: str, folder: str, base: int) -> int:
    """Makes the folder the version after ``base``, the one that its rows were made from."""
    if version(spark, path) != base:
        raise Conflict(f"{path} is no longer at version {base}")
    fs, at, _ = _files(spark, f"{path}/{_ENTRIES}/{base + 1:010d}")
    if fs.exists(at) and not fs.getFileStatus(at).getLen():
        fs.delete(at, False)  # its writer died
    try:
        stream = fs.create(at, False)
    except Exception as made:
        raise Conflict(f"{path} has a version {base + 1} already") from made
    stream.writeUTF(folder)
    stream.close()
    return base + 1


def replace(df: DataFrame, path: str, base: int | None = None) -> int:
    """Writes the rows and makes them the next version."""
    spark = df.sparkSession
    base = version(spark, path) if base is None else base
    return swap(spark, path, stage(df, path), base)


def upsert(new: DataFrame, path: str, key: str, ordinal: str) -> int:
    """K6: the next version has one row per key, the new one if there is one; keys keep the table's order, new
    ones follow in theirs. The first version has the new rows alone."""
    spark = new.sparkSession
    base = version(spark, path)
    old = read(spark, path) if base else new.limit(0)
    return swap(spark, path, stage(sinks.upserted(old, new, key, ordinal), path), base)


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes the folders of all but the last ``keep`` versions, and those of no version; none may be writing. Returns how many."""
    held = _entries(spark, path)
    stay = {folder for _, folder in held[-keep:]}
    fs, at, jvm = _files(spark, f"{path}/{_DATA}")
    gone = [s.getPath() for s in fs.listStatus(at) if f"{_DATA}/{s.getPath().getName()}" not in stay] if fs.exists(at) else []
    for n, _ in held[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{_ENTRIES}/{n:010d}"), False)
    for folder in gone:
        fs.delete(folder, True)
    return len(gone)
